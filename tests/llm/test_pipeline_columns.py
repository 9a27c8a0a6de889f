"""Every stage of the pipeline on awkward rows and on an empty table: further columns come out as they went in."""

from __future__ import annotations

import pytest

import corpus_pipeline

CLASHES = {"size": 7, "target": "t", "kept": "k", "lang_pred": "x", "component_id": "c", "n_removed": "n", "kept_text": "z", "score": 0.5}


@pytest.fixture(scope="module")
def wide(messy):
    from pyspark.sql import functions as F

    return messy.withColumns({c: F.lit(v) for c, v in CLASHES.items()})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_further_columns_stay(spark, sf_dir, wide, name, stage):
    out = stage(spark, wide, sf_dir)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in wide.schema]
    rows = out.collect()
    assert rows and all(r[c] == v for r in rows for c, v in CLASHES.items())
    before = {r.doc_id for r in wide.collect()}
    assert {r.doc_id for r in rows} <= before and {r["n words"] for r in rows} == {5}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_empty_table(spark, sf_dir, nothing, name, stage):
    assert stage(spark, nothing, sf_dir).collect() == []
