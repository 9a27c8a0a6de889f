from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from messy import DOCUMENTS, documents  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and very long texts, ties, repeated rows, and extra columns whose names clash."""
    return documents(spark, DOCUMENTS).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
