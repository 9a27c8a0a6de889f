"""URL filters: allow and block rules, and logistic regression on hashed character n-grams for what no rule fits.

The regression is trained on a small table of labelled URLs and then judges every URL.  Where no table is given, URLs
that a rule fits are the labelled ones; ``max_labelled`` of them at most are used, those with the smallest MD5, so that the
fit is bounded whatever the corpus holds.  Everything runs in the JVM (DataFrame functions and Spark's own estimator).

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and the regression's verdict on
the empty URL; repeated rows are judged one by one; without labelled URLs, or with labels of one kind only, the verdict
is ``allow`` or that kind; an empty table gives an empty result.  Input columns may have any names; an added column replaces
one of the same name.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import shielded, staged, unshielded

Rules = tuple[tuple[str, str], ...]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where ``://`` is missing."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)\A.*?://", ""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(rules: Rules, host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits.  ``rules``: (verdict, host/path), a short list."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _part_grams(mark: str, part: Column, n: int) -> Column:
    whole = F.concat(F.lit("^"), part, F.lit("$"))
    starts = F.sequence(F.lit(1), F.length(whole) - (n - 1))
    grams = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(whole, i, F.lit(n))))
    return F.when(F.length(whole) >= n, grams).otherwise(F.array().cast("array<string>"))


def _grams(host: Column, path: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of host and path, told apart by a mark; both have marks for start and end."""
    return F.concat(*[_part_grams(mark, part, n) for mark, part in (("h", host), ("p", path)) for n in sizes])


def train(
    labelled: DataFrame, *, sizes: tuple[int, ...] = (2, 3, 4), features: int = 1 << 14, max_labelled: int = 20_000, rounds: int = 50
):
    """A model from ``host, path, label`` (1: block), or None if there are none.  Repeated URLs count once."""
    distinct = labelled.filter("label is not null").groupBy("host", "path").agg(F.max("label").alias("label"))
    order = F.md5(F.concat_ws("/", "host", "path"))
    sample = distinct.orderBy(order, "host", "path").limit(max_labelled)
    sample = staged(sample.withColumn("grams", _grams(F.col("host"), F.col("path"), sizes)), "url-labelled")
    if sample.isEmpty():
        return None
    counted = HashingTF(inputCol="grams", outputCol="features", numFeatures=features).transform(sample)
    return LogisticRegression(maxIter=rounds, regParam=1e-3).fit(counted.withColumn("label", F.col("label").cast("double")))


def judge_urls(
    pages: DataFrame,
    rules: Rules,
    *,
    url_col: str = "url",
    labelled: DataFrame | None = None,
    sizes: tuple[int, ...] = (2, 3, 4),
    features: int = 1 << 14,
    max_labelled: int = 20_000,
    limit: float = 0.5,
) -> DataFrame:
    """All input columns plus ``host, path, rule, block_score, verdict``; ``block_score`` is the regression's probability of block."""
    rows, inner = shielded(pages)
    host, path = url_parts(F.col(inner[url_col]))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    if labelled is None:
        labelled = rows.filter("ruled is not null").select("host", "path", (F.col("ruled") == "block").cast("int").alias("label"))
    model = train(labelled, sizes=sizes, features=features, max_labelled=max_labelled)
    if model is None:
        rows = rows.withColumn("block_score", F.lit(0.0))
    else:
        rows = rows.withColumn("grams", _grams(F.col("host"), F.col("path"), sizes))
        rows = model.transform(HashingTF(inputCol="grams", outputCol="features", numFeatures=features).transform(rows))
        rows = rows.withColumn("block_score", vector_to_array("probability")[1])
    judged = F.coalesce("ruled", F.when(F.col("block_score") > limit, "block").otherwise("allow"))
    added = ["host", "path", "rule", "block_score", "verdict"]
    return rows.withColumn("verdict", judged).select(*unshielded(inner, added), *added)
