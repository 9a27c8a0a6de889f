"""Quality rules that hold a document against its own figures and against its host.

Every document is measured once.  Failures of the rules are summed by host and shrunk towards the corpus by an empirical
beta prior, so that a host with a few documents is judged mostly by the others.  Hosts whose shrunken rate of some rule is
beyond the limit are rejected, and their verdicts join back to the documents.

Defined results: a null text has no words; a null host has no verdict of its own, and its documents only their own rules; a
null id is a document like another; repeated rows are judged one by one; an empty table gives an empty result.  Input
columns may have any names; an added column replaces one of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.shared import SPACES, WORD, shielded, staged, unshielded

RULES = ("few_words", "repetitive", "symbols", "repeated_lines")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _with_equal_neighbour(ordered: str, same, position) -> Column:
    """Positions of the elements of the array column that have a ``same`` one beside them."""
    after = F.slice(ordered, 2, F.size(ordered))
    pairs = F.zip_with(ordered, after, lambda x, y: F.when(same(x, y), F.array(position(x), position(y))))
    return F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in 3-word windows that occur twice or more; ``q_grams`` has the windows' hashes by start.

    Each hash gives its low part to the window's start, so that sorting plain numbers brings windows of one high part
    together.  Only those are compared by their whole hashes.  The starts that remain add three words each, less what the
    window before already covers.  Each step is a column of its own, so that it is evaluated once.
    """
    n = F.size("q_grams").cast("long")
    high = lambda x: x - F.pmod(x, n)
    rows = rows.withColumn("q_packed", F.sort_array(F.transform("q_grams", lambda h, i: high(F.shiftright(h, 1)) + i)))
    alike = _with_equal_neighbour("q_packed", lambda x, y: high(x) == high(y), lambda x: F.pmod(x, n).cast("int"))
    rows = rows.withColumn("q_alike", F.when(n > 1, alike))
    rows = rows.withColumn("q_whole", F.array_sort(F.transform("q_alike", lambda i: F.struct(F.get("q_grams", i).alias("h"), i.alias("i")))))
    starts = _with_equal_neighbour("q_whole", lambda x, y: x["h"] == y["h"], lambda x: x["i"])
    covered = F.aggregate(
        F.sort_array(starts),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return rows.drop("q_grams", "q_packed", "q_alike", "q_whole")


def measured(rows: DataFrame, text: Column) -> DataFrame:
    """Adds MEASURES of ``text``; windows are compared by 64-bit hashes within a document."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # Both array functions below would otherwise evaluate the splitting again for each use.
    rows = rows.withColumn("q_text", text).withColumn("q_lines", lines).withColumn("q_words", F.regexp_extract_all("q_text", F.lit(f"({WORD})")))
    words = F.col("q_words")
    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    rows = rows.withColumn("q_grams", F.when(F.size(words) >= 3, grams).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": (F.length("q_text") - F.length(F.regexp_replace("q_text", r"[#*$%&|<>]", ""))).cast("long"),
            "n_lines": F.size("q_lines").cast("long"),
            "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
        }
    ).drop("q_text", "q_lines", "q_words")
    return _with_repeat_words(rows)


def host_verdicts(failures: DataFrame, limits: dict[str, float], max_strength: float = 10.0) -> DataFrame:
    """``host, n_docs, <rule>_rate, host_kept`` from rows ``host`` and a 0/1 column for each rule.

    For each rule the hosts' rates give a beta prior by their mean m and variance v over hosts, weighted by documents:
    strength ``m (1 - m) / v - 1``, between 1 and ``max_strength``.  A host's rate is ``(failures + strength m) / (documents +
    strength)``.  The prior weighs at most ``max_strength`` documents, so a host is judged alike in a corpus of any size.
    """
    hosts = failures.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *[F.sum(r).alias(r) for r in limits])
    hosts = staged(hosts, "quality-host-sums")
    sums = [F.sum("n_docs").alias("total")]
    for rule in limits:
        sums += [F.sum(rule).alias(f"s_{rule}"), F.sum(F.col(rule) * F.col(rule) / F.col("n_docs")).alias(f"q_{rule}")]
    # One row, summed by partial sums, that every host gets.
    hosts = hosts.join(F.broadcast(hosts.agg(*sums)))
    for rule in limits:
        mean = F.col(f"s_{rule}") / F.col("total")
        spread = F.col(f"q_{rule}") / F.col("total") - mean * mean
        strength = F.when(spread > 0, mean * (1 - mean) / spread - 1).otherwise(F.lit(max_strength))
        strength = F.least(F.greatest(strength, F.lit(1.0)), F.lit(max_strength))
        hosts = hosts.withColumn(f"{rule}_rate", (F.col(rule) + strength * mean) / (F.col("n_docs") + strength))
    good = [F.col(f"{rule}_rate") <= limit for rule, limit in limits.items()]
    kept = good[0]
    for g in good[1:]:
        kept = kept & g
    return hosts.select("host", "n_docs", *[f"{r}_rate" for r in limits], kept.alias("host_kept"))


def judge(
    documents: DataFrame,
    *,
    text_col: str = "text",
    host_col: str = "source",
    limits: dict[str, float] | None = None,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """The input's columns (of these ``carry``, by default all), MEASURES, ``base_failed, host_kept, kept``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated 3-word windows.  ``kept``: neither that nor a
    rejected host.  ``limits`` has the largest rate of failures that a host may have, by rule; a host is rejected only
    when most of what it has fails, as its good documents go with it.
    """
    limits = limits or dict.fromkeys(RULES, 0.8)
    rows, inner = shielded(documents)
    carried = {name: i for name, i in inner.items() if carry is None or name in carry}
    rows = measured(rows, F.col(inner[text_col])).withColumn("host", F.col(inner[host_col]))
    few, repetitive = F.col("n_words") < 50, 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    rows = rows.withColumns(
        {
            "base_failed": few | repetitive,
            "few_words": few.cast("int"),
            "repetitive": repetitive.cast("int"),
            "symbols": (10 * F.col("n_symbols") > F.col("word_chars")).cast("int"),
            "repeated_lines": (2 * F.col("n_dup_lines") > F.col("n_lines")).cast("int"),
        }
    )
    rows = staged(rows.select(*carried.values(), "host", *MEASURES, "base_failed", *RULES), "quality-measured")
    hosts = host_verdicts(rows.filter("host is not null").select("host", *RULES), limits)
    hosts = staged(hosts.select(F.col("host").alias("h_host"), "host_kept"), "quality-hosts")
    rows = rows.join(hosts, F.col("host") == F.col("h_host"), "left").withColumn("host_kept", F.coalesce("host_kept", F.lit(True)))
    added = [*MEASURES, "base_failed", "host_kept", "kept"]
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).select(*unshielded(carried, added), *added)
