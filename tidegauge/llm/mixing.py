"""Mixes sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sizes are words.  A source's words are dealt to shards by a seeded hash, so that a source with a third of all rows is as
many independent cells as its size asks for.  Blocks of equal words are apportioned to all cells by the highest quotients
``votes / (2 k + 1)``.  Each cell then takes that many of its blocks: whole passes first, the rest by a seeded
permutation of the block numbers.  Only per-source and per-cell sums leave the scan; words are counted once.

Defined results: a null text has size 0 and gives nothing; null sources are one source, ordered last; a null id is a
document like another (ordered as an empty id); the text takes part in the key, so rows of one id with different texts spread
over the shards in a fixed order; repeated rows are separate documents; an empty table gives an empty
result.  Further input columns may have any names; an added column replaces one of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.shared import WORD, shielded, staged, unshielded, word_count

#: Multiplier of the permutation: a prime above any number of blocks in a cell, so it shares no factor with it.
_PRIME = 2_147_483_647


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    Sources by code point, null last, get the weights in turn.  They share ``share`` times all words; nobody gets more
    than ``cap`` times its size, and the excess is shared again by weight.  With sources in order of ``cap * size /
    weight``, the capped ones are a prefix, and the level of the others is the largest level over all prefixes.
    """
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("ratio", "turn").rowsBetween(Window.unboundedPreceding, -1)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("turn", F.row_number().over(ordered)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    )
    most = F.col("source_size") * F.lit(float(cap))
    per = per.withColumn("ratio", most / F.col("weight"))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return per.select("source", "source_size", F.least(most, F.col("weight") * F.col("level")).alias("target"))


def quotas(cells: DataFrame, block_words: int, cap: float = 2.0) -> DataFrame:
    """Adds ``blocks`` and the integer quota ``seats`` to cells ``source, shard, cell_size, votes`` (words wanted).

    With V votes, M seats and C cells, the divisors V / (M - C/2) and V / (M + C/2) give too few and too many seats in all.
    The seats of the first are certain, so only the quotients between both, 2 C at most, are ranked.
    """
    everything = Window.partitionBy()
    cells = (
        cells.filter("cell_size > 0")
        .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("cell_size") / block_words)).cast("long"))
        .withColumn("all_votes", F.sum("votes").over(everything))
        .withColumn("half", F.count(F.lit(1)).over(everything) / 2)
        .withColumn("all_seats", F.round(F.col("all_votes") / block_words))
    )

    def rounded(seats: Column) -> Column:
        wanted = F.floor(F.col("votes") * F.greatest(seats, F.lit(0.0)) / F.col("all_votes") + 0.5)
        return F.when(F.col("all_votes") > 0, F.least(wanted, F.floor(F.col("blocks") * cap))).otherwise(0).cast("long")

    cells = cells.withColumn("sure", rounded(F.col("all_seats") - F.col("half"))).withColumn(
        "upmost", rounded(F.col("all_seats") + F.col("half"))
    )
    cells = cells.withColumn("open", F.col("all_seats") - F.sum("sure").over(everything))
    ranked = Window.orderBy(F.col("quotient").desc(), F.col("source").asc_nulls_last(), "shard", "k")
    won = (
        cells.filter("upmost > sure")
        .select("source", "shard", "votes", "open", F.explode(F.sequence("sure", F.col("upmost") - 1)).alias("k"))
        .withColumn("quotient", F.col("votes") / (2 * F.col("k") + 1))
        .withColumn("place", F.row_number().over(ranked))
        .filter("place <= open")
        .groupBy(F.col("source").alias("won_source"), F.col("shard").alias("won_shard"))
        .agg(F.count(F.lit(1)).alias("more"))
    )
    joined = cells.join(won, F.col("source").eqNullSafe(F.col("won_source")) & (F.col("shard") == F.col("won_shard")), "left")
    return joined.select(
        "source", "shard", "cell_size", "blocks", (F.col("sure") + F.coalesce("more", F.lit(0))).cast("long").alias("seats")
    )


def mix(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = 64,
    shard_words: int = 1_000_000,
    seed: int = 20,
) -> DataFrame:
    """All input columns plus ``size, source_size, target, passes, spans, taken``.

    ``passes`` is how often the whole text is taken, ``spans`` the word ranges (start, end) taken once more, ``taken``
    the words of both.  A document never gives more than ``cap`` times its words.
    """
    rows, inner = shielded(documents)
    own = F.coalesce(F.col(inner[id_col]).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), own, F.xxhash64(inner[text_col]).cast("string")))
    keyed = rows.withColumns({"size": word_count(F.col(inner[text_col])), "mix_key": key, "mix_source": F.col(inner[source_col])})
    sizes = staged(keyed.select(F.col("mix_source").alias("source"), "mix_key", "size"), "mix-sizes")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    targets = staged(source_targets(sizes, weights, share, cap).withColumn("shards", shards), "mix-targets")

    def in_shard(rows: DataFrame, source: str) -> DataFrame:
        wide = targets.withColumnRenamed("source", "t_source")
        number = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
        return rows.join(wide, F.col(source).eqNullSafe(F.col("t_source"))).withColumn("shard", number % F.col("shards"))

    cells = (
        in_shard(sizes, "source")
        .groupBy("source", "shard")
        .agg(F.sum("size").alias("cell_size"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
        .withColumn("votes", F.when(F.col("source_size") > 0, F.col("target") * F.col("cell_size") / F.col("source_size")).otherwise(0.0))
    )
    seats = staged(quotas(cells, block_words, cap), "mix-quotas").withColumnsRenamed({"source": "q_source", "shard": "q_shard"})

    placed = in_shard(keyed, "mix_source").join(
        seats, F.col("mix_source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")), "left"
    )
    in_order = Window.partitionBy("t_source", "shard").orderBy("mix_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("stop", F.sum("size").over(in_order)).withColumn("start", F.col("stop") - F.col("size"))
    # Block b holds the cell's words from floor(b * cell_size / blocks) on.
    block_of = lambda word: F.expr(f"(({word} + 1) * blocks - 1) div cell_size")
    shift = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce("t_source", F.lit("")), F.col("shard"))), 1, 8), 16, 10)
    rest, shift = F.expr("seats % blocks"), shift.cast("long")
    taken_blocks = F.filter(
        F.sequence(block_of("start"), block_of("(stop - 1)")), lambda b: (b * F.lit(_PRIME) + F.col("shift")) % F.col("blocks") < F.col("rest")
    )
    edge = lambda b: F.floor(b * F.col("cell_size") / F.col("blocks"))
    spans = F.transform(
        taken_blocks,
        lambda b: F.struct(
            (F.greatest(edge(b), F.col("start")) - F.col("start")).alias("start"),
            (F.least(edge(b + 1), F.col("stop")) - F.col("start")).alias("end"),
        ),
    )
    has = (F.col("size") > 0) & F.col("seats").isNotNull()
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    out = placed.withColumns({"rest": rest, "shift": shift}).withColumns(
        {
            "passes": F.when(has, F.expr("seats div blocks")).otherwise(0).cast("long"),
            "spans": F.when(has & (F.col("rest") > 0), spans).otherwise(none),
        }
    )
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    out = out.withColumn("taken", F.col("passes") * F.col("size") + words)
    added = ["size", "source_size", "target", "passes", "spans", "taken"]
    return out.select(*unshielded(inner, added), *added)


def mixed_documents(mixed: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """The documents of the mix: a row for each whole pass, and one with the words of the spans where these are not empty.

    ``columns`` are the input's.  Texts that are taken in part join their words by blanks; ``n_chars`` follows the text.
    """
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))
    part = F.array_join(
        F.flatten(F.transform("spans", lambda s: F.slice(words, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), " "
    )
    extra = F.col("taken") - F.col("passes") * F.col("size")
    last = F.when(extra == F.col("size"), F.col(text_col)).when(extra > 0, part)
    copies = F.concat(F.array_repeat(F.col(text_col), F.col("passes").cast("int")), F.when(extra > 0, F.array(last)).otherwise(F.array()))
    rows = mixed.filter("taken > 0").withColumn("mix_text", F.explode(copies))
    out = rows.withColumn(text_col, F.col("mix_text"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(out.schema["n_chars"].dataType))
    return out.select(*columns)
