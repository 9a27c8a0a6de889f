"""Registered queries of the subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.html_text import extract_text
from tidegauge.llm.language import held_out, identify, learn
from tidegauge.llm.licenses import BASE_PHRASES, scan_licenses
from tidegauge.llm.minhash import link_documents
from tidegauge.llm.mixing import mix
from tidegauge.llm.negatives import mine_negatives
from tidegauge.llm.packing import pack, tokenized_pieces
from tidegauge.llm.quality import judge
from tidegauge.llm.repeats import remove_repeats
from tidegauge.llm.runs import periodic_runs
from tidegauge.llm.shared import WORD, read_table
from tidegauge.llm.url_filter import judge_urls
from tidegauge.llm.vectors import link_vectors
from tidegauge.llm.warc import read_records, write_archives

def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of 4096."""
    import public_tokenizers

    documents = read_table(spark, sf_dir, "documents")
    pieces = pack(tokenized_pieces(documents, public_tokenizers.path("word_bpe_49k.json")))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: The rules of the page table: verdict, then host and start of the path.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    judged = judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    linked = link_vectors(read_table(spark, sf_dir, "embeddings"))
    return linked.select("vec_id", "n_links", "component_id", "kept")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of each document."""
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "passes")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back by the index."""
    index, folder = write_archives(read_table(spark, sf_dir, "pages"))
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 200-byte strings that occur twice."""
    left = remove_repeats(read_table(spark, sf_dir, "documents"), carry=("doc_id",), with_text=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each document, its own failures, and whether it and its host are kept."""
    judged = judge(read_table(spark, sf_dir, "documents"), carry=("doc_id",))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_kept", "kept"
    )


def op8_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 2-word shingles agree to 80 % or more."""
    linked = link_documents(read_table(spark, sf_dir, "documents"), words=2, percent=80, carry=("doc_id",))
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", "n_chars")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    documents = read_table(spark, sf_dir, "documents")
    found = identify(documents, learn(documents), carry=("doc_id",))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after labels of every seventh are moved by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", label))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of four phrases, and all licences that every document names."""
    found = scan_licenses(read_table(spark, sf_dir, "documents"), carry=("doc_id",))
    base = F.filter("places", lambda p: p.phrase.isin(*BASE_PHRASES))
    found = found.withColumn("base", base)
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def made_periodic(documents: DataFrame) -> DataFrame:
    """Words of every tenth document (by the CRC of its id) repeat with a period from some word on."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    marked = documents.withColumns({"g": g, "words": F.when(h % 10 == 0, words)})
    marked = marked.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    period = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    marked = marked.withColumn("p", period)
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    made = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")), " ")
    return marked.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, the longest one, and digests of all runs and of the text without repetitions."""
    documents = made_periodic(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(documents, carry=("doc_id",))
    longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("falling"), r.start.alias("start"), r.period.alias("period")))), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.falling")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(-F.col("longest.falling") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_url_filter": op2_url_filter,
    "op3_near_vectors": op3_near_vectors,
    "op4_mix_sources": op4_mix_sources,
    "op5_warc": op5_warc,
    "op6_repeats": op6_repeats,
    "op7_quality_rules": op7_quality_rules,
    "op8_near_documents": op8_near_documents,
    "op9_html_text": op9_html_text,
    "op10_language": op10_language,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_licenses": op12_licenses,
    "op13_runs": op13_runs,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_RATE = "({r} + k_{r} * m_{r}) / (n_docs + k_{r})"
_STRENGTH = "least(greatest(CASE WHEN v_{r} > 0 THEN m_{r} * (1 - m_{r}) / v_{r} - 1 ELSE 10 END, 1), 10) AS k_{r}"
_RULES = ("few_words", "repetitive", "symbols", "repeated_lines")

#: What SQL can say.  The others learn, cut text, build files or search by hashing; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_near_vectors": """
WITH RECURSIVE unit AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT e.vec_id, COALESCE(n, 0) AS n_links, LEAST(e.vec_id, COALESCE(least_id, e.vec_id)) AS component_id,
       e.vec_id <= COALESCE(least_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT x, COUNT(*) AS n FROM links GROUP BY x) c ON c.x = e.vec_id
LEFT JOIN (SELECT x, MIN(y) AS least_id FROM reach GROUP BY x) r ON r.x = e.vec_id""",
    "op5_warc": """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM (
  SELECT page_id, octet_length(encode(COALESCE(html, ''))) AS payload_bytes, sha256(COALESCE(html, '')) AS payload_digest,
         CASE WHEN octet_length(encode(COALESCE(html, ''))) >= 100 THEN MIN(page_id) OVER (PARTITION BY COALESCE(html, '')) END
           AS first_id
  FROM pages) p""",
    "op7_quality_rules": f"""
WITH docs AS (SELECT *, row_number() OVER () AS row FROM documents),
words AS (SELECT row, {_WORDS} AS words FROM docs),
grams AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM words) g),
again AS (SELECT row, i FROM (SELECT *, COUNT(*) OVER (PARTITION BY row, gram) AS n FROM grams) g WHERE n > 1),
covered AS (SELECT row, COUNT(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) t GROUP BY row),
lines AS (
  SELECT row, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines
  FROM (SELECT row, unnest(string_split(COALESCE(text, ''), chr(10))) AS line FROM docs) l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
measured AS (
  SELECT d.row, doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(COALESCE(text, '')) - length(regexp_replace(COALESCE(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
         COALESCE(n_dup_lines, 0) AS n_dup_lines, COALESCE(n_lines, 0) AS n_lines, COALESCE(c.n, 0) AS n_repeat_words
  FROM docs d JOIN words USING (row) LEFT JOIN lines USING (row) LEFT JOIN covered c USING (row)),
judged AS (
  SELECT *, CAST(n_words < 50 AS INT) AS few_words, CAST(100 * n_repeat_words > 50 * n_words AS INT) AS repetitive,
         CAST(10 * n_symbols > word_chars AS INT) AS symbols, CAST(2 * n_dup_lines > n_lines AS INT) AS repeated_lines
  FROM measured),
hosts AS (
  SELECT source AS host, COUNT(*) AS n_docs, {", ".join(f"SUM({r}) AS {r}" for r in _RULES)}
  FROM judged WHERE source IS NOT NULL GROUP BY 1),
means AS (SELECT *, {", ".join(f"SUM({r}) OVER () / SUM(n_docs) OVER () AS m_{r}" for r in _RULES)} FROM hosts),
spreads AS (
  SELECT *, {", ".join(f"SUM(n_docs * ({r} / n_docs - m_{r}) * ({r} / n_docs - m_{r})) OVER () / SUM(n_docs) OVER () AS v_{r}" for r in _RULES)}
  FROM means),
priors AS (SELECT *, {", ".join(_STRENGTH.format(r=r) for r in _RULES)} FROM spreads),
verdicts AS (SELECT host, {" AND ".join(_RATE.format(r=r) + " <= 0.8" for r in _RULES)} AS host_kept FROM priors)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words + repetitive > 0 AS base_failed,
       COALESCE(host_kept, true) AS host_kept, few_words + repetitive = 0 AND COALESCE(host_kept, true) AS kept
FROM judged LEFT JOIN verdicts ON host = source""",
    "op11_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM whole a JOIN whole r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10""",
}
