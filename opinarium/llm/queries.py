"""Registered queries of this package and their SQL, where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinarium.llm import (
    byte_bpe,
    collocations,
    decontamination,
    fingerprints,
    hard_negatives,
    language,
    near_duplicates,
    packing,
    quality,
    sharding,
    token_counts,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _registered(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@_registered
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, folder, "documents"))


@_registered
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


@_registered
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_registered
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, folder, "documents"))


@_registered
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(_table(spark, folder, "documents"))
    return found.withColumn("n_spans", F.size("spans")).drop("spans")


@_registered
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, folder, "pages"))
    return judged.withColumn("words", F.array_join("words", " "))


@_registered
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = (_table(spark, folder, t) for t in ("documents", "benchmark"))
    return decontamination.find_leaks(documents, benchmark)


@_registered
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


@_registered
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_registered
def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_neighbours(_table(spark, folder, "documents"))


@_registered
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\n-\r]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
places AS (
  SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i
  FROM listed, (VALUES (1), (2), (3), (4)) AS sizes(s)),
counted AS (
  SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase, count(*) AS a
  FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM listed GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE s > 1 AND a >= 30),
cuts AS (
  SELECT lang, phrase, s, a, unnest(range(1, s)) AS k, string_split(phrase, ' ') AS w FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, f.a AS l, g.a AS r, (2000000::HUGEINT * c.a) // (f.a + g.a) AS score
  FROM cuts c
  JOIN counted f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_sizes AS (
  SELECT lang, phrase, s, a, unnest(range(2, s)) AS t FROM candidates),
inner_places AS (
  SELECT lang, string_split(phrase, ' ') AS w, a, t, unnest(range(1, s - t + 2)) AS i FROM inner_sizes),
longer AS (
  SELECT lang, array_to_string(w[i:i + t - 1], ' ') AS phrase, max(a) AS a FROM inner_places GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.a IS NULL OR 100::HUGEINT * o.a < 80::HUGEINT * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score::BIGINT AS score
FROM ranked k JOIN totals t ON t.lang = k.lang WHERE k.rank <= 2000
"""


@_registered
def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    decoded = byte_bpe.decode(byte_bpe.encode(_table(spark, folder, "documents")))
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@_registered
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = _table(spark, folder, "embeddings")
    return hard_negatives.mine(embeddings, "embedding", label, F.col("vec_id") % 100 == 0)
