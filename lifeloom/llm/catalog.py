"""Registered queries of this subpackage, each over whole tables, and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom.llm.clusters import clustered
from lifeloom.llm.jaccard import jaccard_components
from lifeloom.llm.lattice import lattice_scores
from lifeloom.llm.leaks import leaks
from lifeloom.llm.lines import dedup_lines
from lifeloom.llm.manifest import verified
from lifeloom.llm.near import near_duplicates
from lifeloom.llm.oracles import JACCARD_SQL, clusters_sql, manifest_sql
from lifeloom.llm.packing import pack
from lifeloom.llm.pii import pseudonymise
from lifeloom.llm.preferences import as_turns, preference_pairs
from lifeloom.llm.quality import quality
from lifeloom.llm.repeats import remove_repeats
from lifeloom.llm.sharding import hilbert_shards
from lifeloom.llm.tables import read


def op1_line_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed_lines", "text")


def op2_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its last reply replaced by its first one.

    Conversations with fewer than two replies give no pair; what follows the last reply is left out.
    """
    turns = as_turns(read(spark, sf_dir, "conversations"))
    replies = F.filter(
        F.sequence(F.lit(1), F.size("turns")), lambda i: F.get("turns", i - 1)["role"] == "assistant"
    )
    turns = turns.withColumn("first", F.get(replies, F.lit(0))).withColumn("last", F.get(replies, F.size(replies) - 1))
    turns = turns.filter("first < last")
    kept = F.slice("turns", F.lit(1), F.col("last") - 1)
    pairs = turns.select(
        F.col("conv_id").alias("pair_id"),
        F.slice("turns", F.lit(1), F.col("last")).alias("chosen"),
        F.concat(kept, F.array(F.get("turns", F.col("first") - 1))).alias("rejected"),
    )
    done = preference_pairs(pairs)
    digest = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return done.withColumns({c: digest(c) for c in ("chosen_spans", "rejected_spans")})


OP2_SQL = """
WITH c AS (
  SELECT conv_id, list(struct_pack(role := replace(coalesce(role, ''), '<|', '< |'),
                                   text := replace(coalesce(text, ''), '<|', '< |'))
                       ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS t
  FROM conversations GROUP BY conv_id
), r AS (
  SELECT *, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS a FROM c
), p AS (
  SELECT conv_id, t[1:a[-1]] AS x, list_append(t[1:a[-1] - 1], t[a[1]]) AS y FROM r WHERE len(a) > 1
), q AS (
  SELECT *, coalesce(nullif(list_position(list_transform(range(1, least(len(x), len(y)) + 1), lambda i: x[i] = y[i]), false), 0) - 1,
                     least(len(x), len(y))) AS n FROM p
), parts AS (
  SELECT conv_id, n, x[1:n] AS p, x[n + 1:] AS x, y[n + 1:] AS y FROM q
), sides AS (
  SELECT conv_id, 'x' AS side, u.i, u.t FROM (SELECT conv_id, unnest(list_transform(range(1, len(x) + 1),
    lambda i: struct_pack(i := i, t := x[i]))) AS u FROM parts)
  UNION ALL
  SELECT conv_id, 'y', u.i, u.t FROM (SELECT conv_id, unnest(list_transform(range(1, len(y) + 1),
    lambda i: struct_pack(i := i, t := y[i]))) AS u FROM parts)
), sized AS (
  SELECT *, length(t.role) + 5 AS head, length(t.text) + 8 AS body FROM sides
), placed AS (
  SELECT *, sum(head + body) OVER (PARTITION BY conv_id, side ORDER BY i) AS stop FROM sized
), spans AS (
  SELECT conv_id, side, string_agg(CAST(stop - body AS BIGINT) || '-' || CAST(stop AS BIGINT), ',' ORDER BY i) AS s
  FROM placed WHERE t.role = 'assistant' GROUP BY conv_id, side
)
SELECT parts.conv_id AS pair_id, CAST(n AS INTEGER) AS prompt_turns,
  coalesce(list_aggregate(list_transform(p, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS prompt,
  coalesce(list_aggregate(list_transform(x, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS chosen,
  coalesce(list_aggregate(list_transform(y, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '') AS rejected,
  coalesce(a.s, '') AS chosen_spans, coalesce(b.s, '') AS rejected_spans
FROM parts LEFT JOIN spans a ON a.conv_id = parts.conv_id AND a.side = 'x'
LEFT JOIN spans b ON b.conv_id = parts.conv_id AND b.side = 'y'
"""


def op3_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select(
        F.col("doc_id").cast("long"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "score",
    )


def op4_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(read(spark, sf_dir, "documents"))


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert_shards(read(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def op6_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(read(spark, sf_dir, "documents")).select("doc_id", "n_replaced", "text")


def op8_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def op9_bm25_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = clustered(read(spark, sf_dir, "embeddings"))
    return done.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(read(spark, sf_dir, "documents"))


def op13_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_neighbours": op1_line_neighbours,
    "op2_preferences": op2_preferences,
    "op3_quality_ratio": op3_quality_ratio,
    "op4_lattice_likelihood": op4_lattice_likelihood,
    "op5_hilbert_shards": op5_hilbert_shards,
    "op6_minhash_hamming": op6_minhash_hamming,
    "op7_surrogates": op7_surrogates,
    "op8_pack_windows": op8_pack_windows,
    "op9_bm25_leaks": op9_bm25_leaks,
    "op10_suffix_repeats": op10_suffix_repeats,
    "op11_shallot_clusters": op11_shallot_clusters,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_jaccard_tiles": op13_jaccard_tiles,
}
ORACLE: dict[str, str] = {
    "op2_preferences": OP2_SQL,
    "op11_shallot_clusters": clusters_sql(),
    "op12_merkle_manifest": manifest_sql(),
    "op13_jaccard_tiles": JACCARD_SQL,
}
