"""Queries of the training-data operators: (spark, sf_dir) to a DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockpulse.llm import (
    active_lloyd, cell_dedup, cuckoo_dedup, multiplicity_whitening, nb_svm, partition_ann, perspectives, prefix_counts, secret_scan, simhash, slot_shards,
    source_mix, stream_bpe,
)

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        QUERIES[name] = plan
        if sql is not None:
            ORACLE[name] = sql
        return plan

    return register


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest id of its class of near copies."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_stream_bpe")
def op4_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded again."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    found = stream_bpe.encode_documents(_table(spark, sf_dir, "documents"), vocabulary, with_ids=False)
    return found.withColumnRenamed("id", "doc_id")


@query("op10_prefix_token_counts")
def op10_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and the longest prefix within 4096 tokens."""
    limit, model = 4096, public_tokenizers.path("piece_bpe_32k.model")
    found = prefix_counts.count_documents(_table(spark, sf_dir, "documents"), model, budget=limit)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("fitting_chars").alias("kept_chars"),
        F.col("fitting_tokens").alias("kept_tokens"),
    )


@query("op3_slot_shards")
def op3_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard of 40 and its place there; the map balances bytes.

    Under this law there is no `grown_shard`; `next_shard` is the shard after the map is edited for 41.
    """
    placed = slot_shards.shard_documents(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
        "next_shard",
    )


OP5_SQL = r"""
WITH named AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-' || md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS own
    FROM documents
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY own ORDER BY encode(source) NULLS FIRST, size, doc_id) - 1 AS again FROM named
), d AS (
    SELECT doc_id, source, size, CASE WHEN again = 0 THEN own ELSE CAST('0x' || substr(md5(own || '#' || again), 1, 15) AS BIGINT) END AS h FROM numbered
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [1, 2, 3][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
    FROM d GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source_size / weight, encode(source) NULLS LAST) AS k FROM s
), cut AS (
    SELECT r.k, CAST((SELECT sum(source_size) FROM s) - 3 * coalesce(sum(p.source_size), 0) AS DOUBLE) AS l,
           CAST((SELECT sum(weight) FROM s) - coalesce(sum(p.weight), 0) AS DOUBLE) AS w
    FROM ranked r LEFT JOIN ranked p ON p.k < r.k GROUP BY r.k
), open_ AS (
    SELECT cut.k, l, w FROM cut JOIN ranked USING (k) WHERE weight * l <= 3 * source_size * w ORDER BY cut.k LIMIT 1
), t AS (
    SELECT source, source_size, CASE WHEN o.k IS NULL OR r.k < o.k THEN CAST(3 * source_size AS DOUBLE)
                                     ELSE least(o.l * weight / o.w, CAST(3 * source_size AS DOUBLE)) END AS target
    FROM ranked r LEFT JOIN open_ o ON TRUE
), c AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t
), g AS (
    SELECT source, h, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) - sum(size) AS spent
    FROM d GROUP BY source, h
), b AS (
    SELECT c.source, max(CASE WHEN g.spent <= c.target - c.copies * c.source_size THEN g.h END) AS h
    FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source GROUP BY c.source
), e AS (
    SELECT c.*, CASE WHEN target - copies * source_size <= 0 THEN 0
                     WHEN 2 * (target - copies * source_size - g.spent) >= g.size THEN b.h + 1 ELSE b.h END AS below
    FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source JOIN g ON g.source IS NOT DISTINCT FROM b.source AND g.h = b.h
)
SELECT doc_id, size, source_size, target, CAST((copies + CASE WHEN h < below THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""


@query("op5_source_mix", OP5_SQL)
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that a mix by source weights takes of it."""
    found = source_mix.taken_words(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and places of the secrets of every document."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in secret_scan.BASE_RULES]

    def of(*wanted: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*wanted))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    base = of(*kinds)
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


@query("op6_nb_svm_quality")
def op6_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; labels are learned outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = nb_svm.train(docs, _table(spark, sf_dir, "labels"))
    scored = nb_svm.score_documents(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"),
        nb_svm.is_held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op1_partition_ann")
def op1_partition_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    return partition_ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query("op7_cell_dedup")
def op7_cell_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and the smallest id of its group of near copies."""
    return cell_dedup.near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


OP9_SQL = """
WITH t AS (
    SELECT conv_id, role, coalesce(text, '') AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, md5(coalesce(text, ''))) - 1 AS place
    FROM conversations
), p AS (
    SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role <> 'system'
), r AS (
    SELECT t.conv_id, speaker, CAST(place // 64 AS INTEGER) AS part, place, coalesce(role = speaker, FALSE) AS own,
           '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system'
                                  ELSE 'user name=' || coalesce(role, 'unnamed') END || chr(10) AS header,
           said || '<|im_end|>' AS body
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
    SELECT *, sum(length(header) + length(body) + 1) OVER (PARTITION BY conv_id, speaker, part ORDER BY place) - length(body) - 1 AS begun FROM r
)
SELECT conv_id, speaker, part, CAST(count(*) AS INTEGER) AS n_turns, CAST(count(*) FILTER (own) AS INTEGER) AS n_own,
       string_agg(header || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CASE WHEN own THEN begun || ':' || (begun + length(body)) END, ',' ORDER BY place), '') AS mask
FROM o GROUP BY conv_id, speaker, part
"""


@query("op9_perspective_rotation", OP9_SQL)
def op9_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from each speaker's perspective, with the spans that speaker is trained on."""
    shown = perspectives.rotate(_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return shown.select(F.col("conv").alias("conv_id"), "speaker", "part", "n_turns", "n_own", "text", mask.alias("mask"))


OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op11_cuckoo_dedup", OP11_SQL)
def op11_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    found = cuckoo_dedup.exact_copies(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op12_multiplicity_whitening")
def op12_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector along the 32 leading components of all, whitened."""
    found = multiplicity_whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return multiplicity_whitening.by_component(found).withColumnRenamed("id", "vec_id")


@query("op13_active_lloyd")
def op13_active_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, its squared error, that of its label, and a digest of the codebooks."""
    found = active_lloyd.compress(_table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return found.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", "codebooks_sha256")
