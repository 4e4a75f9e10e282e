"""The queries of this subpackage over the driver's tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from wattline.llm import (
    ann, bpe, exact_dedup, filter_audit, html_text, license_scan, mixing, near_dedup, quality, sharding, substring_dedup, url_filter,
    vector_codes)
from wattline.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


RULES = [url_filter.Rule(*r) for r in (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"))]


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), RULES)


def op3_ann_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, use=~quality.held_out())
    scored = quality.score(docs, model, ["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_mix_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op6_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op7_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(table(spark, sf_dir, "documents"), ranks)


def op9_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=16)


def op10_exact_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("doc").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


def op11_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20),
h AS (SELECT s.doc_id, s.s, md5(array_to_string(w[s.s : s.s + 19], ' ')) AS h FROM s JOIN d ON s.doc_id = d.doc_id),
r AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS k FROM h) WHERE k > 1),
g AS (SELECT DISTINCT doc_id, s + k AS i FROM r, range(0, 20) AS x(k)),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS kept, count(*) AS n
      FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.i = g.i WHERE g.i IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""

OP10_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS kept, h AS text_sha256
FROM n"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_url_templates": op2_url_templates,
    "op3_ann_projections": op3_ann_projections,
    "op4_quality_attention": op4_quality_attention,
    "op5_mix_pivotal": op5_mix_pivotal,
    "op6_minhash_bayes": op6_minhash_bayes,
    "op7_recompression": op7_recompression,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_shard_bytes": op9_shard_bytes,
    "op10_exact_dedup_stream": op10_exact_dedup_stream,
    "op11_text_density": op11_text_density,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op7_recompression": OP7_SQL,
    "op10_exact_dedup_stream": OP10_SQL,
    "op11_text_density": html_text.oracle(),
    "op12_filter_audit": filter_audit.oracle(),
    "op13_vector_codes": vector_codes.oracle(),
}
