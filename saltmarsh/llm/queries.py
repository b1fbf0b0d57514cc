"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import license_scan

    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("hits")


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc
    from .scratch import Scratch

    folder = Scratch(spark, "warc").path("files")
    warc.write_warc(warc.messages(_table(spark, sf_dir, "pages")), folder, compression="lz4")
    read = warc.read_warc(spark, folder).withColumn("source_id", F.col("source_id").try_cast("long"))
    records = warc.serialised(warc.derive(warc.parsed(read)))
    return records.select("*", F.md5("record").alias("record_md5")).drop("record")


def op3_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import kneser_ney

    return kneser_ney.decide(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("did", "tk")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    rows = mixing.schedule(_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return rows.select("doc_id", "stream", "mass", "start", "block", "release", "deadline", "slot", "selected")


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_vectors

    return near_vectors.near_components(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import topk_nra

    rows = topk_nra.integers(_table(spark, sf_dir, "embeddings"), scale=1024)
    return topk_nra.top_k(rows, rows.where("vec_id % 100 = 0"), k=10)


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sstable

    manifest, _ = sstable.token_shards(_table(spark, sf_dir, "documents"), tokenizer(), end_id=1)
    return sstable.read_shards(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard_join

    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), words=5, percent=80)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer(), capacity=4096, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substring_index

    return substring_index.report(_table(spark, sf_dir, "documents"), window=50)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import filter_audit

    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import vector_codes

    return vector_codes.encode(_table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)[0]


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_warc_derivatives, op3_quality_perplexity, op4_source_mixing, op5_near_vectors, op6_topk_search, op7_token_shards, op8_jaccard_join, op9_packing, op10_substring_dedup, op11_filter_audit, op12_vector_codes, op13_toxicity)}


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    from . import filter_audit, license_scan, vector_codes, warc

    return {"op1_license_scan": license_scan.scan_sql(), "op2_warc_derivatives": warc.derive_sql(), "op6_topk_search": TOP_K_SQL, "op11_filter_audit": filter_audit.AUDIT_SQL, "op12_vector_codes": vector_codes.CODES_SQL}
