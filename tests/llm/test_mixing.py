"""Source mixing: blocks that don't depend on the corpus's size, and the order that packing takes over."""

from __future__ import annotations

import random

import pyarrow as pa
from saltmarsh.llm import mixing

from .test_models import DOCS


def test_blocks_are_the_same_in_a_large_corpus(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 8, raising=False)
    docs = spark.createDataFrame([(i, "x" * 100, "en", "ab"[i % 3 == 0], 0, "") for i in range(300)], DOCS)
    out = mixing.schedule(docs, block_size=100).collect()
    assert sorted(x["slot"] for x in out) == list(range(300))
    assert all(x["block"] * 100 == x["start"] for x in out)


def test_packing_takes_its_order_from_the_mixings_files(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["tide", "reed", "mud", "crab"]) for _ in range(r.randint(1, 900))), "en", "aab"[i % 3], 0, "") for i in range(2000)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/docs")
    mixed = corpus_pipeline.mixed_sources(spark, spark.read.schema(DOCS).parquet(f"{tmp_path}/docs"), "")
    mixed.write.parquet(f"{tmp_path}/mixed")
    spark.createDataFrame(sorted(rows, key=lambda x: -x[0]), DOCS).coalesce(1).write.parquet(f"{tmp_path}/other")

    def stored(name):
        df = spark.read.schema(DOCS).parquet(f"{tmp_path}/{name}")
        return df, [x[0] for x in df.select("doc_id", "_metadata.file_path", "_metadata.row_index").orderBy("file_path", "row_index").collect()]

    docs, order = stored("mixed")
    again = [x[0] for x in mixing.mixed(docs, as_stored=True).select("doc_id").collect()]
    assert again == order != sorted(order) and sorted(again) == list(range(2000))
    docs, order = stored("other")
    ours = [x[0] for x in mixing.mixed(docs, as_stored=True).select("doc_id").collect()]
    source = {x[0]: x[3] for x in rows}
    assert all([i for i in ours if source[i] == s] == [i for i in order if source[i] == s] for s in "ab") and ours != again
    first = [[x["doc_id"] for x in corpus_pipeline.packed(spark, stored(n)[0], "").orderBy("sequence_id", "offset").collect()] for n in ("mixed", "other")]
    assert first[0] != first[1] and set(first[0]) == set(first[1])


def test_tables_of_blocks_start_no_python_workers(spark, monkeypatch):
    given, own = [], type(spark).createDataFrame
    docs = spark.range(5).selectExpr("id AS doc_id", "repeat('x', 1000) AS text", "'a' AS source")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: given.append(data) or own(self, data, *a, **k))
    assert mixing.mixed(docs).count() == 5 and mixing.mixed(docs.where("false")).count() == 0
    assert given and all(isinstance(x, pa.Table) for x in given)
