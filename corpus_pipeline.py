"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the columns of ``documents``, the last the packed
pieces with their token ids. A stage's result is written before the next one reads it. No stage swallows a failure of an operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saltmarsh.llm import jaccard_join, kneser_ney, mixing, packing, substring_index
from saltmarsh.llm.queries import tokenizer
from saltmarsh.llm.scratch import Scratch

#: Target weights by source; None: the sources' own masses, and no document is dropped.
WEIGHTS: dict[str, float] | None = None
#: Tokens packed together: 16 sequences, some eight blocks of the mixing.
GROUP_TOKENS = 1 << 16


def good_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier doesn't reject."""
    return kneser_ney.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near copies."""
    return jaccard_join.without_near_copies(docs, words=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that stand in a document with a smaller doc_id."""
    return substring_index.clean(docs, window=50)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources interleaved in proportion to their own texts; every document stays, as no target weights are stated."""
    return mixing.mixed(docs, WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed in their order of mixing: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    The order is that of the mixing's files: a source's documents as they stand in these, so each gets its slot of the mixing again. Sequences
    follow the slots by sequence_id; packing moves a document within its group of GROUP_TOKENS only.
    """
    return packing.pack(mixing.mixed(docs, WEIGHTS, as_stored=True), tokenizer(), capacity=4096, end_id=2, group_tokens=GROUP_TOKENS, in_order=True)


STAGES = [("quality classifier", good_language), ("near copies", one_of_each), ("repeated passages", without_repeats), ("source mixing", mixed_sources), ("packing", packed)]

#: Language-model training, components and tokens aren't SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
