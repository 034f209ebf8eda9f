"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Each stage function takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the
columns of ``docs``: toxic documents go, one document of each near-duplicate group stays, documents that hold a benchmark
item go, and what is left is mixed to the sources' target weights (a document taken twice is there twice). The last stage
stores token ids and returns a row per stored document.

Null ids, texts and other columns are allowed and have the results that the stages' operators state; empty tables give
empty results; columns beyond those of ``documents`` pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boostframe.llm import decontaminate, mixing, simhash, tokens, toxicity
from boostframe.llm.common import cut, prepare, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below 0.5, under a model fitted on the labelled ones among all of them."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), held_fold=None))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash group: that with the smallest doc_id (`simhash.keep_one`)."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of ``benchmark``."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and n_symbols of every stored document, read back from the shards."""
    return tokens.store_tokens(docs, tokens.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", store_tokens),
]

#: SQL can't express the first, second and last stage; tests/llm holds the pipeline against plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
