"""The corpus pipeline: toxicity, near-duplicate texts, repeated passages, source mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns a DataFrame that
is written as Parquet and reread as the next stage's documents. All stages but the last keep the
columns of ``documents``.

In every stage an empty table stays empty, other columns are carried along, texts of any length are read whole, and:
null and empty texts, and rows with a null id, are kept (packing: null is the empty text, one piece of the end mark alone). Rows that
repeat an id and a text are one document for near_dedup (one stays) and are cut alike by passages; toxicity and packing take each row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import mixing, near_dedup, packing, passages, toxicity
from tessera.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest window is scored below the threshold."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id holds."""
    return passages.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by source so that shares follow the root of the sources' sizes, shuffled."""
    return mixing.mix_sources(docs).drop("mix_rate", "mix_copy", "mix_key")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences; copies that the mix made are pieces of their own."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("passages", cut_repeats),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: training, sampling over TF-IDF and alignment cannot be put as SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
