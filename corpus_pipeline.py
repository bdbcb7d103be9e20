"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents.  SQL can express none of the stages' models
and tokenizer; the pipeline is tested against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyman.llm import decontaminate, linededup, minhash, packing, queries, toxicity
from tallyman.llm.shared import apart, forget, written


def _kept_where(docs: DataFrame, judge: Callable[[DataFrame, list[str]], DataFrame], keep: Column) -> DataFrame:
    """The rows of docs that a judge's columns keep; docs' other columns have other names meanwhile, so none clashes with a judge's."""
    masked, restored = apart(docs, ["doc_id", "text"])
    return restored(judge(masked, masked.columns).where(keep))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below one half."""
    model = queries.fitted_toxicity(spark, docs, sf_dir)
    return _kept_where(docs, lambda df, keep: toxicity.score_texts(df, model, keep), F.col("score") < 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand elsewhere before; those that lose all their words go."""
    return linededup.drop_lines(docs, size_col="n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the least id."""
    return minhash.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    bench = queries.table(spark, sf_dir, "benchmark")
    return _kept_where(docs, lambda df, keep: decontaminate.find_contamination(df, bench, keep), ~F.col("contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and offset."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), name.replace(" ", "-"), "snappy")
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
