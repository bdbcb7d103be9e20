"""Keys that occur more than once on a side: exact copies and variations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyman.config import CompareConfig
from tallyman.functions import columns as C
from tallyman.sources.tables import compared_columns

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("origin", "id", "category", "exact_duplicates", "dupes_w_variations", "occurrences", "variations")])


def _side(df: DataFrame, ref: DataFrame, config: CompareConfig, columns: list[str], origin: str) -> DataFrame:
    """origin, id, keys as text, and every other column as text."""
    kinds = {f.name: f.dataType for f in df.schema}
    keys = [C.key(F.col(k), kinds[k]).cast("string").alias(f"k{i}") for i, k in enumerate(config.keys)]
    rest = [c for c in columns if c not in config.priority]
    texts = [C.row_text(F.col(c), kinds[c]).alias(f"t{i}") for i, c in enumerate(rest)]
    return df.select(F.lit(origin).alias("origin"), *keys, *texts)


def duplicates(ref: DataFrame, new: DataFrame, config: CompareConfig, columns: list[str] | None = None) -> DataFrame:
    """One row per side and duplicated key.

    Equal rows are counted together first (partial aggregation, then a shuffle
    by whole row, which a hot key does not skew); their counts go to keys by
    partial aggregation as well.  Only rows of keys that occur twice or more are
    gathered into sets of values, which a semi-join leaves to them (adaptive
    execution splits a hot key's share of it).  With priority columns the rows
    that differ in nothing else count once.
    """
    columns = compared_columns(ref, new, config) if columns is None else [c for c in columns if c in ref.columns and c in new.columns]
    rest = [c for c in columns if c not in config.priority]
    keys, texts = [f"k{i}" for i in range(len(config.keys))], [f"t{i}" for i in range(len(rest))]
    both = _side(ref, ref, config, columns, "ref").unionByName(_side(new, ref, config, columns, "new"))
    # rows with equal texts are rows with equal hashes; the texts themselves group without a sort
    copies = F.lit(1) if config.priority else F.count(F.lit(1))
    distinct = both.groupBy("origin", *keys, *texts).agg(copies.cast("long").alias("copies"))
    counted = distinct.groupBy("origin", *keys).agg(F.sum("copies").alias("occurrences"), F.count(F.lit(1)).alias("hashes")).where(F.col("occurrences") >= 2)
    named = counted.withColumnsRenamed({k: f"_{k}" for k in ("origin", *keys)})
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in ("origin", *keys)))
    sets = [F.collect_set(t).alias(t) for t in texts]
    grouped = distinct.join(named, same).groupBy("origin", *keys).agg(F.max("occurrences").alias("occurrences"), F.max("hashes").alias("hashes"), *sets)
    grouped = grouped.withColumn("id", C.composite_id([F.col(k) for k in keys]))
    own = Window.partitionBy(*keys)
    on_ref, on_new = F.bool_or(F.col("origin") == "ref").over(own), F.bool_or(F.col("origin") == "new").over(own)
    # as text: hundreds of columns would take many calls each
    shown = f"transform(array_sort({{}}), x -> CASE x WHEN '{C.NULL_MARK}' THEN '{C.NULL_TEXT}' WHEN '' THEN '{C.EMPTY_TEXT}' ELSE x END)"
    quoted = lambda c: c.replace("\\", "\\\\").replace("'", "\\'")
    told = [F.expr(f"CASE WHEN size({t}) > 1 THEN concat('{quoted(c)}: [', array_join({shown.format(t)}, ', '), ']') END") for c, t in zip(rest, texts, strict=True)]
    variations = F.concat_ws(" | ", *told) if told else F.lit("")
    return grouped.select(
        "origin",
        "id",
        F.when(on_ref & on_new, "both").when(on_ref, "only_ref").otherwise("only_new").alias("category"),
        (F.col("occurrences") - F.col("hashes")).cast("string").alias("exact_duplicates"),
        (F.col("hashes") - 1).cast("string").alias("dupes_w_variations"),
        F.col("occurrences").cast("string").alias("occurrences"),
        F.when(variations == "", "-").otherwise(variations).alias("variations"),
    )


def no_duplicates(spark) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
