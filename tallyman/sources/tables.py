"""The two sides of a comparison, loaded lazily."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyman.config import CompareConfig

from . import specs

log = logging.getLogger(__name__)


def as_frame(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """A DataFrame as it is, a Parquet path, or a table of the catalog."""
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def spec_predicate(df: DataFrame, spec: str | None) -> Column | None:
    """Conjunction of `column IN (values)`, values cast to the column's type so that partitions are pruned; None: all rows."""
    terms = []
    for column, values in specs.parse_spec(spec).items():
        if not values:
            continue
        if column not in df.columns:
            raise ValueError(f"the partition spec names {column}, which is not a column")
        kind = df.schema[column].dataType.simpleString()
        terms.append(F.col(column).isin(*(F.lit(v).try_cast(kind) for v in values)))
    return reduce(Column.__and__, terms) if terms else None


def load(spark: SparkSession, source: DataFrame | str, spec: str | None = None, where: str | None = None) -> DataFrame:
    """Rows of a source within a spec that meet a Spark SQL predicate."""
    df = as_frame(spark, source)
    predicate = spec_predicate(df, spec)
    df = df if predicate is None else df.where(predicate)
    return df.where(F.expr(where)) if where and where.strip() else df


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """df with NEW names turned into REF names; names that are absent are left out."""
    present = {new: ref for ref, new in mapping.items() if new in df.columns and new != ref}
    for ref, new in mapping.items():
        if new not in df.columns:
            log.warning("mapped column %s is absent; %s stays as it is", new, ref)
    clash = set(present.values()) & (set(df.columns) - set(present))
    if clash:
        raise ValueError(f"NEW already has columns named {', '.join(sorted(clash))}")
    return df.withColumnsRenamed(present)


def sides(spark: SparkSession, ref: DataFrame | str, new: DataFrame | str, config: CompareConfig) -> tuple[DataFrame, DataFrame]:
    """Both sides within their specs and filters, NEW in REF's vocabulary."""
    new_spec = config.new_spec or config.spec
    return (
        load(spark, ref, config.ref_spec or config.spec, config.ref_filter),
        renamed(load(spark, new, specs.renamed_spec(new_spec, config.mapping), config.new_filter), config.mapping),
    )


def compared_columns(ref: DataFrame, new: DataFrame, config: CompareConfig) -> list[str]:
    """REF's columns in order, without ignored ones, keys and columns of the spec, as far as NEW has them."""
    pinned = set()
    for spec in (config.spec, config.ref_spec):
        pinned |= set(specs.parse_spec(spec)) if spec else set()
    out = {*config.ignore, *config.keys, *pinned}
    return [c for c in ref.columns if c not in out and c in new.columns]


def projected(df: DataFrame, config: CompareConfig, columns: list[str]) -> DataFrame:
    """Keys, compared columns, and what chooses among rows."""
    extra = [c for c in (*config.priority, *config.first_order) if c in df.columns]
    return df.select(*dict.fromkeys([*config.keys, *columns, *extra]))


def input_files(df: DataFrame) -> int:
    """Files that a side reads, or -1 where that can't be told."""
    try:
        return len(df.inputFiles())
    except Exception:  # noqa: BLE001  a report only
        return -1
