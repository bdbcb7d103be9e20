"""Result tables: partitioned Parquet, overwritten by initiative and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyman.operators import differences, duplicates, summary

KINDS = {"differences": differences.SCHEMA, "duplicates": duplicates.SCHEMA, "summary": summary.SCHEMA}
ENVELOPE = ("initiative", "data_date_part")


def table_name(prefix: str, kind: str) -> str:
    return (prefix if prefix.endswith("_") else f"{prefix}_") + kind


def create_tables(spark: SparkSession, prefix: str, location: str | None = None) -> None:
    """The three result tables, where they are absent; each below the prefix's own folder."""
    for kind, schema in KINDS.items():
        cells = ", ".join(f"`{f.name}` STRING" for f in schema)
        place = f" LOCATION '{location.rstrip('/')}/{table_name(prefix, kind)}/'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table_name(prefix, kind)} ({cells}, initiative STRING, data_date_part STRING) "
            f"USING parquet PARTITIONED BY (initiative, data_date_part){place}"
        )


def enveloped(df: DataFrame, kind: str, initiative: str, date: str) -> DataFrame:
    return df.select(*(f.name for f in KINDS[kind]), F.lit(initiative).alias("initiative"), F.lit(date).alias("data_date_part"))


def _laid_out(df: DataFrame, files: int | None) -> DataFrame:
    """A given number of files, or as many as adaptive execution finds fitting."""
    return df.coalesce(files) if files else df.hint("rebalance")


def write_path(df: DataFrame, path: str, kind: str, initiative: str, date: str, files: int | None = None) -> None:
    """Replaces one (initiative, date) below path, also by nothing: an empty result leaves no old rows behind."""
    rows = _laid_out(df.select(*(f.name for f in KINDS[kind])), files)
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{kind}/initiative={initiative}/data_date_part={date}")


def write_table(df: DataFrame, prefix: str, kind: str, initiative: str, date: str, files: int | None = None) -> None:
    """Replaces one (initiative, date) of a result table."""
    spark, name = df.sparkSession, table_name(prefix, kind)
    rows = _laid_out(enveloped(df, kind, initiative, date), files)
    quote = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
    if rows.limit(1).count() == 0:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (initiative='{quote(initiative)}', data_date_part='{quote(date)}')")
        return
    # insertInto takes the mode from the session only
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(key, before)


def export_summary(df: DataFrame, path: str) -> None:
    """The thirteen summary rows as a spreadsheet, or as CSV if the path says so; without a spreadsheet writer an error."""
    rows = df.limit(len(summary.ROWS)).toPandas()
    if path.endswith(".csv"):
        rows.to_csv(path, index=False)
        return
    try:
        rows.to_excel(path, sheet_name="Sheet1", index=False)
    except ImportError as e:
        raise RuntimeError(f"no spreadsheet writer is installed for {path}; a path that ends in .csv needs none") from e
