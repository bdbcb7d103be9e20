"""The folder that driver and executors share, and tables written there.

Cutting lineage goes through Parquet tables below `spark.checkpoint.dir`, so a
lost executor never loses an intermediate result.  Where the setting is absent, a
local session (tests) gets a folder, made once and put into the setting; on a
cluster that is an error.
"""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "spark.checkpoint.dir"
#: What one Arrow batch to a Python worker is meant to hold, and the setting for it with its default.
BATCH_BYTES, BATCH_KEY, BATCH_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark application, so that their Python workers can import it.

    Where the session leaves the size of Arrow batches at the default, they are
    made smaller, so that a task's memory follows its longest text, not 10,000 rows.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_KEY, str(BATCH_DEFAULT)).rstrip("b") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_KEY, BATCH_BYTES)
    if getattr(context, "_tallyman_shipped", False):
        return
    package, held = Path(__file__).parent.parent, io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as pack:
        for source in sorted(package.rglob("*.py")):
            pack.write(source, source.relative_to(package.parent))
    path = f"{shared_folder(spark)}/{package.name}-{uuid.uuid4().hex}.zip"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(held.getvalue())
    out.close()
    context.addPyFile(path)
    context._tallyman_shipped = True


def shared_folder(spark: SparkSession) -> str:
    found = spark.sparkContext.getConf().get(KEY, None) or spark.conf.get(KEY, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{KEY} is not set: on a cluster it has to name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyman-")
        spark.conf.set(KEY, found)
    return found.rstrip("/")


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """df, written as a Parquet table in the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._table_path = path
    return made


def table_bytes(df: DataFrame) -> int | None:
    """Bytes on disk of a table that `written` made; None for other frames."""
    path = getattr(df, "_table_path", None)
    if not path:
        return None
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


#: Bytes on disk up to which a written table may be broadcast.
BROADCAST_BYTES = 8 << 20


def bounded(df: DataFrame, table: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """df with a broadcast hint if its written table (or `table`, of which it is a view) is small (of `most` bytes, if less); else df itself, for a shuffled join."""
    size, limit = table_bytes(df if table is None else table), BROADCAST_BYTES if most is None else min(most, BROADCAST_BYTES)
    return F.broadcast(df) if size is not None and size <= limit else df


def dealt_join(many: DataFrame, few: DataFrame, keys: list[str], n: str, salt: str, share: int = 1000, limit: int | None = None) -> DataFrame:
    """many joined with few (a written table: one row a key, and in n how many rows of many it meets).

    A small `few` is broadcast.  Beyond that, keys with over a thousandth of all
    rows, of which there are less than a thousand, are dealt over several tasks
    by a hash of `salt`.
    """
    broadcast = bounded(few, most=limit)
    if broadcast is not few:
        return many.join(broadcast, keys)
    total = few.agg(F.sum(n)).first()[0] or 0
    most = max(1000, total // share)
    hot = few.where(F.col(n) > most).select(*keys, F.ceil(F.col(n) / most).cast("int").alias("_parts"))
    spread = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / most).cast("int") - 1)))
    dealt = many.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(salt), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
    return dealt.join(spread, [*keys, "_salt"]).drop("_salt")


def apart(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with all columns but those needed under other names, so that none clashes with an operator's, and what restores docs' columns."""
    names = {c: c if c in needed else f"_col{i}" for i, c in enumerate(docs.columns)}
    masked = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return masked, lambda df: df.select(*(F.col(f"`{n}`").alias(c) for c, n in names.items()))


def forget(*tables: DataFrame | None) -> None:
    """Deletes tables that `written` made, once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "_table_path", None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
