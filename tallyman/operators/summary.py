"""The thirteen summary rows of a comparison.

The metrics are conditional counts over one row of flags per key, which the
grouped union of the differences gives as well (`differences.key_flags`), so a
summary costs one scan of either side and one shuffle.  Keys are told apart as
keys: ids, which join a key's texts, only name them.  The sample ids are the
least ones of each metric, or with a seed random ones, found by a rank that
Spark limits inside every partition before it shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyman.config import CompareConfig
from tallyman.functions import columns as C

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("block", "metric", "universe", "numerator", "denominator", "pct", "samples")])

# Blocks, metrics and universes, in their order.
ROWS = (
    ("M1", "KPIS", "Unique IDs", "REF"),
    ("M2", "KPIS", "Unique IDs", "NEW"),
    ("M3", "KPIS", "Total rows REF", "ROWS"),
    ("M4", "KPIS", "Total rows NEW", "ROWS"),
    ("M5", "KPIS", "Total diff(new-ref)", "ROWS"),
    ("M6", "KPIS", "Global quality", "BOTH"),
    ("M7", "EXACT MATCH", "1:1 (all columns)", "BOTH"),
    ("M8", "PARTIAL MATCH", "1:1 (match & no_match cols)", "BOTH"),
    ("M9", "GAP", "1:0 (only in ref)", "REF"),
    ("M10", "GAP", "0:1 (only in new)", "NEW"),
    ("M11", "DUPS", "duplicates (both)", "BOTH"),
    ("M12", "DUPS", "duplicates (only in ref)", "REF"),
    ("M13", "DUPS", "duplicates (only in new)", "NEW"),
)
BLOCKS = ("KPIS", "EXACT MATCH", "PARTIAL MATCH", "GAP", "DUPS")


def _flags() -> dict[str, Column]:
    """The ids that each metric counts."""
    on_ref, on_new, differs, category = F.col("n_ref") > 0, F.col("n_new") > 0, F.col("differs"), F.col("category")
    both = on_ref & on_new
    equal = both & ~differs
    return {
        "M1": on_ref,
        "M2": on_new,
        "M6": equal & category.isNull(),
        "M7": equal,
        "M8": both & differs,
        "M9": on_ref & ~on_new,
        "M10": on_new & ~on_ref,
        "M11": category == "both",
        "M12": category == "only_ref",
        "M13": category == "only_new",
    }


def summary(ids: DataFrame, config: CompareConfig) -> DataFrame:
    """block, metric, universe, numerator, denominator, pct, samples from key flags; all text, in the order of the blocks."""
    flags = _flags()
    both = (F.col("n_ref") > 0) & (F.col("n_new") > 0)
    counts = ids.agg(
        *(F.count_if(flag).alias(m) for m, flag in flags.items()),
        F.coalesce(F.sum("n_ref"), F.lit(0)).alias("M3"),
        F.coalesce(F.sum("n_new"), F.lit(0)).alias("M4"),
        F.count_if(both).alias("B"),
    )
    zero, of_ref, of_new, of_both = F.lit(0).cast("long"), F.col("M1"), F.col("M2"), F.col("B")
    over = {"M5": F.col("M3"), "M6": of_both, "M7": of_both, "M8": of_both, "M9": of_ref, "M10": of_new, "M11": of_both, "M12": of_ref, "M13": of_new}

    def row(i: int, m: str, block: str, metric: str, universe: str) -> Column:
        numerator = F.col("M4") - F.col("M3") if m == "M5" else F.col(m)
        denominator = over.get(m, zero)
        return F.struct(
            F.lit(i).alias("place"),
            F.lit(m).alias("m"),
            F.lit(block).alias("block"),
            F.lit(metric).alias("metric"),
            F.lit(universe).alias("universe"),
            numerator.cast("string").alias("numerator"),
            F.when(denominator > 0, denominator.cast("string")).otherwise("-").alias("denominator"),
            C.percentage(numerator, denominator).alias("pct"),
        )

    rows = counts.select(F.inline(F.array(*(row(i, *r) for i, r in enumerate(ROWS)))))
    sampled = [m for m in flags if m not in ("M1", "M2", "M6")]
    named = ids.select("id", F.explode(F.array_compact(F.array(*(F.when(flags[m], F.lit(m)) for m in sampled)))).alias("m"))
    order = ["id"] if config.sample_seed is None else [F.xxhash64("id", F.lit(config.sample_seed)), "id"]
    least = named.withColumn("rank", F.row_number().over(Window.partitionBy("m").orderBy(*order))).where(F.col("rank") <= config.samples)
    samples = least.groupBy(F.col("m").alias("sm")).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("samples"))
    told = rows.join(F.broadcast(samples), rows["m"] == samples["sm"], "left")  # at most ten rows
    rank = F.array_position(F.array(*map(F.lit, BLOCKS)), F.col("block"))
    ordered = told.orderBy(rank, "metric", "universe")
    return ordered.select("block", "metric", "universe", "numerator", "denominator", "pct", F.coalesce("samples", F.lit("-")).alias("samples"))
