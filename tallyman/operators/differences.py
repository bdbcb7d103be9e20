"""Column-level differences of two tables on a composite key.

Both sides are tagged, unioned and grouped by key once: one aggregate row holds
a key's representative values of either side, so representatives and the full
outer match on null-safe keys cost a single shuffle, with partial aggregation
before it (a key, or the null key, with a third of all rows is reduced where it
lies).  Cells are compared by position in arrays, one short expression a column, so
tables of hundreds of columns plan and compile as fast as narrow ones; equal
cells are filtered inside the array, so they are never exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyman.config import CompareConfig
from tallyman.functions import columns as C
from tallyman.sources.tables import projected

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "column", "value_ref", "value_new", "results")])


def tagged(ref: DataFrame, new: DataFrame, config: CompareConfig, columns: list[str]) -> DataFrame:
    """_new (side), keys, compared columns c0..., priority p0..., order o0...; NEW in REF's types."""

    target = {f.name: f.dataType for f in ref.schema}

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        kinds, names = {f.name: f.dataType for f in df.schema}, set(df.columns)

        def typed(c: str) -> Column:
            if is_new:
                return C.comparable(F.col(c), kinds[c], target[c])
            return C.canonical(F.col(c), kinds[c])

        def extra(names: tuple[str, ...], mark: str) -> list[Column]:
            # a column that one side lacks is null there
            shared = [c for c in names if c in ref.columns or c in new.columns]
            return [(typed(c) if c in target and c in names else F.col(c) if c in names else F.lit(None)).alias(f"{mark}{i}") for i, c in enumerate(shared)]

        # with priorities, duplicates are the rows that differ in something else
        rest = [C.row_text(F.col(c), kinds[c]) for c in columns if c not in config.priority] if config.priority else []
        row = [F.xxhash64(*rest, F.lit(0)).alias("_row")] if config.priority else []
        keys = [(C.key(F.col(k), kinds[k]) if not is_new else C.key(C.comparable(F.col(k), kinds[k], target[k]), target[k])).alias(f"k{i}") for i, k in enumerate(config.keys)]
        return df.select(F.lit(is_new).alias("_new"), *keys, *(typed(c).alias(f"c{i}") for i, c in enumerate(columns)), *extra(config.priority, "p"), *extra(config.first_order, "o"), *row)

    return side(ref, False).unionByName(side(new, True))


#: From so many columns on, constants are found from one row a cell instead of three aggregates a column.
WIDE = 48


def constant_columns(both: DataFrame, columns: list[str], null_aware: bool) -> set[str]:
    """Columns that hold one equal value on both sides: least and greatest values of either side, two rows a column to the driver at most."""
    if not columns:
        return set()
    spread = [F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_if(F.col("v").isNull()).alias("nulls")]
    if len(columns) >= WIDE:
        texts = ", ".join(f"CAST(c{i} AS STRING)" for i in range(len(columns)))
        cells = both.select("_new", F.posexplode(F.expr(f"array({texts})")).alias("i", "v"))
        stats = {(r["_new"], r["i"]): r for r in cells.groupBy("_new", "i").agg(*spread).collect()}
    else:
        values = [F.col(f"c{i}").cast("string") for i in range(len(columns))]
        held = [F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count_if(v.isNull()).alias("nulls")).alias(f"s{i}") for i, v in enumerate(values)]
        stats = {(r["_new"], i): r[f"s{i}"] for r in both.groupBy("_new").agg(*held).collect() for i in range(len(columns))}
    found = set()
    for i, c in enumerate(columns):
        a, b = stats.get((False, i)), stats.get((True, i))
        if a and b and a.lo is not None and a.lo == a.hi == b.lo == b.hi and not (null_aware and (a.nulls or b.nulls)):
            found.add(c)
    return found


def _representatives(both: DataFrame, config: CompareConfig, columns: list[str], at: dict[str, int], distinct: bool = False) -> DataFrame:
    """One row per key: r (REF's values), n (NEW's), n_ref and n_new (rows), in_ref, in_new, and with priorities d_ref and d_new (rows that differ in something else)."""
    keys = [f"k{i}" for i in range(len(config.keys))]
    priority = [c for c in both.columns if c[0] == "p" and c[1:].isdigit()]
    order = [c for c in both.columns if c[0] == "o" and c[1:].isdigit()]
    names = [f"c{at[c]}" for c in columns]

    def values(is_new: bool) -> list[Column]:
        here = F.col("_new") == is_new
        if not columns:
            return []
        if priority:
            # the row with the greatest priorities; ties go to the greatest values
            rank = F.struct(*(F.col(p) for p in priority), *(F.col(c) for c in names))
            return [F.max_by(F.struct(*names), F.when(here, rank)).alias("n" if is_new else "r")]
        made = []
        for c, name in zip(columns, names, strict=True):
            how = config.override(c)
            if how == "first":
                wanted = here & F.col(name).isNotNull()
                made.append(F.min_by(F.col(name), F.when(wanted, F.struct(*order))) if order else F.first(F.when(here, F.col(name)), ignorenulls=True))
            else:
                # as text: hundreds of columns would take many calls each
                made.append(F.expr(f"{how}(CASE WHEN {'' if is_new else 'NOT '}_new THEN {name} END)"))
        return [m.alias(("n" if is_new else "r") + name) for m, name in zip(made, names, strict=True)]

    group = [F.col(k) for k in keys]
    if not config.null_keys_match:
        # rows with a null in the key only meet rows of their own side
        some_null = F.lit(False)
        for k in keys:
            some_null = some_null | F.col(k).isNull()
        group.append(F.when(some_null, F.col("_new")).alias("_apart"))
    rows = [F.count_if(~F.col("_new")).alias("n_ref"), F.count_if("_new").alias("n_new")]
    if priority and distinct:
        rows += [F.count_distinct(F.when(F.col("_new") == is_new, F.col("_row"))).alias(name) for is_new, name in ((False, "d_ref"), (True, "d_new"))]
    grouped = both.groupBy(*group).agg(*values(False), *values(True), *rows).withColumns({"in_ref": F.col("n_ref") > 0, "in_new": F.col("n_new") > 0})
    if priority and columns:
        grouped = grouped.select("*", *(F.col(f"r.{c}").alias(f"r{c}") for c in names), *(F.col(f"n.{c}").alias(f"n{c}") for c in names)).drop("r", "n")
    return grouped


def prepared(ref: DataFrame, new: DataFrame, config: CompareConfig, columns: list[str]) -> DataFrame:
    """Both sides, tagged, with the compared columns."""
    missing = [k for k in config.keys if k not in ref.columns or k not in new.columns]
    if missing:
        raise ValueError(f"key columns are missing: {', '.join(missing)}")
    return tagged(projected(ref, config, columns), projected(new, config, columns), config, columns)


def pruned_columns(both: DataFrame, config: CompareConfig, columns: list[str]) -> list[str]:
    """The compared columns without constants."""
    if not config.prune_constants:
        return columns
    constant = constant_columns(both, columns, config.null_aware_constants)
    return [c for c in columns if c not in constant]


def _compared(rows: DataFrame, columns: list[str], at: dict[str, int]) -> DataFrame:
    """rows with `_same`, a flag for each column."""
    same = ", ".join(f"rc{at[c]} <=> nc{at[c]}" for c in columns)
    return rows.withColumn("_same", F.expr(f"CAST(array({same}) AS array<boolean>)"))


def _exact() -> Column:
    return F.col("in_ref") & F.col("in_new") & ~F.array_contains("_same", False)


def key_flags(both: DataFrame, config: CompareConfig, columns: list[str], pruned: list[str]) -> DataFrame:
    """One row per key (not per id, which joins the key's texts): id, n_ref, n_new (rows), differs, category of its duplicates (null without).

    The same single shuffle as the differences.
    """
    at = {c: i for i, c in enumerate(columns)}
    rows = _compared(_representatives(both, config, pruned, at, distinct=True) if pruned else _counted(both, config), pruned, at)
    names = ("d_ref", "d_new") if "d_ref" in rows.columns else ("n_ref", "n_new")
    on_ref, on_new = (F.col(c) >= 2 for c in names)
    category = F.when(on_ref & on_new, "both").when(on_ref, "only_ref").when(on_new, "only_new") if config.check_duplicates else F.lit(None).cast("string")
    # a key that no compared column tells apart differs if one side lacks it, as long as anything is compared
    differs = ~_exact() if pruned else F.lit(False)
    key = C.composite_id([F.col(f"k{i}") for i in range(len(config.keys))])
    return rows.select(key.alias("id"), "n_ref", "n_new", differs.alias("differs"), category.alias("category"))


def _counted(both: DataFrame, config: CompareConfig) -> DataFrame:
    """Keys and their rows alone, where no column is left to compare."""
    return _representatives(both, config, [], {}, distinct=True)


def differences(both: DataFrame, config: CompareConfig, columns: list[str], pruned: list[str]) -> DataFrame:
    """id, column, value_ref, value_new, results: a row per key and column, EXACT_MATCH keys in one row."""
    at = {c: i for i, c in enumerate(columns)}
    columns = pruned
    if not columns:
        return both.sparkSession.createDataFrame([], SCHEMA)
    rows = _compared(_representatives(both, config, columns, at), columns, at)
    rows = rows.withColumn("id", C.composite_id([F.col(f"k{i}") for i in range(len(config.keys))]))
    if not config.include_equals:
        rows = rows.where(~_exact())
    texts = lambda side: F.expr("array(" + ", ".join(f"CAST({side}c{at[c]} AS STRING)" for c in columns) + ")")
    rows = rows.select("id", "in_ref", "in_new", "_same", F.array(*map(F.lit, columns)).alias("column"), texts("r").alias("r"), texts("n").alias("n"))
    zipped = F.arrays_zip("column", "r", "n", "_same")

    def told(x: Column) -> Column:
        result = F.when(~F.col("in_ref"), C.ONLY_NEW).when(~F.col("in_new"), C.ONLY_REF).when(x["_same"], C.MATCH).otherwise(C.NO_MATCH)
        return F.struct(x["column"].alias("column"), C.display(x["r"]).alias("value_ref"), C.display(x["n"]).alias("value_new"), result.alias("results"))

    if config.include_equals:
        one = F.struct(F.lit(C.ALL_COLUMNS).alias("column"), F.lit(C.ALL_MATCH).alias("value_ref"), F.lit(C.ALL_MATCH).alias("value_new"), F.lit(C.EXACT).alias("results"))
        cells = F.when(_exact(), F.array(one)).otherwise(F.transform(zipped, told))
    else:
        cells = F.transform(F.filter(zipped, lambda x: ~x["_same"] | ~F.col("in_ref") | ~F.col("in_new")), told)
    return rows.select("id", F.inline(cells)).select(*(F.col(f.name).cast("string").alias(f.name) for f in SCHEMA))


def mismatches_by_column(diff: DataFrame) -> DataFrame:
    """column, results, keys: how many keys have each verdict in each column."""
    return diff.groupBy("column", "results").agg(F.count(F.lit(1)).alias("keys"))
