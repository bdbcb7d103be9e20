"""Registered queries of the reconciliation engine, over the driver's tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyman.functions import columns as C
from tallyman.operators.differences import mismatches_by_column
from tallyman.sources import sinks, specs
from tallyman.sources.tables import sides

from .compare import Comparison, compare, config_of_parameters, parse_arguments
from .pairs import COLUMNS, KEYS, PAIRS, TABLES

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pair(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    source = TABLES[name]
    rows = table(spark, sf_dir, source)
    return tuple(spark.sql(sql.replace(f"FROM {source}", "FROM {rows}"), rows=rows) for sql in PAIRS[name])


def compared(spark: SparkSession, sf_dir: str, name: str, **options) -> Comparison:
    return compare(spark, *pair(spark, sf_dir, name), keys=KEYS[name], **options)


def _diff(name: str, **options) -> Query:
    return lambda spark, sf_dir: compared(spark, sf_dir, name, **options).differences


def _dups(name: str, **options) -> Query:
    return lambda spark, sf_dir: compared(spark, sf_dir, name, **options).duplicates


def _summary(name: str, *blocks: str, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = compared(spark, sf_dir, name, **options).summary
        return made.where(F.col("block").isin(*blocks)) if blocks else made

    return run


def diff_mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, new = pair(spark, sf_dir, "cust")
    names = {"name": "nombre", "segment": "segmento", "balance": "saldo"}
    return compare(spark, ref, new.withColumnsRenamed(names), keys=["name"], mapping=names).differences


def _nested(keys: str, ref: DataFrame, new: DataFrame) -> DataFrame:
    """Whole rows, so the canonical texts of nested values are compared as well."""
    return compare(ref.sparkSession, ref, new, keys=[keys], include_equals=True).differences


def diff_array_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of an array's elements counts."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), F.array(F.col("event_type"), F.col("user_id").cast("string"), F.lit(None)).alias("c"))
    return _nested("k", rows, rows.withColumn("c", F.when(F.col("k") % 4 == 0, F.reverse("c")).otherwise(F.col("c"))))


def diff_struct_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null field is no difference to a field that is absent; another value is."""
    rows = table(spark, sf_dir, "events")
    ref = rows.select(F.col("event_id").alias("k"), F.struct(F.col("event_type").alias("a"), F.lit(None).cast("int").alias("b")).alias("c"))
    changed = F.when(F.col("event_id") % 6 == 0, F.concat("event_type", F.lit("!"))).otherwise(F.col("event_type"))
    return _nested("k", ref, rows.select(F.col("event_id").alias("k"), F.struct(changed.alias("a")).alias("c")))


def diff_map_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps with entries in another order are equal."""
    rows = table(spark, sf_dir, "events")
    ref = rows.select(F.col("event_id").alias("k"), F.create_map(F.lit("t"), F.col("event_type"), F.lit("u"), F.col("user_id").cast("string")).alias("c"))
    kind = F.when(F.col("event_id") % 6 == 0, F.lit("other")).otherwise(F.col("event_type"))
    new = rows.where(F.col("event_id") % 8 != 7).select(F.col("event_id").alias("k"), F.create_map(F.lit("u"), F.col("user_id").cast("string"), F.lit("t"), kind).alias("c"))
    return _nested("k", ref, new)


def diff_binary_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), F.unhex(F.sha2("text", 256)).alias("c"))
    return _nested("k", rows, rows.withColumn("c", F.when(F.col("k") % 5 == 0, F.lit("x").cast("binary")).otherwise(F.col("c"))))


def diff_mismatch_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mismatches_by_column(compared(spark, sf_dir, "ord", include_equals=True).differences)


def dups_variations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir, "li").duplicates.where(F.col("variations") != "-").select("origin", "id", "variations")


def dups_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir, "li").duplicates.groupBy("origin", "category").agg(F.count(F.lit(1)).alias("keys"))


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, _ = pair(spark, sf_dir, "li")
    kinds = {f.name: f.dataType for f in ref.schema}
    return ref.select(C.row_hash([C.row_text(F.col(c), kinds[c]) for c in (*KEYS["li"], *COLUMNS["li"])]).alias("hash"))


def _ids(on_ref: bool, on_new: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        flags = compared(spark, sf_dir, "ord").key_flags
        return flags.where(((F.col("n_ref") > 0) == on_ref) & ((F.col("n_new") > 0) == on_new)).select("id")

    return run


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, new = pair(spark, sf_dir, "cust")
    changed = new.withColumn("nation", F.col("nation").cast("string")).withColumnRenamed("balance", "saldo").select("segment", "name", "nation", "saldo")
    return compare(spark, ref, changed, keys=["name"]).schema_report.frame(spark)


def drift_lossy_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of NEW that REF's type can't hold: texts that are no number, fractions, numbers beyond it."""
    rows = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey").cast("string")
    odd = F.when(F.col("o_orderkey") % 7 == 0, F.lit("none")).when(F.col("o_orderkey") % 7 == 1, F.concat(number, F.lit(".5"))).otherwise(number)
    ref = rows.select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("int").alias("n"), F.col("o_orderkey").cast("int").alias("m"), F.lit("x").alias("t"))
    new = rows.select(F.col("o_orderkey").alias("k"), odd.alias("n"), (F.col("o_orderkey").cast("decimal(20,2)") + F.when(F.col("o_orderkey") % 5 == 0, F.lit(0.25).cast("decimal(20,2)")).otherwise(0)).alias("m"), F.lit("x").alias("t"))
    return compare(spark, ref, new, keys=["k"]).lossy_casts


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of this query's own, shared by driver and executors."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{at.rstrip('/')}/tallyman/{name}-{uuid.uuid4().hex}"


def _partitioned(spark: SparkSession, sf_dir: str, name: str) -> dict[str, str]:
    """Paths of the orders' sides as tables partitioned by month."""
    paths = {}
    for side, rows in zip(("ref", "new"), pair(spark, sf_dir, "ord"), strict=True):
        paths[side] = _scratch(spark, f"{name}-{side}")
        month = F.date_format("odate", "yyyy-MM-01").cast("date")
        rows.withColumn("data_date_part", month).repartition("data_date_part").write.partitionBy("data_date_part").parquet(paths[side])
    return paths


def _of_parameters(spark: SparkSession, parameters: dict[str, str]) -> Comparison:
    named, config = config_of_parameters(parameters)
    return Comparison(*sides(spark, named["refTable"], named["newTable"], config), config)


def _parameters(paths: dict[str, str], **more: str) -> dict[str, str]:
    return {"refTable": paths["ref"], "newTable": paths["new"], "initiativeName": "orders", "tablePrefix": "t", "outputBucket": "out", "executionDate": "1995-03-01", "compositeKeyCols": "k", "ignoreCols": "odate", **more}


def run_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key=value parameters with a date token, over partitioned tables; one side's columns have other names."""
    paths = _partitioned(spark, sf_dir, "parameters")
    args = [f"{k}={v}" for k, v in _parameters(paths, partitionSpec='"data_date_part=$EXEC_DATE/"', newFilter="price > 1000", includeEqualsInDiff="true").items()]
    return _of_parameters(spark, parse_arguments(args)).differences


def run_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON payload whose partitions are an object with a token, and whose priority and overrides are lists and objects."""
    paths = _partitioned(spark, sf_dir, "json")
    body = _parameters(paths) | {"partitions": {"data_date_part": "{{ds}}"}, "aggOverrides": {"price": "min"}, "compositeKeyCols": ["k"]}
    return _of_parameters(spark, parse_arguments([json.dumps({"parameters": body})])).differences


def diff_window_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Either side's own window of days around the execution date (here of months, of which only the firsts exist)."""
    paths = _partitioned(spark, sf_dir, "window")
    windows = {"partitionSpec": "data_date_part=YYYY-MM-dd", "refWindowDays": "-31..+31", "newWindowDays": "0..+31"}
    return _of_parameters(spark, _parameters(paths, **windows)).differences


def input_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether either side's input files can be told."""
    counts = _of_parameters(spark, _parameters(_partitioned(spark, sf_dir, "files"))).input_files()
    return spark.createDataFrame([(side, n > 0) for side, n in zip(("ref", "new"), counts, strict=True)], "side string, known boolean")


def sink_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results written below a path twice, and read back with their partition columns as text."""
    made, path = compared(spark, sf_dir, "cust"), _scratch(spark, "sink")
    for _ in range(2):
        made.write(path, "customers", "2024-05-01")
    return _read_back({kind: spark.read.parquet(f"{path}/{kind}") for kind in sinks.KINDS})


def sink_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results in the catalog's result tables: written for two dates, one of them twice, one of those then by nothing."""
    prefix, made = f"t{uuid.uuid4().hex}", compared(spark, sf_dir, "cust")
    where = _scratch(spark, "tables")
    for date in ("2024-05-01", "2024-05-02", "2024-05-02"):
        made.write_tables(prefix, "customers", date, where)
    compared(spark, sf_dir, "same").write_tables(prefix, "customers", "2024-05-02", where)
    made = {}
    for kind in sinks.KINDS:  # what the tables hold is kept, the tables go
        name = sinks.table_name(prefix, kind)
        spark.table(name).write.parquet(copy := _scratch(spark, name))
        made[kind] = spark.read.schema(spark.table(name).schema).parquet(copy)
        spark.sql(f"DROP TABLE {name}")
    return _read_back(made)


def _read_back(results: dict[str, DataFrame]) -> DataFrame:
    """kind, initiative, date, and every row of the results as one text."""
    told = []
    for kind, df in results.items():
        cells = F.concat_ws("|", *(F.col(f.name) for f in sinks.KINDS[kind]))
        told.append(df.select(F.lit(kind).alias("kind"), F.col("initiative").cast("string").alias("initiative"), F.col("data_date_part").cast("string").alias("date"), cells.alias("cells")))
    return reduce(DataFrame.unionByName, told)


def spec_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the functions of specs and dates make of typical texts; plain Python, so a list."""
    day, parts = "2025-10-06", ["geo=ES/ds=2025-10-05", "geo=ES/ds=2025-10-06", "geo=MX/ds=2025-10-06"]
    shown = lambda x: json.dumps(x, separators=(",", ":"))
    rows = [
        *(("parse_spec", t, shown(specs.parse_spec(t))) for t in SPECS),
        ("matching_values", "geo=*/ds=2025-10-06", shown(specs.matching_values(parts, specs.parse_spec("geo=*/ds=2025-10-06"), "geo"))),
        ("parse_partition", parts[0], shown(specs.parse_partition(parts[0]))),
        *(("normalize_spec", t, specs.normalize_spec(t, day)) for t in ('"ds=$EXEC_DATE/geo=*"', "ds=YYYYMMdd/x=1", "d={{ds}}/", "*")),
        *(("rewrite_dates", t, specs.rewrite_dates(t, day)) for t in ("a 2020-01-31 b", "31/01/2020", "yyyy-MM-dd and dd/MM/yyyy", "{{ ds_nodash }}", "YYYY_MM_DD", "99/99/2020")),
        ("rewrite_dates_deep", '["2020-01-31",{"a":"{{ds}}"},3]', shown(specs.rewrite_dates_deep(["2020-01-31", {"a": "{{ds}}"}, 3], day))),
        ("spec_of_partitions", '{"a":"x","b":true,"c":null,"d":7}', specs.spec_of_partitions({"a": "x", "b": True, "c": None, "d": 7})),
        *(("extract_date", t, specs.extract_date(t, "1999-01-01")) for t in ('ds="2025-10-06"/geo=ES', "ds=06/10/2025", 'y="2025"/m="10"/d="06"', "geo=ES")),
        *(("extract_date_or", t, specs.extract_date_or(t, "1999-01-01")) for t in ("geo=ES", "ds=2025-10-06")),
        *(("execution_date_or", f"{t},{c}", specs.execution_date_or(t, c, "1999-01-01")) for t, c in (('ds="2025-10-06"', None), ('ds="06/10/2025"', "x"), ("", "2025-10-07"), ("", None))),
        *(("window_dates", t, ",".join(specs.window_dates(day, specs.parse_window(t) or (0, 0)))) for t in ("-1..+1", "0..2", "x")),
        ("with_dates", "geo=ES/ds=x", specs.with_dates("geo=ES/ds=x", ["2025-10-06"], "ds")),
        ("with_dates", "geo=ES", specs.with_dates("geo=ES", ["2025-10-06"], "ds")),
        *(("side_spec", shown([d, w, "ds=2025-10-06"]), specs.side_spec(d, w, "ds=2025-10-06", day, "ds")) for d, w in (("ds=1", "-1..0"), (None, "-1..0"), (None, None))),
        ("renamed_spec", "geo=ES/ds=x", specs.renamed_spec("geo=ES/ds=x", {"geo": "pais"})),
    ]
    return spark.createDataFrame(rows, "function string, input string, output string")


#: One spec of every form.
SPECS = ("a=1", 'a="x y"', "a=*", "a=", "a=[1, 2]", "a=(1|2)", "a=IN[1,2]", "a=in(1,2)", "a=1|2", "a=06/10/2025/b=x", 'a="p/q"/b=[r/s]', "nothing")

_FILTER = "price > 1000 AND status IN ('O', 'F')"

QUERIES: dict[str, Query] = {
    "diff_full": _diff("ord", include_equals=True),
    "diff_no_equals": _diff("ord"),
    "diff_composite_key": _diff("li"),
    "diff_null_keys_match": _diff("cust", include_equals=True),
    "diff_null_keys_strict": _diff("cust", include_equals=True, null_keys_match=False),
    "diff_agg_min": _diff("li", overrides={"qty": "min", "ship": "min"}),
    "diff_agg_first": _diff("li", overrides={"qty": "first_non_null", "flag": "first"}, first_order=("price", "part")),
    "diff_priority": _diff("evt", priority=("e",)),
    "diff_mapped_columns": diff_mapped_columns,
    "diff_filtered": _diff("ord", ref_filter=_FILTER, new_filter=_FILTER),
    "diff_partition_spec": _diff("cust", spec="nation=[1,3|5]"),
    "diff_window_days": diff_window_days,
    "diff_wide": _diff("wide"),
    "dups_wide": _dups("wide"),
    "summary_wide": _summary("wide"),
    "summary_ambiguous_ids": _summary("amb"),
    "summary_priority": _summary("evt", priority=("e",)),
    "dups_null_keys": _dups("cust"),
    "run_parameters": run_parameters,
    "run_json": run_json,
    "input_file_counts": input_file_counts,
    "sink_paths": sink_paths,
    "sink_tables": sink_tables,
    "spec_functions": spec_functions,
    "drift_lossy_casts": drift_lossy_casts,
    "diff_constant_pruned": _diff("const"),
    "diff_array_column": diff_array_column,
    "diff_struct_column": diff_struct_column,
    "diff_map_column": diff_map_column,
    "diff_binary_column": diff_binary_column,
    "diff_mismatch_by_column": diff_mismatch_by_column,
    "dups_basic": _dups("ord"),
    "dups_composite": _dups("li"),
    "dups_priority": _dups("evt", priority=("e",)),
    "dups_variations": dups_variations,
    "dups_category_counts": dups_category_counts,
    "row_hash": row_hash,
    "summary_full": _summary("ord"),
    "summary_composite": _summary("li"),
    "summary_kpis": _summary("ord", "KPIS"),
    "summary_matches": _summary("ord", "EXACT MATCH", "PARTIAL MATCH"),
    "summary_gaps": _summary("ord", "GAP"),
    "summary_dups": _summary("ord", "DUPS"),
    "ids_only_ref": _ids(True, False),
    "ids_only_new": _ids(False, True),
    "ids_both": _ids(True, True),
    "schema_report": schema_report,
}
