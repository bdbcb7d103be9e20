"""Sources and sinks on disk and in the catalog."""

import os

import pytest
from pyspark.sql import functions as F

from tallyman import cli
from tallyman.plans.compare import compare
from tallyman.sources import sinks
from tallyman.sources.tables import load


def test_partitions_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 4, f"d{i % 3}") for i in range(40)], "v int, p int, d string")
    df.write.partitionBy("p", "d").parquet(str(tmp_path / "t"))
    got = load(spark, str(tmp_path / "t"), "p=[1,2]/d=*")
    assert got.count() == 20
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "p#" in plan.split("PartitionFilters")[1][:60]
    assert load(spark, str(tmp_path / "t"), "p=x").count() == 0


def test_paths_are_overwritten_by_date(spark, tmp_path):
    kind = "id int, v string"
    ref, new = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], kind), spark.createDataFrame([(1, "a"), (2, "c")], kind)
    made = compare(spark, ref, new, keys=["id"])
    out = str(tmp_path / "out")
    for _ in range(2):
        made.write(out, "init", "2024-01-01", files=1)
    read = lambda kind: spark.read.parquet(f"{out}/{kind}")
    assert read("differences").count() == 1 and read("duplicates").count() == 1 and read("summary").count() == 13
    # an empty result replaces the old one
    compare(spark, new, new, keys=["id"]).write(out, "init", "2024-01-01")
    same = spark.read.schema("id string").parquet(f"{out}/duplicates/initiative=init/data_date_part=2024-01-01")
    assert same.count() == 0
    assert read("summary").where("metric = 'Global quality'").first().pct == "100.0000%"


def test_tables(spark, tmp_path):
    kind = "id int, v string"
    ref, new = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], kind), spark.createDataFrame([(1, "a"), (2, "c")], kind)
    where = str(tmp_path / "wh")
    for name in ("differences", "duplicates", "summary"):
        spark.sql(f"DROP TABLE IF EXISTS t_{name}")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        compare(spark, ref, new, keys=["id"]).write_tables("t", "init", day, where)
    assert spark.table("t_differences").groupBy("data_date_part").count().orderBy("data_date_part").collect()[1]["count"] == 1
    compare(spark, new, new, keys=["id"]).write_tables("t", "init", "2024-01-02", where)
    assert [r[0] for r in spark.table("t_duplicates").select("data_date_part").collect()] == ["2024-01-01"]
    assert spark.table("t_summary").count() == 26
    for name in ("differences", "duplicates", "summary"):
        spark.sql(f"DROP TABLE t_{name}")
    assert sinks.table_name("x_", "summary") == "x_summary"


def test_command_line(spark, tmp_path):
    df = spark.range(20).select(F.col("id").cast("int"), F.lit("2024-05-01").alias("ds"), (F.col("id") % 3).alias("v"))
    df.write.parquet(str(tmp_path / "ref"))
    df.where("id <> 3").withColumnRenamed("v", "w").write.parquet(str(tmp_path / "new"))
    args = [f"refTable={tmp_path}/ref", f"newTable={tmp_path}/new", "initiativeName=i", "tablePrefix=p", f"outputBucket={tmp_path}/out", "executionDate=2024-05-01", "compositeKeyCols=id", "colMap.v=w", "partitionSpec=ds=$EXEC_DATE", "checkDuplicates=true", f"exportExcelPath={tmp_path}/s.csv"]
    done = cli.run(args, spark)
    assert done.columns == ["v"]
    assert spark.read.parquet(f"{tmp_path}/out/p/differences").count() == 1
    assert os.path.exists(tmp_path / "s.csv") and done.input_files()[0] >= 1


def test_a_spreadsheet_without_a_writer_is_an_error(spark, tmp_path, monkeypatch):
    import pandas as pd

    def absent(*a, **k):
        raise ImportError("no writer")

    monkeypatch.setattr(pd.DataFrame, "to_excel", absent)
    ref = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(RuntimeError, match="spreadsheet"):
        sinks.export_summary(compare(spark, ref, ref, keys=["id"]).summary, str(tmp_path / "s.xlsx"))
