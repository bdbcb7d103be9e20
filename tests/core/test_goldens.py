"""Golden tables: the fixtures of FIXTURES.md."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyman.config import CompareConfig
from tallyman.operators import summary as S
from tallyman.plans.compare import compare
from tallyman.sources.tables import renamed

F1 = "id int, country string, amount decimal(38,18), status string"
REF1 = [(1, "US", "100.40", "active"), (2, "ES ", "1.000000000000000001", "expired"), (3, "MX", "150", "active"), (4, "FR", "200", "new"), (4, "BR", "201", "new"), (5, "FR", "300", "active"), (5, "FR", "300.5", "active"), (7, "PT", "300.5", "active"), (8, "BR", "100.5", "pending"), (9, "AN", "80", "new"), (10, "GR", "60", "new"), (None, "GR", "61", "new"), (None, "GR", "60", "new")]
NEW1 = [(1, "US", "100.40", "active"), (2, "ES", "1.000000000000000001", "expired"), (4, "BR", "201", "new"), *[(4, "BR", "200", "new")] * 3, *[(6, "DE", "400", "new")] * 2, (6, "DE", "400.10", "new"), (7, "", "300.5", "active"), (8, "BR", None, "pending"), (9, "AN", "80", None), *[(None, "GR", "60", "new")] * 3, (None, "GR", "61", "new")]


def full(text):
    return f"{D(text):.18f}"


def frame(spark, rows, schema):
    return spark.createDataFrame([(a, b, None if c is None else D(c), d) for a, b, c, d in rows], schema)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


@pytest.fixture(scope="module")
def f1(spark):
    return frame(spark, REF1, F1), frame(spark, NEW1, F1)


def test_f1_differences(spark, f1):
    got = rows_of(compare(spark, *f1, keys=["id"]).differences)
    one = lambda i, a, c, s, ref: [(i, col, v if ref else "NULL", "NULL" if ref else v, "ONLY_IN_REF" if ref else "ONLY_IN_NEW") for col, v in (("country", c), ("amount", full(a)), ("status", s))]
    want = [("2", "country", "ES ", "ES", "NO_MATCH"), ("4", "country", "FR", "BR", "NO_MATCH"), ("7", "country", "PT", "<empty>", "NO_MATCH"), ("8", "amount", full("100.5"), "NULL", "NO_MATCH"), ("9", "status", "new", "NULL", "NO_MATCH")]
    want += one("3", "150", "MX", "active", True) + one("5", "300.5", "FR", "active", True) + one("10", "60", "GR", "new", True) + one("6", "400.1", "DE", "new", False)
    assert got == sorted(want, key=str) and len(got) == 17


def test_f1_with_equals(spark, f1):
    made = compare(spark, *f1, keys=["id"], include_equals=True).differences
    counts = dict(rows_of(made.groupBy("results").count()))
    assert counts == {"EXACT_MATCH": 2, "MATCH": 10, "NO_MATCH": 5, "ONLY_IN_NEW": 3, "ONLY_IN_REF": 9}
    assert rows_of(made.where("results = 'EXACT_MATCH'")) == [("1", "ALL_COLUMNS", "ALL_MATCH", "ALL_MATCH", "EXACT_MATCH"), ("NULL", "ALL_COLUMNS", "ALL_MATCH", "ALL_MATCH", "EXACT_MATCH")]


def test_f1_strict_null_keys(spark, f1):
    got = rows_of(compare(spark, *f1, keys=["id"], null_keys_match=False).differences.where("id = 'NULL'"), "results", "value_ref", "value_new")
    assert len(got) == 6 and [r[0] for r in got].count("ONLY_IN_REF") == 3 and ("ONLY_IN_REF", full("61"), "NULL") in got


def test_f1_duplicates(spark, f1):
    text = lambda *v: "amount: [" + ", ".join(full(x) for x in v) + "]"
    assert rows_of(compare(spark, *f1, keys=["id"]).duplicates) == sorted(
        [
            ("new", "4", "both", "2", "1", "4", text("200", "201")),
            ("new", "6", "only_new", "1", "1", "3", text("400", "400.1")),
            ("new", "NULL", "both", "2", "1", "4", text("60", "61")),
            ("ref", "4", "both", "0", "1", "2", "country: [BR, FR] | " + text("200", "201")),
            ("ref", "5", "only_ref", "0", "1", "2", text("300", "300.5")),
            ("ref", "NULL", "both", "0", "1", "2", text("60", "61")),
        ],
        key=str,
    )


def test_f1_summary(spark, f1):
    got = [tuple(r) for r in compare(spark, *f1, keys=["id"]).summary.collect()]
    assert [r[1:6] for r in got] == [
        ("Global quality", "BOTH", "1", "7", "14.2857%"),
        ("Total diff(new-ref)", "ROWS", "3", "13", "23.0769%"),
        ("Total rows NEW", "ROWS", "16", "-", "-"),
        ("Total rows REF", "ROWS", "13", "-", "-"),
        ("Unique IDs", "NEW", "8", "-", "-"),
        ("Unique IDs", "REF", "10", "-", "-"),
        ("1:1 (all columns)", "BOTH", "2", "7", "28.5714%"),
        ("1:1 (match & no_match cols)", "BOTH", "5", "7", "71.4286%"),
        ("0:1 (only in new)", "NEW", "1", "8", "12.5000%"),
        ("1:0 (only in ref)", "REF", "3", "10", "30.0000%"),
        ("duplicates (both)", "BOTH", "2", "7", "28.5714%"),
        ("duplicates (only in new)", "NEW", "1", "8", "12.5000%"),
        ("duplicates (only in ref)", "REF", "1", "10", "10.0000%"),
    ]
    samples = {r[1]: r[6] for r in got}
    assert samples["1:0 (only in ref)"] == "10,3,5" and samples["1:1 (all columns)"] == "1,NULL" and samples["Global quality"] == "-"
    assert tuple(got[0]._fields if hasattr(got[0], "_fields") else S.SCHEMA.names) == tuple(S.SCHEMA.names)


def test_f2_small_cases(spark):
    ref, new = spark.createDataFrame([(1, "a"), (2, "x")], "id int, col string"), spark.createDataFrame([(1, "b")], "id int, col string")
    assert rows_of(compare(spark, ref, new, keys=["id"]).differences) == [("1", "col", "a", "b", "NO_MATCH"), ("2", "col", "x", "NULL", "ONLY_IN_REF")]
    ref = spark.createDataFrame([(1, "foo"), (1, "foo"), (2, "bar")], "id int, value string")
    assert rows_of(compare(spark, ref, ref.limit(0), keys=["id"]).duplicates) == [("ref", "1", "only_ref", "1", "0", "2", "-")]
    empty = spark.createDataFrame([], "id int")
    made = compare(spark, empty, empty, keys=["id"]).summary
    assert made.where("numerator <> '0' or denominator <> '-' or pct <> '-' or samples <> '-'").count() == 0 and made.count() == 13


F3_REF = "id int, name string, balance string, priority int, geo string, data_date_part string"
F3_NEW = "id_v2 int, nombre_cliente string, saldo string, priority int, pais string, fecha_proceso string"


@pytest.fixture(scope="module")
def f3(spark):
    day = lambda rows: [(*r[:-1], f"2023-11-{r[-1]}") for r in rows]
    ref = [(1, "Alice", "", 1, "ES", 22)] * 2 + [(2, "Bob_v1", "200.0", 4, "ES", 23), (2, "Bob_v2", "220.0", 2, "ES", 23), (2, "Bob_v4", "255.0", 2, "ES", 23), (2, "Bob", "180.0", 0, "ES", 22), (3, "Charlie", "300.0", 1, "FR", 22), (5, "Emma", "150.0", 1, "ES", 22), (6, "Frank", "275.0", 1, "FR", 22), (7, "Grace", "320.0", 2, "ES", 22), (8, "Henry", "190.0", 1, "FR", 22), (9, "Iris", "410.0", 1, "ES", 22), (10, "Jack", "230.0", 2, "FR", 22)]
    new = [(1, "Alice", None, 1, "ES", 22), (2, "Bob_v1", "250.0", 2, "ES", 23), (2, "Bob_v2", "260.0", 4, "ES", 23), (2, "Bob_v4", "260.0", 2, "ES", 23), (4, "David", "400.0", 1, "FR", 22), (5, "Emma", "155.0", 1, "ES", 22), (6, "Frank", "275.0", 1, "FR", 22), (7, "Grace", "325.0", 2, "ES", 22), (8, "Henry", "190.0", 1, "FR", 22), (9, "Iris", "415.0", 1, "ES", 22), (9, "Iris", "415.0", 2, "ES", 22), (10, "Jack", "230.0", 2, "FR", 22)]
    mapping = {"id": "id_v2", "name": "nombre_cliente", "balance": "saldo", "data_date_part": "fecha_proceso", "geo": "pais"}
    options = {"keys": ["id"], "mapping": mapping, "spec": "data_date_part=[2023-11-22,2023-11-23]", "include_equals": True}
    return spark.createDataFrame(day(ref), F3_REF), spark.createDataFrame(day(new), F3_NEW), options


def test_f3_mapped(spark, f3):
    ref, new, options = f3
    made = compare(spark, ref, new, **options)
    diff = rows_of(made.differences)
    assert len(diff) == 31
    no = [r[:4] for r in diff if r[4] == "NO_MATCH"]
    assert no == sorted([("1", "balance", "<empty>", "NULL"), ("2", "balance", "255.0", "260.0"), ("5", "balance", "150.0", "155.0"), ("7", "balance", "320.0", "325.0"), ("9", "balance", "410.0", "415.0"), ("9", "priority", "1", "2")], key=str)
    assert [r[0] for r in diff if r[4] == "EXACT_MATCH"] == ["10", "6", "8"]
    dups = {(r[0], r[1]): r[2:] for r in rows_of(made.duplicates)}
    assert {k: v[:4] for k, v in dups.items()} == {("new", "2"): ("both", "0", "2", "3"), ("new", "9"): ("only_new", "0", "1", "2"), ("ref", "1"): ("only_ref", "1", "0", "2"), ("ref", "2"): ("both", "0", "3", "4")}
    assert dups["new", "9"][4] == "priority: [1, 2]" and dups["ref", "1"][4] == "-"
    summary = {(r[1], r[2]): (r[3], r[4], r[5]) for r in rows_of(made.summary)}
    assert summary["Total diff(new-ref)", "ROWS"] == ("-1", "13", "-7.6923%")
    assert summary["Global quality", "BOTH"][:2] == ("3", "8") and summary["1:1 (match & no_match cols)", "BOTH"][:2] == ("5", "8")
    assert summary["duplicates (both)", "BOTH"][:2] == ("1", "8") and summary["duplicates (only in ref)", "REF"][:2] == ("1", "9")


def test_f3_priority(spark, f3):
    ref, new, options = f3
    made = compare(spark, ref, new, priority=["priority"], **options)
    diff = rows_of(made.differences)
    assert len(diff) == 31
    assert ("2", "name", "Bob_v1", "Bob_v2", "NO_MATCH") in diff and ("2", "balance", "200.0", "260.0", "NO_MATCH") in diff
    dups = rows_of(made.duplicates, "origin", "id", "variations")
    assert [r[:2] for r in dups] == [("new", "2"), ("ref", "2")] and not any("priority" in r[2] for r in dups)


def test_f4_mapping(spark):
    df = spark.createDataFrame([(1, "Alice", 100.0)], "id_v2 int, nombre_cliente string, monto double")
    assert renamed(df, {"id": "id_v2", "name": "nombre_cliente"}).columns == ["id", "name", "monto"]
    assert renamed(df, {"id": "id_v2", "x": "absent"}).columns == ["id", "nombre_cliente", "monto"]
    assert renamed(df, {}).columns == df.columns
    with pytest.raises(ValueError):
        renamed(df, {"monto": "id_v2"})


def test_f5_filters(spark):
    ref = spark.createDataFrame([(1, "A", 100.0), (2, "B", 200.0), (3, "C", 300.0)], "id int, name string, balance double")
    new = ref.withColumnRenamed("id", "id_v2")
    made = compare(spark, ref, new, keys=["id"], mapping={"id": "id_v2"}, ref_filter="id IN (2,3)", new_filter="id_v2 IN (2,4)")
    assert rows_of(made.ref, "id") == [(2,), (3,)] and rows_of(made.new, "id") == [(2,)]
    assert compare(spark, ref, ref, keys=["id"], ref_filter="id > 99").ref.count() == 0


def test_f6_priority_duplicates(spark):
    kind = "id int, ts int, v string"
    none = spark.createDataFrame([], kind)
    same = spark.createDataFrame([(1, 10, "A"), (1, 20, "A"), (2, 10, "B")], kind)
    assert compare(spark, same, none, keys=["id"], priority=["ts"]).duplicates.count() == 0
    other = spark.createDataFrame([(1, 10, "A"), (1, 20, "B")], kind)
    made = compare(spark, other, none, keys=["id"], priority=["ts"])
    assert rows_of(made.duplicates, "id", "variations") == [("1", "v: [A, B]")]
    assert ("1", "v", "B", "NULL", "ONLY_IN_REF") in rows_of(made.differences)


def columns_of(spark, ref, new, **options):
    return {r[0] for r in rows_of(compare(spark, ref, new, keys=["id"], include_equals=True, **options).differences, "column")} - {"ALL_COLUMNS"}


def test_f7_constants(spark):
    kind = "id int, name string, same string, apart string, none string, some string"
    ref = spark.createDataFrame([(1, "a", "C", "x", None, "X"), (2, "b", "C", "x", None, None)], kind)
    new = spark.createDataFrame([(1, "z", "C", "y", None, "X"), (2, "q", "C", "y", None, "X")], kind)
    assert columns_of(spark, ref, new) == {"name", "apart", "none"}
    assert columns_of(spark, ref, new, null_aware_constants=True) == {"name", "apart", "none", "some"}
    assert "same" in columns_of(spark, ref, new, prune_constants=False)
    assert "same" in columns_of(spark, ref, new.limit(0))


def test_f8_types(spark):
    sql = "SELECT 1 AS id, {m} AS m, {a} AS a, {s} AS s, {b} AS b, {t} AS t, {d} AS d"
    ref = spark.sql(sql.format(m="map('x', 1, 'y', 2)", a="array(1, 2)", s="named_struct('a', 1)", b="X'00FF'", t="TIMESTAMP_NTZ'2024-01-01 00:00:00'", d="CAST(1.25 AS DECIMAL(10,2))"))
    new = spark.sql(sql.format(m="map('y', 2, 'x', 1)", a="array(2, 1)", s="named_struct('a', 1, 'b', CAST(NULL AS INT))", b="X'00FE'", t="TIMESTAMP_NTZ'2024-01-01 00:00:00'", d="CAST(1.2501 AS DECIMAL(12,4))"))
    made = compare(spark, ref, new, keys=["id"], include_equals=True, prune_constants=False)
    got = {r[0]: r[1] for r in rows_of(made.differences, "column", "results")}
    assert got == {"m": "MATCH", "a": "NO_MATCH", "s": "MATCH", "b": "NO_MATCH", "t": "MATCH", "d": "MATCH"}
    assert made.duplicates.count() == 0


def test_f8_drift_and_blank_keys(spark):
    ref = spark.createDataFrame([("  ", 1, "r"), ("a", 2, "r")], "id string, v int, only_ref string")
    new = spark.createDataFrame([(None, "1", "n"), ("a", "abc", "n"), ("a", "abc", "n")], "id string, v string, only_new string")
    made = compare(spark, ref, new, keys=["id"], prune_constants=False)
    assert rows_of(made.differences) == [("a", "v", "2", "NULL", "NO_MATCH")]
    assert rows_of(made.duplicates, "origin", "id", "variations") == [("new", "a", "-")]
    report = made.schema_report
    assert report.only_ref == ["only_ref"] and report.only_new == ["only_new"] and report.differences[0].severity == "critical" and not report.identical
    assert {r["kind"] for r in report.frame(spark).collect()} == {"only_in_ref", "only_in_new", "type"}
    off = compare(spark, ref, new, keys=["id"], check_duplicates=False)
    assert off.summary.where("metric = 'duplicates (both)'").first().numerator == "0"


def test_metamorphic(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    made = compare(spark, docs, docs.repartition(7), keys=["o_orderkey"], include_equals=True)
    assert made.differences.where("results <> 'EXACT_MATCH'").count() == 0
    a = docs.where("o_orderkey % 3 <> 0")
    there = rows_of(compare(spark, docs, a, keys=["o_orderkey"]).differences, "id", "column", "value_ref", "results")
    back = rows_of(compare(spark, a, docs, keys=["o_orderkey"]).differences, "id", "column", "value_new", "results")
    assert [r[:3] for r in there] == [r[:3] for r in back] and {r[3] for r in there} == {"ONLY_IN_REF"} and {r[3] for r in back} == {"ONLY_IN_NEW"}


def test_one_shuffle_of_the_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = compare(spark, docs, docs, keys=["o_orderkey"], prune_constants=False).differences._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_configuration_is_checked():
    for bad in ({"keys": ()}, {"keys": ("a", "a")}, {"keys": ("a",), "overrides": {"x": "median"}}, {"keys": ("a",), "mapping": {"x": "z", "y": "z"}}):
        with pytest.raises(ValueError):
            CompareConfig(**bad)


def test_percentages(spark):
    from tallyman.functions.columns import percentage

    one = spark.range(1)
    assert one.select(percentage(F.lit(5), F.lit(0)), percentage(F.lit(1), F.lit(3))).first()[:] == ("-", "33.3333%")


def test_ids_name_keys_but_do_not_join_them(spark):
    """(`a_b`, `c`) and (`a`, `b_c`) have one id and are two keys."""
    kind = "p string, q string, v int"
    ref = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 2)], kind)
    new = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 3), ("a", "b_c", 3)], kind)
    got = {(r.metric, r.universe): (r.numerator, r.samples) for r in compare(spark, ref, new, keys=["p", "q"]).summary.collect()}
    assert got["Unique IDs", "REF"][0] == got["Unique IDs", "NEW"][0] == "2"
    assert got["Global quality", "BOTH"][0] == "1" and got["duplicates (only in new)", "NEW"] == ("1", "a_b_c")
    assert got["1:1 (all columns)", "BOTH"] == got["1:1 (match & no_match cols)", "BOTH"] == ("1", "a_b_c")


def test_random_samples(spark):
    ref = spark.range(100).select(F.col("id").cast("int"), F.lit("x").alias("v"))
    new = ref.where("id < 0")
    pick = lambda **o: compare(spark, ref, new, keys=["id"], samples=5, **o).summary.where("metric = '1:0 (only in ref)'").first().samples.split(",")
    assert pick() == ["0", "1", "10", "11", "12"]
    assert pick(sample_seed=1) == pick(sample_seed=1) != pick(sample_seed=2) and len(set(pick(sample_seed=2))) == 5


def test_lossy_casts(spark):
    ref = spark.createDataFrame([(1, 1, "a")], "id int, n int, t string")
    new = spark.createDataFrame([(1, D("1.50"), "a"), (2, D("2.00"), "b"), (3, None, "c"), (4, D("99999999999.00"), "d")], "id int, n decimal(20,2), t string")
    assert rows_of(compare(spark, ref, new, keys=["id"]).lossy_casts) == [("n", 1, 1)]
    assert compare(spark, ref, ref, keys=["id"]).lossy_casts.count() == 0


def test_names_with_quotes(spark):
    ref = spark.createDataFrame([(1, "x"), (1, "y")], ["id", "it's"])
    assert rows_of(compare(spark, ref, ref, keys=["id"], prune_constants=False).duplicates, "origin", "variations") == [("new", "it's: [x, y]"), ("ref", "it's: [x, y]")]
