"""Specs, dates, parameters: plain Python."""

import json

import pytest

from tallyman.plans.compare import config_of_parameters, parameters_of_json
from tallyman.cli import parse_arguments
from tallyman.sources import specs

DAY = "2025-08-14"


@pytest.mark.parametrize(
    "spec, want",
    [
        ("a=1/b=x", {"a": ["1"], "b": ["x"]}),
        ('a="1"/b=\'x\'', {"a": ["1"], "b": ["x"]}),
        ("a=[1,2|3]/b=(x|y)/c=IN[p,q]/d=in(r,s)", {"a": ["1", "2", "3"], "b": ["x", "y"], "c": ["p", "q"], "d": ["r", "s"]}),
        ("a=*/b=/c=[*]", {"a": [], "b": [], "c": []}),
        ("geo=ES|PT/", {"geo": ["ES", "PT"]}),
        ("d=14/08/2025/e=1", {"d": ["14/08/2025"], "e": ["1"]}),
        ('d="a/b"/e=[x/y,z]', {"d": ["a/b"], "e": ["x/y", "z"]}),
        ("no equals", {}),
        (None, {}),
    ],
)
def test_parse_spec(spec, want):
    assert specs.parse_spec(spec) == want


@pytest.mark.parametrize(
    "spec, want",
    [
        ("ds=YYYY-MM-dd/geo=*", "ds=2025-08-14"),
        ('ds="$EXEC_DATE"/geo="ES"', "ds=2025-08-14/geo=ES"),
        ("ds=${EXEC_DATE}/x={{ds}}", "ds=2025-08-14/x=2025-08-14"),
        ("ds=yyyyMMdd/junk", "ds=20250814"),
        ("fecha=dd/MM/yyyy/geo=ES", "fecha=14/08/2025/geo=ES"),
        ("geo=*", None),
        ("  ", None),
        (None, None),
    ],
)
def test_normalize_spec(spec, want):
    assert specs.normalize_spec(spec, DAY) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ('date="$dataDatePart"/geo="ES"', 'date="2025-08-14"/geo="ES"'),
        ('fecha="14/08/2024"/country="ES"', 'fecha="14/08/2025"/country="ES"'),
        ("A: 2024-01-02 | B: 03/02/2024 | C end", "A: 2025-08-14 | B: 14/08/2025 | C end"),
        ("ref-2024-01-01x not_a_date 99/99/9999", "ref-2024-01-01x not_a_date 99/99/9999"),
        ("$EXEC_DATE ${EXEC_DATE} {{ds}} {{ ds_nodash }}", "2025-08-14 2025-08-14 2025-08-14 20250814"),
        ("yyyy/MM/dd dd-MM-yyyy YYYY_MM_dd ddMMyyyy YYYYMMDD", "2025/08/14 14-08-2025 2025_08_14 14082025 20250814"),
    ],
)
def test_rewrite_dates(text, want):
    assert specs.rewrite_dates(text, DAY) == want


def test_parameters():
    got, spec = specs.normalize_parameters({"partitions": {"layer": "silver", "ds": "2024-01-01", "region": "ES"}, "n": 3, "deep": ["2024-01-01", {"x": "{{ds}}", "y": True}]}, DAY)
    assert spec == 'layer="silver"/ds="2025-08-14"/region="ES"'
    assert got["n"] == 3 and got["deep"] == [DAY, {"x": DAY, "y": True}]
    assert specs.normalize_parameters({"partitionSpec": "a=1", "partitions": {"b": "2"}}, DAY)[1] == "a=1"
    assert specs.normalize_parameters({}, DAY)[1] is None
    with pytest.raises(json.JSONDecodeError):
        specs.parse_json("{bad")


@pytest.mark.parametrize(
    "spec, want",
    [
        ('foo="x"/any_key="2025-08-14"/bar="y"', DAY),
        ("geo=BJG/data_date_part=2020-12-01/", "2020-12-01"),
        ('dia="14/08/2025"/otro="zz"', DAY),
        ('year="2025"/month="08"/day="14"', DAY),
        ('m="08"/y="2025"/d="14"', DAY),
        ("y=2025/d=14/m=08", DAY),
        ("none", "today"),
        (None, "today"),
    ],
)
def test_extract_date(spec, want):
    assert specs.extract_date(spec, "today") == want


def test_dates_of_sides():
    assert specs.extract_date_or("geo=ES", DAY) == DAY
    assert specs.execution_date_or('d="01/02/2020"', None) == "2020-02-01"
    assert specs.execution_date_or('d="2020-01-01"', DAY) == DAY
    assert specs.parse_window(" -2..+1 ") == (-2, 1) and specs.parse_window("x") is None
    assert specs.window_dates("2024-03-01", (-1, 1)) == ["2024-02-29", "2024-03-01", "2024-03-02"]
    assert specs.with_dates("geo=ES/data_date_part=x", ["a", "b"]) == "geo=ES/data_date_part=[a,b]"
    assert specs.with_dates(None, ["a"], "ds") == "ds=[a]"
    assert specs.side_spec("direct=1", "0..1", "common=1", DAY) == "direct=1"
    assert specs.side_spec(None, "0..1", "geo=ES", DAY) == "geo=ES/data_date_part=[2025-08-14,2025-08-15]"
    assert specs.side_spec(None, None, "geo=ES", DAY) == "geo=ES"


def test_renamed_spec():
    assert specs.renamed_spec("geo=*/data_date_part=2023-11-22", {"geo": "pais", "data_date_part": "fecha_proceso"}) == "pais=*/fecha_proceso=2023-11-22"
    assert specs.renamed_spec("year=2023/month=11/day=22/geo=ES", {"year": "ano", "month": "mes", "day": "dia", "geo": "pais"}) == "ano=2023/mes=11/dia=22/pais=ES"


def test_partitions():
    parts = ["geo=ES/ds=1", "geo=FR/ds=1", "geo=ES/ds=2"]
    assert specs.matching_values(parts, specs.parse_spec("geo=*/ds=1"), "geo") == ["ES", "FR"]


KV = ["refTable=r", "newTable=n", "initiativeName=i", "tablePrefix=p", "outputBucket=/tmp/x", f"executionDate={DAY}", "compositeKeyCols=a, b"]


def test_key_value_arguments():
    kv = parse_arguments([*KV, "refFilter=status = 'A'", "newFilter=\"x > 1\"", "priorityCol=z", "colMap.a=aa", "newWindowDays=-1..0", "partitionSpec=ds=YYYY-MM-dd/geo=*", "dateColumn=ds", "junk"])
    named, config = config_of_parameters(kv)
    assert config.keys == ("a", "b") and config.ref_filter == "status = 'A'" and config.new_filter == "x > 1"
    assert config.priority == ("z",) and config.mapping == {"a": "aa"} and config.spec == "ds=2025-08-14"
    assert config.ref_spec is None and config.new_spec == "ds=[2025-08-13,2025-08-14]" and named["files"] == 1
    with pytest.raises(ValueError, match="compositeKeyCols"):
        config_of_parameters(parse_arguments(KV[:-1]))


def test_json_payload():
    payload = {"parameters": {"refTable": "r", "newTable": "n", "initiativeName": "i", "tablePrefix": "p", "outputBucket": "b", "executionDate": DAY, "compositeKeyCols": ["a"], "checkDuplicates": True, "nullKeyMatches": False, "aggOverrides": {"v": "min"}, "partitions": {"region": "ES", "ds": "2024-01-01"}}}
    kv = parameters_of_json(json.dumps(payload))
    _, config = config_of_parameters(kv)
    assert kv["partitionSpec"] == 'region="ES"/ds="2025-08-14"'
    assert config.spec == "region=ES/ds=2025-08-14" and config.override("v") == "min" and not config.null_keys_match and config.check_duplicates
