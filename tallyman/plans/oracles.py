"""DuckDB SQL for the registered queries: joins and windows, where Spark has one grouped union."""

from __future__ import annotations

from .pairs import COLUMNS, KEYS, PAIRS


def _blank(key: str) -> str:
    return f"CASE WHEN trim(CAST({key} AS VARCHAR), ' ') <> '' THEN {key} END"


def _cid(keys: tuple[str, ...], sep: str = "'_'") -> str:
    return f" || {sep} || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in keys)


def _shown(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'NULL' WHEN trim(CAST({value} AS VARCHAR), ' ') = '' THEN '<empty>' ELSE CAST({value} AS VARCHAR) END"


def _rows(sql: str, keys: tuple[str, ...], where: str = "") -> str:
    cast = ", ".join(f"{_blank(k)} AS {k}" for k in keys)
    return f"SELECT * REPLACE ({cast}) FROM ({sql}) {where}"


def diff_sql(pair: str, equals: bool = False, strict: bool = False, how: dict[str, str] | None = None, priority: str = "", where: tuple[str, str] = ("", ""), columns: tuple[str, ...] | None = None, sep: str = "'_'") -> str:
    keys, columns = KEYS[pair], columns or COLUMNS[pair]
    pick = lambda c: (how or {}).get(c, "max({})").format(c)
    parts = []
    for name, sql, only in zip("rn", PAIRS[pair], where, strict=True):
        rows = _rows(sql, keys, only)
        if priority:
            order = ", ".join(f"{c} DESC NULLS LAST" for c in (priority, *columns))
            rows = f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1"
        parts.append(f"{name} AS (SELECT {', '.join(keys)}, {', '.join(f'{pick(c)} AS {c}' for c in columns)}, true AS here FROM ({rows}) GROUP BY {', '.join(keys)})")
    meet = " AND ".join(f"r.{k} = n.{k}" if strict else f"r.{k} IS NOT DISTINCT FROM n.{k}" for k in keys)
    cid = f" || {sep} || ".join(f"coalesce(CAST(coalesce(r.{k}, n.{k}) AS VARCHAR), 'NULL')" for k in keys)
    cells = ", ".join(f"r.{c} AS r_{c}, n.{c} AS n_{c}" for c in columns)
    exact = " AND ".join(["in_r", "in_n", *(f"r_{c} IS NOT DISTINCT FROM n_{c}" for c in columns)])
    joined = f"j AS MATERIALIZED (SELECT *, {exact} AS exact FROM (SELECT {cid} AS id, coalesce(r.here, false) AS in_r, coalesce(n.here, false) AS in_n, {cells} FROM r FULL JOIN n ON {meet}))"
    result = "CASE WHEN NOT in_r THEN 'ONLY_IN_NEW' WHEN NOT in_n THEN 'ONLY_IN_REF' WHEN r_{c} IS NOT DISTINCT FROM n_{c} THEN 'MATCH' ELSE 'NO_MATCH' END"
    cells = {"column": "'{c}'", "value_ref": _shown("r_{c}"), "value_new": _shown("n_{c}"), "results": result}
    told = "SELECT id, " + ", ".join(f'unnest([{", ".join(cell.format(c=c) for c in columns)}]) AS "{name}"' for name, cell in cells.items()) + " FROM j WHERE NOT exact"
    if equals:
        told += f" UNION ALL SELECT id, 'ALL_COLUMNS', 'ALL_MATCH', 'ALL_MATCH', 'EXACT_MATCH' FROM j WHERE exact"
    keep = "" if equals else " WHERE results <> 'MATCH'"
    return f"WITH {', '.join(parts)}, {joined} SELECT * FROM ({told}){keep}"


def dups_sql(pair: str, priority: tuple[str, ...] = (), sep: str = "'_'") -> str:
    keys, columns = KEYS[pair], tuple(c for c in COLUMNS[pair] if c not in priority)
    sides = []
    for origin, sql in zip(("ref", "new"), PAIRS[pair], strict=True):
        texts = [f"coalesce(CAST({c} AS VARCHAR), '__NULL__')" for c in columns]
        names = [f"CAST({k} AS VARCHAR) AS {k}" for k in keys]
        distinct = "DISTINCT " if priority else ""
        sides.append(f"SELECT {distinct}'{origin}' AS origin, {', '.join(names)}, [{', '.join(texts)}] AS vals FROM ({_rows(sql, keys)})")
    own, of_key = f"OVER (PARTITION BY {', '.join(keys)})", f"origin, {', '.join(keys)}"
    shown = "CASE WHEN x = '__NULL__' THEN 'NULL' WHEN x = '' THEN '<empty>' ELSE x END"
    listed = ", ".join(f"'{c}'" for c in columns)
    ctes = [
        f"s AS MATERIALIZED (SELECT *, concat_ws(chr(1), origin, {_cid(keys, 'chr(1)')}) AS kid FROM ({' UNION ALL '.join(sides)}) QUALIFY count(*) OVER (PARTITION BY {of_key}) >= 2)",
        f"g AS (SELECT {of_key}, kid, count(*) AS occ, count(DISTINCT vals) AS hashes FROM s GROUP BY ALL)",
        f"v AS (SELECT kid, i, list_sort(list(DISTINCT x)) AS xs FROM (SELECT kid, unnest(range(1, {len(columns) + 1})) AS i, unnest(vals) AS x FROM s) GROUP BY kid, i HAVING count(DISTINCT x) > 1)",
        f"t AS (SELECT kid, string_agg(([{listed}])[i] || ': [' || array_to_string(list_transform(xs, lambda x: {shown}), ', ') || ']', ' | ' ORDER BY i) AS told FROM v GROUP BY kid)",
    ]
    return (
        f"WITH {', '.join(ctes)} SELECT origin, {_cid(keys, sep)} AS id, CASE WHEN bool_or(origin = 'ref') {own} AND bool_or(origin = 'new') {own} THEN 'both' WHEN bool_or(origin = 'ref') {own} THEN 'only_ref' ELSE 'only_new' END AS category, "
        f"CAST(occ - hashes AS VARCHAR) AS exact_duplicates, CAST(hashes - 1 AS VARCHAR) AS dupes_w_variations, CAST(occ AS VARCHAR) AS occurrences, coalesce(told, '-') AS variations FROM g LEFT JOIN t USING (kid)"
    )


def summary_sql(pair: str, priority: tuple[str, ...] = ()) -> str:
    """Keys are told apart by an unambiguous text; ids are shown."""
    keys, sep = KEYS[pair], "chr(1)"
    ids = [f"SELECT {_cid(keys, sep)} AS id FROM ({_rows(sql, keys)})" for sql in PAIRS[pair]]
    least = lambda who: f"(SELECT coalesce(nullif(string_agg(shown, ',' ORDER BY shown), ''), '-') FROM (SELECT replace(id, chr(1), '_') AS shown FROM (SELECT DISTINCT id FROM ({who})) ORDER BY shown LIMIT 10))"
    sets = {
        "M1": "SELECT id FROM r",
        "M2": "SELECT id FROM n",
        "M6": "SELECT id FROM b WHERE id NOT IN (SELECT id FROM v) AND id NOT IN (SELECT id FROM d)",
        "M7": "SELECT id FROM b WHERE id NOT IN (SELECT id FROM v)",
        "M8": "SELECT id FROM b WHERE id IN (SELECT id FROM v)",
        "M9": "SELECT id FROM r EXCEPT SELECT id FROM n",
        "M10": "SELECT id FROM n EXCEPT SELECT id FROM r",
        "M11": "SELECT DISTINCT id FROM d WHERE category = 'both'",
        "M12": "SELECT DISTINCT id FROM d WHERE category = 'only_ref'",
        "M13": "SELECT DISTINCT id FROM d WHERE category = 'only_new'",
    }
    count = lambda s: f"(SELECT count(*) FROM ({s}))"
    over = {"M5": count("SELECT * FROM ra"), "M6": count("SELECT * FROM b"), "M9": count("SELECT * FROM r"), "M10": count("SELECT * FROM n")}
    over |= {m: over["M6"] for m in ("M7", "M8", "M11")} | {"M12": over["M9"], "M13": over["M10"]}
    numbers = {m: count(s) for m, s in sets.items()} | {"M3": count("SELECT * FROM ra"), "M4": count("SELECT * FROM na")}
    numbers["M5"] = f"({numbers['M4']} - {numbers['M3']})"
    from tallyman.operators.summary import ROWS

    rows = []
    for m, block, metric, universe in ROWS:
        den = over.get(m, "0")
        sample = least(sets[m]) if m in sets and m not in ("M1", "M2", "M6") else "'-'"
        rows.append(f"SELECT '{block}' AS block, '{metric}' AS metric, '{universe}' AS universe, {numbers[m]} AS num, {den} AS den, {sample} AS samples")
    return (
        f"WITH ra AS ({ids[0]}), na AS ({ids[1]}), r AS (SELECT DISTINCT id FROM ra), n AS (SELECT DISTINCT id FROM na), b AS (SELECT id FROM r INTERSECT SELECT id FROM n), "
        f"v AS (SELECT DISTINCT id FROM ({diff_sql(pair, priority=priority[0] if priority else '', sep=sep)})), d AS (SELECT id, category FROM ({dups_sql(pair, priority, sep)})) "
        f"SELECT block, metric, universe, CAST(num AS VARCHAR) AS numerator, CASE WHEN den > 0 THEN CAST(den AS VARCHAR) ELSE '-' END AS denominator, "
        f"CASE WHEN den > 0 THEN printf('%.4f%%', num * 100.0::DOUBLE / den) ELSE '-' END AS pct, samples FROM ({' UNION ALL '.join(rows)})"
    )


def _block(*blocks: str, samples: bool = True) -> str:
    listed = ", ".join(f"'{b}'" for b in blocks)
    return f"SELECT block, metric, universe, numerator, denominator, pct, samples FROM ({summary_sql('ord')}) WHERE block IN ({listed})"


_FIRST = {"qty": "arg_min(qty, (price, part)) FILTER (qty IS NOT NULL)", "flag": "arg_min(flag, (price, part)) FILTER (flag IS NOT NULL)"}
def _nested(rows: str) -> str:
    """Whole rows of one compared column c, from k, r and n (texts, null where the side lacks the key)."""
    return (
        f"SELECT CAST(k AS VARCHAR) AS id, CASE WHEN r = n THEN 'ALL_COLUMNS' ELSE 'c' END AS \"column\", CASE WHEN r = n THEN 'ALL_MATCH' ELSE coalesce(r, 'NULL') END AS value_ref, "
        f"CASE WHEN r = n THEN 'ALL_MATCH' ELSE coalesce(n, 'NULL') END AS value_new, CASE WHEN n IS NULL THEN 'ONLY_IN_REF' WHEN r IS NULL THEN 'ONLY_IN_NEW' WHEN r = n THEN 'EXACT_MATCH' ELSE 'NO_MATCH' END AS results FROM ({rows})"
    )


def _told(kind: str, date: str, columns: tuple[str, ...], sql: str) -> str:
    cells = ", ".join(f'"{c}"' for c in columns)
    return f"SELECT '{kind}' AS kind, 'customers' AS initiative, '{date}' AS date, concat_ws('|', {cells}) AS cells FROM ({sql})"


def _sunk(date: str, pair: str) -> list[str]:
    return [
        _told("differences", date, ("id", "column", "value_ref", "value_new", "results"), diff_sql(pair)),
        _told("duplicates", date, ("origin", "id", "category", "exact_duplicates", "dupes_w_variations", "occurrences", "variations"), dups_sql(pair)),
        _told("summary", date, ("block", "metric", "universe", "numerator", "denominator", "pct", "samples"), summary_sql(pair)),
    ]


def _values(columns: str, rows: list[tuple]) -> str:
    """A list of texts (and flags) as a table."""
    cell = lambda x: "CAST(NULL AS VARCHAR)" if x is None else str(x).lower() if isinstance(x, bool) else "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({columns})"


def _months(first: str, last: str) -> str:
    return f"WHERE date_trunc('month', odate) BETWEEN DATE '{first}' AND DATE '{last}'"


_NOT_DATE = ("cust", "status", "price", "priority")
_MARCH = _months("1995-03-01", "1995-03-01")
_VARIED = tuple(c for c in COLUMNS["wide"] if int(c[1:]) % 7)

#: What the spec functions are to give, by SURVEY's descriptions of S2 to S15.
_SPECS = [
    *(("parse_spec", t, v) for t, v in (("a=1", '{"a":["1"]}'), ('a="x y"', '{"a":["x y"]}'), ("a=*", '{"a":[]}'), ("a=", '{"a":[]}'))),
    *(("parse_spec", t, '{"a":["1","2"]}') for t in ("a=[1, 2]", "a=(1|2)", "a=IN[1,2]", "a=in(1,2)", "a=1|2")),
    ("parse_spec", "a=06/10/2025/b=x", '{"a":["06/10/2025"],"b":["x"]}'),
    ("parse_spec", 'a="p/q"/b=[r/s]', '{"a":["p/q"],"b":["r/s"]}'),
    ("parse_spec", "nothing", "{}"),
    ("matching_values", "geo=*/ds=2025-10-06", '["ES","MX"]'),
    ("parse_partition", "geo=ES/ds=2025-10-05", '{"geo":"ES","ds":"2025-10-05"}'),
    ("normalize_spec", '"ds=$EXEC_DATE/geo=*"', "ds=2025-10-06"),
    ("normalize_spec", "ds=YYYYMMdd/x=1", "ds=20251006/x=1"),
    ("normalize_spec", "d={{ds}}/", "d=2025-10-06"),
    ("normalize_spec", "*", None),
    ("rewrite_dates", "a 2020-01-31 b", "a 2025-10-06 b"),
    ("rewrite_dates", "31/01/2020", "06/10/2025"),
    ("rewrite_dates", "yyyy-MM-dd and dd/MM/yyyy", "2025-10-06 and 06/10/2025"),
    ("rewrite_dates", "{{ ds_nodash }}", "20251006"),
    ("rewrite_dates", "YYYY_MM_DD", "2025_10_06"),
    ("rewrite_dates", "99/99/2020", "99/99/2020"),
    ("rewrite_dates_deep", '["2020-01-31",{"a":"{{ds}}"},3]', '["2025-10-06",{"a":"2025-10-06"},3]'),
    ("spec_of_partitions", '{"a":"x","b":true,"c":null,"d":7}', 'a="x"/b="true"/c=""/d="7"'),
    *(("extract_date", t, "2025-10-06") for t in ('ds="2025-10-06"/geo=ES', "ds=06/10/2025", 'y="2025"/m="10"/d="06"')),
    ("extract_date", "geo=ES", "1999-01-01"),
    ("extract_date_or", "geo=ES", "1999-01-01"),
    ("extract_date_or", "ds=2025-10-06", "2025-10-06"),
    ("execution_date_or", 'ds="2025-10-06",None', "2025-10-06"),
    ("execution_date_or", 'ds="06/10/2025",x', "2025-10-06"),
    ("execution_date_or", ",2025-10-07", "2025-10-07"),
    ("execution_date_or", ",None", "1999-01-01"),
    ("window_dates", "-1..+1", "2025-10-05,2025-10-06,2025-10-07"),
    ("window_dates", "0..2", "2025-10-06,2025-10-07,2025-10-08"),
    ("window_dates", "x", "2025-10-06"),
    ("with_dates", "geo=ES/ds=x", "geo=ES/ds=[2025-10-06]"),
    ("with_dates", "geo=ES", "geo=ES/ds=[2025-10-06]"),
    ("side_spec", '["ds=1","-1..0","ds=2025-10-06"]', "ds=1"),
    ("side_spec", '[null,"-1..0","ds=2025-10-06"]', "ds=[2025-10-05,2025-10-06]"),
    ("side_spec", '[null,null,"ds=2025-10-06"]', "ds=2025-10-06"),
    ("renamed_spec", "geo=ES/ds=x", "pais=ES/ds=x"),
]

ORACLE_SQL: dict[str, str] = {
    "diff_full": diff_sql("ord", equals=True),
    "diff_no_equals": diff_sql("ord"),
    "diff_composite_key": diff_sql("li"),
    "diff_null_keys_match": diff_sql("cust", equals=True),
    "diff_null_keys_strict": diff_sql("cust", equals=True, strict=True),
    "diff_agg_min": diff_sql("li", how={"qty": "min({})", "ship": "min({})"}),
    "diff_agg_first": diff_sql("li", how=_FIRST),
    "diff_priority": diff_sql("evt", priority="e"),
    "diff_mapped_columns": diff_sql("cust"),
    "diff_filtered": diff_sql("ord", where=("WHERE price > 1000 AND status IN ('O', 'F')", "WHERE price > 1000 AND status IN ('O', 'F')")),
    "diff_partition_spec": diff_sql("cust", where=("WHERE nation IN (1, 3, 5)",) * 2, columns=("segment", "balance")),
    "diff_window_days": diff_sql("ord", where=(_months("1995-02-01", "1995-04-01"), _months("1995-03-01", "1995-04-01")), columns=_NOT_DATE),
    "run_parameters": diff_sql("ord", equals=True, where=(_MARCH, _MARCH + " AND price > 1000"), columns=_NOT_DATE),
    "run_json": diff_sql("ord", how={"price": "min({})"}, where=(_MARCH, _MARCH), columns=_NOT_DATE),
    "diff_wide": diff_sql("wide", columns=_VARIED),
    "dups_wide": dups_sql("wide"),
    "summary_wide": summary_sql("wide"),
    "summary_ambiguous_ids": summary_sql("amb"),
    "summary_priority": summary_sql("evt", priority=("e",)),
    "dups_null_keys": dups_sql("cust"),
    "spec_functions": _values("function, input, output", _SPECS),
    "schema_report": _values(
        'kind, "column", ref, new, severity',
        [
            ("only_in_ref", "balance", "balance", None, "moderate"),
            ("only_in_new", "saldo", None, "saldo", "moderate"),
            ("type", "nation", "int", "string", "critical"),
            ("order", "name", "0", "1", "minimal"),
            ("order", "segment", "1", "0", "minimal"),
        ],
    ),
    "drift_lossy_casts": "SELECT 'n' AS \"column\", count(*) FILTER (o_orderkey % 7 IN (0, 1)) AS lost, 0::BIGINT AS changed FROM orders UNION ALL SELECT 'm', 0, count(*) FILTER (o_orderkey % 5 = 0) FROM orders",
    "input_file_counts": _values("side, known", [("ref", True), ("new", True)]),
    "sink_paths": " UNION ALL ".join(_sunk("2024-05-01", "cust")),
    "sink_tables": " UNION ALL ".join([*_sunk("2024-05-01", "cust"), *_sunk("2024-05-02", "same")]),
    "diff_constant_pruned": diff_sql("const"),
    "diff_array_column": _nested("SELECT event_id AS k, '[\"' || event_type || '\",\"' || user_id || '\",null]' AS r, CASE WHEN event_id % 4 = 0 THEN '[null,\"' || user_id || '\",\"' || event_type || '\"]' ELSE '[\"' || event_type || '\",\"' || user_id || '\",null]' END AS n FROM events"),
    "diff_struct_column": _nested("SELECT event_id AS k, '{\"a\":\"' || event_type || '\"}' AS r, '{\"a\":\"' || event_type || CASE WHEN event_id % 6 = 0 THEN '!' ELSE '' END || '\"}' AS n FROM events"),
    "diff_map_column": _nested("SELECT event_id AS k, '{\"t\":\"' || event_type || '\",\"u\":\"' || user_id || '\"}' AS r, CASE WHEN event_id % 8 <> 7 THEN '{\"t\":\"' || CASE WHEN event_id % 6 = 0 THEN 'other' ELSE event_type END || '\",\"u\":\"' || user_id || '\"}' END AS n FROM events"),
    "diff_binary_column": _nested("SELECT doc_id AS k, to_base64(unhex(sha256(text))) AS r, CASE WHEN doc_id % 5 = 0 THEN 'eA==' ELSE to_base64(unhex(sha256(text))) END AS n FROM documents"),
    "diff_mismatch_by_column": f"SELECT \"column\", results, count(*) AS keys FROM ({diff_sql('ord', equals=True)}) GROUP BY ALL",
    "dups_basic": dups_sql("ord"),
    "dups_composite": dups_sql("li"),
    "dups_priority": dups_sql("evt", priority=("e",)),
    "dups_variations": f"SELECT origin, id, variations FROM ({dups_sql('li')}) WHERE variations <> '-'",
    "dups_category_counts": f"SELECT origin, category, count(*) AS keys FROM ({dups_sql('li')}) GROUP BY ALL",
    "row_hash": "SELECT sha256(concat_ws('§', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '__NULL__')" for c in (*KEYS["li"], *COLUMNS["li"])) + f")) AS hash FROM ({PAIRS['li'][0]})",
    "summary_full": summary_sql("ord"),
    "summary_composite": summary_sql("li"),
    "summary_kpis": _block("KPIS"),
    "summary_matches": _block("EXACT MATCH", "PARTIAL MATCH"),
    "summary_gaps": _block("GAP"),
    "summary_dups": _block("DUPS"),
    "ids_only_ref": f"SELECT CAST(k AS VARCHAR) AS id FROM ({PAIRS['ord'][0]}) EXCEPT SELECT CAST(k AS VARCHAR) FROM ({PAIRS['ord'][1]})",
    "ids_only_new": f"SELECT CAST(k AS VARCHAR) AS id FROM ({PAIRS['ord'][1]}) EXCEPT SELECT CAST(k AS VARCHAR) FROM ({PAIRS['ord'][0]})",
    "ids_both": f"SELECT CAST(k AS VARCHAR) AS id FROM ({PAIRS['ord'][0]}) INTERSECT SELECT CAST(k AS VARCHAR) FROM ({PAIRS['ord'][1]})",
}
