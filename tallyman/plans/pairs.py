"""REF and NEW for the registered queries: SQL that Spark and DuckDB read alike.

NEW is REF changed by arithmetic on its keys, so either engine makes the same
rows.  Money is a decimal and dates are dates, whose text is the same in both.
"""

from __future__ import annotations

_ORD = "o_custkey AS cust, {status} AS status, CAST(o_totalprice{up} AS DECIMAL(18,2)) AS price, CAST(o_orderdate AS DATE) AS odate, {priority} AS priority"
_ORD_REF = _ORD.format(status="o_orderstatus", up="", priority="o_orderpriority")
_ORD_NEW = _ORD.format(
    status="CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE o_orderstatus END",
    up=" + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END",
    priority="CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderpriority END",
)

#: Compared columns of the wide pair.
WIDE = 308


def _wide() -> tuple[str, str]:
    """Customers with hundreds of texts, some of which are constant and some change in a few rows."""
    ref = [f"CAST(c_custkey * {i + 1} % {97 + i} AS VARCHAR(9)) AS w{i}" if i % 7 else f"'fixed {i}' AS w{i}" for i in range(WIDE)]
    new = [f"CAST(c_custkey * {i + 1} % {97 + i} + CASE WHEN (c_custkey + {i}) % 101 = 0 THEN 1 ELSE 0 END AS VARCHAR(9)) AS w{i}" if i % 7 else f"'fixed {i}' AS w{i}" for i in range(WIDE)]
    return (
        f"SELECT c_custkey AS k, {', '.join(ref)} FROM customer",
        f"SELECT c_custkey AS k, {', '.join(new)} FROM customer WHERE c_custkey % 43 <> 0 UNION ALL SELECT c_custkey AS k, {', '.join(ref)} FROM customer WHERE c_custkey % 61 = 0",
    )


PAIRS: dict[str, tuple[str, str]] = {
    "ord": (
        f"SELECT o_orderkey AS k, {_ORD_REF} FROM orders",
        f"SELECT o_orderkey AS k, {_ORD_NEW} FROM orders WHERE o_orderkey % 29 <> 0 "
        f"UNION ALL SELECT o_orderkey + 10000000 AS k, {_ORD_REF} FROM orders WHERE o_orderkey % 41 = 0 "
        f"UNION ALL SELECT o_orderkey AS k, {_ORD_NEW} FROM orders WHERE o_orderkey % 31 = 0 AND o_orderkey % 29 <> 0 "
        f"UNION ALL SELECT o_orderkey AS k, {_ORD.format(status='o_orderstatus', up=' + 5', priority='o_orderpriority')} FROM orders WHERE o_orderkey % 37 = 0",
    ),
    "const": (
        f"SELECT o_orderkey AS k, {_ORD_REF}, 'fixed' AS same, 'a' AS apart, CAST(NULL AS VARCHAR(5)) AS none FROM orders",
        f"SELECT o_orderkey AS k, {_ORD_NEW}, 'fixed' AS same, 'b' AS apart, CAST(NULL AS VARCHAR(5)) AS none FROM orders",
    ),
    "li": (
        "SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS part, CAST(l_quantity AS DECIMAL(18,2)) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ship FROM lineitem",
        "SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS part, CAST(l_quantity + CASE WHEN l_orderkey % 13 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_returnflag END AS flag, CAST(l_shipdate AS DATE) AS ship FROM lineitem WHERE l_orderkey % 17 <> 0",
    ),
    "cust": (
        "SELECT CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS name, c_mktsegment AS segment, c_nationkey AS nation, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer",
        "SELECT CASE WHEN c_custkey % 11 = 0 THEN '  ' WHEN c_custkey % 23 = 0 THEN c_name || 'x' ELSE c_name END AS name, CASE WHEN c_custkey % 9 = 0 THEN 'OTHER' ELSE c_mktsegment END AS segment, c_nationkey AS nation, CAST(c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 10 ELSE 0 END AS DECIMAL(18,2)) AS balance FROM customer",
    ),
    "amb": (
        "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'a_b' ELSE 'a' END AS p, CASE WHEN c_custkey % 2 = 0 THEN 'c' ELSE 'b_c' END AS q, c_custkey % 50 AS r, c_mktsegment AS segment FROM customer",
        "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'a_b' ELSE 'a' END AS p, CASE WHEN c_custkey % 2 = 0 THEN 'c' ELSE 'b_c' END AS q, c_custkey % 50 AS r, CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 50 <> 7",
    ),
    "same": ("SELECT c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer",) * 2,
    "wide": _wide(),
    "evt": (
        "SELECT user_id AS u, event_id AS e, event_type AS kind, CAST(value AS DECIMAL(18,4)) AS val FROM events",
        "SELECT user_id AS u, event_id AS e, CASE WHEN event_id % 5 = 0 THEN 'changed' ELSE event_type END AS kind, CAST(value AS DECIMAL(18,4)) AS val FROM events WHERE event_id % 3 <> 0",
    ),
}
TABLES = {"ord": "orders", "const": "orders", "li": "lineitem", "cust": "customer", "amb": "customer", "same": "customer", "wide": "customer", "evt": "events"}
KEYS = {"ord": ("k",), "const": ("k",), "li": ("ok", "ln"), "cust": ("name",), "amb": ("p", "q", "r"), "same": ("name",), "wide": ("k",), "evt": ("u",)}
COLUMNS = {
    "ord": ("cust", "status", "price", "odate", "priority"),
    "const": ("cust", "status", "price", "odate", "priority", "apart", "none"),
    "li": ("part", "qty", "price", "flag", "ship"),
    "cust": ("segment", "nation", "balance"),
    "amb": (
        "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'a_b' ELSE 'a' END AS p, CASE WHEN c_custkey % 2 = 0 THEN 'c' ELSE 'b_c' END AS q, c_custkey % 50 AS r, c_mktsegment AS segment FROM customer",
        "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'a_b' ELSE 'a' END AS p, CASE WHEN c_custkey % 2 = 0 THEN 'c' ELSE 'b_c' END AS q, c_custkey % 50 AS r, CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 50 <> 7",
    ),
    "same": ("SELECT c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer",) * 2,
    "wide": _wide(),
    "amb": ("segment",),
    "same": ("segment", "nation"),
    "wide": tuple(f"w{i}" for i in range(WIDE)),
    "evt": ("e", "kind", "val"),
}
