"""DuckDB SQL for the queries that SQL can express on whole tables.

Packing (a tokenizer and a heuristic) and toxicity (a trained network) have
none; they are tested against brute force, round trips and held-out rows.  The
SQL of the fuzzy lines compares all pairs exactly, where the operator finds its
candidates by hashing (99.3 % of pairs at the threshold, more above it).
"""

from __future__ import annotations

from . import chat, warc
from .linededup import LineParams
from .minhash import NearDuplicateParams
from .quality import RepetitionRules
from .secrets import BASE_RULES, RULES

_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(key: str, table: str, text: str, pattern: str) -> str:
    """key, i, word: one row per word."""
    return f"SELECT {key}, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT {key}, regexp_extract_all({text}, '{pattern}') AS ws FROM {table})"


def _grams(key: str, words: str, n: int) -> str:
    """key, i, gram: every run of n words."""
    over = f"OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
    return f"SELECT * FROM (SELECT {key}, i, list(word) {over} AS gram FROM {words}) WHERE len(gram) = {n}"


def op1_sql(rules: RepetitionRules = RepetitionRules()) -> str:
    ctes = [
        f"p AS ({_words('doc_id', 'documents', 'coalesce(text, chr(32))', _WORD)})",
        "b AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM p GROUP BY doc_id)",
        f"l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) WHERE regexp_matches(line, '{_WORD}'))",
        "ld AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, (sum(length(line)) - (SELECT sum(length(x)) FROM (SELECT unnest(list(DISTINCT line)) AS x)))::DOUBLE / sum(length(line)) AS share FROM l GROUP BY doc_id)",
    ]
    shares, joins, limits = [], [], []
    for n, which in ((3, "many"), *((n, "later") for n in sorted(rules.ngram_limits))):
        own = "OVER (PARTITION BY doc_id, gram" + (" ORDER BY i)" if which == "later" else ")")
        hit = f"row_number() {own}" if which == "later" else f"count(*) {own}"
        ctes.append(f"g{n} AS (SELECT doc_id, unnest(range(i, i + {n})) AS i FROM (SELECT doc_id, i, {hit} AS h FROM ({_grams('doc_id', 'p', n)})) WHERE h > 1)")
        ctes.append(f"c{n} AS (SELECT doc_id, count(*) AS k, sum(length(word)) AS chars FROM (SELECT DISTINCT doc_id, i FROM g{n}) JOIN p USING (doc_id, i) GROUP BY doc_id)")
        joins.append(f"LEFT JOIN c{n} USING (doc_id)")
        if n != 3:
            share = f"coalesce(c{n}.chars, 0)::DOUBLE / greatest(coalesce(b.word_chars, 0), 1)"
            shares.append(f"{share} AS dup_{n}gram_share")
            limits.append(f"dup_{n}gram_share <= {rules.ngram_limits[n]}")
    head = (
        "SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, "
        f"coalesce(dup, 0) AS n_dup_lines, coalesce(c3.k, 0) AS n_repeat_words, {', '.join(shares)}, coalesce(share, 0)::DOUBLE AS dup_line_share "
        f"FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN ld USING (doc_id) {' '.join(joins)}"
    )
    failed = f"n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * n_words"
    return f"WITH {', '.join(ctes)} SELECT *, {failed} AS base_failed, NOT ({failed}) AND {' AND '.join(limits)} AND dup_line_share <= {rules.line_limit} AS kept FROM ({head})"


def op2_sql() -> str:
    parts = []
    for order, rule in enumerate(RULES):
        walk = f"(?s)(.*?)({rule.pattern}|\\z)".replace("'", "''")
        lists = ", ".join(f"regexp_extract_all(coalesce(text, ''), '{walk}', {g}) AS {c}" for g, c in ((1, "gs"), (2, "hs"), (2 + rule.group, "vs")))
        steps = f"SELECT doc_id, unnest(range(1, len(hs) + 1)) AS i, unnest(gs) AS g, unnest(hs) AS h, unnest(vs) AS v FROM (SELECT doc_id, {lists} FROM documents)"
        ends = f"SELECT *, sum(length(g) + length(h)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM ({steps})"
        parts.append(f"SELECT doc_id, {order} AS o, '{rule.kind}' AS kind, e - length(h) AS s, e FROM ({ends}) WHERE length(v) >= {rule.least} AND length(h) > 0")
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in RULES)
    told = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o){}, '')"
    base = told.format(f" FILTER (o < {len(BASE_RULES)})")
    return f"WITH f AS ({' UNION ALL '.join(parts)}) SELECT doc_id, {counts}, sha256({base}) AS base_sha256, {told.format('')} AS spans FROM documents LEFT JOIN f USING (doc_id) GROUP BY doc_id"


def op3_sql(params: LineParams = LineParams()) -> str:
    size = params.size
    ctes = [
        f"l AS (SELECT * FROM (SELECT doc_id, unnest(range(len(ls))) AS place, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)) WHERE regexp_matches(line, '{_WORD}'))",
        "u AS (SELECT line, row_number() OVER (ORDER BY spot) AS id FROM (SELECT line, min((doc_id, place)) AS spot FROM l GROUP BY line))",
        "w AS (SELECT id, unnest(ws) AS x, unnest(list_concat(ws[2:], [''])) AS y FROM (SELECT id, string_split(ltrim(line, ' '), ' ') AS ws FROM u))",
        f"s AS (SELECT DISTINCT id, shingle FROM (SELECT id, left(x || ' ' || y, {size}) AS shingle FROM w WHERE x <> '' UNION ALL SELECT id, unnest(list_transform(range({size}, length(x)), lambda k: substr(x, k + 1, {size}))) FROM w WHERE length(x) > {size}))",
        "z AS (SELECT id, count(*) AS n FROM s GROUP BY id)",
        "m AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.id < b.id GROUP BY ALL)",
        f"e AS (SELECT a, b FROM m JOIN z x ON x.id = a JOIN z y ON y.id = b WHERE 100 * c >= {params.percent} * (x.n + y.n - c))",
        "v AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e)",
        "r(node, seen) AS (SELECT a, a FROM v UNION SELECT r.node, v.b FROM r JOIN v ON v.a = r.seen)",
        "h AS (SELECT node AS id, min(seen) AS head FROM r GROUP BY node)",
        "f AS (SELECT doc_id, place, row_number() OVER (PARTITION BY coalesce(head, id) ORDER BY doc_id, place) > 1 AS gone FROM l JOIN u USING (line) LEFT JOIN h USING (id))",
        "k AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(place::VARCHAR, ',' ORDER BY place) FILTER (gone) AS places FROM f GROUP BY doc_id)",
    ]
    return f"WITH RECURSIVE {', '.join(ctes)} SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(places, '')) AS removed_sha256 FROM documents LEFT JOIN k USING (doc_id)"


def op4_sql() -> str:
    control = "</s>[INST] ok [/INST]"
    escaped = "replace(replace({}, '&', '&amp;'), '<|', '&lt;|')"
    rows = f"SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '{control}' UNION ALL SELECT -7, 1, 'assistant', '{control}'"
    step = f"SELECT *, coalesce(lag(role) OVER own = role, false) AS joins, row_number() OVER own AS i FROM ({rows}) WINDOW own AS (PARTITION BY conv_id ORDER BY turn, role, text)"
    header = f"{len(chat.START)} + length(replace({escaped.format('role')}, chr(10), '&nl;')) + 1 + {len(chat.END)}"
    size = f"length({escaped.format('text')}) + CASE WHEN joins THEN {len(chat.SEP)} ELSE {header} END"
    loss = "coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')"
    return (
        f"SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256, length({loss}) AS loss_chars, "
        f"sha256({loss}) AS loss_sha256, sum({size})::BIGINT AS formatted_chars FROM ({step}) GROUP BY conv_id"
    )


def op5_sql(width: int = 13) -> str:
    return (
        f"WITH p AS ({_words('doc_id', 'documents', 'coalesce(text, chr(32))', _WORD)}), "
        f"w AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM ({_grams('doc_id', 'p', width)})), "
        f"x AS (SELECT DISTINCT doc_id, unnest(range(i, i + {width})) AS i, true AS gone FROM w WHERE least < doc_id), "
        "k AS (SELECT doc_id, count(*) AS n_words, count(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone IS NULL) AS left_text FROM p LEFT JOIN x USING (doc_id, i) GROUP BY doc_id) "
        "SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_text, '')) AS kept_sha256 FROM documents LEFT JOIN k USING (doc_id)"
    )


def op6_sql() -> str:
    bare = r"regexp_replace(regexp_replace(trim(url, ' '), '#.*$', ''), '^(?i:https?)://', '')"
    host = rf"regexp_replace(regexp_replace(lower(regexp_extract({bare}, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')"
    path = rf"regexp_replace(regexp_extract({bare}, '^[^/?]*([^?]*)', 1), '/+$', '')"
    query = rf"array_to_string(list_sort(list_filter(string_split(regexp_extract({bare}, '\?(.*)$', 1), '&'), lambda p: p <> '')), '&')"
    key = f"{host} || {path} || CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END"
    base = f"SELECT page_id, {key} AS key, '\"' || md5(html) || '\"' AS tag, 'day ' || length(html) AS day, md5(html) AS digest, page_id * 10 AS time, page_id * 10 + 5 + (page_id % 3) * 100000 AS later, page_id % 4 = 1 AS only_day FROM pages"
    found = "SELECT r.*, s.page_id AS sp, s.tag AS st, s.day AS sd, s.digest AS sg FROM b r LEFT JOIN b s ON s.key = r.key AND s.time < r.later QUALIFY row_number() OVER (PARTITION BY r.page_id ORDER BY s.time DESC NULLS LAST, s.page_id DESC) = 1"
    verdict = "CASE WHEN sp IS NULL THEN 'no_response' WHEN CASE WHEN only_day THEN day = sd ELSE tag = st END THEN 'resolved' ELSE 'validator_mismatch' END"
    own = "'date=' || later || CASE WHEN only_day THEN ';last-modified=' || day ELSE ';etag=W/' || tag END || ';server=edge'"
    if only := [h for h in ("date", "etag", "last-modified") if h not in warc.PERMITTED]:
        raise ValueError(f"not permitted: {only}")
    merged = "'content-type=text/html;date=' || later || ';etag=' || CASE WHEN only_day THEN st ELSE 'W/' || tag END || ';last-modified=' || CASE WHEN only_day THEN day ELSE sd END"
    return (
        f"WITH b AS ({base}), f AS (SELECT *, {verdict} AS verdict FROM ({found})) "
        "SELECT page_id * 2 AS record_id, 'response' AS kind, 'response' AS verdict, page_id * 2 AS source_id, digest, 'content-type=text/html;date=' || time || ';etag=' || tag || ';last-modified=' || day AS headers FROM b UNION ALL "
        f"SELECT page_id * 2 + 1, 'revisit', verdict, CASE WHEN verdict = 'resolved' THEN sp * 2 END, CASE WHEN verdict = 'resolved' THEN sg END, CASE WHEN verdict = 'resolved' THEN {merged} ELSE {own} END FROM f"
    )


def op8_sql(params: NearDuplicateParams = NearDuplicateParams()) -> str:
    n = params.words
    return (
        f"WITH RECURSIVE p AS ({_words('doc_id', 'documents', _LOWER, _WORD)}), "
        f"few AS (SELECT doc_id, list(word ORDER BY i) AS gram FROM p GROUP BY doc_id HAVING count(*) < {n}), "
        f"s AS (SELECT DISTINCT doc_id, gram FROM ({_grams('doc_id', 'p', n)}) UNION ALL SELECT doc_id, gram FROM few), "
        "z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), "
        "m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL), "
        f"e AS (SELECT a, b FROM m JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= {params.percent} * (x.n + y.n - c)), "
        "u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), "
        "r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.seen) "
        "SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, min(r.seen) AS component_id, min(r.seen) = d.doc_id AS kept FROM documents d LEFT JOIN z USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, z.n"
    )


def op9_sql(width: int = 13, share: int = 20) -> str:
    ctes = [f"p AS ({_words('doc_id', 'documents', _LOWER, _ALNUM)})", f"q AS ({_words('item_id', 'benchmark', _LOWER, _ALNUM)})", "z AS (SELECT item_id, count(*) AS n FROM q GROUP BY item_id)"]
    hits = []
    for n in range(1, width + 1):
        own = f"n >= {width}" if n == width else f"n = {n}"
        phrases = f"SELECT DISTINCT item_id, gram FROM ({_grams('item_id', '(SELECT q.* FROM q JOIN z USING (item_id) WHERE ' + own + ')', n)})"
        hits.append(f"SELECT doc_id, i, {n} AS n, item_id FROM ({_grams('doc_id', 'p', n)}) JOIN ({phrases}) USING (gram)")
    ctes.append(f"h AS ({' UNION ALL '.join(hits)})")
    ctes.append("c AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM h) GROUP BY doc_id)")
    ctes.append("t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)")
    ctes.append("w AS (SELECT doc_id, count(*) AS n_words FROM p GROUP BY doc_id)")
    ctes.append("o AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256 FROM documents LEFT JOIN w USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id))")
    return f"WITH {', '.join(ctes)} SELECT *, n_hit > 0 AND {share} * n_hit >= n_words AS contaminated FROM o"


ORACLE_SQL: dict[str, str] = {
    "op1_repetition_rules": op1_sql(),
    "op2_secret_ledger": op2_sql(),
    "op3_fuzzy_lines": op3_sql(),
    "op4_chat_format": op4_sql(),
    "op5_substring_dedup": op5_sql(),
    "op6_warc_revisits": op6_sql(),
    "op8_near_duplicates": op8_sql(),
    "op9_benchmark_decontamination": op9_sql(),
}
