"""Partition specs, date tokens and day windows: plain Python, no Spark.

A spec is `column=values/column=values`.  Values: `v`, `"v"`, `*` or nothing
(any), `[a,b]`, `(a|b)`, `IN[a,b]`, `IN(a,b)`, and `a|b`.  A slash inside quotes
or brackets, or between the numbers of a day/month/year date, parts nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import re

#: The tokens that stand for the execution date in a key=value spec, and how it is written for them.
SPEC_TOKENS = {
    "YYYY-MM-dd": "%Y-%m-%d",
    "yyyy-MM-dd": "%Y-%m-%d",
    "DD/MM/YYYY": "%d/%m/%Y",
    "dd/MM/yyyy": "%d/%m/%Y",
    "YYYYMMdd": "%Y%m%d",
    "yyyyMMdd": "%Y%m%d",
    "${EXEC_DATE}": "%Y-%m-%d",
    "$EXEC_DATE": "%Y-%m-%d",
    "{{ds}}": "%Y-%m-%d",
}
#: Tokens in JSON parameters.
TEXT_TOKENS = {
    "$dataDatePart": "%Y-%m-%d",
    "${EXEC_DATE}": "%Y-%m-%d",
    "$EXEC_DATE": "%Y-%m-%d",
    "{{ds}}": "%Y-%m-%d",
    "{{ ds }}": "%Y-%m-%d",
    "{{ds_nodash}}": "%Y%m%d",
    "{{ ds_nodash }}": "%Y%m%d",
}
#: Parts of a written date pattern, in any case.
_PARTS = {"yyyy": "%Y", "mm": "%m", "dd": "%d"}
_PATTERN = re.compile(r"\b(?:(yyyy)([-/_]?)(mm)\2(dd)|(dd)([-/_]?)(mm)\6(yyyy))\b", re.IGNORECASE)
ISO = re.compile(r"\b(\d{4}-\d{2}-\d{2})\b")
DMY = re.compile(r"\b(\d{2}/\d{2}/\d{4})\b")


def _date(text: str, form: str) -> dt.date | None:
    try:
        return dt.datetime.strptime(text, form).date()
    except ValueError:
        return None


def unquoted(text: str) -> str:
    """text without the quotes around it, if they are a pair."""
    text = text.strip()
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "\"'":
        return text[1:-1].strip()
    return text


def split_spec(spec: str) -> list[str]:
    """The `column=values` parts of a spec."""
    parts, depth, quote, now = [], 0, "", ""
    for i, c in enumerate(spec):
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c in "[(":
            depth += 1
        elif c in "])":
            depth -= 1
        date_slash = c == "/" and re.match(r"(\d{2}/)?\d{4}(?!\d)|\d{2}/\d{4}", spec[i + 1 :]) and re.search(r"(?<!\d)\d{2}(/\d{2})?$", spec[:i])
        if c == "/" and not quote and depth == 0 and not date_slash:
            parts.append(now)
            now = ""
        else:
            now += c
    return [p.strip() for p in [*parts, now] if p.strip()]


def parse_spec(spec: str | None) -> dict[str, list[str]]:
    """Column -> wanted values; an empty list stands for any value."""
    wanted: dict[str, list[str]] = {}
    for part in split_spec(spec or ""):
        column, eq, values = part.partition("=")
        if not eq:
            continue
        values = values.strip()
        listed = re.fullmatch(r"(?i)(?:in\s*)?\[(.*)\]|in\s*\((.*)\)", values)
        either = re.fullmatch(r"\((.*)\)", values)
        if listed:
            found = re.split(r"[,|]", listed[1] if listed[1] is not None else listed[2])
        elif either:
            found = either[1].split("|")
        else:
            quoted = unquoted(values) != values
            found = [values] if quoted else values.split("|")
        cleaned = [unquoted(v) for v in found]
        cleaned = [v for v in cleaned if v]
        wanted[unquoted(column)] = [] if cleaned == ["*"] else cleaned
    return wanted


def parse_partition(path: str) -> dict[str, str]:
    """`k=v/k=v`, as catalogs name a partition."""
    return dict(tuple(map(str.strip, p.split("=", 1))) for p in path.split("/") if "=" in p)


def matching_values(partitions: list[str], wanted: dict[str, list[str]], column: str) -> list[str]:
    """Distinct values of a column among the partitions that agree with the spec's other columns (for reports; filters need no list)."""
    parsed = map(parse_partition, partitions)
    fits = [p for p in parsed if all(not v or c not in p or p[c] in v for c, v in wanted.items())]
    return sorted({p[column] for p in fits if column in p})


def normalize_spec(spec: str | None, execution_date: str) -> str | None:
    """A spec with its date tokens filled in, outer quotes dropped, and parts left out that want any value or are no part."""
    day = dt.date.fromisoformat(execution_date)
    text = (spec or "").strip()
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "\"'" and text.count(text[0]) == 2:
        text = unquoted(text)
    for token, form in SPEC_TOKENS.items():
        text = text.replace(token, day.strftime(form))
    parts = []
    for part in split_spec(text):
        column, eq, value = part.partition("=")
        value = unquoted(value)
        if eq and value != "*":
            parts.append(f"{column.strip()}={value}")
    return "/".join(parts) or None


def rewrite_dates(text: str, execution_date: str | dt.date) -> str:
    """text with tokens, date patterns and dates of two shapes replaced by the execution date, in the same shape."""
    day = execution_date if isinstance(execution_date, dt.date) else dt.date.fromisoformat(execution_date)
    for token, form in TEXT_TOKENS.items():
        text = text.replace(token, day.strftime(form))

    def written(m: re.Match) -> str:
        groups = m.groups()
        first, mark, second, third = groups[:4] if groups[0] else groups[4:]
        return day.strftime(mark.join(_PARTS[p.lower()] for p in (first, second, third)))

    text = _PATTERN.sub(written, text)
    for shape, form in ((ISO, "%Y-%m-%d"), (DMY, "%d/%m/%Y")):
        text = shape.sub(lambda m, form=form: day.strftime(form) if _date(m[1], form) else m[1], text)
    return text


def rewrite_dates_deep(node, execution_date: str):
    """rewrite_dates for every text of a JSON tree."""
    if isinstance(node, str):
        return rewrite_dates(node, execution_date)
    if isinstance(node, list):
        return [rewrite_dates_deep(x, execution_date) for x in node]
    if isinstance(node, dict):
        return {k: rewrite_dates_deep(v, execution_date) for k, v in node.items()}
    return node


def spec_of_partitions(partitions: dict) -> str:
    """`k="v"/k="v"` from an object."""
    plain = lambda v: "" if v is None or isinstance(v, (dict, list)) else str(v).lower() if isinstance(v, bool) else str(v)
    return "/".join('{}="{}"'.format(k, plain(v).replace('"', '\\"')) for k, v in partitions.items())


def parse_json(text: str):
    return json.loads(text)


def normalize_parameters(parameters: dict, execution_date: str) -> tuple[dict, str | None]:
    """Parameters with their dates rewritten, and the spec they name: `partitionSpec`, else from `partitions`."""
    done = rewrite_dates_deep(parameters, execution_date)
    direct, listed = done.get("partitionSpec"), done.get("partitions")
    if direct:
        return done, str(direct)
    return done, spec_of_partitions(listed) if isinstance(listed, dict) else None


def _of_numbers(numbers: list[str]) -> str | None:
    """A date from numbers of two and four digits: the year has four, the month comes first if it can."""
    years = [int(n) for n in numbers if len(n) == 4]
    pairs = [int(n) for n in numbers if len(n) == 2]
    if not years or len(pairs) < 2:
        return None
    year = next((y for y in years if 1900 <= y <= 2100), years[0])
    for month, day in (pairs[:2], pairs[1::-1]):
        if 1 <= month <= 12 and 1 <= day <= 31:
            return f"{year}-{month:02d}-{day:02d}"
    return None


def extract_date(spec: str | None, today: str | None = None) -> str:
    """The date that a spec names, as ISO; without one, today."""
    spec = spec or ""
    quoted = r'[A-Za-z0-9_]+\s*=\s*"({})"'
    for shape in (quoted.format(r"\d{4}-\d{2}-\d{2}"), ISO.pattern):
        if found := re.search(shape, spec):
            return found[1]
    for shape in (quoted.format(r"\d{2}/\d{2}/\d{4}"), DMY.pattern):
        if found := re.search(shape, spec):
            if day := _date(found[1], "%d/%m/%Y"):
                return day.isoformat()
    named = re.findall(r'=\s*"(\d{2,4})"', spec)
    loose = list(dict.fromkeys(named + re.findall(r"\b(\d{2,4})\b", spec)))[:3]
    for numbers in (named, loose):
        if len(numbers) >= 3 and (day := _of_numbers(numbers)):
            return day
    return today or dt.date.today().isoformat()


def extract_date_or(spec: str | None, default: str) -> str:
    """extract_date, with the default where the spec has no digit or no date."""
    return extract_date(spec, default) if re.search(r"\d", spec or "") else default


def execution_date_or(spec: str | None, configured: str | None, today: str | None = None) -> str:
    """The configured ISO date; else a quoted date of the spec; else today."""
    if configured and _date(configured.strip(), "%Y-%m-%d"):
        return configured.strip()
    if found := re.search(r'"(\d{4}-\d{2}-\d{2})"', spec or ""):
        return found[1]
    if (found := re.search(r'"(\d{2}/\d{2}/\d{4})"', spec or "")) and (day := _date(found[1], "%d/%m/%Y")):
        return day.isoformat()
    return today or dt.date.today().isoformat()


def parse_window(text: str | None) -> tuple[int, int] | None:
    """`-2..+3` as two numbers."""
    found = re.fullmatch(r"\s*([+-]?\d+)\s*\.\.\s*([+-]?\d+)\s*", text or "")
    return (int(found[1]), int(found[2])) if found else None


def window_dates(center: str, window: tuple[int, int]) -> list[str]:
    day = dt.date.fromisoformat(center)
    return [(day + dt.timedelta(days=i)).isoformat() for i in range(window[0], window[1] + 1)]


def with_dates(spec: str | None, dates: list[str], column: str = "data_date_part") -> str | None:
    """spec with the column's values replaced by, or extended by, a list of dates."""
    if not dates:
        return spec
    part = f"{column}=[{','.join(dates)}]"
    parts = split_spec(spec or "")
    out = [part if p.partition("=")[0].strip() == column else p for p in parts]
    return "/".join(out if part in out else [*out, part])


def side_spec(direct: str | None, window: str | None, common: str | None, center: str, column: str = "data_date_part") -> str | None:
    """A side's spec: its own, else the common one moved by its window, else the common one."""
    if direct:
        return direct
    days = parse_window(window)
    return with_dates(common, window_dates(center, days), column) if days else common


def renamed_spec(spec: str | None, mapping: dict[str, str]) -> str | None:
    """spec in NEW's vocabulary: columns by the mapping REF name -> NEW name."""
    if spec is None:
        return None
    parts = [p.partition("=") for p in split_spec(spec)]
    return "/".join(mapping.get(c.strip(), c.strip()) + eq + v for c, eq, v in parts)
