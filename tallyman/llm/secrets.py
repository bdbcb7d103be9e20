"""Secret scans: an incremental blob ledger, in Spark expressions only.

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger holds one row per blob and rule version that was ever scanned, with its
findings; a scan reads only blobs for which the ledger lacks the present rule
version (a digest of the rules themselves), and joins findings, old and new,
back to all paths with that content.

A first pass shuffles addresses only: it tells which blobs are unseen, and which
of their texts a rule can match in at all, by a plain search.  Only texts that
pass are shuffled, one copy of each, and scanned.  Positions come from
expressions: `regexp_extract_all` with the pattern `(gap)(match or end)` yields
every match with the gap before it, and running sums of lengths give starts and
ends in code points.

Null text: empty, hence no findings.  Copies (same content, any number of paths)
are scanned once: addresses and texts are grouped with partial aggregation, and
the join back carries addresses and findings only; a small set of findings is
broadcast, a large one leaves hot addresses to adaptive skew handling.  Further
columns are ignored, whatever their names.  A text in which a rule matches has
to fit a task's memory some six times over; others are streamed.
"""

from __future__ import annotations

import hashlib
from dataclasses import astuple, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import bounded, forget, written


@dataclass(frozen=True)
class Rule:
    kind: str
    #: RE2/Java pattern; matches are leftmost and do not overlap.
    pattern: str
    #: Least length of the whole match, or of group `group` of the pattern.
    least: int
    group: int = 0
    #: A string that every match holds, if there is one.
    must: str | None = None


# The patterns of the contract.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    Rule("access", r"AKIA[A-Z0-9]+", 20, 0, "AKIA"),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: What the method adds to them: private keys, signed web tokens, and tokens with a telling start.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 20, 0, "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 24, 0, "eyJ"),
    Rule("prefixed", r"(?:gh[opsu]_|xox[abps]-|sk_live_)[A-Za-z0-9-]+", 20),
)
RULES = (*BASE_RULES, *MORE_RULES)

FINDING = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rule_version", T.StringType()), T.StructField("findings", T.ArrayType(FINDING))])


def version_of(rules: tuple[Rule, ...] = RULES) -> str:
    """Names the rules by what they are: an edited rule makes another version."""
    return hashlib.sha256(repr([astuple(r) for r in rules]).encode()).hexdigest()[:16]


def _narrowed(rule: Rule) -> str:
    """An equal pattern for whole-match rules whose repeated class ends the match.

    A run of the class that is too short for the rule is used up by the failing
    match, and no later start inside it is longer, so asking for the length in
    the pattern finds the same spans and skips the short ones.
    """
    if rule.group or rule.pattern.count("[") != 1 or "(" in rule.pattern or not rule.pattern.endswith("]+"):
        return rule.pattern
    head = rule.pattern[:-1].split("[")[0]
    return f"{rule.pattern[:-1]}{{{rule.least - len(head)},}}"


def can_match(text: Column, rule: Rule) -> Column:
    """Whether a rule's pattern, of the rule's length, is found in the text."""
    found = text.rlike(_narrowed(rule))
    return F.contains(text, F.lit(rule.must)) & found if rule.must else found


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, kind, end) for the rule's matches in text."""
    pattern = _narrowed(rule)
    walk = F.lit(rf"(?s)(.*?)({pattern}|\z)")
    zipped = F.arrays_zip(F.regexp_extract_all(text, walk, F.lit(0)).alias("w"), F.regexp_extract_all(text, walk, F.lit(2)).alias("h"))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x["w"])
        start = end - F.length(x["h"])
        told = F.regexp_extract(x["h"], pattern, rule.group) if rule.group else x["h"]
        one = F.struct(start.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(told) >= rule.least, F.array_append(acc["found"], one)).otherwise(acc["found"]).alias("found"))

    spans = F.aggregate(zipped, empty, step, lambda acc: acc["found"])
    return F.when(can_match(text, rule), spans).otherwise(empty["found"])


def scan_text(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Findings of one text, ordered by start and then by the order of the rules."""
    every = F.array_sort(F.concat(*(_spans(text, rule, i) for i, rule in enumerate(rules))))
    return F.transform(every, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _body(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def addressed(text_col: str) -> Column:
    return F.sha2(_body(text_col), 256)


def unseen_blobs(versions: DataFrame, text_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, hit): each content once that the ledger lacks under these rules, and whether any of them can match in it."""
    hit = reduce(Column.__or__, (can_match(_body(text_col), r) for r in rules))
    blobs = versions.select(addressed(text_col).alias("blob"), hit.alias("hit")).groupBy("blob").agg(F.bool_or("hit").alias("hit"))
    if ledger is None:
        return blobs
    done = ledger.where(F.col("rule_version") == version_of(rules)).select("blob")
    return blobs.join(done, "blob", "left_anti")


def scan(versions: DataFrame, text_col: str = "text", ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rule_version, findings) for the unseen blobs only, as a written table."""
    unseen = written(unseen_blobs(versions, text_col, ledger, rules), "unseen")
    wanted = written(unseen.where("hit").select("blob"), "unseen-hits")
    texts = versions.where(reduce(Column.__or__, (can_match(_body(text_col), r) for r in rules))).select(addressed(text_col).alias("blob"), _body(text_col).alias("body"))
    one = texts.join(bounded(wanted), "blob", "left_semi").groupBy("blob").agg(F.any_value("body").alias("body"))
    found = written(one.select("blob", scan_text(F.col("body"), rules).alias("findings")), "findings")
    rows = unseen.join(bounded(found), "blob", "left").select("blob", F.lit(version_of(rules)).alias("rule_version"), F.coalesce("findings", F.array().cast(T.ArrayType(FINDING))).alias("findings"))
    made = written(rows, "ledger")
    forget(unseen, wanted, found)
    return made


def updated(ledger: DataFrame | None, versions: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with the findings of versions' unseen blobs added."""
    new = scan(versions, text_col, ledger, rules)
    return new if ledger is None else ledger.select(*LEDGER.names).unionByName(new)


def findings_by_path(versions: DataFrame, path_cols: list[str], ledger: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path columns, blob, findings: one row per version, from a ledger that is up to date.

    Only blobs with findings enter the join with the texts' paths; the others get an empty array.
    """
    told = ledger.where(F.col("rule_version") == version_of(rules)).where(F.size("findings") > 0)
    found = written(told.select(F.col("blob").alias("_blob"), F.col("findings").alias("_findings")).dropDuplicates(["_blob"]), "found")
    paths = versions.select(*path_cols, addressed(text_col).alias("blob"))
    joined = paths.join(bounded(found), F.col("blob") == F.col("_blob"), "left")
    return joined.select(*path_cols, "blob", F.coalesce("_findings", F.array().cast(T.ArrayType(FINDING))).alias("findings"))


def spans_text(findings: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the findings (of some kinds), comma-joined."""
    chosen = F.filter(findings, lambda x: x["kind"].isin(*kinds)) if kinds else findings
    return F.array_join(F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_kind(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("long")
