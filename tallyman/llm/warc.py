"""Not-modified revisits of web archives, resolved by an as-of join.

A revisit record says that a page had not changed; its content is that of the
latest earlier full response for the same canonical URL.  The join takes the
greatest (time, id) below the revisit's, checks the validators (entity tag by
weak comparison, else modification date, and the payload digest where both
sides have one) and merges the headers that a 304 answer may update.

The join is two windows of bounded frames: time is cut at approximate quantiles
into `slices` spans, and each span evenly into so many slices that one is meant
to hold `slice_rows` records; inside a (URL, slice) the last response is carried
forward, and what a slice hands on is one row per (URL, slice).  A URL with a
third of all records is thus dealt over as many tasks as there are slices, and
their number grows with the records.

Defined results: null URL or time: never resolved, and never a source.  Of
equal times the greater id is later; a response at the very time of a revisit
is not earlier.  Repeated rows stay.  A record that is no revisit (of another
kind, or of none) passes as it is, with itself as source and its kind, or
`other` where it has none, as verdict.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The headers that a 304 answer may carry for the stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified")


def canonical_url(url: Column) -> Column:
    """Scheme, `www.`, default ports, fragment, empty query and trailing slashes dropped; host in lower case; parameters sorted."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i:https?)://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: p != "")), "&")
    return F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def _verdict(source: Column) -> Column:
    tag, stored_tag = _weak(F.col("headers")["etag"]), _weak(source["headers"]["etag"])
    date, stored_date = F.col("headers")["last-modified"], source["headers"]["last-modified"]
    valid = F.when(tag.isNotNull() & stored_tag.isNotNull(), tag == stored_tag).when(date.isNotNull() & stored_date.isNotNull(), date == stored_date).otherwise(F.lit(False))
    same = F.coalesce(F.col("digest") == source["digest"], F.lit(True))
    return F.when(source.isNull(), "no_response").when(~valid, "validator_mismatch").when(~same, "digest_mismatch").otherwise("resolved")


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers, updated by the permitted ones of the revisit."""
    allowed = F.map_filter(update, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def _slice(time: Column, cuts: list[int], least: int, most: int, parts: int) -> Column:
    """The number of a time's slice, which rises with time: cuts at or below it, then `parts` even parts of the span."""
    if not cuts:
        cuts = [least]
    ends = F.array(*(F.lit(c).cast("long") for c in [least, *cuts, most + 1]))
    span = F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in cuts)), lambda c: c <= time))
    if parts == 1:
        return span.cast("long")
    low, high = F.get(ends, span), F.get(ends, span + 1)
    part = F.floor((time - low).cast("double") / F.greatest(high - low, F.lit(1)) * parts)
    return span * F.lit(parts).cast("long") + F.greatest(F.lit(0), F.least(part, F.lit(parts - 1))).cast("long")


def resolve_revisits(records: DataFrame, slices: int = 64, slice_rows: int = 1_000_000) -> DataFrame:
    """records (id, url, time long, kind, headers map, digest) to id, kind, verdict, source_id, headers, digest.

    Only records of kind `revisit` are resolved, and only those of kind
    `response` are sources; header names are in lower case.
    """
    revisit = F.col("kind").eqNullSafe("revisit")
    base = records.select("id", canonical_url(F.col("url")).alias("key"), "time", "kind", "headers", "digest")
    spread = F.percentile_approx("time", [i / slices for i in range(1, slices)], 1000) if slices > 1 else F.array()
    seen = base.agg(F.count("time").alias("rows"), F.min("time").alias("least"), F.max("time").alias("most"), spread.alias("cuts")).first()
    parts = max(1, -(-seen.rows // (slices * slice_rows)))
    slice_of = _slice(F.col("time"), sorted(set(seen.cuts or [])), seen.least or 0, seen.most or 0, parts)
    usable = base.withColumn("slice", slice_of).where(F.col("key").isNotNull() & F.col("time").isNotNull())
    stored = F.struct(F.col("time"), F.col("id"), F.col("headers"), F.col("digest"))
    full = F.when(F.col("kind") == "response", stored)
    # what each (URL, slice) hands on: its last response, then that of the slices before
    last = usable.where(F.col("kind") == "response").groupBy("key", "slice").agg(F.max_by(stored, F.struct("time", "id")).alias("last"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    touched = usable.select("key", "slice").distinct().join(last, ["key", "slice"], "left")
    handed = touched.withColumn("earlier", F.last("last", ignorenulls=True).over(before)).where(F.col("earlier").isNotNull())
    handed = handed.select("key", "slice", "earlier")
    # inside a slice: responses strictly before the revisit's time
    inside = Window.partitionBy("key", "slice").orderBy("time", F.when(F.col("kind") == "response", 1).otherwise(0), "id").rowsBetween(Window.unboundedPreceding, -1)
    own = usable.withColumn("near", F.last(full, ignorenulls=True).over(inside)).where(revisit)
    found = own.join(handed, ["key", "slice"], "left").withColumn("source", F.coalesce("near", "earlier"))
    lost = base.where((F.col("key").isNull() | F.col("time").isNull()) & revisit)
    found = found.unionByName(lost.withColumn("source", F.lit(None).cast(found.schema["source"].dataType)), allowMissingColumns=True)
    verdict = _verdict(F.col("source"))
    done = found.withColumn("verdict", verdict)
    ok = F.col("verdict") == "resolved"
    revisits = done.select(
        "id",
        "kind",
        "verdict",
        F.when(ok, F.col("source.id")).alias("source_id"),
        F.when(ok, merged_headers(F.col("source.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
        F.when(ok, F.col("source.digest")).alias("digest"),
    )
    passed = base.where(~revisit).select("id", "kind", F.coalesce("kind", F.lit("other")).alias("verdict"), F.col("id").alias("source_id"), "headers", "digest")
    return revisits.unionByName(passed)


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records of raw pages, in the order of their ids.

    Every page is a full response at time 10 * page_id, and was asked for again
    later (after up to two spans of 10,000 pages) with its own validators; the
    archive then holds a revisit record.  Where the same canonical URL was
    crawled in between with other content, the revisit must not resolve.
    """
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    day = F.concat(F.lit("day "), F.length("html").cast("string"))
    time = F.col("page_id") * 10
    response = pages.select(
        (F.col("page_id") * 2).alias("id"),
        "url",
        time.alias("time"),
        F.lit("response").alias("kind"),
        F.create_map(F.lit("etag"), tag, F.lit("last-modified"), day, F.lit("content-type"), F.lit("text/html"), F.lit("date"), time.cast("string")).alias("headers"),
        F.md5("html").alias("digest"),
    )
    later = time + 5 + (F.col("page_id") % 3) * 100000
    only_day = F.col("page_id") % 4 == 1
    first = F.when(only_day, F.create_map(F.lit("last-modified"), day)).otherwise(F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag)))
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("id"),
        F.concat("url", F.lit("#again")).alias("url"),
        later.alias("time"),
        F.lit("revisit").alias("kind"),
        F.map_concat(first, F.create_map(F.lit("date"), later.cast("string"), F.lit("server"), F.lit("edge"))).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return response.unionByName(revisit)
