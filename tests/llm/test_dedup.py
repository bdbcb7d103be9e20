"""Near duplicates, lines, components and revisits against brute force."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyman.llm import components, linededup, minhash, queries, shared, warc

from . import brute, cases

DOCS = "doc_id long, text string"


def near_copies(seed=3, groups=6, copies=14):
    """Groups of texts that differ in a growing number of words, exact copies, and awkward rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    texts = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([7, 40, 120, 260])) + passage.split()
        for c in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words) if c % 3 else " ".join(words).upper())
        texts.append(" ".join(base))
    texts += ["", None, "  \n", "one", "ONE", "one two three", "One two three", "a b c d e", "a b c d f"]
    rng.shuffle(texts)
    return list(enumerate(texts, 1000))


@pytest.mark.parametrize("seed", [3, 4])
def test_op8_brute_force(spark, seed):
    rows = near_copies(seed)
    for params in (minhash.NearDuplicateParams(), minhash.NearDuplicateParams(block=4, many=3, most=9)):
        df = spark.createDataFrame(rows, DOCS).withColumns({"k1": F.lit(1), "sketch": F.lit("x"), "component": F.lit(2)}).repartition(3)
        got = {r[0]: r[1:] for r in cases.rows_of(minhash.near_duplicates(df, params=params), "doc_id", "n_shingles", "component_id", "kept")}
        assert got == brute.op8(rows)


def test_op8_large_tables_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_BYTES", 0)
    rows = near_copies(5) + [(10**6 + i, " ".join(f"x{j}" for j in range(80)) + f" tail{i}") for i in range(1200)]
    got = {r[0]: r[2] for r in cases.rows_of(minhash.near_duplicates(spark.createDataFrame(rows, DOCS)), "doc_id", "n_shingles", "component_id")}
    few = brute.op8(rows[: len(rows) - 1200])
    assert {i: got[i] for i in few} == {i: r[1] for i, r in few.items()}
    assert {got[i] for i in got if i >= 10**6} == {10**6}


def test_op8_a_shared_passage_makes_no_cluster(spark):
    """Texts that share a passage meet in lists, but only those that can be linked are joined."""
    rng, p = random.Random(1), minhash.NearDuplicateParams()
    passage = " ".join(f"p{i}" for i in range(62))
    rows = [(i, f"{passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(56))) for i in range(40)]
    rows += [(100 + i, text + " end") for i, text in rows[:5]]
    named = minhash.sketches(spark.createDataFrame(rows, DOCS), "doc_id", "text", p)
    classes = shared.written(named.withColumnRenamed("doc_id", "first_id"), "classes")
    found = cases.rows_of(minhash.candidate_clusters(classes, p), "node", "component")
    ids = dict(cases.rows_of(classes, "k1", "first_id"))
    groups = collections.defaultdict(set)
    for node, component in found:
        groups[component].add(ids[node])
    assert sorted(map(sorted, groups.values())) == [[i, 100 + i] for i in range(5)]
    lists = minhash.inverted_lists(classes, p)
    assert lists.groupBy("value").count().where("count > 5").count() > 0


@pytest.mark.parametrize("block", [512, 16])
def test_op8_links_between_components_span_them(spark, block):
    """A list of near copies in several components lets out links that connect them, not a row for each pair."""
    rng, p = random.Random(2), minhash.NearDuplicateParams(block=block)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base, f"tail{rng.randrange(10**6)}"])) for i in range(80)]
    named = minhash.sketches(spark.createDataFrame(rows, DOCS), "doc_id", "text", p)
    held = shared.written(named.select("k1", F.struct(F.col("n_shingles").alias("n"), "sketch").alias("own")), "held")
    keys = [r.k1 for r in held.select("k1").collect()]
    met = shared.written(held.select(F.explode(F.array(F.lit(7), F.lit(8)).cast("array<bigint>")).alias("value"), "k1"), "met")
    labels = spark.createDataFrame([(k, keys[i % 2]) for i, k in enumerate(keys[:60])], "node long, component long")
    links = cases.rows_of(minhash._other_links(met, held, labels, p), "a", "b")
    parent = {k: k for k in [*keys[:2], *keys[60:]]}  # of components
    for a, b in links:
        old, new = parent[a], parent[b]
        parent = {k: new if c == old else c for k, c in parent.items()}
    assert len(set(parent.values())) == 1
    blocks = -(-80 // block)
    assert len(links) <= 21 * blocks * (blocks + 1) // 2  # of 2,290 pairs across components, all of them linked


def test_op8_tables(spark):
    docs = cases.rows_of(cases.documents(spark), "doc_id", "text")
    got = {r[0]: r[1:] for r in cases.rows_of(queries.op8_near_duplicates(spark, cases.DATA), "doc_id", "n_shingles", "component_id", "kept")}
    assert got == brute.op8(docs)


def test_op8_null_and_repeated_ids(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (5, text), (5, text), (9, text), (9, "other words of no relation at all here")]
    got = sorted(cases.rows_of(minhash.near_duplicates(spark.createDataFrame(rows, DOCS)), "doc_id", "component_id", "kept"), key=str)
    assert got == sorted([(None, None, True), (5, 5, True), (5, 5, True), (9, 5, False), (9, 9, True)], key=str)
    empty = minhash.near_duplicates(spark.createDataFrame([], DOCS))
    assert empty.count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(10**6), rng.randrange(10**6)) for _ in range(300)]
    chain = rng.sample(range(10**7, 2 * 10**7), 60)
    edges += list(zip(chain, chain[1:]))
    edges += [(5 * 10**7, 5 * 10**7 + i) for i in range(1, 80)] + [(1, 1)]
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[root(a)] = root(b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
    for x in got:
        for y in (got[x], edges[0][0]):
            if y in got:
                assert (got[x] == got[y]) == (root(x) == root(y))
    assert len(set(got.values())) == len({root(x) for x in got})


def line_shingles(line, p):
    """Written from the docstring, by words, apart from the operator's expressions."""
    words, found = line.lstrip(" ").split(" "), set()
    for i, word in enumerate(words):
        if word:
            ahead = words[i + 1] if i + 1 < len(words) else ""
            found.add((word + " " + ahead)[: p.size])
            found |= {word[k : k + p.size] for k in range(p.size, len(word))}
    return found


def brute_lines(rows, p):
    at, sets = {}, {}
    for d, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if re.search(r"[^\x20\x09-\x0D]", line):
                at.setdefault(line, []).append((d, i))
                sets[line] = line_shingles(line, p)
    lines = sorted(sets)
    parent = {x: x for x in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict = {}
    for x in lines:
        for shingle in sets[x]:
            holders.setdefault(shingle, []).append(x)
    for x in lines:
        shared = collections.Counter(y for shingle in sets[x] for y in holders[shingle])
        for y, both in shared.items():
            if x < y and 100 * both >= p.percent * (len(sets[x]) + len(sets[y]) - both):
                parent[root(x)] = root(y)
    first, gone = {}, {}
    for x in lines:
        first[root(x)] = min([*at[x], first.get(root(x), (10**9, 0))])
    for x in lines:
        for d, i in at[x]:
            if (d, i) != first[root(x)]:
                gone.setdefault(d, []).append(i)
    return {d: sorted(v) for d, v in gone.items()}


def fuzzy_rows():
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "an", "river", "stone", "light", "ümlaut", "日本語"] + [f"t{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(30)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(0, 9)):
            line = rng.choice(base).split(" ")
            if rng.random() < 0.4:
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        lines += rng.choice([[], [""], ["", "  "], ["once " * 3], ["漢字" * 40 + str(d % 3)]])
        rows.append((d, "\n".join(lines)))
    return [*rows, (900, None), (901, ""), (902, "\n\n"), (903, "x" * 4000), (904, "x" * 4000 + "y")]


def test_op3_brute_force(spark):
    rows = fuzzy_rows()
    p = linededup.LineParams(bands=24, rows=1)  # every pair of the fixture at 80 % meets
    df = spark.createDataFrame(rows, DOCS).withColumns({"line": F.lit(1), "address": F.lit("q"), "gone": F.lit(0), "first": F.lit(2)})
    got = cases.rows_of(linededup.deduplicate_lines(df, params=p), "doc_id", "text", "n_lines", "n_removed", "kept_text")
    want = brute_lines(rows, p)
    for d, text, n_lines, n_removed, kept in got:
        lines = (text or "").split("\n")
        out = want.get(d, [])
        assert n_removed == len(out), d
        assert n_lines == sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in lines)
        assert kept == (None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in out))
    assert len(got) == len(rows)


def test_op3_recall_of_production_parameters(spark):
    docs = cases.rows_of(cases.documents(spark), "doc_id", "text")
    p = linededup.LineParams()
    want = sum(len(v) for v in brute_lines(docs, p).values())
    got = queries.op3_fuzzy_lines(spark, cases.DATA).agg(F.sum("n_removed")).first()[0]
    assert 0.95 * want <= got <= want


def test_op3_empty_null_and_repeated(spark):
    assert linededup.deduplicate_lines(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "same line of text"), (3, "same line of text"), (3, "same line of text"), (4, "same line of text")]
    got = sorted(cases.rows_of(linededup.deduplicate_lines(spark.createDataFrame(rows, DOCS)), "doc_id", "n_removed"), key=str)
    assert got == sorted([(None, 1), (3, 0), (3, 0), (4, 1)], key=str)


def bands_of(spark, lines, p):
    """line -> bands."""
    table = spark.createDataFrame([(x,) for x in lines], "line string").withColumns({"a1": F.xxhash64("line"), "a2": F.xxhash64(F.lit(1), "line")})
    return {r.line: r.bands for r in table.join(linededup.signatures(table, p), ["a1", "a2"]).collect()}


def bucket_links(spark, lines, p):
    """Lines gone when every pair of each bucket is compared."""
    buckets: dict = {}
    for line, bands in bands_of(spark, lines, p).items():
        for b in bands:
            buckets.setdefault(b, []).append(line)
    sets, parent = {x: line_shingles(x, p) for x in lines}, {x: x for x in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in {(x, y) for held in buckets.values() for x in held for y in held if x < y}:
        if 100 * len(sets[x] & sets[y]) >= p.percent * len(sets[x] | sets[y]):
            parent[root(x)] = root(y)
    return len(lines) - len({root(x) for x in lines})


@pytest.mark.parametrize("block", [512, 16])
def test_op3_every_pair_of_a_bucket(spark, block):
    """Variants of one line: most pairs of a bucket are no pairs with its leader."""
    rng = random.Random(5)
    base = [f"word{i}" for i in range(40)]
    lines = set()
    for n in range(150):
        line = list(base)
        for _ in range(rng.randrange(4)):
            line[rng.randrange(len(line))] = f"other{n}x{rng.randrange(10**6)}"
        lines.add(" ".join(line))
    p = linededup.LineParams(block=block)
    got = linededup.line_report(spark.createDataFrame(list(enumerate(sorted(lines))), DOCS), params=p).agg(F.sum("n_removed")).first()[0]
    assert got == bucket_links(spark, sorted(lines), p)


@pytest.mark.parametrize("least, union", [(80, 5), (83, 6), (80, 10), (90, 10), (80, 20), (80, 50)])
def test_op3_recall_of_fuzzy_pairs(spark, least, union):
    """Pairs that differ in a few of `union` shingles (no exact copies) share a bucket as often as independent values do."""
    rng, p, pairs = random.Random(union * least), linededup.LineParams(), 1000
    lost = union - -(-least * union // 100)
    rows = []
    for _ in range(pairs):
        words = [f"{rng.randrange(10**11):012d}" for _ in range(union)]
        rows.append((" ".join(words), " ".join(words[lost:])))
    bands = {k: set(v) for k, v in bands_of(spark, [line for pair in rows for line in pair], p).items()}
    met = sum(bool(bands[x] & bands[y]) for x, y in rows) / pairs
    expected = (1 - ((union - lost) / union) ** p.rows) ** p.bands
    print(f"{least} % of {union} shingles: met {met:.4f}, expected {1 - expected:.4f}")
    assert met >= 0.95 and 1 - met <= expected + 4 * (expected / pairs) ** 0.5 + 0.002


def test_op3_every_character_is_in_a_shingle(spark):
    pairs = [
        ("https://example.com/a", "https://example.com/b"),
        ("#include<iostream>", "#include<iostring.h>"),
        (" return self.configuration", " return self.configurable_thing"),
        ("transaction_000001 settled", "transaction_999999 settled"),
        ("2023-10-01T12:00:01Z order accepted", "2023-10-01T13:59:59Z order accepted"),
        ("這是一個沒有空格的句子它說的是貓", "這是一個沒有空格的句子它說的是狗"),
        ("a" * 12 + "b" * 12 + "c" * 2, "a" * 12 + "d" * 12 + "c" * 2),
        ("abcdefghijklmnopq tail", "abcdefghijklmnopr tail"),
    ]
    rows = [(i, line) for i, line in enumerate(line for pair in pairs for line in pair)]
    p = linededup.LineParams()
    # whatever character changes, a shingle changes, wherever the line's words end
    texts = [line for _, line in rows] + [line for _, text in fuzzy_rows()[:20] for line in (text or "").split("\n") if line.strip()][:40]
    changed = [(t, t[:i] + "\U0001f600" + t[i + 1 :]) for t in texts for i in range(len(t)) if t[i] != " "]
    df = spark.createDataFrame(changed, "x string, y string")
    assert df.where(linededup.shingles(F.col("x"), p) == linededup.shingles(F.col("y"), p)).count() == 0
    sizes = df.select("x", F.size(linededup.shingles(F.col("x"), p)).alias("n")).distinct().collect()
    assert all(r.n == len(line_shingles(r.x, p)) for r in sizes)
    got = cases.rows_of(linededup.deduplicate_lines(spark.createDataFrame(rows, DOCS)), "doc_id", "n_removed")
    for x, y in pairs:
        assert 100 * len(line_shingles(x, p) & line_shingles(y, p)) < p.percent * len(line_shingles(x, p) | line_shingles(y, p))
    assert all(n == 0 for _, n in got)


def test_op3_every_place_begins_a_shingle(spark):
    """With `every`, all runs of up to `size` characters count, so words that differ in their first characters only stay."""
    p = linededup.LineParams(every=True)
    texts = [line for _, text in fuzzy_rows() for line in (text or "").split("\n") if line.strip()][:200]
    texts += [" a  b ", "x", "é" * 63 + "ab", "0123456789" * 7, "0123456789" * 14 + "\U0001f600", "".join(map(chr, range(0x4E00, 0x4E00 + 200)))]
    table = spark.createDataFrame([(x,) for x in sorted(set(texts))], "line string").withColumns({"a1": F.xxhash64("line"), "a2": F.xxhash64(F.lit(1), "line")})
    want = {x: {x.strip(" ")[k : k + p.size] for k in range(len(x.strip(" ")))} for x in texts}
    hashes = {r.line: r.hashes for r in table.select("line", linededup.shingles(F.col("line"), p).alias("hashes")).collect()}
    named = {r.s: r.h for r in spark.createDataFrame([(s,) for s in set().union(*want.values())], "s string").select("s", F.xxhash64("s").alias("h")).collect()}
    assert {x: set(h) for x, h in hashes.items()} == {x: {named[s] for s in want[x]} for x in want}
    exploded = linededup._hashed(table, p).groupBy("a1", "a2").agg(F.count_if("first").alias("n"), F.collect_set("h").alias("h")).join(table, ["a1", "a2"]).collect()
    assert {r.line: set(r.h) for r in exploded} == {x: set(h) for x, h in hashes.items()} and all(r.n == 1 for r in exploded)


def test_op3_lines_that_differ_in_skipped_places_stay(spark):
    """Two hosts with one path: all they differ in is read by a single shingle of the SQL's, and by twelve of all."""
    path = "/a/very/long/path/that/both/hosts/share/index.html"
    rows = [(1, f"http://a.com{path}"), (2, f"http://b.org{path}"), (4, "the same line of plain words"), (5, "the same line of plain words")]
    left = linededup.drop_lines(spark.createDataFrame(rows, DOCS), params=linededup.LineParams(every=True))
    assert {r.doc_id for r in left.collect()} == {1, 2, 4}


def test_op3_large_tables_are_not_broadcast(spark, monkeypatch):
    """The way beyond the bound on broadcasts, with keys dealt over several tasks, gives the same."""
    df = spark.createDataFrame([*fuzzy_rows(), *((10**6 + i, "the same line everywhere\nand another one") for i in range(1500))], DOCS)
    cols = ("doc_id", "n_removed", "kept_text")
    small = sorted(cases.rows_of(linededup.deduplicate_lines(df), *cols))
    monkeypatch.setattr(shared, "BROADCAST_BYTES", 0)
    assert sorted(cases.rows_of(linededup.deduplicate_lines(df), *cols)) == small


def brute_revisits(records):
    def key(url):
        if url is None:
            return None
        url = re.sub(r"^(?i:https?)://", "", re.sub(r"#.*$", "", url.strip(" ")))
        host = re.match(r"[^/?]*", url)[0]
        rest = url[len(host) :].split("?", 1)
        query = "&".join(sorted(p for p in (rest[1] if len(rest) > 1 else "").split("&") if p))
        host = re.sub(r"^www\.", "", re.sub(r":(80|443)$", "", host.lower()))
        return host + rest[0].rstrip("/") + ("?" + query if query else "")

    out = {}
    for i, url, time, kind, headers, digest in records:
        if kind == "response":
            out[i] = ("response", i, headers, digest)
            continue
        before = [r for r in records if r[3] == "response" and None not in (key(url), time, r[2]) and key(r[1]) == key(url) and r[2] < time]
        if not before:
            out[i] = ("no_response", None, headers, None)
            continue
        s = max(before, key=lambda r: (r[2], r[0]))
        tag, old = headers.get("etag"), s[4].get("etag")
        if tag is not None and old is not None:
            valid = tag.removeprefix("W/") == old.removeprefix("W/")
        else:
            valid = headers.get("last-modified") is not None and headers.get("last-modified") == s[4].get("last-modified")
        if not valid:
            out[i] = ("validator_mismatch", None, headers, None)
        elif digest is not None and s[5] is not None and digest != s[5]:
            out[i] = ("digest_mismatch", None, headers, None)
        else:
            out[i] = ("resolved", s[0], s[4] | {k: v for k, v in headers.items() if k in warc.PERMITTED}, s[5])
    return out


RECORDS = "id long, url string, time long, kind string, headers map<string,string>, digest string"


@pytest.mark.parametrize(("slices", "slice_rows"), [(1, 10**6), (3, 10**6), (64, 10**6), (1, 20), (3, 2), (8, 1)])
def test_op6_brute_force(spark, slices, slice_rows):
    rng = random.Random(slices)
    urls = ["http://A.com/x", "https://www.a.com:443/x/", "a.com/x#f", "http://a.com/x?b=2&a=1", "http://a.com/x?a=1&b=2&", "http://b.org", None, ""]
    rows = []
    for i in range(400):
        kind = rng.choice(["response", "revisit", "revisit"])
        headers = {k: v for k, v in (("etag", rng.choice(['"1"', 'W/"1"', '"2"'])), ("last-modified", rng.choice("de")), ("server", str(i)), ("date", str(i))) if rng.random() < 0.7}
        rows.append((i, rng.choice(urls), rng.choice([None, *range(60)]), kind, headers, rng.choice([None, "p", "p", "q"])))
    got = {r.id: (r.verdict, r.source_id, r.headers, r.digest) for r in warc.resolve_revisits(spark.createDataFrame(rows, RECORDS).withColumn("key", F.lit(1)), slices, slice_rows).collect()}
    assert got == brute_revisits(rows)


def test_op6_tables_and_empty(spark):
    assert warc.resolve_revisits(spark.createDataFrame([], RECORDS)).count() == 0
    records = warc.records_of_pages(spark.read.parquet(f"{cases.DATA}/pages.parquet"))
    rows = cases.rows_of(records, "id", "url", "time", "kind", "headers", "digest")
    got = {r.record_id: (r.verdict, r.source_id, r.digest) for r in queries.op6_warc_revisits(spark, cases.DATA).collect()}
    assert got == {k: (v[0], v[1], v[3]) for k, v in brute_revisits(rows).items()}


def test_op6_other_kinds_pass(spark):
    tag = {"etag": "1"}
    rows = [(1, "a.com", 1, "response", tag, "p"), (2, "a.com", 5, None, tag, None), (3, "a.com", 6, "metadata", tag, "q"), (4, None, None, None, tag, None), (5, "a.com", 7, "revisit", tag, None)]
    got = sorted(cases.rows_of(warc.resolve_revisits(spark.createDataFrame(rows, RECORDS)), "id", "kind", "verdict", "source_id", "headers", "digest"))
    assert got == [
        (1, "response", "response", 1, tag, "p"),
        (2, None, "other", 2, tag, None),
        (3, "metadata", "metadata", 3, tag, "q"),
        (4, None, "other", 4, tag, None),
        (5, "revisit", "resolved", 1, tag, "p"),
    ]
