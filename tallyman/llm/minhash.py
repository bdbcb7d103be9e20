"""Near-duplicate documents by bottom-k sketches.

One hash function over a text's word shingles; the k least values are its
sketch.  Texts with equal shingle sets (exact copies among them) are one class
from the start.

1. Inverted lists.  Linked texts share at least `overlap` of their retained
   values: surely for texts whose whole set is retained, and for larger ones
   but for a chance of 6e-8 a pair at the threshold (binomial tail, k = 64).
   So under any order of the values the first `m - overlap + 1` of two linked
   sketches meet.  The order is rarest first, hence a passage in a third of all
   documents makes no lists unless it is most of the text, and a value that one
   class alone holds makes none.
2. In a list, sizes and the union's sketch estimate whether classes can be
   linked: each list's first class with the others, then, where a list still
   holds several components, all pairs across components, in blocks; each pair
   of blocks is a task that reports a spanning forest of its components, not its
   links.  Classes that merely share a passage are thus never joined.
   Components of estimated links are clusters.
3. A cluster's classes are dealt into blocks, and each pair of blocks is a task
   that counts overlaps again and verifies on the full sets.  Pairs already
   connected are skipped, and a task reports a spanning forest, not its pairs.
4. The verified links' components give each class the least id it reaches.

Defined results: null, empty or wordless text has no shingles, links with
nothing and is kept.  Texts with fewer words than a shingle are one shingle.
Rows with a null id are never linked (component null, kept).  Rows that share
an id get the component of their own text.  Ids are integers; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as K
from .components import connected_components
from .shared import apart, bounded, dealt_join, forget, ship, written

_BASE = 0x9E3779B97F4A7C15
#: Bytes on disk up to which a table of lists or sketches is broadcast.
_BROADCAST = 2 << 20


@dataclass(frozen=True)
class NearDuplicateParams:
    words: int = 5
    #: Least similarity in percent.
    percent: int = 85
    #: Values of a sketch.
    k: int = 64
    #: Least shared values of linked sketches of at least `percent` % of k values.
    overlap: int = 36
    #: Classes of one block of a cluster, until `many` blocks; then blocks grow up to `most`.
    block: int = 512
    many: int = 8
    most: int = 8192


def _sets(words: K.Words, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    every = K.mix64(K.rolling(words.hashes, n, _BASE)) if len(words.hashes) >= n else np.zeros(0, np.uint64)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(every[a : b - n + 1])
        elif b > a:  # the whole sequence, kept apart from sequences of other lengths
            yield K.mix64(K.rolling(words.hashes[a:b], b - a, _BASE) + K.U64((b - a) * _BASE & 0xFFFFFFFFFFFFFFFF))
        else:
            yield words.hashes[:0]


def _key(values: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: sums of two mixes of its values."""
    one = K.mix64(values ^ K.U64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = K.mix64(values + K.U64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    signed = np.array([one, two], np.uint64).view(np.int64)
    return int(signed[0]), int(signed[1])


def sketches(docs: DataFrame, id_col: str, text_col: str, params: NearDuplicateParams) -> DataFrame:
    """id, row_key (the text's hash), n_shingles, k1, k2 (the set's name), sketch (array of retained values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words in K.words_of(K.text_column(batch, text_col), lower=True):
                n, k1, k2, kept, at = [], [], [], [], [0]
                for s in _sets(words, params.words):
                    one, two = _key(s)
                    n.append(len(s))
                    k1.append(one)
                    k2.append(two)
                    kept.append(s[: params.k])
                    at.append(at[-1] + len(kept[-1]))
                values = (np.concatenate(kept) ^ K.U64(1 << 63)).view(np.int64)  # signed, in the order of the unsigned
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int64()))
                ids = batch.column(0).slice(lo, words.n_texts)
                keys = batch.column(2).slice(lo, words.n_texts)
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), lists], names=[id_col, "row_key", "n_shingles", "k1", "k2", "sketch"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, F.xxhash64(text_col).alias("_row_key")).mapInArrow(K.tidy(run), f"`{id_col}` {kind}, row_key long, n_shingles long, k1 long, k2 long, sketch array<long>")


def inverted_lists(classes: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """value, k1: the lists in which linked classes meet, of values that several classes retain."""
    values = classes.select("k1", F.size("sketch").alias("m"), F.explode("sketch").alias("value"))
    counts = written(values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1), "counts")
    holders = dealt_join(values, counts, ["value"], "df", "k1", limit=_BROADCAST)
    own = Window.partitionBy("k1")
    ranked = holders.withColumns({"rank": F.row_number().over(own.orderBy("df", "value")), "shared": F.count(F.lit(1)).over(own)})
    part = F.floor((F.col("m") * params.percent + 99) / 100)
    overlap = F.when(F.col("m") * 100 >= params.percent * params.k - 100, F.least(part, F.lit(params.overlap))).otherwise(part)
    # values that no other class holds come first in the order and make no lists
    first = F.col("m") - overlap + 1 - (F.col("m") - F.col("shared"))
    lists = written(ranked.where(F.col("rank") <= first).select("value", "k1"), "lists")
    forget(counts)
    return lists


def _estimated(x: Column, y: Column, params: NearDuplicateParams) -> Column:
    """Whether two held classes (n_shingles, sketch) can be linked by their sizes and their union's sketch."""
    likely = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * params.percent
    both = F.array_intersect(x["sketch"], y["sketch"])
    enough = F.size(both) * params.k >= F.least(F.size(x["sketch"]), F.size(y["sketch"])) * params.overlap
    union = F.slice(F.sort_array(F.array_union(x["sketch"], y["sketch"])), 1, params.k)
    return likely & enough & (F.size(F.array_intersect(both, union)) * params.k >= F.size(union) * params.overlap)


def _blocks(size: Column, params: NearDuplicateParams) -> Column:
    few = F.ceil(size / params.block)
    return F.when(few <= params.many, few).otherwise(F.greatest(F.lit(params.many), F.ceil(size / params.most))).cast("int")


def _head_links(met: DataFrame, held: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """(a, b): estimated links of each list's first class with the list's others."""
    pairs = written(met.where(F.col("a") != F.col("k1")).select("a", F.col("k1").alias("b")).distinct(), "pairs")
    stars = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n_pairs"))
    heads = written(stars.join(held.select(F.col("k1").alias("a"), F.col("own").alias("x")), "a"), "stars")
    left = pairs.join(bounded(held.select(F.col("k1").alias("b"), F.col("own").alias("y")), held, _BROADCAST), "b")
    links = written(dealt_join(left, heads, ["a"], "n_pairs", "b", limit=_BROADCAST).where(_estimated(F.col("x"), F.col("y"), params)).select("a", "b"), "head-links")
    forget(pairs, heads)
    return links


def _other_links(met: DataFrame, held: DataFrame, labels: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """(a, b): components that estimated links join, from all pairs in lists that hold several; a pair of a list's blocks gives a spanning forest."""
    known = met.select("value", "k1").join(labels.select(F.col("node").alias("k1"), "component"), "k1", "left")
    known = written(known.withColumn("component", F.coalesce("component", "k1")), "labelled")
    mixed = known.groupBy("value").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("n_list"))
    mixed = written(mixed.where(F.col("least") != F.col("most")).select("value", "n_list"), "mixed")
    rows = dealt_join(known, mixed, ["value"], "n_list", "k1", limit=_BROADCAST).join(bounded(held, most=_BROADCAST), "k1")
    rows = rows.withColumn("blocks", _blocks(F.col("n_list"), params)).withColumn("mine", F.pmod(F.xxhash64("k1"), F.col("blocks")).cast("int"))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("value", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "k1", "mine", "component", F.col("own.n").alias("n"), "own.sketch")

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for links in _spanned(batches, params):
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in links], pa.int64()) for j in (0, 1)], names=["a", "b"])

    found = dealt.repartition("value", "p", "q").sortWithinPartitions("value", "p", "q").mapInArrow(K.tidy(span), "a long, b long")
    links = written(found.distinct(), "other-links")
    forget(known, mixed)
    return links


def _spanned(batches: Iterator[pa.RecordBatch], params: NearDuplicateParams) -> Iterator[list[tuple[int, int]]]:
    """For each run of rows with the same value, p and q: pairs of components that estimated links between its classes join, spanning all they connect."""
    now, held = None, []

    def out() -> list[tuple[int, int]]:
        # a pair inside one block is met in (p, p) only
        if len({row[2] for row in held}) < 2 or (now[1] != now[2] and len({row[1] for row in held}) < 2):
            return []
        held.sort(key=lambda row: row[0])
        _, mine, components, n, kept = zip(*held, strict=True)
        component = np.array(components, np.int64)
        parent = np.unique(component, return_inverse=True)[1]
        return _forest(component, np.array(mine), np.array(n, np.int64), list(kept), parent, lambda i, j: True, params)

    for batch in batches:
        value, p, q, k1, mine, component, n = (c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns[:7])
        sketch = batch.column(7)
        at = sketch.offsets.to_numpy().tolist()
        flat = sketch.values.to_numpy().view(np.uint64) ^ K.U64(1 << 63)
        for i, key in enumerate(zip(value, p, q, strict=True)):
            if now is not None and key != now:
                if links := out():
                    yield links
                held = []
            now = key
            held.append((k1[i], mine[i], component[i], n[i], flat[at[i] : at[i + 1]]))
    if held and (links := out()):
        yield links


def candidate_clusters(classes: DataFrame, params: NearDuplicateParams) -> DataFrame:
    """(node, component) of the classes that are connected by estimated links."""
    lists = inverted_lists(classes, params)
    heads = written(lists.groupBy("value").agg(F.min("k1").alias("a"), F.count(F.lit(1)).alias("n_list")).where(F.col("n_list") > 1), "heads")
    met = written(dealt_join(lists, heads, ["value"], "n_list", "k1", limit=_BROADCAST).select("value", "k1", "a"), "met")
    wanted = written(met.select("k1").distinct(), "wanted")
    own = F.struct(F.col("n_shingles").alias("n"), "sketch").alias("own")
    held = written(classes.join(bounded(wanted, most=_BROADCAST), "k1").select("k1", own), "held")
    near = _head_links(met, held, params)
    labels = connected_components(near, "heads")
    far = _other_links(met, held, labels, params)
    if far.limit(1).count():
        old, moved = labels, connected_components(far, "clusters")
        to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
        kept = old.join(bounded(to, moved), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        alone = moved.join(old.select("node"), "node", "left_anti")  # a class without a link of its own list's first
        labels = written(kept.unionByName(alone), "clusters")
        forget(old, moved)
    forget(lists, heads, met, wanted, held, near, far)
    return labels


def _forest(keys: np.ndarray, side: np.ndarray, size: np.ndarray, kept: list[np.ndarray], parent: np.ndarray, confirmed: Callable[[int, int], bool], params: NearDuplicateParams) -> list[tuple[int, int]]:
    """Estimated and confirmed links that span the components of a task's classes, from those in parent on; with two sides, only pairs across count."""
    n, k = len(keys), params.k
    values = np.concatenate(kept)
    row = np.repeat(np.arange(n), np.minimum(size, k))
    # inverted lists of the values that several classes retain
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    cuts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
    times = np.diff(np.append(cuts, len(ranked)))
    col = np.empty(len(values), np.int64)
    col[order] = np.repeat(np.arange(len(cuts)), times)
    holders, ends, at = row[order], cuts + times, np.concatenate(([0], np.cumsum(np.minimum(size, k))))
    padded = np.full((n, k), np.iinfo(np.uint64).max, np.uint64)
    padded[row, np.concatenate([np.arange(min(s, k)) for s in size.tolist()])] = values
    across = len(np.unique(side)) > 1
    links: list[tuple[int, int]] = []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        near = np.minimum(size[i], size[rest]) * 100 >= params.percent * np.maximum(size[i], size[rest])
        rest = rest[near & (parent[rest] != parent[i]) & ((side[rest] != side[i]) | (not across))]
        if not len(rest):
            continue
        own = [c for c in col[at[i] : at[i + 1]].tolist() if times[c] > 1]
        if not own:
            continue
        meet = np.bincount(np.concatenate([holders[cuts[c] : ends[c]] for c in own]), minlength=n)[rest]
        least = np.minimum(np.minimum(size[rest], size[i]), k) * params.overlap // k
        rest = rest[meet >= least]
        if not len(rest):
            continue
        merged = np.sort(np.concatenate((padded[rest], np.broadcast_to(padded[i], (len(rest), k))), axis=1), axis=1)
        twice = np.concatenate((np.zeros((len(rest), 1), bool), merged[:, 1:] == merged[:, :-1]), axis=1) & (merged != np.iinfo(np.uint64).max)
        real = merged != np.iinfo(np.uint64).max
        order = np.cumsum(real & ~twice, axis=1)
        shared = (twice & (order <= k)).sum(axis=1)
        rest = rest[shared * k >= np.minimum(order[:, -1], k) * params.overlap]
        for j in rest.tolist():
            if parent[j] == parent[i]:
                continue
            if confirmed(i, j):
                links.append((int(keys[i]), int(keys[j])))
                parent[parent == parent[j]] = parent[i]
    return links


def verified_links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, id_col: str, text_col: str, params: NearDuplicateParams) -> DataFrame:
    """(a, b): links between classes that hold on the full sets, enough to connect each component."""
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    dealt = clusters.join(sizes.withColumn("blocks", _blocks(F.col("size"), params)), "component").select(F.col("node").alias("k1"), F.col("component").alias("cluster"), "blocks")
    wanted = dealt.join(classes.select("k1", "k2", F.col("first_id").alias("_doc")), "k1").select("_doc", "k1", "k2", "cluster", "blocks")
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("body")).join(wanted, "_doc").select("body", "k1", "k2", "cluster", "blocks")
    names = ["cluster", "p", "q", "k1", "side", "values"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1s, k2s, clusters, blocks = (batch.column(i).to_pylist() for i in range(1, 5))
            for lo, words in K.words_of(K.text_column(batch, "body"), lower=True):
                rows = []
                for i, s in enumerate(_sets(words, params.words), lo):
                    if _key(s) != (k1s[i], k2s[i]):
                        continue  # another row with the same id
                    mine = (k1s[i] & 0x7FFFFFFF) % blocks[i]
                    raw = s.tobytes()
                    rows += [(clusters[i], min(mine, b), max(mine, b), k1s[i], mine, raw) for b in range(blocks[i])]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names=names)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def out() -> pa.RecordBatch:
            keys = sorted(held)
            sets = [held[x][1] for x in keys]
            size = np.array([len(s) for s in sets])

            def confirmed(i: int, j: int) -> bool:
                inter = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                return bool(100 * inter >= params.percent * (size[i] + size[j] - inter))

            links = _forest(np.array(keys, np.int64), np.array([held[x][0] for x in keys]), size, [s[: params.k] for s in sets], np.arange(len(keys)), confirmed, params) if len(keys) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in links], pa.int64()) for j in (0, 1)], names=["a", "b"])

        for batch in batches:
            for cluster, p, q, k1, side, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and (cluster, p, q) != now:
                    yield out()
                    held = {}
                now = (cluster, p, q)
                held[k1] = (side, np.frombuffer(raw, np.uint64))
        if held:
            yield out()

    rows = texts.mapInArrow(K.tidy(deal), "cluster long, p int, q int, k1 long, side int, values binary")
    return rows.repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q").mapInArrow(K.tidy(verify), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDuplicateParams = NearDuplicateParams()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept."""
    return _judged(docs, id_col, text_col, params).drop("row_key")


def _judged(docs: DataFrame, id_col: str, text_col: str, params: NearDuplicateParams) -> DataFrame:
    """near_duplicates, with row_key, the hash of each row's text."""
    ship(docs.sparkSession)
    named = written(sketches(docs, id_col, text_col, params), "sketches")
    full = named.where((F.col("n_shingles") > 0) & F.col(id_col).isNotNull())
    classes = written(full.groupBy("k1", "k2").agg(F.min(id_col).alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    clusters = candidate_clusters(classes, params)
    found = connected_components(verified_links(docs, classes, clusters, id_col, text_col, params), "links")
    forget(clusters)
    # only classes with links go through these joins
    linked = found.select(F.col("node").alias("k1"), "component").join(classes.select("k1", "first_id"), "k1")
    heads = linked.groupBy("component").agg(F.min("first_id").alias("head"))
    moved = linked.join(heads, "component").groupBy("k1").agg(F.min("head").alias("_head"))
    own = classes.select("k1", "k2", "first_id").join(moved, "k1", "left").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.coalesce("_head", "first_id").alias("_least"))
    rows = named.select(id_col, "row_key", "n_shingles", "k1", "k2")
    joined = rows.join(own, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n_shingles") > 0) & F.col(id_col).isNotNull(), "left")
    least = F.coalesce("_least", F.col(id_col))
    return joined.select(id_col, "row_key", "n_shingles", least.alias("component_id"), F.coalesce(least == F.col(id_col), F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDuplicateParams = NearDuplicateParams()) -> DataFrame:
    """The rows of docs without near duplicates: of each component one row stays, that with the least id.

    Rows are told apart by id and text.  Of several rows with a component's
    least id the one with the least hash of its text stays, and of rows that
    are equal in both one.  Rows with a null id or without words all stay.
    """
    docs, restored = apart(docs, [id_col, text_col])
    judged = written(_judged(docs, id_col, text_col, params), "judged")
    grouped = judged.where((F.col("n_shingles") > 0) & F.col(id_col).isNotNull())
    gone = grouped.where(~F.col("kept")).select(F.col(id_col).alias("_gone_id"), F.col("row_key").alias("_gone_key"))
    several = grouped.where("kept").groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), F.min("row_key").alias("first_key")).where(F.col("n") > 1)
    several = written(several, "several")
    rows = docs.withColumn("_key", F.xxhash64(text_col))
    at = lambda df, i, k: (rows[id_col] == df[i]) & (rows["_key"] == df[k])
    if several.limit(1).count():
        # ids that are not unique
        extra = grouped.where("kept").join(several, "component_id").where(F.col("row_key") != F.col("first_key"))
        gone = gone.unionByName(extra.select(F.col(id_col).alias("_gone_id"), F.col("row_key").alias("_gone_key")))
    gone = written(gone.distinct(), "gone")
    stay = rows.join(bounded(gone), at(gone, "_gone_id", "_gone_key"), "left_anti")
    if several.limit(1).count():
        first = several.select(F.col("component_id").alias("_id"), F.col("first_key").alias("_first"))
        named = stay[id_col].eqNullSafe(first["_id"]) & (stay["_key"] == first["_first"])
        plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
        one = stay.join(bounded(first, several), named, "left_semi").groupBy(id_col, "_key").agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.xxhash64(*(F.col(f"`{c}`") for c in plain))).alias("_row"))
        stay = stay.join(bounded(first, several), named, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(one.select("_row.*"))
    return restored(stay)
