"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of training texts (a few MB).  Its words are numbered by the
benchmark's vocabulary; a word outside it ends a run, and runs shorter than the
shortest test phrase can hold no occurrence, so the index is built over what
is left.  Suffix array by prefix doubling, Burrows-Wheeler transform in a
wavelet matrix, suffix positions sampled.  All test phrases are searched at
once, from their last word to their first, two ranks a word; the rows of those
that occur are walked back to sampled positions.  Occurrences merge into
removal spans per text.

The test phrases are broadcast, in blocks of a bounded number of characters;
the training texts are not shuffled for it.  Where there are several blocks, one
at a time is on the driver: it writes what it hits by the texts' hashes, and the
last block's pass merges that in (a broadcast if it is small).

Defined results: null text has no words.  Repeated rows are judged each.  An
item without words has no phrases; null item ids are ignored in `items`.  An
empty benchmark hits nothing.  Further columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as K
from .shared import bounded, forget, ship, written


@dataclass(frozen=True)
class DecontaminationParams:
    #: Words of a test phrase; an item of fewer words is one phrase.
    width: int = 13
    #: A text is contaminated if hits reach 1 / share of its words.
    share: int = 20
    #: Every so many positions of a shard are sampled.
    sample: int = 16
    #: Characters of benchmark text in one broadcast block.
    block_chars: int = 4 << 20
    #: Bytes of training text of a shard.
    shard_bytes: int = 4 << 20


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector for each bit, highest first, zeros before ones at the next."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (seq >> bit) & 1
            before = np.concatenate(([0], np.cumsum(ones, dtype=np.int32)))
            zeros = len(seq) - int(before[-1])
            self.levels.append((bit, before, zeros))
            seq = np.concatenate((seq[ones == 0], seq[ones == 1]))

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each pair, how often the symbol stands in the sequence before the place."""
        lo = np.zeros(len(at), np.int64)
        hi = at.astype(np.int64)
        for bit, before, zeros in self.levels:
            one = (symbols >> bit) & 1 == 1
            a, b = before[lo], before[hi]
            lo = np.where(one, zeros + a, lo - a)
            hi = np.where(one, zeros + b, hi - b)
        return hi - lo


class FMIndex:
    """Full-text index of runs of symbols (2 or more), each run ended by the separator 1; 0 ends the text."""

    def __init__(self, seq: np.ndarray, top: int, sample: int):
        n = len(seq)
        self.n = n
        # separators are ordered by place, so no two suffixes are equal beyond a run
        cuts = np.flatnonzero(seq == 1)
        rank = seq + len(cuts)
        rank[cuts] = 1 + np.arange(len(cuts))
        rank[-1] = 0
        order = np.argsort(rank, kind="stable")
        step = 1
        while True:
            ahead = np.zeros(n, np.int64)
            ahead[: max(0, n - step)] = rank[step:] + 1
            key = rank * (n + top + 2) + ahead
            order = np.argsort(key, kind="stable")
            by = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate(([0], np.cumsum(by[1:] != by[:-1])))
            rank = new
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.order = order
        bwt = seq[order - 1]
        self.wavelet = WaveletMatrix(bwt, top)
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=top + 1))))
        keep = (order % sample == 0) | (seq[order - 1] <= 1)  # a walk back never crosses a separator
        self.sampled = keep
        self.sample_rank = np.concatenate(([0], np.cumsum(keep)))
        self.samples = order[keep]
        self.bwt = bwt

    def search(self, phrases: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of each phrase, by backward search; phrases are columns of words from the last to the first, padded with 0."""
        n = len(phrases[0]) if phrases else 0
        lo, hi, alive = np.zeros(n, np.int64), np.full(n, self.n, np.int64), np.arange(n)
        for column in phrases:
            c = column[alive]
            go = c > 0
            c, at = c[go], alive[go]
            if not len(at):
                break
            first = self.begin[c]
            lo[at] = first + self.wavelet.rank(c, lo[at])
            hi[at] = first + self.wavelet.rank(c, hi[at])
            alive = np.concatenate((alive[~go], at[lo[at] < hi[at]]))
            dead = at[lo[at] >= hi[at]]
            hi[dead] = lo[dead]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: steps back to the next sampled position, then that plus the steps."""
        rows = rows.copy()
        steps, at = np.zeros(len(rows), np.int64), np.flatnonzero(~self.sampled[rows])
        while len(at):
            c = self.bwt[rows[at]]
            rows[at] = self.begin[c] + self.wavelet.rank(c, rows[at])
            steps[at] += 1
            at = at[~self.sampled[rows[at]]]
        return self.samples[self.sample_rank[rows]] + steps


@dataclass
class Phrases:
    """Distinct test phrases of a block of items, over the block's vocabulary."""

    vocabulary: np.ndarray  # sorted word hashes; symbol = index + 2
    columns: list[np.ndarray]  # symbols from the last word to the first, 0 where a phrase is shorter
    lengths: np.ndarray
    names: list[str]  # of the items
    holders: np.ndarray  # for each phrase in turn, the items that hold it
    first: np.ndarray  # borders of the phrases in holders

    @property
    def shortest(self) -> int:
        return int(self.lengths.min())

    def items(self, phrase: int) -> list[str]:
        return [self.names[i] for i in self.holders[self.first[phrase] : self.first[phrase + 1]]]


def phrases_of(items: list[tuple], width: int) -> Phrases | None:
    """Phrases of (item id, text) rows."""
    words = K.tokenise(*K.buffers(pa.array([t or "" for _, t in items], pa.string())), K.ALNUM_WORDS, True)
    if not len(words.hashes):
        return None
    vocabulary, symbols = np.unique(words.hashes, return_inverse=True)
    symbols = (symbols + 2).astype(np.int32)
    counts = words.counts()
    n = np.where(counts >= width, counts - width + 1, counts > 0)
    owner = np.repeat(np.arange(len(items)), n)
    start = words.first[:-1][owner] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    length = np.minimum(counts[owner], width)
    grid = np.zeros((len(owner), int(length.max())), np.int32)
    for j in range(grid.shape[1]):
        has = length > j
        grid[has, j] = symbols[start[has] + length[has] - 1 - j]
    # equal phrases side by side, by their symbols
    order = np.lexsort(grid.T[::-1])
    grid, owner, length = grid[order], owner[order], length[order]
    new = np.append(True, (grid[1:] != grid[:-1]).any(axis=1))
    phrase = np.cumsum(new) - 1
    named = np.array([item is not None for item, _ in items])[owner]
    pairs = np.unique(np.stack((phrase[named], owner[named])), axis=1)
    at = np.flatnonzero(new)
    first = np.searchsorted(pairs[0], np.arange(len(at) + 1))
    return Phrases(vocabulary, [np.ascontiguousarray(c) for c in grid[at].T], length[at], ["" if i is None else str(i) for i, _ in items], pairs[1].astype(np.int32), first)


def shard_hits(words: K.Words, phrases: Phrases, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard: first word (index in words), length, phrase."""
    none = np.zeros(0, np.int64)
    if not len(words.hashes):
        return none, none, none
    place = np.minimum(np.searchsorted(phrases.vocabulary, words.hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[place] == words.hashes
    # runs of known words inside one text
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    heads = words.first[:-1][words.counts() > 0]
    begins[heads] = known[heads]
    at = np.flatnonzero(known)
    run = np.cumsum(begins)[at] - 1
    long = np.bincount(run, minlength=1) >= phrases.shortest if len(at) else none
    at = at[long[run]] if len(at) else at
    if not len(at):
        return none, none, none
    run = np.cumsum(begins)[at]
    gap = np.append(run[1:] != run[:-1], True)
    slot = np.arange(len(at)) + np.concatenate(([0], np.cumsum(gap)[:-1]))
    n = len(at) + int(gap.sum()) + 1
    seq, origin = np.ones(n, np.int64), np.zeros(n, np.int64)
    seq[slot], origin[slot] = place[at] + 2, at
    seq[-1] = 0
    index = FMIndex(seq, len(phrases.vocabulary) + 1, sample)
    lo, hi = index.search(phrases.columns)
    found = np.flatnonzero(hi > lo)
    which = np.repeat(found, (hi - lo)[found])
    rows = np.concatenate([np.arange(lo[i], hi[i]) for i in found]) if len(found) else none
    return origin[index.locate(rows)] if len(rows) else none, phrases.lengths[which], which


_SPANS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_RESULTS = ("n_words", "spans", "items", "n_hit", "contaminated")


def _with_block(docs: DataFrame, keep: list[str], text_col: str, phrases: Phrases | None, params: DecontaminationParams, earlier: bool = False) -> DataFrame:
    """Columns `keep`, n_words, spans and items; what other blocks found (`_spans`, `_items`) is merged in if `earlier`."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(phrases)
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep) + _SPANS
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    named = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        for batch in batches:
            data, ends = K.buffers(K.text_column(batch, "_body"))
            for lo, hi in K.pieces(ends, params.shard_bytes):
                part = batch.slice(lo, hi - lo)
                words = K.tokenise(data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], K.ALNUM_WORDS, True)
                n_texts = words.n_texts
                cover: list[list] = [[] for _ in range(n_texts)]
                items: list[set] = [set() for _ in range(n_texts)]
                if earlier:
                    cover = [[(s["start"], s["end"]) for s in x or ()] for x in part.column(len(keep) + 1).to_pylist()]
                    items = [set(x or ()) for x in part.column(len(keep) + 2).to_pylist()]
                if phrases is not None:
                    at, length, which = shard_hits(words, phrases, params.sample)
                    text = np.searchsorted(words.first, at, "right") - 1
                    for t, a, n, w in zip(text.tolist(), (at - words.first[text]).tolist(), length.tolist(), which.tolist(), strict=True):
                        cover[t].append((a, a + n))
                        items[t].update(phrases.items(w))
                merged = []
                for spans in cover:
                    out: list[dict] = []
                    for a, b in sorted(spans):
                        if out and a <= out[-1]["end"]:
                            out[-1]["end"] = max(out[-1]["end"], b)
                        else:
                            out.append({"start": a, "end": b})
                    merged.append(out)
                found = [pa.array(words.counts(), pa.int64()), pa.array(merged, pa.list_(span)), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(keep))] + found, names=[*keep, "n_words", "spans", "items"])

    made = docs.select(*named, F.col(text_col).alias("_body"), *(["_spans", "_items"] if earlier else [])).mapInArrow(K.tidy(run), schema)
    made._sent = sent
    return made


def _block_hits(docs: DataFrame, text_col: str, phrases: Phrases | None, params: DecontaminationParams) -> DataFrame:
    """_h1, _h2 (the text's hashes), spans, items of the distinct texts that a block of phrases hits, as a written table."""
    keyed = docs.select(F.xxhash64(text_col).alias("_h1"), F.xxhash64(F.lit(1), text_col).alias("_h2"), text_col)
    found = _with_block(keyed, ["_h1", "_h2"], text_col, phrases, params)
    hits = written(found.where(F.size("spans") > 0).groupBy("_h1", "_h2").agg(F.any_value("spans").alias("spans"), F.any_value("items").alias("items")), "hits")
    found._sent.destroy()
    return hits


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", params: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """Columns `keep` of every row, with n_words, merged removal spans (words), items, n_hit and contaminated; columns of docs with these names give way."""
    keep = [c for c in keep if c not in _RESULTS]
    clean = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("body")).where(F.length("body") > 0)
    size = clean.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-size // params.block_chars))

    def phrases(b: int) -> Phrases | None:
        part = clean if blocks == 1 else clean.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b)
        return phrases_of([(r.item, r.body) for r in part.collect()], params.width) if size else None

    if blocks == 1:
        out = _with_block(docs, keep, text_col, phrases(0), params)
    else:
        # every block but the last writes what it hits and is forgotten
        hits = [_block_hits(docs, text_col, phrases(b), params) for b in range(blocks - 1)]
        every = reduce(DataFrame.unionByName, hits).groupBy("_h1", "_h2").agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items"))
        every = written(every, "all-hits")
        forget(*hits)
        keyed = docs.withColumns({"_w1": F.xxhash64(text_col), "_w2": F.xxhash64(F.lit(1), text_col)})
        joined = keyed.join(bounded(every), (F.col("_w1") == F.col("_h1")) & (F.col("_w2") == F.col("_h2")), "left")
        out = _with_block(joined, keep, text_col, phrases(blocks - 1), params, earlier=True)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * params.share >= F.col("n_words")))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the words of the spans and what stands between them; the rest as it was."""
    if not spans:
        return text
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    words = K.tokenise(data, np.array([0, len(data)]), K.ALNUM_WORDS, True)
    left, at = [], 0
    for a, b in spans:
        left.append(raw[at : words.starts[a]])
        at = int(words.ends[b - 1])
    return b"".join([*left, raw[at:]]).decode()
