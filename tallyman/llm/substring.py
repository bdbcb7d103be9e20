"""Substring deduplication with a count-min prefilter.

A window is `width` consecutive words of one text.  Every word inside a window
whose word sequence also starts in a document with a smaller id is removed.

1. Each partition turns its windows into sparse count-min cells (two rows,
   counts 0, 1 and "2 or more"); cells are merged shard by shard as a stream, by
   groups of partitions first where one shard has many cells.
   Only the merged "2 or more" bits reach the executors: 2 * 2**max_bits bits
   at most (64 MB by default), whatever the size of the corpus.  An estimate
   is never below the true count, so no repeated window is lost; a fuller
   sketch merely lets more single windows through to step 2.
2. Each partition hashes its windows again (96 bits), keeps those estimated
   repeated, and settles what it can: of a window's documents in one partition
   only the smallest can keep it.  That one goes to the window's shard, so a
   window in a third of all documents sends one entry per partition.  Shards
   group exactly and report the losing (document, position) pairs.
3. Positions are gathered per row, by buckets of rows, and joined with the texts.

Defined results: null or empty text has no words.  Rows with a null id neither
lose words nor cause removals.  Rows that share an id are judged one by one and
take nothing from each other.  Ids are integers.  Texts are never cut; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as K
from .shared import ship

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_CELL_BITS = 22  # cells of one shard of the sketch


@dataclass(frozen=True)
class SubstringParams:
    width: int = 13
    #: log2 of the cells of each of the two rows of the sketch, at most.
    max_bits: int = 28
    #: Cells per row for each expected window.
    cells_per_window: float = 3.0
    #: Cells of one shard of the sketch that one task is meant to merge.
    merge_cells: int = 1 << 26
    #: Entries of step 2 that one shard is meant to hold.
    shard_entries: int = 1_000_000
    #: Documents whose lost positions are gathered together.
    bucket_docs: int = 2000
    #: Windows (step 1) or entries (step 2) that a task gathers before it passes them on.
    flush_windows: int = 4_000_000
    flush: int = 1_500_000
    #: Bytes of a text that are cut into words at a time when its kept words are told.
    piece_bytes: int = K.BLOCK_BYTES


def _window_hashes(words: K.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (word index) of a block's windows and their two hashes."""
    at = K.window_index(words, width)
    one, two = (K.mix64(K.rolling(words.hashes, width, base)[at]) for base in _BASES)
    return at, one, two >> K.U64(32)


def _cells(one: np.ndarray, two: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (one >> K.U64(64 - bits)).astype(np.uint32), (two >> K.U64(32 - bits)).astype(np.uint32)


def _pack(sorted_cells: np.ndarray) -> bytes:
    gaps = np.diff(sorted_cells, prepend=sorted_cells.dtype.type(0))
    small = not len(gaps) or gaps.max() < 1 << 16
    return (b"h" if small else b"i") + zstandard.compress(gaps.astype(np.uint16 if small else np.uint32).tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(blob[1:]), np.uint16 if blob[:1] == b"h" else np.uint32), dtype=np.int64)


def _dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """df with equal keys together and in order, in as many tasks as the data need where that is more than the session's number."""
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartition(tasks, *keys) if tasks > own else df.repartition(*keys)).sortWithinPartitions(*keys)


def repeated_bits(docs: DataFrame, text_col: str, windows: int, params: SubstringParams) -> tuple[list[np.ndarray], int]:
    """The merged sketch's "2 or more" bits, one packed array per row, and log2 of its cells, for about so many windows."""
    bits = max(_CELL_BITS, min(params.max_bits, int(np.ceil(np.log2(max(2, params.cells_per_window * windows))))))
    per_row, width, flush = 1 << (bits - _CELL_BITS), params.width, params.flush_windows
    groups = max(1, -(-windows // (per_row * params.merge_cells)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        n, group = 0, TaskContext.get().partitionId()

        def out() -> Iterator[pa.RecordBatch]:
            for row, parts in enumerate(held):
                if not parts:
                    continue
                cells = np.sort(np.concatenate(parts))
                parts.clear()
                new = np.append(True, cells[1:] != cells[:-1])
                again = np.append(~new[1:], False) & new
                cells, again = cells[new], again[new]
                ends = np.searchsorted(cells, np.arange(1, per_row + 1, dtype=np.uint64) << K.U64(_CELL_BITS))
                low = cells & np.uint32((1 << _CELL_BITS) - 1)
                rows = [(row * per_row + i, group % groups, _pack(low[a:b]), _pack(low[a:b][again[a:b]])) for i, (a, b) in enumerate(zip(np.append(0, ends), ends, strict=False)) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["shard", "group", "once", "twice"])

        for batch in batches:
            for _, words in K.words_of(K.text_column(batch, text_col)):
                _, one, two = _window_hashes(words, width)
                for parts, cells in zip(held, _cells(one, two, bits), strict=True):
                    parts.append(cells)
                n += len(one)
                if n >= flush:
                    yield from out()
                    n, group = 0, group + 1
        yield from out()

    def united(add: Callable[[np.ndarray, np.ndarray, bytes, bytes], None]) -> Callable[[Iterator], Iterator]:
        """What makes one row of every shard and group: its cells seen once or more, and twice or more, as bits."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, seen, many = None, np.zeros(1 << _CELL_BITS, bool), np.zeros(1 << _CELL_BITS, bool)

            def out() -> pa.RecordBatch:
                packed = [pa.array([zstandard.compress(np.packbits(x).tobytes(), 1)], pa.binary()) for x in (seen, many)]
                seen[:] = False
                many[:] = False
                return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int64()), *packed], names=["shard", "group", "once", "twice"])

            for batch in batches:
                for shard, group, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if now is not None and (shard, group) != now:
                        yield out()
                    now = (shard, group)
                    add(seen, many, once, twice)
            if now is not None:
                yield out()

        return run

    def add_cells(seen: np.ndarray, many: np.ndarray, once: bytes, twice: bytes) -> None:
        cells = _unpack(once)
        many[cells] |= seen[cells]
        seen[cells] = True
        many[_unpack(twice)] = True

    def add_bits(seen: np.ndarray, many: np.ndarray, once: bytes, twice: bytes) -> None:
        more, again = (np.unpackbits(np.frombuffer(zstandard.decompress(x), np.uint8)).view(bool) for x in (once, twice))
        many |= (seen & more) | again
        seen |= more

    kind = "shard int, group long, once binary, twice binary"
    cells = docs.select(text_col).mapInArrow(K.tidy(sketch), kind)
    merged = _dealt(cells, len(_BASES) * per_row * groups if groups > 1 else 1, "shard", "group").mapInArrow(K.tidy(united(add_cells)), kind)
    if groups > 1:
        merged = _dealt(merged.withColumn("group", F.lit(0).cast("long")), 1, "shard").mapInArrow(K.tidy(united(add_bits)), kind)
    flags = [np.zeros(1 << (bits - 3), np.uint8) for _ in _BASES]
    step = 1 << (_CELL_BITS - 3)
    for shard, packed in merged.select("shard", "twice").toLocalIterator():
        row, i = divmod(shard, per_row)
        flags[row][i * step : (i + 1) * step] = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return flags, bits


def _pack_entries(doc: np.ndarray, key: np.ndarray, one: np.ndarray, two: np.ndarray, local: np.ndarray, pos: np.ndarray) -> bytes:
    """Entries in the order of `one`: its gaps by byte planes, the rest as it is, compressed."""
    gaps = np.diff(one, prepend=K.U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    ints = two.astype(np.uint32).tobytes() + local.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() + pos.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    body = doc.astype(np.int64).tobytes() + key.astype(np.int64).tobytes() + gaps + ints
    return np.array([len(doc), len(one)], np.uint32).tobytes() + zstandard.compress(body, 1)


def _unpack_entries(blob: bytes) -> tuple[np.ndarray, ...]:
    rows, m = (int(x) for x in np.frombuffer(blob, np.uint32, 2))
    body = zstandard.decompress(blob[8:])
    doc, key = np.frombuffer(body, np.int64, 2 * rows).reshape(2, rows)
    at = 16 * rows

    def planes(width: int, kind: type) -> np.ndarray:
        return np.ascontiguousarray(np.frombuffer(body, np.uint8, m * width, at).reshape(width, m).T).view(kind).ravel()

    one = np.cumsum(planes(8, np.uint64), dtype=np.uint64)
    at += 8 * m
    two = np.frombuffer(body, np.uint32, m, at).astype(np.uint64)
    at += 4 * m
    local = planes(4, np.uint32).astype(np.int64)
    at += 4 * m
    return doc, key, one, two, local, planes(4, np.uint32)


def _lit(flags: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (flags[cells >> np.uint32(3)] >> (np.uint32(7) - (cells & np.uint32(7))).astype(np.uint8)) & 1 == 1


def _losers(one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of entries by window, and flags (in that order) of those whose window has a smaller document."""
    order = np.lexsort((doc, two, one))
    a, b, d = one[order], two[order], doc[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, bool)
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(a) else d
    return order, d > least


def _by_row(row: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(row, packed positions) from entries."""
    order = np.lexsort((pos, row))
    row, pos = row[order], pos[order].astype(np.uint32)
    cuts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(row)), strict=True):
        yield int(row[a]), _pack(pos[a:b])


_ENTRY = "shard int, doc long, row_key long, blob binary"


def _loss_batch(shard: int, docs: np.ndarray, keys: np.ndarray, found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    at = [r for r, _ in found]
    cols = [pa.array(np.full(len(at), shard), pa.int32()), pa.array(docs[at], pa.int64()), pa.array(keys[at], pa.int64()), pa.array([b for _, b in found], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["shard", "doc", "row_key", "blob"])


def _pack_losses(doc: np.ndarray, key: np.ndarray, pos: np.ndarray) -> bytes:
    """Lost positions of some rows, sorted by row: ids, keys, counts, positions."""
    cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
    count = np.diff(np.append(cuts, len(doc))).astype(np.uint32)
    body = doc[cuts].tobytes() + key[cuts].tobytes() + count.tobytes() + pos.view(np.uint8).reshape(-1, 4).T.tobytes()
    return np.uint32(len(cuts)).tobytes() + zstandard.compress(body, 1)


def _unpack_losses(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, body = int(np.frombuffer(blob, np.uint32, 1)[0]), zstandard.decompress(blob[4:])
    doc, key = np.frombuffer(body, np.int64, 2 * rows).reshape(2, rows)
    count = np.frombuffer(body, np.uint32, rows, 16 * rows)
    pos = np.ascontiguousarray(np.frombuffer(body, np.uint8, -1, 20 * rows).reshape(4, -1).T).view(np.uint32).ravel()
    return np.repeat(doc, count), np.repeat(key, count), pos


def removed_positions(docs: DataFrame, id_col: str, text_col: str, params: SubstringParams) -> DataFrame:
    """doc, row_key, blob: the packed starts of the windows that each row loses."""
    spark = docs.sparkSession
    sizes = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.col(text_col))).alias("bytes")).first()
    size, windows = sizes.rows, (sizes.bytes or 0) // 6
    flags, bits = repeated_bits(docs, text_col, windows, params)
    # Entries of step 2: windows that set a bit twice, and in a full sketch the single ones that meet two such bits.
    fill = [float(np.unpackbits(f[: 1 << 20]).mean()) for f in flags]
    expected = max(size, int(sum(fill) * (1 << bits)), int(windows * fill[0] * fill[1]))
    shards = max(8, -(-expected // params.shard_entries))
    sent = spark.sparkContext.broadcast(flags)
    width, flush = params.width, params.flush

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lit = sent.value
        ids: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        held: list[tuple] = []
        n = n_rows = 0

        def out() -> Iterator[pa.RecordBatch]:
            one, two, row, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            doc, key = np.concatenate(ids), np.concatenate(keys)
            order, lost = _losers(one, two, doc[row])
            gone = order[lost]
            if len(gone):
                found = list(_by_row(row[gone], pos[gone]))
                yield _loss_batch(-1 - (n % shards), doc, key, found)
            stay = order[~lost]
            one, two, row, pos = one[stay], two[stay], row[stay], pos[stay]
            shard = (one >> K.U64(32)) * K.U64(shards) >> K.U64(32)  # rises with `one`, by which entries are sorted
            blobs = []
            for s, a, b in zip(range(shards), np.searchsorted(shard, np.arange(shards)), np.searchsorted(shard, np.arange(shards), "right"), strict=True):
                if b > a:
                    own, local = np.unique(row[a:b], return_inverse=True)
                    blobs.append((s, _pack_entries(doc[own], key[own], one[a:b], two[a:b], local, pos[a:b])))
            none = pa.nulls(len(blobs), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in blobs], pa.int32()), none, none, pa.array([b for _, b in blobs], pa.binary())], names=["shard", "doc", "row_key", "blob"])
            held.clear()

        for batch in batches:
            col = K.text_column(batch, text_col)
            known = batch.column(0)
            ids.append(known.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            keys.append(batch.column(1).to_numpy(zero_copy_only=False))
            usable = known.is_valid().to_numpy(zero_copy_only=False)
            for lo, words in K.words_of(col):
                at, one, two = _window_hashes(words, width)
                maybe = np.ones(len(at), bool)
                for flag, cells in zip(lit, _cells(one, two, bits), strict=True):
                    maybe[maybe] = _lit(flag, cells[maybe])
                owner = words.owner()[at]
                maybe &= usable[lo + owner]
                held.append((one[maybe], two[maybe], (n_rows + lo + owner)[maybe], (at - words.first[owner])[maybe]))
                n += int(maybe.sum())
            n_rows += len(col)
            if n >= flush:
                yield from out()
                n = n_rows = 0
                ids, keys = [], []
        if n:
            yield from out()

    buckets = max(8, -(-size // params.bucket_docs))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, base, waiting = None, [], 0, 0
        docs_held: list[np.ndarray] = []
        keys_held: list[np.ndarray] = []
        lost: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def shard_losses() -> None:
            one, two, row, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            doc, key = np.concatenate(docs_held), np.concatenate(keys_held)
            order, flag = _losers(one, two, doc[row])
            gone = order[flag]
            lost.append((doc[row[gone]], key[row[gone]], pos[gone].astype(np.uint32)))

        def out() -> pa.RecordBatch:
            doc, key, pos = (np.concatenate(x) for x in zip(*lost, strict=True))
            lost.clear()
            bucket = (K.mix64(doc.astype(np.uint64) + K.mix64(key.astype(np.uint64))) % K.U64(buckets)).astype(np.int64)
            order = np.lexsort((pos, key, doc, bucket))
            bucket, doc, key, pos = bucket[order], doc[order], key[order], pos[order]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
            blobs = [_pack_losses(doc[a:b], key[a:b], pos[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(bucket)), strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for shard, doc, key, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and shard != now and held:
                    shard_losses()
                    waiting += len(lost[-1][2])
                    held, docs_held, keys_held, base = [], [], [], 0
                now = shard
                if shard < 0:  # lost already
                    pos = _unpack(blob).astype(np.uint32)
                    lost.append((np.full(len(pos), doc, np.int64), np.full(len(pos), key, np.int64), pos))
                    waiting += len(pos)
                else:
                    docs, keys, one, two, local, pos = _unpack_entries(blob)
                    docs_held.append(docs)
                    keys_held.append(keys)
                    held.append((one, two, local + base, pos))
                    base += len(docs)
                if waiting > flush:
                    yield out()
                    waiting = 0
        if held:
            shard_losses()
        if lost:
            yield out()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            doc, key, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((pos, key, doc))
            doc, key, pos = doc[order], key[order], pos[order]
            cuts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))
            blobs = [_pack(pos[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(doc)), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(doc[cuts], pa.int64()), pa.array(key[cuts], pa.int64()), pa.array(blobs, pa.binary())], names=["doc", "row_key", "blob"])

        for batch in batches:
            for bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and bucket != now:
                    yield out()
                    held = []
                now = bucket
                held.append(_unpack_losses(blob))
        if held:
            yield out()

    entries = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("row_key"), F.col(text_col)).mapInArrow(K.tidy(candidates), _ENTRY)
    settled = _dealt(entries, shards, "shard").mapInArrow(K.tidy(settle), "bucket int, blob binary")
    return _dealt(settled, buckets // 8, "bucket").mapInArrow(K.tidy(gather), "doc long, row_key long, blob binary")


def deduplicate_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: SubstringParams = SubstringParams(), with_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, and the kept words (joined by one space) if with_text."""
    ship(docs.sparkSession)
    losses = removed_positions(docs, id_col, text_col, params).withColumnsRenamed({"doc": "_doc", "row_key": "_key"})
    texts = docs.select(id_col, text_col, F.xxhash64(text_col).alias("_row"))
    both = texts.join(losses, (F.col(id_col) == F.col("_doc")) & (F.col("_row") == F.col("_key")), "left").select(id_col, text_col, F.col("blob").alias("_blob"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    width, piece = params.width, params.piece_bytes

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_gone, digest, kept = [], [], [], []
            for text, blob in zip(K.text_column(batch, text_col).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, starts = text.encode(), _unpack(blob) if blob else np.zeros(0, np.int64)
                gone = K.covered(int(starts[-1]) + width, starts, width) if len(starts) else np.zeros(0, bool)
                n, left, told, parts = 0, 0, hashlib.sha256(), []
                # piece by piece, so that a long text's words are never held all at once
                for a, b in zip(cuts := K.word_cuts(np.frombuffer(raw, np.uint8), K.BLANK_SEPARATED, piece), cuts[1:], strict=False):
                    words = raw[a:b].split()
                    lost = gone[n : n + len(words)]
                    n += len(words)
                    if lost.any():
                        words = [*compress(words, (~lost).tolist()), *words[len(lost) :]]
                    if words:
                        part = b" " * (left > 0) + b" ".join(words)
                        left += len(words)
                        told.update(part)
                        if with_text:
                            parts.append(part)
                n_words.append(n)
                n_gone.append(n - left)
                digest.append(told.hexdigest())
                if with_text:
                    kept.append(b"".join(parts).decode())
            cols = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * with_text, names=[id_col, "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)

    return both.mapInArrow(K.tidy(cut), schema)
