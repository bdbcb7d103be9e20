"""Bounded-space online best-fit packing of token sequences.

Documents are tokenised in place; texts longer than a sequence are cut into
full pieces, the first piece taking the remainder.  Small rows (id, piece,
length, checksum) are dealt into groups of bounded size by a hash of their
content, and each group is packed in one pass by a packer with a fixed number
of open bins: a bitset keyed by free space finds the tightest bin that fits in
a few machine operations, and when all bins are open the fullest closes first.
Pieces arrive in batches of a fixed size, the longest of a batch first, which
leaves about a thousandth of the places empty instead of a hundredth.
More groups, not larger ones, take up more data; each leaves its last open bins
part-filled, a fraction of a percent of its sequences.

Defined results: a null or empty text is one piece that holds only the end id.
Repeated rows are packed each.  Null ids are allowed.  Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as K
from .shared import ship


@dataclass(frozen=True)
class PackingParams:
    #: Rank file of the tokenizer's vocabulary, and its pattern; None: the installed public files.
    ranks_path: str | None = None
    pattern: str | None = None
    capacity: int = 2048
    end_id: int = 0
    #: Strings of the tokenizer that always become one id.
    special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)
    open_bins: int = 1024
    #: Pieces that arrive together; the longest of them are placed first.
    lookahead: int = 4096
    #: Documents that one packing group is meant to hold.
    group_docs: int = 16384
    #: Words whose ids a worker keeps at hand.
    cache_words: int = 400_000


class WordCache(dict):
    """Token ids (little-endian uint32 bytes) of chunks, filled on demand."""

    def __init__(self, encode, lead: str, most: int):
        super().__init__()
        self.encode, self.lead, self.most = encode, lead, most

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[chunk] = np.array(self.encode(self.lead + chunk), np.uint32).tobytes()
        return ids


class Encoder:
    """Ids of whole texts by byte-level BPE, word by word.

    The tokenizer's pattern always starts a token at a space between two
    non-spaces, so such a space is a safe cut, and words recur; a text with
    white space elsewhere beside a cut is encoded in one go.
    """

    #: A space beside other white space, or at either end: no safe cut.
    UNSAFE = re.compile(r"\s\s|^\s|\s$")

    def __init__(self, params: PackingParams):
        import public_tokenizers
        import tiktoken

        path = params.ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ranks", pat_str=params.pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = params.special
        self.split = re.compile("(" + "|".join(re.escape(s) for s, _ in params.special) + ")") if params.special else None
        self.heads, self.words = WordCache(self.encode, "", params.cache_words // 8), WordCache(self.encode, " ", params.cache_words)

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if self.UNSAFE.search(text):
            return np.array(self.encode(text), np.uint32).tobytes()
        head, *words = text.split(" ")
        return self.heads[head] + b"".join(map(self.words.__getitem__, words))

    def __call__(self, text: str) -> bytes:
        if self.split is None or not any(s in text for s, _ in self.special):
            return self.plain(text)
        ids = dict(self.special)
        return b"".join(np.uint32(ids[part]).tobytes() if part in ids else self.plain(part) for part in self.split.split(text))


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: PackingParams = PackingParams(), with_ids: bool = False) -> DataFrame:
    """Pieces of every row: id, piece, start, length, ids_crc32, and the ids (packed uint32) if with_ids."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, cap, end = Encoder(params), params.capacity, np.uint32(params.end_id).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(K.text_column(batch, text_col).to_pylist()):
                raw = encode(text) + end
                n = len(raw) // 4
                start, piece = 0, 0
                size = n % cap or min(n, cap)
                while start < n:
                    part = raw[4 * start : 4 * (start + size)]
                    rows.append((i, piece, start, size, zlib.crc32(part), part if with_ids else None))
                    start, piece, size = start + size, piece + 1, cap
            at, *cols = zip(*rows, strict=True) if rows else ([],) * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())[: 4 + with_ids]
            arrays = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=False))]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return docs.select(id_col, text_col).mapInArrow(K.tidy(run), schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each length in order of arrival, and the number of bins.

    `by_free[f]` holds the open bins with f free places; bit f of `free` says
    that there are some.
    """
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = n_open = n_bins = 0
    bins, offsets = [], []
    for length in lengths:
        fits = free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            at = by_free[room].pop()
            if not by_free[room]:
                free ^= 1 << room
            n_open -= 1
        else:
            room, at, n_bins = capacity, n_bins, n_bins + 1
        bins.append(at)
        offsets.append(capacity - room)
        left = room - length
        if left:
            if n_open == open_bins:
                fullest = (free & -free).bit_length() - 1
                if left <= fullest:
                    continue  # the bin just filled is the fullest
                by_free[fullest].pop()
                if not by_free[fullest]:
                    free ^= 1 << fullest
                n_open -= 1
            by_free[left].append(at)
            free |= 1 << left
            n_open += 1
    return bins, offsets, n_bins


def pack(pieces: DataFrame, n_docs: int, id_col: str = "doc_id", params: PackingParams = PackingParams()) -> DataFrame:
    """Adds sequence_id and offset to pieces."""
    ship(pieces.sparkSession)
    groups = max(1, -(-n_docs // params.group_docs))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names, capacity, open_bins, ahead = pieces.columns, params.capacity, params.open_bins, params.lookahead

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop_columns(["_group"]).sort_by([("_order", "ascending"), (id_col, "ascending"), ("piece", "ascending")])
        lengths = table["length"].to_numpy()
        batches = np.arange(len(lengths)) // ahead
        table, lengths = table.take(order := np.lexsort((-lengths, batches))), lengths[order]
        bins, offsets, _ = best_fit(lengths.tolist(), capacity, open_bins)
        ids = np.array(bins, np.int64) + (key[0].as_py() << 40)
        return table.select(names).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))

    deal = F.xxhash64(F.col(id_col), "piece", "ids_crc32")
    dealt = pieces.withColumns({"_order": deal, "_group": F.pmod(deal, F.lit(groups)).cast("long")})
    return dealt.groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: PackingParams = PackingParams(), with_ids: bool = False) -> DataFrame:
    """Every piece of every row with its place: a sequence and an offset in it."""
    return pack(token_pieces(docs, id_col, text_col, params, with_ids), docs.count(), id_col, params)
