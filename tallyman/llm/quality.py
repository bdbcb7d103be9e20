"""Quality rules: repetition coverage.

Rolling polynomial hashes of several n-gram lengths (words, in numpy) measure
which share of a text's word characters lies inside n-grams that occurred
before in the same text; equal lines are measured likewise.  A text is kept if
every share stays at or below its limit.

Null or empty text: no words, all measures 0, fails `min_words`.  Characters are
code points.  Repeated
rows are measured one by one.  Only the named id and text columns are read, so
further columns, whatever their names, don't matter.  No shuffle: the operator
is one map over the input.  Texts are worked through some megabytes at a time; a
single longer text has to fit with its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textkit as K
from .shared import ship

_BASE = 0x9FB21C651E98DF25
_SYMBOLS = K._lut(b"#*$%&|<>")


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the method: shares of word characters (n-grams) or of characters (lines)."""

    #: n (3 or more) -> largest share of word characters inside n-grams seen before in the text.
    #: Twice the limits published with the Gopher rules, which also reject short texts that repeat one line.
    ngram_limits: dict[int, float] = field(default_factory=lambda: {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20})
    #: Largest share of the characters of lines with a word that lies in lines seen before.
    line_limit: float = 0.30
    #: Texts with fewer words fail the base rules.
    min_words: int = 50
    #: Words in repeated 3-word windows, as a percentage of all words.
    max_repeat_pct: int = 50
    #: Columns with the measured shares, beside the verdicts.
    shares: bool = True


def _repeats(words: K.Words, owner: np.ndarray, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that start at `at`: those found twice or more in their text, and those found before in it."""
    key = K.rolling(words.hashes, n, _BASE)
    key = K.mix64(key[at]) + K.mix64(owner[at].astype(np.uint64) + K.U64(n))
    ranked = np.sort(key)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return at[:0], at[:0]
    many = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
    at, key = at[many], key[many]
    order = np.argsort(key, kind="stable")
    return at, at[order[1:]][key[order[1:]] == key[order[:-1]]]


def measure_block(words: K.Words, rules: RepetitionRules) -> dict[str, np.ndarray]:
    owner, n_words = words.owner(), words.counts()
    # code points of the words: between words stand only one-byte characters
    chars = words.ends - words.starts
    if len(chars):
        chars = chars - np.add.reduceat((words.data & 0xC0) == 0x80, words.starts, dtype=np.int32)
    total = np.maximum(K.per_text(chars, words.first), 1)
    many, _ = _repeats(words, owner, 3, K.window_index(words, 3))
    last = words.first[1:][owner] if len(owner) else owner  # end of each word's text
    out = {
        "n_words": n_words,
        "word_chars": K.per_text(chars, words.first),
        "n_symbols": np.diff(np.searchsorted(np.flatnonzero(_SYMBOLS[words.data]), words.texts)),
        "n_repeat_words": K.per_text(K.covered(len(owner), many, 3), words.first),
    }
    kept = np.ones(len(n_words), bool)
    for n, limit in sorted(rules.ngram_limits.items()):
        # what begins a repeated longer run begins a repeated shorter one
        many, later = _repeats(words, owner, n, many[many + n <= last[many]])
        inside = K.covered(len(owner), later, n)
        share = K.per_text(np.where(inside, chars, 0), words.first) / total
        out[f"dup_{n}gram_share"] = share
        kept &= share <= limit
    raw, ends = words.data.tobytes(), words.texts.tolist()
    dup_lines, dup_share = np.zeros(len(n_words), np.int64), np.zeros(len(n_words))
    for i, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False)):
        seen: set[bytes] = set()
        again = again_size = size = 0
        for line in raw[lo:hi].split(b"\n"):
            if not line.strip(K.SPACES):
                continue
            points = len(line) if line.isascii() else len(line.decode(errors="replace"))
            size += points
            if line in seen:
                again += 1
                again_size += points
            else:
                seen.add(line)
        dup_lines[i], dup_share[i] = again, again_size / max(size, 1)
    out |= {"n_dup_lines": dup_lines, "dup_line_share": dup_share}
    base_failed = (n_words < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_pct * n_words)
    return out | {"base_failed": base_failed, "kept": kept & (dup_share <= rules.line_limit) & ~base_failed}


def _fields(rules: RepetitionRules) -> list[tuple[str, T.DataType]]:
    longs = [(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    shares = [(f"dup_{n}gram_share", T.DoubleType()) for n in sorted(rules.ngram_limits)] + [("dup_line_share", T.DoubleType())]
    return longs + (shares if rules.shares else []) + [("base_failed", T.BooleanType()), ("kept", T.BooleanType())]


def repetition_coverage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """One row per input row: id, measures, base_failed, kept."""
    ship(docs.sparkSession)
    fields = _fields(rules)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(c, t) for c, t in fields)])
    kinds = {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words in K.words_of(K.text_column(batch, text_col)):
                got = measure_block(words, rules)
                ids = batch.column(0).slice(lo, words.n_texts)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(got[c]).cast(kinds[type(t)]) for c, t in fields)], names=[id_col, *(c for c, _ in fields)])

    return docs.select(id_col, text_col).mapInArrow(K.tidy(run), schema)
