"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its hashed word vector beside the mean of its hashed
character n-gram vectors.  Two gated recurrent passes read a window of words,
attention pools their states, and a linear layer scores the window.  A text's
score is that of its highest window, over all overlapping windows of the whole
text; a final one-dimensional fit turns it into a probability.

Training runs in one task over a sample bounded by `TrainingParams` (rows and
characters); windows
of a toxic text that the network, after its first pass, finds harmless are left
out of the next pass (a toxic text needs only one toxic window).  Scoring is a
map without a shuffle; vectors are made once for each distinct word of a block.

Defined results: null or empty text has no windows and gets the score of the
prior.  Without labelled rows of both classes every score is 0.  Repeated rows
are scored each; null ids are allowed.  Ids, labels and other columns are never
inputs of a score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as K
from .shared import ship


@dataclass(frozen=True)
class TrainingParams:
    #: Labelled rows of class 0 and of class 1 in the sample, at most.
    rows: tuple[int, int] = (3000, 700)
    #: Longer texts are not taken into the sample, and no more characters than these altogether.
    longest: int = 40_000
    chars: int = 16_000_000
    passes: int = 4
    #: Steps at least; a small sample is passed over more often, in smaller batches.
    steps: int = 160
    batch: int = 384
    rate: float = 0.02
    seed: int = 5


@dataclass(frozen=True)
class NetworkParams:
    window: int = 48
    stride: int = 36
    hidden: int = 8
    attention: int = 6
    word_dim: int = 4
    char_dim: int = 8
    word_buckets: int = 1 << 15
    char_buckets: int = 1 << 17
    #: Lengths of the character n-grams (bytes of the lower-cased word between two marks).
    grams: tuple[int, ...] = (3, 4, 5)


@dataclass
class Inputs:
    """Distinct words of a block: word bucket, and n-gram buckets as one flat list with borders."""

    bucket: np.ndarray
    grams: np.ndarray
    first: np.ndarray


@dataclass
class Model:
    net: NetworkParams
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    shift: float = 0.0
    prior: float = 0.0


def word_inputs(words: K.Words, net: NetworkParams) -> tuple[Inputs, np.ndarray]:
    """Inputs of the distinct words, and the index of each word among them."""
    kept, at, index = np.unique(words.hashes, return_index=True, return_inverse=True)
    starts, ends = words.starts[at], words.ends[at]
    # the distinct words' bytes, each between two marks
    size = ends - starts + 2
    border = np.concatenate(([0], np.cumsum(size)))
    text = np.zeros(int(border[-1]), np.uint64)
    inner = np.arange(int(border[-1])) - np.repeat(border[:-1], size)
    body = (inner > 0) & (inner < np.repeat(size, size) - 1)
    text[body] = words.data[(np.repeat(starts, size) + inner - 1)[body]].astype(np.uint64) + K.U64(1)
    held, owner = [], []
    for n in net.grams:
        count = np.maximum(size - n + 1, 0)
        total = int(count.sum())
        start = np.arange(total) + np.repeat(border[:-1] - (np.cumsum(count) - count), count)
        key = np.zeros(total, np.uint64)
        for j in range(n):
            key = key * K.U64(0x100000001B3) + text[start + j]
        held.append((K.mix64(key + K.U64(n << 40)) % K.U64(net.char_buckets)).astype(np.int32))
        owner.append(np.repeat(np.arange(len(kept), dtype=np.int32), count))
    grams, own = np.concatenate(held), np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    first = np.concatenate(([0], np.cumsum(np.bincount(own, minlength=len(kept)))))
    return Inputs((kept % K.U64(net.word_buckets)).astype(np.int64), grams[order], first), index


def vectors(inputs: Inputs, w: dict[str, np.ndarray], chunk: int = 16384) -> np.ndarray:
    """Input vectors of the distinct words: word vector beside the mean n-gram vector."""
    n = len(inputs.bucket)
    mean = np.zeros((n, w["chars"].shape[1]), w["chars"].dtype)
    for a in range(0, n, chunk):
        first = inputs.first[a : a + chunk + 1]
        if first[-1] > first[0]:
            sums = np.add.reduceat(w["chars"][inputs.grams[first[0] : first[-1]]], first[:-1] - first[0], axis=0)
            mean[a : a + chunk] = sums / np.diff(first)[:, None]
    return np.concatenate((w["words"][inputs.bucket], mean), axis=1)


def gates_of(x: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The part of both directions' gates that depends on the inputs alone."""
    return {side: x @ w[f"x{side}"] + w[f"c{side}"] for side in ("f", "b")}


def window_grid(counts: np.ndarray, first: np.ndarray, length: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows that together cover each text, and the text of each."""
    n = np.where(counts > length, 1 + -(-(counts - length) // stride), (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return first[:-1][owner] + k * stride, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, u: np.ndarray, c: np.ndarray, backward: bool, keep: bool):
    """Hidden states (time, window, hidden) of one direction, and what its gradient needs."""
    n, length = ids.shape
    h = u.shape[0]
    state = np.zeros((n, h), np.float32)
    states = np.empty((length, n, h), np.float32)
    saved = []
    for t in range(length - 1, -1, -1) if backward else range(length):
        x = gates[ids[:, t]]
        inner = state @ u + c
        zr = _sigmoid(x[:, : 2 * h] + inner[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        new = np.tanh(x[:, 2 * h :] + r * inner[:, 2 * h :])
        m = mask[:, t : t + 1]
        after = state + m * (1 - z) * (new - state)
        if keep:
            saved.append((t, state, z, r, new, inner[:, 2 * h :], m))
        states[t] = state = after
    return states, saved


def forward(w: dict[str, np.ndarray], gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logit of each window; ids: row of the gates for each place."""
    sides = []
    for side in ("f", "b"):
        sides.append(_read(gates[side], ids, mask, w[f"u{side}"], w[f"d{side}"], side == "b", keep))
    both = np.concatenate((sides[0][0], sides[1][0]), axis=2)
    hidden = np.tanh(both @ w["att"] + w["att_c"])
    energy = np.where(mask.T > 0, hidden @ w["att_v"], np.float32(-1e9))
    energy -= energy.max(axis=0)
    alpha = np.exp(energy)
    alpha /= alpha.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", alpha, both)
    logit = pooled @ w["out"] + w["out_c"][0]
    return logit, (sides, both, hidden, alpha, pooled) if keep else None


def row_sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that go to each of n places."""
    order = np.argsort(at, kind="stable")
    ranked = at[order]
    cuts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[ranked[cuts]] = np.add.reduceat(rows[order], cuts, axis=0)
    return out


def gradients(w: dict[str, np.ndarray], x: np.ndarray, ids: np.ndarray, mask: np.ndarray, saved, d_logit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the weights and of the input vectors x, from that of the logits."""
    sides, both, hidden, alpha, pooled = saved
    g = {"out": pooled.T @ d_logit, "out_c": np.array([d_logit.sum()], np.float32)}
    d_pooled = d_logit[:, None] * w["out"]
    d_both = alpha[:, :, None] * d_pooled
    d_alpha = np.einsum("tnh,nh->tn", both, d_pooled)
    d_energy = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
    g["att_v"] = np.einsum("tna,tn->a", hidden, d_energy)
    d_hidden = d_energy[:, :, None] * w["att_v"] * (1 - hidden**2)
    g["att"] = np.einsum("tnh,tna->ha", both, d_hidden)
    g["att_c"] = d_hidden.sum(axis=(0, 1))
    d_both = d_both + d_hidden @ w["att"].T
    d_x = np.zeros_like(x)
    h = w["uf"].shape[0]
    for k, side in enumerate(("f", "b")):
        u = w[f"u{side}"]
        d_u, d_d, d_state = np.zeros_like(u), np.zeros_like(w[f"d{side}"]), np.zeros((len(ids), h), np.float32)
        every = np.empty((ids.shape[1], len(ids), 3 * h), np.float32)
        for t, state, z, r, new, inner_n, m in reversed(sides[k][1]):
            d_after = d_state + d_both[t][:, k * h : (k + 1) * h]
            step = m * d_after
            d_new = step * (1 - z) * (1 - new**2)
            d_z = -step * (new - state) * z * (1 - z)
            d_r = d_new * inner_n * r * (1 - r)
            d_inner = np.concatenate((d_z, d_r, d_new * r), axis=1)
            every[t] = np.concatenate((d_z, d_r, d_new), axis=1)
            d_u += state.T @ d_inner
            d_d += d_inner.sum(axis=0)
            d_state = d_after - step * (1 - z) + d_inner @ u.T
        g[f"u{side}"], g[f"d{side}"] = d_u, d_d
        d_gates = row_sums(ids.T.ravel(), every.reshape(-1, 3 * h), len(x))
        g[f"x{side}"], g[f"c{side}"] = x.T @ d_gates, d_gates.sum(axis=0)
        d_x += d_gates @ w[f"x{side}"].T
    return g, d_x


def initial(net: NetworkParams, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d, h = net.word_dim + net.char_dim, net.hidden

    def normal(scale: float, *shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    w = {"words": normal(0.02, net.word_buckets, net.word_dim), "chars": normal(0.05, net.char_buckets, net.char_dim)}
    for side in ("f", "b"):
        w |= {f"x{side}": normal(d**-0.5, d, 3 * h), f"u{side}": normal(h**-0.5, h, 3 * h), f"c{side}": np.zeros(3 * h, np.float32), f"d{side}": np.zeros(3 * h, np.float32)}
    return w | {"att": normal((2 * h) ** -0.5, 2 * h, net.attention), "att_c": np.zeros(net.attention, np.float32), "att_v": normal(0.5, net.attention), "out": normal(0.3, 2 * h), "out_c": np.zeros(1, np.float32)}


def _grid_ids(starts: np.ndarray, owner: np.ndarray, last: np.ndarray, index: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    place = starts[:, None] + np.arange(length)
    mask = place < last[owner][:, None]
    return index[np.minimum(place, len(index) - 1)], mask.astype(np.float32)


def window_logits(w: dict[str, np.ndarray], net: NetworkParams, words: K.Words, stride: int, chunk: int = 1024, span: int = 16384) -> tuple[np.ndarray, np.ndarray]:
    """Logits of all windows of a block of texts, and the text of each; inputs are made for `span` windows at a time."""
    starts, owner = window_grid(words.counts(), words.first, net.window, stride)
    out = np.zeros(len(starts), np.float32)
    for s in range(0, len(starts), span):
        own = slice(s, min(s + span, len(starts)))
        lo, hi = int(starts[own][0]), min(int(starts[own][-1]) + net.window, len(words.hashes))
        near = K.Words(words.data, words.texts, words.starts[lo:hi], words.ends[lo:hi], words.first, words.hashes[lo:hi])
        inputs, index = word_inputs(near, net)
        gates = gates_of(vectors(inputs, w), w)
        for a in range(own.start, own.stop, chunk):
            part = slice(a, min(a + chunk, own.stop))
            ids, mask = _grid_ids(starts[part] - lo, owner[part], words.first[1:] - lo, index, net.window)
            out[part] = forward(w, gates, ids, mask)[0]
    return out, owner


def _highest(logits: np.ndarray, owner: np.ndarray, n: int, empty: float) -> np.ndarray:
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, logits)
    return np.where(np.isfinite(top), top, empty)


def best_cut(values: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the fewest errors (label 1 above it), amid the widest gap that has as few."""
    order = np.argsort(values, kind="stable")
    v, y = values[order], labels[order]
    errors = np.cumsum(y)[:-1] + (1 - y)[::-1].cumsum()[::-1][1:]
    gap = np.where(errors == errors.min(), np.diff(v), -1.0)
    at = int(np.argmax(gap))
    return float((v[at] + v[at + 1]) / 2)


def train(texts: list[str] | pa.Array, labels: np.ndarray, net: NetworkParams = NetworkParams(), how: TrainingParams = TrainingParams()) -> Model:
    """Fits the network to whole texts with labels 0 and 1."""
    model = Model(net, initial(net, how.seed))
    if not len(labels) or labels.min() == labels.max():
        model.scale, model.shift, model.prior = 0.0, -np.inf, -np.inf
        return model
    w, rng = model.weights, np.random.default_rng(how.seed)
    data, at = K.buffers(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    words = K.tokenise(data, at, lower=True)
    inputs, index = word_inputs(words, net)
    index = index.astype(np.int32)
    starts, owner = window_grid(words.counts(), words.first, net.window, net.stride)
    # a fifth of the texts of either class is kept from the network, for the last fit
    aside = np.zeros(len(labels), bool)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        aside[rng.permutation(own)[: len(own) // 5]] = True
    target = labels[owner].astype(np.float32)
    learn = ~aside[owner]
    toxic, clean = np.flatnonzero(learn & (target == 1)), np.flatnonzero(learn & (target == 0))
    mom = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step = 0

    def logits_of(chunk: int = 1024) -> np.ndarray:
        gates = gates_of(vectors(inputs, w), w)
        return np.concatenate([forward(w, gates, *_grid_ids(starts[a : a + chunk], owner[a : a + chunk], words.first[1:], index, net.window))[0] for a in range(0, len(starts), chunk)])

    turn = 0
    while turn < how.passes or step < how.steps:
        if turn == 0:
            use = np.concatenate((toxic, rng.permutation(clean)[: len(toxic)]))
        else:
            # toxic texts give the windows found toxic, and their highest in any case; the others their hardest and some more
            logits = logits_of()
            top = _highest(logits, owner, len(labels), 0.0)
            found = toxic[(logits[toxic] > 0) | (logits[toxic] >= top[owner[toxic]])]
            hard = clean[np.argsort(-logits[clean], kind="stable")[: len(found)]]
            use = np.unique(np.concatenate((found, hard, rng.permutation(clean)[: len(found) // 2])))
        size = min(how.batch, max(32, len(use) // 40))
        for batch in np.array_split(rng.permutation(use), max(1, len(use) // size)):
            ids, mask = _grid_ids(starts[batch], owner[batch], words.first[1:], index, net.window)
            near, local = np.unique(ids, return_inverse=True)
            some = Inputs(inputs.bucket[near], np.concatenate([inputs.grams[inputs.first[i] : inputs.first[i + 1]] for i in near]), np.concatenate(([0], np.cumsum(np.diff(inputs.first)[near]))))
            x = vectors(some, w)
            ids = local.reshape(ids.shape)
            logit, saved = forward(w, gates_of(x, w), ids, mask, keep=True)
            d = _sigmoid(logit) - target[batch]
            g, d_x = gradients(w, x, ids, mask, saved, (d / len(batch)).astype(np.float32))
            per_gram = (d_x[:, net.word_dim :] / np.maximum(np.diff(some.first), 1)[:, None])[np.repeat(np.arange(len(near)), np.diff(some.first))]
            touched = {}  # rows of the tables that this batch reads
            for k, at, rows in (("words", some.bucket, d_x[:, : net.word_dim]), ("chars", some.grams, per_gram)):
                touched[k], place = np.unique(at, return_inverse=True)
                g[k] = row_sums(place, rows, len(touched[k]))
            step += 1
            rate = how.rate * min(1.0, step / 10) * (0.5 if 2 * step > how.steps else 1.0)
            for k, v in w.items():
                rows = touched.get(k, slice(None))
                grad = np.clip(g[k], -1, 1)
                a, b = (m[rows] for m in mom[k])
                a, b = a + 0.1 * (grad - a), b + 0.01 * (grad**2 - b)
                mom[k][0][rows], mom[k][1][rows] = a, b
                v[rows] -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        turn += 1
    # one-dimensional fit of the texts' highest logits
    model.prior = float(np.log(labels.mean() / (1 - labels.mean())))
    top = _highest(logits_of(), owner, len(labels), min(0.0, model.prior) - 4)
    fold = aside if len(np.unique(labels[aside])) == 2 else np.ones(len(labels), bool)
    cut = best_cut(top[fold], labels[fold])
    a = 1.0
    for _ in range(500):
        e = _sigmoid(a * (top[fold] - cut)) - labels[fold]
        a -= 0.05 * float((e * (top[fold] - cut)).mean() + 0.01 * (a - 1))
    model.scale = max(a, 0.05)
    model.shift = -model.scale * cut
    return model


def training_sample(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", how: TrainingParams = TrainingParams()) -> DataFrame | None:
    """_text, _label, _order: at most rows[0] and rows[1] texts of the classes, those with the least hash of their id among the labelled rows."""
    spark = docs.sparkSession
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit(how.seed))
    marked = labelled.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"), order.alias("_order"))
    ids = [r for label in (0, 1) for r in marked.where(F.col("_label") == label).orderBy("_order", "_id").limit(how.rows[label]).collect()]
    if not ids:
        return None
    kind = docs.schema[id_col].dataType
    chosen = F.broadcast(spark.createDataFrame([tuple(r) for r in ids], f"_id {kind.simpleString()}, _label int, _order long").dropDuplicates(["_id"]))
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.length("_text").between(1, how.longest)).join(chosen, "_id").select("_text", "_label", "_order")


def score_texts(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of every row, and its score; a column of docs with that name gives way."""
    keep = [c for c in keep if c != "score"]
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for lo, words in K.words_of(K.text_column(batch, text_col), lower=True):
                logits, owner = window_logits(model.weights, model.net, words, model.net.stride)
                top = _highest(logits, owner, words.n_texts, -np.inf)
                with np.errstate(invalid="ignore"):
                    score = np.where(np.isfinite(top), _sigmoid(model.scale * np.where(np.isfinite(top), top, 0) + model.shift), _sigmoid(np.float64(model.prior)))
                cols = [batch.column(i).slice(lo, words.n_texts) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.clip(score, 0.0, 1.0))], names=[*keep, "score"])

    return docs.select(*keep, *([] if text_col in keep else [text_col])).mapInArrow(K.tidy(run), schema)


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", net: NetworkParams = NetworkParams(), how: TrainingParams = TrainingParams()) -> Model:
    """The network, trained in one task on the bounded sample; only its weights come to the driver."""
    ship(docs.sparkSession)
    sample = training_sample(docs, labelled, id_col, text_col, label_col, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels, size = [], [], 0
        for batch in batches:  # in the order of the hashes, up to the bound on characters
            upto = size + np.cumsum(pc.utf8_length(batch.column(0)).to_numpy(zero_copy_only=False))
            n = int(np.searchsorted(upto, how.chars, "right"))
            texts.append(pa.array(batch.column(0).slice(0, n).to_pylist(), pa.string()))
            labels += batch.column(1).slice(0, n).to_pylist()
            size = int(upto[-1]) if len(upto) else size
        whole = pa.concat_arrays(texts) if texts else pa.array([], pa.string())
        del texts
        model = train(whole, np.array(labels, float), net, how)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = [] if sample is None else sample.repartition(1).sortWithinPartitions("_order", "_text").select("_text", "_label").mapInArrow(K.tidy(run), "model binary").collect()
    return pickle.loads(made[0].model) if made else train([], np.zeros(0), net, how)
