"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage is encoded from its characters and
words alone: shares of byte classes and of their successions, word lengths, repetition, and
hashed words. A passage's code is e = tanh(W x); gated attention weighs the passages of a
document by softmax(w . (tanh(V e) * sigmoid(U e))), and the document's score is
sigmoid(c . sum of weighted codes + b). All weights are learned from document labels together.

The model is fitted on the driver from a bounded sample: SAMPLE labelled documents, half of each
label, taken in the order of a hash of the id, with at most TRAIN_PASSAGES evenly spread passages
of each. The intercept is then moved to the labels' true shares. Scoring reads every passage.

Defined cases: null and empty texts are one empty passage. Documents with the same text have the
same score. Labels other than 0 and 1 and null ids are not learned from; a document labelled
both counts as 0; with fewer than two labels to learn from, all scores are the share of label 1
(0.5 without any). Repeated rows keep one row each, an empty table gives none. Texts of any length are scored by all
their passages. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, NOT_SPACE, col, id_text, mix64, pieces, row_and, row_and_text, row_of, text_buffer, with_text,
                     word_hashes, word_spans)

PASSAGE = 32
SAMPLE, TRAIN_PASSAGES = 4096, 64
WORD_DIMS, PAIR_DIMS, HIDDEN, GATE = 48, 64, 24, 12
WORK_BYTES = 1 << 18


def _classes() -> np.ndarray:
    c = np.zeros(256, np.int64)
    groups = [b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!", b"?", b";:", b"'\"", b"()[]{}<>", b"#$%&*@", b"|/\\_=+~^`-"]
    for k, g in enumerate(groups, 4):
        c[list(g)] = k
    c[0x61:0x7B], c[0x41:0x5B], c[0x30:0x3A], c[0x80:] = 1, 2, 3, 16
    return c  # 0: control characters


_CLASS, N_CLASS = _classes(), 17
N_SHAPE = 6
N_FEATURES = N_CLASS + PAIR_DIMS + N_SHAPE + WORD_DIMS


def passages(arr) -> tuple[np.ndarray, np.ndarray]:
    """(features, offsets): passage features of every text, at least one row per text."""
    data, offs = text_buffer(arr)
    starts, ends, at = word_spans(data, offs, NOT_SPACE)
    n = np.diff(at)
    many = np.maximum(-(-n // PASSAGE), 1)
    out_at = np.append(0, np.cumsum(many))
    total = int(out_at[-1])
    x = np.zeros((total, N_FEATURES), np.float32)
    if not len(data):
        return x, out_at
    word_row = row_of(at)
    word_of = out_at[word_row] + (np.arange(len(starts)) - at[word_row]) // PASSAGE
    # a passage reaches from its first word (a text's first byte) to the next passage
    begin = np.repeat(offs[:-1], many)
    later = np.arange(total) - np.repeat(out_at[:-1], many) > 0
    begin[later] = starts[(np.repeat(at[:-1], many) + PASSAGE * (np.arange(total) - np.repeat(out_at[:-1], many)))[later]]
    size = np.diff(np.append(begin, len(data)))
    byte_of = np.repeat(np.arange(total), size)
    cls = _CLASS[data]
    chars = np.maximum(size, 1)[:, None]
    x[:, :N_CLASS] = np.bincount(byte_of * N_CLASS + cls, minlength=total * N_CLASS).reshape(total, -1) / chars
    pair = (cls[:-1] * 31 + cls[1:] * 7 + (cls[:-1] == cls[1:])) % PAIR_DIMS
    inside = byte_of[1:] == byte_of[:-1]
    x[:, N_CLASS:N_CLASS + PAIR_DIMS] = np.bincount((byte_of[1:] * PAIR_DIMS + pair)[inside],
                                                    minlength=total * PAIR_DIMS).reshape(total, -1) / chars
    if len(starts):
        data = LOWER[data]
        h = word_hashes(data, starts, ends)
        held = np.bincount(word_of, minlength=total)
        words = np.maximum(held, 1)
        length = (ends - starts).astype(float)
        mean = np.bincount(word_of, length, total) / words
        spread = np.sqrt(np.maximum(np.bincount(word_of, length * length, total) / words - mean * mean, 0))
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (word_of[1:] == word_of[:-1])
        key = mix64(h + word_of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(key, kind="stable")
        fresh = np.ones(len(h), bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        distinct = np.bincount(word_of[order], fresh, total)
        shape = np.column_stack([np.log1p(held), mean / 10, spread / 10, distinct / words,
                                 np.bincount(word_of, again, total) / words,
                                 np.bincount(word_of, length > 20, total) / words])
        x[:, N_CLASS + PAIR_DIMS:N_CLASS + PAIR_DIMS + N_SHAPE] = shape
        slot = (h % np.uint64(WORD_DIMS)).astype(np.int64)
        x[:, -WORD_DIMS:] = np.bincount(word_of * WORD_DIMS + slot, minlength=total * WORD_DIMS).reshape(total, -1) \
            / words[:, None]
    return x, out_at


# ------------------------------------------------------------------------- model
def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Attention:
    """Gated-attention pooling over ragged bags, with its gradients."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, a ** -0.5, (a, b))
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.p = {"W": draw(d, HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE, 1)[:, 0],
                  "c": draw(HIDDEN, 1)[:, 0], "b": np.zeros(1)}

    def forward(self, x: np.ndarray, at: np.ndarray):
        p, row = self.p, row_of(at)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        e = np.tanh(x @ p["W"])
        t, g = np.tanh(e @ p["V"]), _sigmoid(e @ p["U"])
        s = (t * g) @ p["w"]
        a = np.exp(s - np.maximum.reduceat(s, at[:-1])[row])
        a /= np.add.reduceat(a, at[:-1])[row]
        z = np.add.reduceat(a[:, None] * e, at[:-1], axis=0)
        return _sigmoid(z @ p["c"] + p["b"]), (x, e, t, g, a, z, row)

    def gradients(self, x: np.ndarray, at: np.ndarray, y: np.ndarray) -> dict:
        p = self.p
        score, (x, e, t, g, a, z, row) = self.forward(x, at)
        d = (score - y) / len(y)
        dz = d[:, None] * p["c"]
        de = a[:, None] * dz[row]
        da = (e * dz[row]).sum(1)
        ds = a * (da - np.add.reduceat(a * da, at[:-1])[row])
        dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
        de = (de + dt @ p["V"].T + dg @ p["U"].T) * (1 - e * e)
        return {"W": x.T @ de, "V": e.T @ dt, "U": e.T @ dg, "w": (t * g).T @ ds, "c": z.T @ d, "b": d.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 3e-3,
            decay: float = 1e-4, seed: int = 11) -> None:
        """Adam over shuffled batches of bags."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(q) for k, q in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for k in range(0, len(order), batch):
                pick = order[k:k + batch]
                at = np.append(0, np.cumsum([len(bags[i]) for i in pick]))
                step += 1
                for name, grad in self.gradients(np.concatenate([bags[i] for i in pick]), at, y[pick]).items():
                    grad = grad + decay * self.p[name]
                    m[name] = 0.9 * m[name] + 0.1 * grad
                    v[name] = 0.999 * v[name] + 0.001 * grad * grad
                    self.p[name] -= rate * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)


# -------------------------------------------------------------------------- Spark
def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, max_bytes=WORK_BYTES):
        x, at = passages(col(b, "_text"))
        bags = []
        for i in range(b.num_rows):
            n = at[i + 1] - at[i]
            take = np.unique(np.linspace(0, n - 1, min(n, TRAIN_PASSAGES)).astype(np.int64)) + at[i]
            bags.append(x[take].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([col(b, "_id"), col(b, "_y"), pa.array(bags, pa.binary())], names=["_id", "_y", "_bag"])


def train(docs: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE):
    """The fitted model (or, with nothing to tell apart, the share of label 1). ``usable`` says of a
    row of ``labels`` whether it may be learned from."""
    known = (labels.filter(usable & labels[label_col].isin(0, 1) & labels[id_col].isNotNull())
             .groupBy(labels[id_col].cast("long").alias("_id")).agg(F.min(label_col).cast("int").alias("_y")))
    n, ones = known.agg(F.count("*"), F.sum("_y")).first()
    order = (F.xxhash64("_id"), F.col("_id"))
    pick = known.filter("_y = 1").orderBy(*order).limit(sample // 2).unionByName(
        known.filter("_y = 0").orderBy(*order).limit(sample // 2))
    rows = (id_text(docs, id_col, text_col).join(F.broadcast(pick), "_id")  # at most ``sample`` rows of labels
            .mapInArrow(_bags, "_id long, _y int, _bag binary").collect())
    rows.sort(key=lambda r: (r._id, bytes(r._bag)))
    y = np.array([r._y for r in rows], float)
    if len(rows) < 2 or y.min() == y.max():
        return (ones / n) if n else 0.5
    bags = [np.frombuffer(r._bag, "<f4").reshape(-1, N_FEATURES) for r in rows]
    del rows
    many = sum(map(len, bags))
    mean = sum(b.sum(0, dtype=float) for b in bags) / many
    spread = np.sqrt(sum(((b - mean) ** 2).sum(0) for b in bags) / many)
    model = Attention(mean, np.maximum(spread, 1e-3))
    model.fit(bags, y)
    share = min(max(ones / n, 1e-3), 1 - 1e-3)
    model.p["b"] = model.p["b"] + np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return model


def _score(shared, column: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in pieces(with_text(batches, text_col), max_bytes=WORK_BYTES):
            if isinstance(model, float):
                score = np.full(b.num_rows, model)
            else:
                score, _ = model.forward(*passages(col(b, "_text")))
            yield pa.RecordBatch.from_arrays([col(b, "_row"), pa.array(score)], names=["_row", column])

    return run


def score(docs: DataFrame, model, text_col: str = "text", column: str = "_score") -> DataFrame:
    """Every document as struct ``_row`` with its score, 0 to 1. No shuffle."""
    out = row_and_text(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return out.mapInArrow(_score(shared, column, text_col), row_and(out, f"{column} double"))


def keep_good(docs: DataFrame, model, text_col: str = "text", least: float = 0.7) -> DataFrame:
    """The documents whose score is at least ``least``, with their columns."""
    kept = score(docs, model, text_col).filter(F.col("_score") >= least)
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
