"""Brown class-based bigram language model: P(w | w') = P(class(w) | class(w')) P(w | class(w)).

Counts of all words of all training documents are a distributed table. One pass over the texts counts every
succession of two words: those among the KNOWN commonest words as packed rows by ranges of words, those of
all others as packed rows by ranges of their hashes. All that follows reads these tables, never the texts.

Exchange clustering starts on a bounded set of types: the FREQUENT commonest words by themselves, every other
word by its ending, hashed to ENDINGS types, and the end token. Types move, one at a time, to the class that
raises the likelihood of the class bigrams most, until a sweep moves none or SWEEPS are done. From these
classes every word of the vocabulary moves by its own successions: in a sweep the counts per neighbouring
class (the cells) of all words are formed in tasks, then all words choose at once, in tasks; a sweep that lowers the
likelihood is not taken and the next lets fewer words move. The class matrix is a sum of the cells. A
word beyond the known ones has its class in its block and hears of the classes of its like by messages to its block;
endings stand for unseen words only. The end token keeps a class of its own.

Transitions are smoothed towards the class shares, (n(c', c) + BETA p(c)) / (n(c') + BETA), and
emissions by (n(w) + 0.1) / (n(c) + 0.1 (words of c + 1)). A document starts after an end token.

Scoring looks up the commonest words in a broadcast table of at most KNOWN rows; the counts and classes
of all others are joined by word hash, so the vocabulary may grow without bound.

Defined cases: null and empty texts have the end token only. Repeated rows keep one row each. A
null id counts as the empty text in the choice of training rows. Without training rows, or without any row, every
count is 0. Texts of any length are read whole. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise
from .common import LOWER, NOT_SPACE, byte_hashes, col, mix64, pieces, row_of, text_buffer, word_spans

FREQUENT, ENDINGS, CLASSES, SWEEPS, BETA = 1024, 512, 48, 8, 5.0
KNOWN = 1 << 17
#: Sweeps over the whole vocabulary at most, and the rise of the log likelihood a token that ends them.
VOCABULARY_SWEEPS, LEAST_RISE = 4, 1e-3
_END = 0x0E4D  # the end token's key; word keys are 64-bit hashes


def _spans(arr):
    """(keys, word offsets, function of word numbers that gives their endings) of lower-cased words."""
    data, offs = text_buffer(arr)
    data = LOWER[data]
    starts, ends, at = word_spans(data, offs, NOT_SPACE)

    def endings(which: np.ndarray) -> np.ndarray:
        first, end = starts[which], ends[which]
        tail = np.zeros(len(which), np.uint64)
        for k in (1, 2, 3):
            have = end - k >= first
            tail[have] += data[end[have] - k].astype(np.uint64) << np.uint64(8 * (k - 1))
        return (mix64(tail + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int64)

    return byte_hashes(data, starts, ends), at, endings


def _words(arr):
    """(keys, endings, word offsets) of lower-cased words."""
    keys, at, endings = _spans(arr)
    return keys, endings(np.arange(len(keys))), at


# ------------------------------------------------------------------------- counting
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def counted():
        key, ending, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(key)
        key, ending, n = key[order], ending[order], n[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
        return key[first], ending[first], np.add.reduceat(n, first)

    def out():
        key, ending, n = counted()
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ending.astype(np.int32)), pa.array(n)], names=["_key", "_ending", "_n"])

    for b in pieces(batches, max_bytes=WORK_BYTES):
        keys, _, endings = _spans(col(b, "_text"))
        first, starts, _ = _grouped(keys)
        key, n = keys[first], np.diff(np.append(starts, len(keys)))
        held.append((np.append(key.view(np.int64), _END), np.append(endings(first), -1), np.append(n, b.num_rows)))
        size += len(key)
        if size > _HELD:
            held = [counted()]
            size = len(held[0][0])
            if size > _HELD // 2:
                yield out()
                held, size = [], 0
    if held:
        yield out()


N_TYPES = FREQUENT + ENDINGS + 1


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted cells, packed for the way to the driver."""
    for b in batches:
        cell, n = np.asarray(col(b, "_cell")), np.asarray(col(b, "_n"))
        order = np.argsort(cell)
        raw = np.diff(cell[order], prepend=0).astype("<i4").tobytes() + n[order].astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([len(cell)], pa.int32()), pa.array([zlib.compress(raw, 6)])],
                                         names=["size", "packed"])


# ------------------------------------------------------------------------- exchange
def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(n: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of types by exchange clustering of their succession counts; the last type (the end
    token) keeps class 0 to itself. Deterministic: types go by count, ties to the lower class."""
    types = len(n)
    weight = n.sum(0)
    order = [int(w) for w in np.argsort(-weight[:-1], kind="stable")]
    cls = np.zeros(types, np.int64)
    for i, w in enumerate(order):
        cls[w] = 1 + i % (classes - 1)
    one = np.zeros((types, classes))
    one[np.arange(types), cls] = 1
    right, left = n @ one, n.T @ one
    g = one.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            a, own = cls[w], n[w, w]
            r, q = right[w].copy(), left[w].copy()
            r[a] -= own
            q[a] -= own
            g[a] -= r
            g[:, a] -= q
            g[a, a] -= own
            rows, cols = g.sum(1), g.sum(0)
            base = _xlogx(g)
            across, down = _xlogx(g + r) - base, _xlogx(g + q[:, None]) - base
            diag = np.diagonal(g)
            gain = (across.sum(1) - np.diagonal(across) + down.sum(0) - np.diagonal(down)
                    + _xlogx(diag + r + q + own) - _xlogx(diag)
                    - _xlogx(rows + r.sum() + own) + _xlogx(rows) - _xlogx(cols + q.sum() + own) + _xlogx(cols))
            gain[0] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] <= gain[a] + 1e-9:
                k = a
            g[k] += r
            g[:, k] += q
            g[k, k] += own
            if k != a:
                cls[w] = k
                moved += 1
                right[:, a] -= n[:, w]
                right[:, k] += n[:, w]
                left[:, a] -= n[w]
                left[:, k] += n[w]
        if not moved:
            break
    return cls


class Model:
    """What scoring needs, of fixed size: the commonest words, classes and log probabilities."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, successions: np.ndarray, type_tokens: np.ndarray,
                 type_words: np.ndarray, tokens: int, words: int):
        self.known, self.counts = known, counts
        self.tokens, self.end = tokens, type_tokens[-1]
        self.cls = exchange(successions) if successions.any() else np.append(np.ones(N_TYPES - 1, np.int64), 0)
        one = np.zeros((N_TYPES, CLASSES))
        one[np.arange(N_TYPES), self.cls] = 1
        self.word_cls = np.zeros(len(known), np.int64)
        self.base = np.log10(tokens + 0.1 * (words + 1))
        self.learn(one.T @ successions @ one, one.T @ type_tokens, one.T @ type_words)

    def learn(self, g: np.ndarray, size: np.ndarray, many: np.ndarray) -> None:
        """Probabilities from the class successions and the tokens and words of the classes."""
        share = (g.sum(0) + 1 / CLASSES) / (g.sum() + 1)
        self.step = np.log10((g + BETA * share) / (g.sum(1, keepdims=True) + BETA))
        self.spread = np.log10(size + 0.1 * (many + 1))


# ----------------------------------------------------------- sweeps over the whole vocabulary
#: Classes are codes of a word's cells: what follows it (c), what stands before (CLASSES + c), itself.
_OWN, _STRIDE = 2 * CLASSES, 2 * CLASSES + 1
#: Known words of a packed row, words that choose at once, pairs a task counts before it hands them on.
_RANGE, _CHUNK, _HELD = 256, 512, 1 << 20
#: Other words of a packed row, bytes of text at once.
_BLOCK_WORDS, WORK_BYTES = 1024, 1 << 20
#: What a row of a batch counts beside its packed bytes, and the columns of packed rows.
_ROW_BYTES = 512
_RANGES, _TAILS = ("_range", "_side", "_size", "_packed"), ("_block", "_kind", "_packed")


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one place of each distinct key, by key; where its places begin in the order; the order of places by key)."""
    order = np.argsort(keys)
    by_key = keys[order]
    starts = np.flatnonzero(np.append(True, by_key[1:] != by_key[:-1])[:len(keys)])
    return order[starts], starts, order


def _index(known: np.ndarray) -> np.ndarray:
    """Where the keys of each prefix begin in the sorted array of hashes; there are up to four prefixes a key."""
    bits = min(max(len(known), 1).bit_length() + 1, 32)
    return np.searchsorted(known >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)


def _find(known: np.ndarray, index: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in the sorted array, -1 for those it does not hold."""
    prefix = keys >> np.uint64(65 - (len(index) - 1).bit_length())
    at, end = index[prefix], index[prefix + np.uint64(1)]
    out, live = np.full(len(keys), -1, np.int64), np.flatnonzero(at < end)
    at, end, left = at[live], end[live], keys[live]
    while len(live):  # the keys of a prefix, one a round
        hit = known[at] == left
        out[live[hit]] = at[hit]
        on = np.flatnonzero(~hit & (at + 1 < end))
        live, at, end, left = live[on], at[on] + 1, end[on], left[on]
    return out


def _batched(*names: str):
    """Of a generator of rows, whose ``_packed`` is bytes and all else an int or None, one of batches of about
    WORK_BYTES: on its way from Python a batch costs far more than a row."""
    kinds = [pa.binary() if x == "_packed" else pa.int32() for x in names]
    at = names.index("_packed")

    def of(rows):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def batch():
                return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*held, strict=True), kinds, strict=True)],
                                                  names=list(names))

            for r in rows(batches):
                held.append(r)
                size += len(r[at]) + _ROW_BYTES
                if size >= WORK_BYTES:
                    yield batch()
                    held, size = [], 0
            if held:
                yield batch()

        return run

    return of


class _Pairs:
    """Successions of known words (and the end) counted in a task: codes before * (known + 1) + after."""

    def __init__(self, words: int):
        self.words, self.parts, self.size = words, [], 0

    def add(self, before: np.ndarray, after: np.ndarray) -> None:
        code, n = np.unique(before * self.words + after, return_counts=True)
        self.parts.append((code, n))
        self.size += len(code)
        if self.size > _HELD and len(self.parts) > 1:
            self.parts = [_summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
            self.size = len(self.parts[0][0])

    def take(self) -> Iterator[tuple]:
        """Packed, a row for each range of words and side: with what follows the words (0), with what stands before (1)."""
        if not self.parts:
            return
        code, n = _summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
        self.parts, self.size = [], 0
        before = code // self.words
        turned = (code - before * self.words) * self.words + before
        for side, c, m in ((0, code, n), (1, *_sorted(turned, n))):
            yield from _packed(c, m, _RANGE * self.words, side)


def _sorted(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes, ascending, and their counts (neither below 0). Both in one number sort several times as fast as places do."""
    bits = int(n.max()).bit_length() if len(n) else 0
    if len(n) and int(code.max()).bit_length() + bits < 64:
        both = np.sort(code.astype(np.int64) << bits | n)
        return both >> bits, both & ((1 << bits) - 1)
    order = np.argsort(code)
    return code[order], n[order]


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code, n = _sorted(code, n)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _packed(code: np.ndarray, n: np.ndarray, wide: int, side: int) -> Iterator[tuple]:
    """Sorted counted codes as rows (_range, _side, _size, _packed); a range has ``wide`` codes."""
    if not len(code):
        return
    cuts = np.flatnonzero(np.append(True, code[1:] // wide != code[:-1] // wide)[:len(code)])
    for i, j in zip(cuts, np.append(cuts[1:], len(code)), strict=True):
        k = int(code[i] // wide)
        yield k, side, j - i, _packed_counts(code[i:j] - k * wide, n[i:j])


def _packed_counts(code: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted codes and their counts, these in as many bytes (1, 2, 4 or 8) as the largest needs."""
    most = int(n.max())
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return zstandard.compress(np.diff(code, prepend=0).astype("<i4").tobytes() + n.astype(f"<u{width}").tobytes(), 1)


def _unpacked(size: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(packed)
    n = np.frombuffer(raw, f"<u{len(raw) // size - 4}", size, 4 * size)
    return np.cumsum(np.frombuffer(raw, "<i4", size), dtype=np.int64), n.astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        columns = [col(b, x) for x in names]
        for i in range(b.num_rows):  # a packed value at a time
            yield tuple(c[i].as_py() for c in columns)


class _Sum:
    """Counts by code, compacted as they come."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, code: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((code, n))
        self.size += len(code)
        if self.size > _HELD:
            self.parts = [self.total()]
            self.size = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))


# ---- words beyond the known ones, many to a packed row (a block of the hash range)
#: heads: (place * 2 + side, count) of a word's successions with known words; others: (key, count * 1024 + ending * 2 +
#: side) of those with other such words; side 0: what follows the word, 1: what stands before; cells: (code, count)
_HEAD = np.dtype([("head", "<i4"), ("n", "<i4")])
_OTHER = np.dtype([("key", "<i8"), ("n", "<i8")])
_CELL = np.dtype([("code", "<i4"), ("n", "<i4")])
_MESSAGE = np.dtype([("key", "<i8"), ("m", "<i8")])


class _Block:
    """Words sorted by key, with their counts, classes and records; ``*_of`` is the word of each record, ascending."""

    def __init__(self, key, n, cls, heads_of, heads, others_of, others, cells_of=None, cells=None):
        self.key, self.n, self.cls = key, n, cls
        self.heads_of, self.heads, self.others_of, self.others = heads_of, heads, others_of, others
        self.cells_of = np.zeros(0, np.int64) if cells_of is None else cells_of
        self.cells = np.zeros(0, _CELL) if cells is None else cells

    def pack(self, i: int = 0, j: int | None = None) -> bytes:
        """Words i to j."""
        j = len(self.key) if j is None else j
        counts, records = [], []
        for of, rec in ((self.heads_of, self.heads), (self.others_of, self.others), (self.cells_of, self.cells)):
            a, z = np.searchsorted(of, (i, j))
            counts.append(np.bincount(of[a:z] - i, minlength=j - i).astype("<i4"))
            records.append(rec[a:z])
        return b"".join([np.array([j - i, *map(len, records)], "<i4").tobytes(), self.key[i:j].astype("<i8").tobytes(),
                         self.n[i:j].astype("<i8").tobytes(), self.cls[i:j].astype("<i4").tobytes(),
                         *(c.tobytes() for c in counts), *(r.tobytes() for r in records)])

    @staticmethod
    def unpack(raw: bytes) -> _Block:
        w, *sizes = np.frombuffer(raw, "<i4", 4).tolist()
        at = 16
        out = []
        for kind in ("<i8", "<i8", "<i4", "<i4", "<i4", "<i4"):
            out.append(np.frombuffer(raw, kind, w, at))
            at += w * np.dtype(kind).itemsize
        records = []
        for kind, size in zip((_HEAD, _OTHER, _CELL), sizes, strict=True):
            records.append(np.frombuffer(raw, kind, size, at))
            at += size * kind.itemsize
        of = [np.repeat(np.arange(w), c) for c in out[3:]]
        return _Block(out[0], out[1], out[2].astype(np.int64), of[0], records[0], of[1], records[1], of[2], records[2])


def _block_of(key: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a key: its place in the range of hashes."""
    return (((key.view(np.uint64) >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _block_order(key: np.ndarray, blocks: int) -> np.ndarray:
    """The order of keys by block, and by key in a block. Blocks ascend with the key's bits."""
    order = np.argsort(key.view(np.uint64))
    middle, high = np.uint64(1 << 63), key.view(np.uint64)[order]
    edge = _block_of(np.array([middle - np.uint64(1), middle]).view(np.int64), blocks)
    if edge[0] == edge[1]:  # one block has the greatest keys and then the least
        of = _block_of(high.view(np.int64), blocks)
        i, j = np.searchsorted(of, edge[0]), np.searchsorted(of, edge[0], "right")
        k = np.searchsorted(high, middle)
        order[i:j] = np.concatenate([order[k:j], order[i:k]])
    return order


def _by_block(key: np.ndarray, blocks: int) -> Iterator[tuple[int, int, int]]:
    """(block, first, end) of keys that stand block by block."""
    if not len(key):
        return
    of = _block_of(key, blocks)
    cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])[:len(of)])
    yield from zip(of[cuts].tolist(), cuts.tolist(), np.append(cuts[1:], len(of)).tolist(), strict=True)


def _combined(blocks: list[_Block], n_blocks: int) -> _Block:
    """Blocks of successions as one: words in order of block and key, equal records summed, counts of the words anew."""
    key = np.concatenate([b.key for b in blocks])
    shift = np.cumsum([0] + [len(b.key) for b in blocks])
    order = _block_order(key, n_blocks)
    new = np.append(True, key[order][1:] != key[order][:-1])[:len(key)]
    word = np.empty(len(key), np.int64)
    word[order] = np.cumsum(new) - 1
    first = order[new]
    n = np.zeros(len(first), np.int64)
    h = np.concatenate([b.heads for b in blocks])
    of, many = _summed(word[np.concatenate([b.heads_of + x for b, x in zip(blocks, shift, strict=False)])] * (1 << 32) + h["head"],
                       h["n"].astype(np.int64))
    heads = np.empty(len(of), _HEAD)
    heads["head"], heads["n"] = of & 0xFFFFFFFF, many
    after = (heads["head"] & 1) == 0
    np.add.at(n, (of >> 32)[after], many[after])  # each occurrence is followed by one token
    o = np.concatenate([b.others for b in blocks])
    w = word[np.concatenate([b.others_of + x for b, x in zip(blocks, shift, strict=False)])]
    # by word; equal records meet by a hash (they are summed again later, should two records share it)
    bits = np.uint64(len(first).bit_length())
    order = np.argsort((w.astype(np.uint64) << (np.uint64(64) - bits))
                       | mix64(o["key"].view(np.uint64) ^ mix64((o["n"] & 1023).astype(np.uint64))) >> bits)
    w, k, f, m = w[order], o["key"][order], (o["n"] & 1023)[order], (o["n"] >> 10)[order]
    new = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (k[1:] != k[:-1]) | (f[1:] != f[:-1]))[:len(w)])
    others = np.empty(len(new), _OTHER)
    if len(new):
        others["key"], others["n"] = k[new], np.add.reduceat(m, new) * 1024 + f[new]
        np.add.at(n, w[new][(f[new] & 1) == 0], (others["n"] >> 10)[(f[new] & 1) == 0])
    return _Block(key[first], n, np.concatenate([b.cls for b in blocks])[first], of >> 32, heads, w[new], others)


_FOUND = "_range int, _side int, _size int, _packed binary, _block int"


def _collect_pairs(shared, blocks: int):
    """The one pass over the texts: packed successions of known words by ranges, and of all others by blocks."""
    @_batched(*_RANGES, "_block")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known = shared.value
        index, end = _index(known), len(known)
        pairs, held, edges = _Pairs(end + 1), [], 0

        def tails():
            nonlocal held, edges
            if held:
                whole = _combined(held, blocks)
                for b, i, j in _by_block(whole.key, blocks):
                    yield None, None, None, whole.pack(i, j), b
            held, edges = [], 0

        def heads():
            for r in pairs.take():
                yield *r, None

        for b in pieces(batches, max_bytes=WORK_BYTES):
            keys, at, endings = _spans(col(b, "_text"))
            place, ending = _find(known, index, keys), np.zeros(len(keys), np.int64)
            rare = np.flatnonzero(place < 0)
            ending[rare] = endings(rare)
            place = np.insert(place, at[1:], end)
            key = np.insert(keys, at[1:], np.uint64(_END)).view(np.int64)
            ending = np.insert(ending, at[1:], 0)
            place0, key0, ending0 = np.append(end, place[:-1]), np.append(_END, key[:-1]), np.append(0, ending[:-1])
            both = (place >= 0) & (place0 >= 0)
            pairs.add(place0[both], place[both])
            # from the side of each word that is not known
            t, t0 = np.flatnonzero(place < 0), np.flatnonzero(place0 < 0)
            of = np.concatenate([key[t], key0[t0]])
            if len(of):
                first, starts, order = _grouped(of)
                row = np.repeat(np.arange(len(first)), np.diff(np.append(starts, len(of))))
                side = np.repeat([1, 0], [len(t), len(t0)])[order]
                head = np.concatenate([place0[t], place[t0]])[order]
                other, its = np.concatenate([key0[t], key[t0]])[order], np.concatenate([ending0[t], ending[t0]])[order]
                to = head >= 0
                h, o = np.empty(to.sum(), _HEAD), np.empty((~to).sum(), _OTHER)
                h["head"], h["n"] = head[to] * 2 + side[to], 1
                o["key"], o["n"] = other[~to], 1024 + its[~to] * 2 + side[~to]
                held.append(_Block(of[first], np.zeros(len(first), np.int64), np.concatenate([ending[t], ending0[t0]])[first], row[to], h, row[~to], o))
                edges += len(row)
            if edges > _HELD:
                yield from tails()
            if pairs.size > _HELD:
                yield from heads()
        yield from tails()
        yield from heads()

    return run


def _merge_blocks(blocks: int):
    """Blocks of successions sorted by _block -> one row a block; a word's class is its ending for now."""
    @_batched(*_TAILS)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, parts = None, []

        def merged():
            return at, 0, _combined(parts, blocks).pack()

        for b, raw in _rows(batches, "_block", "_packed"):
            if b != at:
                if parts:
                    yield merged()
                at, parts = b, []
            parts.append(_Block.unpack(raw))
        if parts:
            yield merged()

    return run


_TAIL = "_block int, _kind int, _packed binary"


@_batched(*_RANGES)
def _merge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Packed rows sorted by range and side -> one row for each."""
    at, parts = None, []

    def merged():
        code, n = _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return *at, len(code), _packed_counts(code, n)

    for k, side, size, packed in _rows(batches, "_range", "_side", "_size", "_packed"):
        if at != (k, side):
            if parts:
                yield merged()
            at, parts = (k, side), []
        parts.append(_unpacked(size, packed))
    if parts:
        yield merged()


def _cells_matrix(code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(code), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(code[k:k + 100_000].astype(np.int32)), pa.array(n[k:k + 100_000])], names=["_cell", "_n"])


def _type_pairs(shared):
    """Successions among known words -> counts of successions of types."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, total = shared.value, _Sum()
        for k, size, packed in _rows(batches, "_range", "_size", "_packed"):
            code, n = _unpacked(size, packed)
            w = code // len(types)
            total.add(types[k * _RANGE + w] * N_TYPES + types[code - w * len(types)], n)
        yield from _cells_matrix(*total.total())

    return run


def _type_tails(shared):
    """The same of the successions of other words; those of two such words are counted once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, total = shared.value, _Sum()
        for (raw,) in _rows(batches, "_packed"):
            b = _Block.unpack(raw)
            own, side, head = FREQUENT + b.cls, b.heads["head"] & 1, types[b.heads["head"] >> 1]
            x, y = np.where(side, head, own[b.heads_of]), np.where(side, own[b.heads_of], head)
            total.add(x * N_TYPES + y, b.heads["n"].astype(np.int64))
            after = (b.others["n"] & 1) == 0
            total.add(own[b.others_of][after] * N_TYPES + FREQUENT + (b.others["n"][after] >> 1 & 511), b.others["n"][after] >> 10)
        yield from _cells_matrix(*total.total())

    return run


def _send(blocks: int, first, choose):
    """Blocks of words -> the blocks with their classes, and messages to the blocks of the words they have successions
    with (count * 256 + code). ``first`` gives the classes to begin with; ``choose`` moves the words."""
    @_batched(*_TAILS)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, size = [], 0

        def messages():
            nonlocal held, size
            if held:
                key, code, n = (np.concatenate(x) for x in zip(*held, strict=True))
                # by block, and nearly by key and code: what is left apart is summed where it arrives
                order = np.argsort(key.view(np.uint64) & ~np.uint64(255) | code.astype(np.uint64))
                key, code, n = key[order], code[order], n[order]
                new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (code[1:] != code[:-1]))[:len(key)])
                out = np.empty(len(new), _MESSAGE)
                if len(new):
                    out["key"], out["m"] = key[new], np.add.reduceat(n, new) * 256 + code[new]
                for b, i, j in _by_block(out["key"].copy(), blocks):
                    yield b, 1, out[i:j].tobytes()
            held, size = [], 0

        for at, raw in _rows(batches, "_block", "_packed"):
            b = _Block.unpack(raw)
            cls = first.value[b.cls] if first is not None else choose(b)
            side, n = b.others["n"] & 1, b.others["n"] >> 10
            own = (b.others["key"] == b.key[b.others_of]) & (side == 0)
            held.append((np.append(b.others["key"], b.key[b.others_of][own]),
                         np.append((1 - side) * CLASSES + cls[b.others_of], np.full(own.sum(), _OWN)), np.append(n, n[own])))
            size += len(held[-1][0])
            yield at, 0, _Block(b.key, b.n, cls, b.heads_of, b.heads, b.others_of, b.others).pack()
            if size > _HELD // 2:
                yield from messages()
        yield from messages()

    return run


@_batched(*_TAILS)
def _receive(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks and messages sorted by (_block, _kind) -> the blocks with the cells the messages make."""
    at, block, got = None, None, []

    def done():
        m = np.concatenate(got) if got else np.zeros(0, _MESSAGE)
        code, n = _summed(np.searchsorted(block.key, m["key"]) * 256 + (m["m"] & 255), m["m"] >> 8)
        block.cells = np.empty(len(code), _CELL)
        block.cells["code"], block.cells["n"], block.cells_of = code & 255, n, code >> 8
        return at, 0, block.pack()

    for b, kind, raw in _rows(batches, "_block", "_kind", "_packed"):
        if kind == 0:
            if block is not None:
                yield done()
            at, block, got = b, _Block.unpack(raw), []
        else:
            got.append(np.frombuffer(raw, _MESSAGE))
    if block is not None:
        yield done()


def _exchanged(tails: DataFrame, send) -> DataFrame:
    """Blocks with classes and with the cells from one another, written. A block and its messages meet in one task."""
    n = int(tails.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(tails.mapInArrow(send, _TAIL).repartition(n, "_block").sortWithinPartitions("_block", "_kind")
                       .mapInArrow(_receive, _TAIL), "tails", tidy=True)


def _head_sums(shared):
    """Successions among known words -> their cells, and (range -1) the class matrix."""
    @_batched(*_RANGES)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cls, one = shared.value, np.eye(CLASSES)
        g = np.zeros(CLASSES * CLASSES)
        for k, side, size, packed in _rows(batches, "_range", "_side", "_size", "_packed"):
            code, n = _unpacked(size, packed)
            w = code // len(cls)
            v = code - w * len(cls)
            total = np.bincount(w * _STRIDE + side * CLASSES + cls[v], n, _RANGE * _STRIDE)
            if side == 0:
                own = cls[k * _RANGE:(k + 1) * _RANGE]
                g += (one[own].T @ total.reshape(_RANGE, _STRIDE)[:len(own), :CLASSES]).ravel()
                same = v == k * _RANGE + w
                total[w[same] * _STRIDE + _OWN] += n[same]
            at = np.flatnonzero(total)
            yield from _packed(at + k * _RANGE * _STRIDE, total[at].astype(np.int64), _RANGE * _STRIDE, 0)
        yield from _matrix_row(g)

    return run


def _tail_sums(shared):
    """Blocks of the other words with their cells -> what they add to the known words' cells and to the class matrix."""
    @_batched(*_RANGES)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cls, total = shared.value, _Sum()
        g = np.zeros(CLASSES * CLASSES)
        for (raw,) in _rows(batches, "_packed"):
            b = _Block.unpack(raw)
            own, n = b.cls[b.heads_of], b.heads["n"].astype(np.int64)
            side, head = (b.heads["head"] & 1).astype(np.int64), b.heads["head"] >> 1
            total.add(head * np.int64(_STRIDE) + (1 - side) * CLASSES + own, n)
            x, y = np.where(side, cls[head], own), np.where(side, own, cls[head])
            g += np.bincount(x * CLASSES + y, n, len(g))
            before = (b.cells["code"] >= CLASSES) & (b.cells["code"] < _OWN)
            g += np.bincount((b.cells["code"][before] - CLASSES) * CLASSES + b.cls[b.cells_of][before], b.cells["n"][before], len(g))
        yield from _packed(*total.total(), _RANGE * _STRIDE, 0)
        yield from _matrix_row(g)

    return run


def _matrix_row(g: np.ndarray) -> Iterator[tuple]:
    at = np.flatnonzero(g)
    for _, *r in _packed(at, g[at].astype(np.int64), len(g), 0):
        yield -1, *r


def _sums(pairs: DataFrame, tails: DataFrame, cls: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """(packed cells of the known words, class matrix) under the present classes."""
    shared = pairs.sparkSession.sparkContext.broadcast(cls)
    spec = "_range int, _side int, _size int, _packed binary"
    cells = materialise(pairs.mapInArrow(_head_sums(shared), spec).unionByName(tails.mapInArrow(_tail_sums(shared), spec)), "cells", tidy=True)
    g = np.zeros(CLASSES * CLASSES)
    for r in cells.filter("_range = -1").collect():  # a row a task, at most CLASSES ** 2 numbers each
        code, n = _unpacked(r["_size"], r["_packed"])
        g[code] += n
    return cells, g.reshape(CLASSES, CLASSES)


#: Counts up to this one have their logarithms in tables.
_SMALL = 16
_tables: dict = {}


def _tabled(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What x log x of g[i, j], and of the column sums, gains by n more, for small n; kept for the last two matrices."""
    kept = _tables.get(id(g))
    if kept is None or kept[0] is not g:
        if len(_tables) > 3:  # two matrices, one of them turned, and their tables
            _tables.clear()
        n = np.arange(_SMALL + 1)
        cell, total = _xlogx(g.T[None] + n[:, None, None]), _xlogx(g.sum(1)[None] + n[:, None])
        kept = _tables[id(g)] = (g, cell - cell[0], total - total[0])
    return kept[1:]


def _gains(g: np.ndarray, r: np.ndarray, q: np.ndarray, own: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Part of the gain of words with the row counts r for every class, diagonals left out. Only where a word's own
    counts are in a cell, or its counts are large, is a logarithm taken anew."""
    out = np.zeros(r.shape)
    w, j = np.divmod(np.flatnonzero(r != 0), CLASSES)
    if not len(w):
        return out
    n, own_class = r[w, j], a[w]
    logs, _ = _tabled(g)
    more = logs[np.minimum(n, _SMALL).astype(np.int64), j]
    anew = np.flatnonzero((n > _SMALL) | (j == own_class))
    if len(anew):
        m, base = n[anew, None], g.T[j[anew]].copy()  # column j of the matrix, less what the word itself has in it
        at = np.arange(len(anew))
        base[at, own_class[anew]] -= n[anew]
        same = np.flatnonzero(j[anew] == own_class[anew])
        base[same] -= q[w[anew[same]]]
        base[same, j[anew[same]]] -= own[w[anew[same]]]
        more[anew] = _xlogx(base + m) - _xlogx(base)
    rest = np.flatnonzero((n <= _SMALL) & (j != own_class))
    before = g[own_class[rest], j[rest]]  # with the word's own count in it
    more[rest, own_class[rest]] = _xlogx(before) - _xlogx(before - n[rest])
    more[np.arange(len(w)), j] = 0
    first = np.flatnonzero(np.diff(w, prepend=-1))
    out[w[first]] = np.add.reduceat(more, first)
    return out


def _turned(g: np.ndarray) -> np.ndarray:
    """The transposed matrix, one object for each matrix, so that its table is found again."""
    kept = _tables.get("turned")
    if kept is None or kept[0] is not g:
        _tables["turned"] = kept = (g, np.ascontiguousarray(g.T))
    return kept[1]


def best_classes(g: np.ndarray, a: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class of the most likelihood for each word of class ``a``, by its cells (word, code, n), all others
    staying where they are. ``g`` has the counts of class successions, these words in class ``a``. An
    empty class is no choice: it fits each single word best, and as words choose at once all would go there."""
    rows = len(a)
    cells = np.bincount(word * _STRIDE + code, n, rows * _STRIDE).reshape(rows, _STRIDE)
    r, q, own, at = cells[:, :CLASSES], cells[:, CLASSES:_OWN], cells[:, _OWN], np.arange(rows)
    r[at, a] -= own
    q[at, a] -= own
    turned = _turned(g)
    gain = _gains(g, r, q, own, a) + _gains(turned, q, r, own, a)
    both, diag = r + q + own[:, None], np.diagonal(g)
    touched = both != 0
    touched[at, a] = True
    word_, class_ = np.divmod(np.flatnonzero(touched), CLASSES)  # elsewhere nothing is added
    base = diag[class_] - np.where(class_ == a[word_], both[word_, class_], 0)
    gain[word_, class_] += _xlogx(base + both[word_, class_]) - _xlogx(base)
    for x, matrix, total in ((r, g, g.sum(1)), (q, turned, g.sum(0))):  # other words' share of the sums of rows and columns
        many = x.sum(1) + own
        _, logs = _tabled(matrix)
        change = logs[np.minimum(many, _SMALL).astype(np.int64)]
        large = np.flatnonzero(many > _SMALL)
        change[large] = _xlogx(total + many[large, None]) - _xlogx(total)
        change[at, a] = _xlogx(total[a]) - _xlogx(total[a] - many)
        gain -= change
    gain[:, 0] = -np.inf
    gain[(g.sum(0) + g.sum(1) == 0) & (np.arange(CLASSES) != a[:, None])] = -np.inf
    k = gain.argmax(1)
    return np.where(gain[at, k] > gain[at, a] + 1e-9, k, a)


def _likelihood(g: np.ndarray) -> float:
    return float(_xlogx(g).sum() - _xlogx(g.sum(0)).sum() - _xlogx(g.sum(1)).sum())


def _may_move(keys: np.ndarray, sweep: int, share: int) -> np.ndarray:
    return mix64(keys + np.uint64(sweep + 1)) % np.uint64(share) == 0


def _choose_heads(shared, sweep: int, share: int):
    """Packed cells sorted by range -> (_place, _cls) of known words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cls, g, _ = shared.value

        def chosen(k, total):
            total = total.reshape(_RANGE, _STRIDE)
            places = np.arange(k * _RANGE, min((k + 1) * _RANGE, len(known)))
            places = places[_may_move(known[places], sweep, share)]
            cells = total[places - k * _RANGE]
            word, code = np.nonzero(cells)
            best = best_classes(g, cls[places], word, code, cells[word, code])
            return pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(best.astype(np.int32))], names=["_place", "_cls"])

        at, total = None, None
        for k, size, packed in _rows(batches, "_range", "_size", "_packed"):
            if k != at:
                if at is not None:
                    yield chosen(at, total)
                at, total = k, np.zeros(_RANGE * _STRIDE, np.int64)
            code, n = _unpacked(size, packed)
            total[code] += n
        if at is not None:
            yield chosen(at, total)

    return run


def single_classes(g: np.ndarray) -> np.ndarray:
    """The classes that words with one occurrence move to, by their class and the classes of what follows and of what stands
    before: a table of CLASSES ** 3, as many words have no more."""
    out = np.zeros((CLASSES,) * 3, np.uint8)
    after, before = (x.ravel() for x in np.indices((CLASSES, CLASSES)))
    word = np.repeat(np.arange(len(after)), 2)
    code = np.column_stack([after, CLASSES + before]).ravel()
    for a in range(1, CLASSES):
        out[a] = best_classes(g, np.full(len(after), a), word, code, np.ones(len(code))).reshape(CLASSES, CLASSES)
    _tables.clear()  # made on the driver, they would travel with every task
    return out


def _choose_tails(shared, sweep: int, share: int):
    """The classes that the words of a block move to."""
    def choose(b: _Block) -> np.ndarray:
        _, heads, g, singles = shared.value
        out, moving = b.cls.copy(), _may_move(b.key.view(np.uint64), sweep, share)
        word = np.append(b.heads_of, b.cells_of)
        code = np.append((b.heads["head"] & 1) * CLASSES + heads[b.heads["head"] >> 1], b.cells["code"])
        n = np.append(b.heads["n"], b.cells["n"])
        single = b.n == 1
        one = single[word]
        beside = np.zeros((2, len(out)), np.int64)
        beside[code[one] // CLASSES, word[one]] = code[one] % CLASSES
        out[single] = singles[b.cls, beside[0], beside[1]][single]
        rest = np.flatnonzero(moving & ~single)
        number = np.full(len(out), -1)
        number[rest] = np.arange(len(rest))
        word = number[word]
        order = np.argsort(word)
        order = order[np.searchsorted(word[order], 0):]
        word, code, n = word[order], code[order], n[order].astype(np.int64)
        for i in range(0, len(rest), _CHUNK):
            a, z = np.searchsorted(word, (i, i + _CHUNK))
            out[rest[i:i + _CHUNK]] = best_classes(g, b.cls[rest[i:i + _CHUNK]], word[a:z] - i, code[a:z], n[a:z])
        return np.where(moving, out, b.cls)

    return choose


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> (_key, _n, _cls) of their words."""
    for (raw,) in _rows(batches, "_packed"):
        b = _Block.unpack(raw)
        yield pa.RecordBatch.from_arrays([pa.array(b.key), pa.array(b.n), pa.array(b.cls.astype(np.int32))], names=["_key", "_n", "_cls"])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> tokens and words of each class, of a task."""
    n, w = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for (raw,) in _rows(batches, "_packed"):
        b = _Block.unpack(raw)
        np.add.at(n, b.cls, b.n)
        w += np.bincount(b.cls, minlength=CLASSES)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(n), pa.array(w)], names=["_cls", "n", "w"])


def settle(model: Model, pairs: DataFrame, tails: DataFrame, cls: np.ndarray, blocks: int) -> DataFrame:
    """Sweeps over all training words from the classes ``cls`` of the known words and the end, and those of the others'
    endings. The model gets the classes of the known words and the probabilities, the result those of all
    others (_key, _n, _cls). A sweep reads only the tables of successions, counted once."""
    sc, known = pairs.sparkSession.sparkContext, model.known
    begin = sc.broadcast(model.cls[FREQUENT:FREQUENT + ENDINGS])
    tails = _exchanged(tails, _send(blocks, begin, None))
    cells, g = _sums(pairs, tails, cls)
    share = 1
    for sweep in range(VOCABULARY_SWEEPS):
        state = sc.broadcast((known, cls, g, single_classes(g)))
        moved = (cells.filter("_range >= 0").repartition("_range").sortWithinPartitions("_range")
                 .mapInArrow(_choose_heads(state, sweep, share), "_place int, _cls int").toPandas())  # at most KNOWN rows
        heads = cls.copy()
        heads[moved["_place"].to_numpy()] = moved["_cls"].to_numpy()
        others = _exchanged(tails, _send(blocks, None, _choose_tails(state, sweep, share)))
        more, then = _sums(pairs, others, heads)
        rise = _likelihood(then) - _likelihood(g)
        if rise <= 0:  # too many moved at once
            share *= 4
            discard(more, others)
            continue
        discard(cells, tails)
        cls, tails, cells, g = heads, others, more, then
        if share == 1 and rise < LEAST_RISE * g.sum():
            break
    size = np.bincount(cls[:-1], model.counts, CLASSES)
    many = np.bincount(cls[:-1], minlength=CLASSES).astype(float)
    for r in tails.mapInArrow(_sizes, "_cls int, n long, w long").groupBy("_cls").agg(F.sum("n").alias("n"), F.sum("w").alias("w")).collect():
        size[r[0]] += r.n  # CLASSES rows
        many[r[0]] += r.w
    size[0], many[0] = model.end, 1 if model.end else 0
    model.word_cls = cls[:-1]
    model.learn(g, size, many)
    return tails.mapInArrow(_listed, "_key long, _n long, _cls int")


def commonest(table: DataFrame, most: int) -> DataFrame:
    """The ``most`` commonest words, or a few less: all above a least (count, key), found by histograms of counts and
    then of key prefixes, which alone reach the driver. Of equal counts smaller keys come first."""
    taken, open_, left = F.lit(False), F.col("_key") != _END, most
    prefix = lambda bits: -F.shiftright("_key", 64 - bits)
    for level in (F.floor(32 * F.log2("_n")).cast("long"), F.col("_n"), prefix(16), prefix(32)):
        sizes = table.filter(open_).groupBy(level.alias("g")).agg(F.count("*").alias("c")).collect()  # 65536 rows at most
        cut = None
        for r in sorted(sizes, reverse=True):
            if r.c > left:
                cut = r.g
                break
            left -= r.c
        if cut is None:
            return table.filter(taken | open_)
        taken, open_ = taken | (open_ & (level > cut)), open_ & (level == cut)
    return table.filter(taken)


def successions(docs: DataFrame, known: np.ndarray, blocks: int) -> tuple[DataFrame, DataFrame]:
    """All successions of the texts, counted in one pass and written: those among known words packed by ranges of
    words, those of all others packed by blocks (a word's class is its ending for now)."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    found = materialise(docs.mapInArrow(_collect_pairs(shared, blocks), _FOUND), "found", tidy=True)
    spec = "_range int, _side int, _size int, _packed binary"
    pairs = materialise(found.filter("_range is not null").select("_range", "_side", "_size", "_packed").repartition("_range", "_side")
                        .sortWithinPartitions("_range", "_side").mapInArrow(_merge_pairs, spec), "pairs", tidy=True)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tails = materialise(found.filter("_block is not null").select("_block", "_packed").repartition(n, "_block").sortWithinPartitions("_block")
                        .mapInArrow(_merge_blocks(blocks), _TAIL), "tails", tidy=True)
    discard(found)
    return pairs, tails


def fit(docs: DataFrame, spark) -> tuple[Model, DataFrame]:
    """Training documents (_text) -> model and the table of the other words (_key, _n, _cls)."""
    counted = docs.mapInArrow(_count, "_key long, _ending int, _n long")
    table = materialise(counted.groupBy("_key").agg(F.max("_ending").alias("_ending"), F.sum("_n").alias("_n")), "words", tidy=True)
    table = table.filter("_n > 0")
    tokens, words = table.agg(F.sum("_n"), F.count("*")).first()
    best = commonest(table, KNOWN).toPandas().sort_values(["_n", "_key"], ascending=[False, True], ignore_index=True)
    end = table.filter(F.col("_key") == _END).agg(F.sum("_n")).first()[0] or 0
    key = best["_key"].to_numpy(np.int64).view(np.uint64)
    count, ending = best["_n"].to_numpy(np.int64), best["_ending"].to_numpy(np.int64)
    order = np.argsort(key)
    top = min(FREQUENT, len(key))
    # words and tokens of each ending, less the frequent words, which are types themselves
    tail = table.groupBy("_ending").agg(F.sum("_n").alias("n"), F.count("*").alias("w")).toPandas()  # ENDINGS rows
    per = np.zeros((2, N_TYPES))
    for e, m, w in tail.itertuples(index=False):
        if e >= 0:
            per[:, FREQUENT + e] = m, w
    np.add.at(per[0], FREQUENT + ending[:top], -count[:top])
    np.add.at(per[1], FREQUENT + ending[:top], -1)
    per[0, :top], per[1, :top] = count[:top], 1
    per[:, -1] = end, 1 if end else 0
    n = np.zeros(N_TYPES * N_TYPES)
    if words:
        blocks = max(1, -(-(int(words) - len(key)) // _BLOCK_WORDS))
        pairs, tails = successions(docs, key[order], blocks)
        types = np.append(np.where(order < top, order, FREQUENT + ending[order]), N_TYPES - 1)
        shared, spec = spark.sparkContext.broadcast(types), "_cell int, _n long"
        cells = (pairs.filter("_side = 0").mapInArrow(_type_pairs(shared), spec)
                 .unionByName(tails.mapInArrow(_type_tails(shared), spec)).groupBy("_cell").agg(F.sum("_n").alias("_n")))
        for r in cells.mapInArrow(_squeeze, "size int, packed binary").collect():  # at most N_TYPES ** 2 cells in all
            raw = zlib.decompress(r.packed)
            n[np.cumsum(np.frombuffer(raw, "<i4", r.size))] = np.frombuffer(raw, "<i8", r.size, 4 * r.size)
    model = Model(key[order], count[order], n.reshape(N_TYPES, N_TYPES), per[0], per[1], int(tokens or 0), int(words))
    if not words:
        return model, table.select("_key", "_n", F.lit(0).alias("_cls"))
    return model, settle(model, pairs, tails, model.cls[types], blocks)


def _score(shared):
    """Per text: counts and logs of its known words, the class of every token (a byte each; that of the ending
    for words not known), and the distinct words not known with how often and where they stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        index = _index(m.known)
        for b in pieces(batches, max_bytes=WORK_BYTES):
            keys, at, endings = _spans(col(b, "_text"))
            spot = _find(m.known, index, keys)
            hit = spot >= 0
            word_row = row_of(at)
            cls = np.empty(len(keys), np.int64)
            cls[hit], cls[~hit] = m.word_cls[spot[hit]], m.cls[FREQUENT + endings(np.flatnonzero(~hit))]
            path = np.insert(cls, at[1:], 0).astype(np.uint8).tobytes()
            ends = at + np.arange(len(at))
            end_logs = np.full(b.num_rows, np.log10(m.end + 0.1))
            logs = np.bincount(word_row[hit], np.log10(m.counts[spot[hit]] + 0.1), b.num_rows) + end_logs
            n_known = np.bincount(word_row[hit], minlength=b.num_rows) + (1 if m.end else 0)
            rest = np.flatnonzero(~hit)
            # by row, and in it by key but for its last bits; a word met twice for those counts as two
            bits = np.uint64(b.num_rows.bit_length())
            rest = rest[np.argsort(word_row[rest].astype(np.uint64) << (np.uint64(64) - bits) | keys[rest] >> bits)]
            key, row = keys[rest].view(np.int64), word_row[rest]
            fresh = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))[:len(key)])
            times = np.diff(np.append(fresh, len(key)))
            place = (rest - at[row]).astype("<i4").tobytes()
            per_row = np.append(0, np.cumsum(np.bincount(row, minlength=b.num_rows)))
            cut = pa.array(np.append(0, np.cumsum(np.bincount(row[fresh], minlength=b.num_rows))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [col(b, "_row"), pa.array(np.diff(at) + 1), pa.array(n_known.astype(np.int64)), pa.array(logs),
                 pa.array([path[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                 pa.ListArray.from_arrays(cut, pa.array(key[fresh])), pa.ListArray.from_arrays(cut, pa.array(times)),
                 pa.array([place[4 * x:4 * y] for x, y in zip(per_row[:-1], per_row[1:], strict=True)], pa.binary()),
                 pa.array(np.diff(per_row))],
                names=["_row", "_tokens", "_known", "_logs", "_path", "_rest", "_times", "_places", "_others"])

    return run


def _class_logs(shared):
    """Texts with their words found by the join (number in _rest x 64 + class) -> log probability of the classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for b in batches:
            logs = []
            for path, found, times, places in zip(*(col(b, x) for x in ("_path", "_found_at", "_times", "_places")), strict=True):
                cls = np.frombuffer(path.as_py(), np.uint8).astype(np.int64)
                if found.is_valid:
                    at, many = np.asarray(found.values), np.asarray(times.values)
                    new = np.full(len(many), -1)
                    new[at >> 6] = at & 63
                    new = np.repeat(new, many)
                    cls[np.frombuffer(places.as_py(), "<i4")[new >= 0]] = new[new >= 0]
                logs.append((m.step[np.append(0, cls[:-1]), cls] - m.spread[cls]).sum())
            yield pa.RecordBatch.from_arrays([*(col(b, x) for x in _PASSED), pa.array(logs, pa.float64())],
                                             names=[*_PASSED, "_classes"])

    return run


_PASSED = ["_id", "_train", "_tokens", "_known", "_logs", "_others", "_found", "_more"]


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, training, n_tokens, n_known, train_tokens, base_score (smoothed
    unigrams) and score (the class model), log10 probabilities of the whole text."""
    spark = docs.sparkSession
    d = docs.select(docs[id_col].alias("_id"), F.coalesce(training, F.lit(False)).alias("_train"),
                    F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    model, counts = fit(d.filter("_train").select("_text"), spark)
    shared = spark.sparkContext.broadcast(model)
    kinds = ("_tokens long, _known long, _logs double, _path binary, _rest array<long>, _times array<long>, "
             "_places binary, _others long")
    rows = d.select(F.struct("_id", "_train", F.monotonically_increasing_id().alias("_key")).alias("_row"), "_text")
    part = materialise(rows.mapInArrow(_score(shared), f"_row {rows.schema['_row'].dataType.simpleString()}, {kinds}")
                       .select("_row.*", "_tokens", "_known", "_logs", "_path", "_rest", "_times", "_places", "_others"), "scores")
    # the words that are not among the commonest: counts and classes by a join, unseen ones count 0
    rare = (part.select(F.col("_key").alias("_doc"), "_times", F.posexplode("_rest").alias("_at", "_key"))
            .select("_doc", "_at", "_key", F.col("_times")[F.col("_at")].alias("_many")))
    found = (rare.join(counts, "_key").groupBy("_doc")
             .agg(F.sum("_many").alias("_found"), F.sum(F.col("_many") * F.log10(F.col("_n") + 0.1)).alias("_more"),
                  F.collect_list(F.col("_at").cast("long") * 64 + F.col("_cls")).alias("_found_at")))
    out = part.join(found, F.col("_key") == F.col("_doc"), "left")
    out = out.select(*_PASSED, "_path", "_times", "_places", "_found_at")
    types = {f.name: f.dataType.simpleString() for f in out.schema}
    out = out.mapInArrow(_class_logs(shared), ", ".join(f"{c} {types[c]}" for c in _PASSED) + ", _classes double")
    seen = F.coalesce("_found", F.lit(0))
    logs = F.col("_logs") + F.coalesce("_more", F.lit(0.0)) - (F.col("_others") - seen)  # log10(0.1) each
    return out.select(F.col("_id").alias(id_col), F.col("_train").alias("training"), F.col("_tokens").alias("n_tokens"),
                      (F.col("_known") + seen).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
                      (logs - F.col("_tokens") * F.lit(float(model.base))).alias("base_score"),
                      (logs + F.col("_classes")).alias("score"))
