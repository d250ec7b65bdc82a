"""SentencePiece encoding and decoding as shortest paths in a weighted finite-state transducer.

A model file is compiled to three machines. The normaliser rewrites characters (its compiled
map, if the model has one), adds the leading blank and squeezes blanks where the model says so.
The piece transducer is a trie over characters with an arc for each piece; a character no piece
covers gets an arc that emits its bytes. Weights are in the tropical semiring: for a unigram
model a piece costs minus its score; for a BPE model the machine remembers the last piece, and an
arc costs 0 if the two pieces may stand side by side in a merge-by-rank encoding, else infinity.
(A piece sequence is the BPE encoding if and only if each of its neighbouring pairs is: merges
never cross a place where no pair merges.) So one path is left, and it is the library's result.

Texts are composed with the machine segment by segment: where no piece contains a non-blank before
a blank, a path can be cut there. Equal segments of a batch are solved once, all of them in step,
by numpy: the n-th round relaxes the arcs that end at each segment's n-th character. A worker
keeps the results of at most CACHE segments between batches.

Defined cases: null and empty texts have no ids and decode to the empty text. Ids of control
pieces decode to nothing, the unknown piece to " ⁇ ". Texts of any length are solved whole. Repeated rows keep
one row each, an empty table gives none. Other columns are not read by encode.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_hashes, col, named, pieces, process_cache, row_and, text_buffer

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
CACHE = 1 << 20
WORK_BYTES = 1 << 18
FAR = np.iinfo(np.int64).max


# ------------------------------------------------------------------------ model file
def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol-buffer message: (number, int or bytes)."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            n = varint() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, raw[at:at + n]
            at += n


def charsmap(raw: bytes) -> dict[bytes, bytes]:
    """All replacements of a compiled character map (a double-array trie and its strings)."""
    if not raw:
        return {}
    size = struct.unpack_from("<I", raw)[0]
    units = np.frombuffer(raw, "<u4", size // 4, 4).tolist()
    strings = raw[4 + size:]
    step = lambda u: (u >> 10) << ((u & 0x200) >> 6)
    out, todo = {}, [(0, b"")]
    while todo:
        at, key = todo.pop()
        base = at ^ step(units[at])
        for c in range(1, 256):
            if (to := base ^ c) < len(units) and units[to] & 0x800000FF == c:
                if units[to] >> 8 & 1:
                    a = units[to ^ step(units[to])] & 0x7FFFFFFF
                    out[key + bytes([c])] = strings[a:strings.index(b"\0", a)]
                todo.append((to, key + bytes([c])))
    return out


class Model:
    """A compiled model: normaliser, piece trie, weights. Its size is that of the model file."""

    def __init__(self, raw: bytes):
        self.pieces, self.scores, self.types = [], [], []
        self.pairs: dict[str, np.ndarray] = {}
        trainer, normaliser = {}, {}
        for number, value in _fields(raw):
            if number == 1:
                p = dict(_fields(value))
                self.pieces.append(p[1].decode())
                self.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.types.append(p.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.bpe = trainer.get(3, 1) == 2
        if trainer.get(3, 1) not in (1, 2) or USER in self.types or trainer.get(24, 0):
            raise ValueError("only unigram and BPE models without user-defined or suffix pieces are compiled")
        self.map = charsmap(normaliser.get(2, b""))
        self.dummy, self.squeeze = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.unknown = self.types.index(UNKNOWN)
        self.fallback = bool(trainer.get(35, 0))
        self.byte_ids = np.full(256, self.unknown, np.int64)
        for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)):
            if t == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self._compile()

    # ---- machines
    def _compile(self) -> None:
        own = [i for i, t in enumerate(self.types) if t == NORMAL]
        if self.bpe:
            own = self._ranks(own)
        else:
            self.rank_id = np.array(own + [self.unknown], np.int64)
            low = min((self.scores[i] for i in own), default=0.0)
            self.weight = np.array([-self.scores[i] for i in own] + [10.0 - low])
        texts = [self.pieces[i] for i in own]
        self.length = np.array([len(t) for t in texts] + [1], np.int64)  # the last one: any unknown character
        self.alphabet = np.array(sorted({ord(c) for t in texts for c in t}), np.int64)
        code = {int(c): k + 1 for k, c in enumerate(self.alphabet)}
        width = len(self.alphabet) + 1
        edges, final, count = {}, {}, 1
        for k, t in enumerate(texts):
            node = 0
            for c in t:
                key = node * width + code[ord(c)]
                if key not in edges:
                    edges[key] = count
                    count += 1
                node = edges[key]
            final[node] = k
        self.width = width
        self.edge_keys = np.array(sorted(edges), np.int64)
        self.edge_to = np.array([edges[k] for k in self.edge_keys.tolist()], np.int64)
        self.final = np.full(count, -1, np.int64)
        self.final[list(final)] = list(final.values())
        # a path may be cut before a blank if no piece holds a non-blank before a blank
        self.cuttable = not any(a != BLANK and b == BLANK for t in texts for a, b in zip(t, t[1:], strict=False))
        out = [t.replace(BLANK, " ").encode() for t in self.pieces]
        for i, t in enumerate(self.types):
            out[i] = b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else \
                bytes([int(self.pieces[i][3:5], 16)]) if t == BYTE else out[i]
        self.out_at = np.append(0, np.cumsum([len(x) for x in out]))
        self.out = np.frombuffer(b"".join(out), np.uint8)

    def _ranks(self, own: list[int]) -> list[int]:
        """Pieces by merge rank, characters first, with the two halves of each one's last merge."""
        single = [i for i in own if len(self.pieces[i]) == 1]
        merged = sorted((i for i in own if len(self.pieces[i]) > 1), key=lambda i: -self.scores[i])
        order = {self.pieces[i]: k for k, i in enumerate(merged)}
        kept, halves = [], []
        for i in merged:
            parts, last = list(self.pieces[i]), None
            while len(parts) > 1:
                best = min(((order.get(a + b, FAR), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
                if best[0] == FAR:
                    break
                k = best[1]
                last = (parts[k], parts[k + 1])
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 1:  # else no text is ever encoded with this piece
                kept.append(i)
                halves.append(last)
        # characters that only occur inside pieces are states of the machine, too
        chars = sorted({c for i in kept for c in self.pieces[i]} - {self.pieces[i] for i in single})
        if chars:
            raise ValueError("a merged piece has a character that is no piece")
        own = single + kept
        rank = {self.pieces[i]: k for k, i in enumerate(own)}
        n = len(own) + 1  # the last: an unknown character
        self.left, self.right = np.arange(n), np.arange(n)
        keys = {}
        for k, (a, b) in enumerate(halves, len(single)):
            self.left[k], self.right[k] = rank[a], rank[b]
            keys[rank[a] * n + rank[b]] = k
        self.pair_keys = np.array(sorted(keys), np.int64)
        self.pair_rank = np.array([keys[k] for k in self.pair_keys.tolist()], np.int64)
        self.rank_id = np.array([*own, self.unknown], np.int64)
        return own

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a, b (as ranks) stay two pieces when their joined text is encoded."""
        ok = np.ones(len(a), bool)
        n = len(self.left)
        todo, limit = np.arange(len(a)), np.full(len(a), FAR)
        while len(todo):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[at] == key, self.pair_rank[at], FAR)
            bad = merged < limit
            ok[todo[bad]] = False
            # undo the later merge of the two; a character cannot be undone
            a_base, b_base = self.right[a] == a, self.left[b] == b
            undo_a = ~a_base & ((a > b) | b_base)
            undo_b = ~undo_a & ~b_base
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            on = ~bad & (undo_a | undo_b)
            todo, a, b, limit = todo[on], a[on], b[on], limit[on]
        return ok

    # ---- shortest paths
    def solve(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of already normalised segments."""
        size = np.array([len(s) for s in segments], np.int64)
        ends = np.cumsum(size)
        first = ends - size
        points = np.frombuffer("".join(segments).encode("utf-32-le"), "<u4").astype(np.int64)
        n = len(points)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(segments) + 1, np.int64)
        spot = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        letter = np.where(self.alphabet[spot] == points, spot + 1, 0)
        stop, begin = np.repeat(ends, size), np.repeat(first, size)
        # compose: all arcs (start, end, piece)
        at, node = np.arange(n), np.zeros(n, np.int64)
        pos = at
        arcs = []
        while len(pos):
            key = node * self.width + letter[pos]
            e = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            on = self.edge_keys[e] == key
            at, pos, node = at[on], pos[on] + 1, self.edge_to[e[on]]
            done = self.final[node] >= 0
            arcs.append((at[done], pos[done], self.final[node[done]]))
            more = pos < stop[at]
            at, pos, node = at[more], pos[more], node[more]
        start, end, piece = map(np.concatenate, zip(*arcs, strict=True))
        covered = np.zeros(n, bool)
        covered[start[end == start + 1]] = True
        bare = np.flatnonzero(~covered)
        start, end = np.append(start, bare), np.append(end, bare + 1)
        piece = np.append(piece, np.full(len(bare), len(self.length) - 1))
        # relax in step: the arcs by the distance of their end from the segment's first character
        step = end - begin[start]
        order = np.argsort(step, kind="stable")
        start, end, piece, step = start[order], end[order], piece[order], step[order]
        bounds = np.searchsorted(step, np.arange(1, int(size.max()) + 2))
        last = np.full(n + 1, -1)  # last piece of the best path to the place before a character
        cost = np.full(n + 1, np.inf)
        best = np.full(n, np.inf)
        opening = begin == np.arange(n)
        for k in range(len(bounds) - 1):
            s, e, p = (x[bounds[k]:bounds[k + 1]] for x in (start, end, piece))
            if not len(s):
                continue
            fresh = opening[s]
            if self.bpe:
                total = np.where(fresh | self._fits_cached(last[s - 1], p, fresh), 0.0, np.inf)
            else:
                total = np.where(fresh, 0.0, cost[s - 1]) + self.weight[p]
            # ``last`` and ``cost`` are kept at a path's last character, so places of two
            # segments never coincide
            np.minimum.at(best, e - 1, total)
            won = (total == best[e - 1]) & (total < np.inf)
            last[e[won][::-1] - 1], cost[e[won] - 1] = p[won][::-1], total[won]
            best[e - 1] = np.inf
        # read the paths back, all segments in step
        place, got = ends[size > 0] - 1, []
        floor = first[size > 0]
        while len(place):
            p = last[place]
            if (p < 0).any():
                raise ValueError("a segment has no path")
            a = place - self.length[p]
            got.append((a + 1, p))
            on = a >= floor
            place, floor = a[on], floor[on]
        where, p = map(np.concatenate, zip(*got, strict=True))
        order = np.argsort(where)
        where, p = where[order], p[order]
        ids = self.rank_id[p]
        counts = np.ones(len(ids), np.int64)
        lost = np.flatnonzero(p == len(self.length) - 1)
        if len(lost) and self.fallback:
            chars = [chr(int(points[w])).encode() for w in where[lost]]
            counts[lost] = [len(c) for c in chars]
            wide = np.repeat(ids, counts)
            spread = np.repeat(p == len(self.length) - 1, counts)
            wide[spread] = self.byte_ids[np.frombuffer(b"".join(chars), np.uint8)]
            ids = wide
        total = np.append(0, np.cumsum(counts))
        return ids, total[np.searchsorted(where, np.append(first, n))]

    def _fits_cached(self, a: np.ndarray, b: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """``fits`` through a direct-mapped table of pairs seen before; -1 (no path) fits nothing."""
        kept = self.pairs  # the model's own: other models in the process have other pairs
        if not kept:
            kept.update(keys=np.full(1 << 21, -1, np.int64), ok=np.zeros(1 << 21, bool))
        live = np.flatnonzero(~skip & (a >= 0))
        x, y = a[live], b[live]
        key = x * len(self.left) + y
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(43)).astype(np.int64)
        ok = kept["ok"][slot]
        miss = np.flatnonzero(kept["keys"][slot] != key)
        if len(miss):
            ok[miss] = self.fits(x[miss], y[miss])
            kept["keys"][slot[miss]], kept["ok"][slot[miss]] = key[miss], ok[miss]
        out = np.zeros(len(a), bool)
        out[live] = ok
        return out

    # ---- normaliser
    def normalise(self, text: str) -> str:
        """The text as the pieces see it (blanks as U+2581)."""
        if self.map:
            raw, out, at = text.encode(), [], 0
            longest = max(map(len, self.map))
            while at < len(raw):
                for n in range(min(longest, len(raw) - at), 0, -1):
                    if (to := self.map.get(raw[at:at + n])) is not None:
                        break
                else:
                    lead = raw[at]
                    n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                    to = raw[at:at + n]
                out.append(to)
                at += n
            text = b"".join(out).decode()
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if text and self.dummy:
            text = " " + text
        return text.replace(" ", BLANK)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """Texts of ragged ids."""
        n = self.out_at[ids + 1] - self.out_at[ids]
        end = np.append(0, np.cumsum(n))
        take = np.arange(end[-1]) + np.repeat(self.out_at[ids] - end[:-1], n)
        raw = self.out[take].tobytes()
        texts = [raw[a:b].decode(errors="replace") for a, b in zip(end[at[:-1]].tolist(), end[at[1:]].tolist(), strict=True)]
        return [t[1:] if self.dummy and t[:1] == " " else t for t in texts]


class Encoder:
    """Encodes batches of texts; equal segments are solved once."""

    def __init__(self, model: Model, cache: int = CACHE):
        self.model, self.cache = model, cache
        self._reset()

    def _reset(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.offs = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text)."""
        import pandas as pd

        m = self.model
        data, offs = text_buffer(pa.array([m.normalise(t).replace(BLANK, " ") for t in texts], pa.large_string()))
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        if m.cuttable:
            cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
        cut[offs] = True
        cut[len(data)] = False
        starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], len(data))
        code, keys = pd.factorize(byte_hashes(data, starts, stops))
        if len(self.keys) + len(keys) > self.cache:
            self._reset()
        new = np.flatnonzero(~np.isin(keys, self.keys, assume_unique=True))
        if len(new):
            first = np.empty(len(keys), np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            raw = data.tobytes()
            a, b = starts[first[new]].tolist(), stops[first[new]].tolist()
            ids, at = m.solve([raw[x:y].decode().replace(" ", BLANK) for x, y in zip(a, b, strict=True)])
            slots = np.arange(len(new)) + len(self.offs) - 1
            self.offs = np.concatenate([self.offs, self.offs[-1] + at[1:]])
            self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
            order = np.argsort(keys[new])
            where = np.searchsorted(self.keys, keys[new][order])
            self.keys = np.insert(self.keys, where, keys[new][order])
            self.slots = np.insert(self.slots, where, slots[order])
        slot = self.slots[np.searchsorted(self.keys, keys)][code]
        n = self.offs[slot + 1] - self.offs[slot]
        end = np.cumsum(n)
        take = np.arange(end[-1]) + np.repeat(self.offs[slot] - (end - n), n)
        return self.flat[take].astype(np.int64), np.append(0, end)[np.searchsorted(starts, offs)]


def encoder(raw: bytes) -> Encoder:
    """One compiled model per worker process."""
    kept = process_cache("piece-model")
    if raw not in kept:
        kept.clear()
        kept[raw] = Encoder(Model(raw))
    return kept[raw]


# -------------------------------------------------------------------------- Spark
def _shared(df: DataFrame, model_file: str):
    with open(model_file, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_file: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the columns ``keep``, n_pieces, ids, decoded_sha256 of the text the ids
    decode to, and lossless (whether that is the text, blanks for U+2581). No shuffle."""
    shared = _shared(docs, model_file)
    rows = docs.select(F.struct(*[named(c) for c in keep]).alias("_row"),
                       F.coalesce(docs[text_col], F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(shared.value)
        for b in pieces(batches, max_bytes=WORK_BYTES):
            texts = col(b, "_text").to_pylist()
            ids, at = e(texts)
            back = e.model.decode(ids, at)
            yield pa.RecordBatch.from_arrays([
                col(b, "_row"), pa.array(np.diff(at)),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                pa.array([t == s.replace(BLANK, " ") for t, s in zip(back, texts, strict=True)], pa.bool_()),
            ], names=["_row", "n_pieces", "ids", "decoded_sha256", "lossless"])

    return rows.mapInArrow(run, row_and(rows, "n_pieces long, ids array<int>, decoded_sha256 string, lossless boolean")).select("_row.*", "n_pieces", "ids", "decoded_sha256", "lossless")


def decode(rows: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with piece ids; null ids are none."""
    shared = _shared(rows, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = encoder(shared.value).model
        for b in batches:
            lists = [x or [] for x in col(b, "_ids").to_pylist()]
            at = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)
            ids = np.array([i for x in lists for i in x], np.int64)
            yield pa.RecordBatch.from_arrays([col(b, "_id"), pa.array(m.decode(ids, at))], names=["doc_id", "text"])

    return (rows.select(rows[id_col].cast("long").alias("_id"), rows[ids_col].alias("_ids"))
            .mapInArrow(run, "doc_id long, text string"))
