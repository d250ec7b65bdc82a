"""Token-ID files coded with a range asymmetric numeral system (rANS).

A segment of about SEGMENT ids is one static frequency table (scaled to 2**SCALE) shared by
independent blocks of whole documents, so nothing global has to be known before coding, and a
task's memory is one segment. In a block, LANES interleaved states code every LANES-th id;
their words go to one stream in the order in which the decoder needs them.

Segment, little-endian: magic ``SKRN``, version, scale, table entries, blocks, bytes of the
packed table, then the table (zlib: symbol gaps u32, frequencies u32), one end offset (u64) per
block, a crc32 of all that, and the blocks. Block: documents, ids, lanes, words (u32 each), the
documents' ends (u32), the checkpoint (one 64-bit state per lane), the 32-bit words, a crc32.
With the table at hand a block decodes on its own from its checkpoint; damage is detected.

Segments are rows of a Parquet table (range, segment, first id, doc_ids, payload), which any store
Spark writes to can hold; its commit protocol makes a lost executor's tasks repeat cleanly.

Ids come from the tokenizers library. Texts are cut where the tokenizer's own splitting always
cuts (before a single blank that a non-blank follows), equal pieces of a batch are encoded once,
and a worker keeps the ids of at most CACHE pieces between batches.

Defined cases: null text is empty: only the end id. Documents with one doc_id follow each other
in a fixed order of their ids; a null doc_id comes first. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import PIECE_BYTES, byte_hashes, col, id_text, in_id_order, process_cache, text_buffer

SCALE = 17
LANES = 2048
LOW = np.uint64(1 << 31)
BLOCK, SEGMENT = 1 << 19, 1 << 21
CACHE = 1 << 21
MAGIC = b"SKRN"


# ------------------------------------------------------------------------- rANS
def scale_of(symbols: int) -> int:
    """Bits of a frequency table: SCALE, more where the symbols would not leave room to share."""
    return max(SCALE, int(symbols).bit_length() + 1)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Positive counts -> positive frequencies that sum to 2**scale_of(their number) (none: none)."""
    total = 1 << scale_of(len(counts))
    if not len(counts):
        return np.zeros(0, np.int64)
    f = np.maximum(counts.astype(np.int64) * total // int(counts.sum()), 1)
    extra = int(f.sum()) - total
    if extra < 0:
        f[np.argmax(f)] -= extra
    while extra > 0:  # take from the largest, never below 1
        order = np.argsort(-f, kind="stable")
        room = np.maximum(f[order] - 1, 0)
        cut = np.minimum(room, -(-room * extra // max(int(room.sum()), 1)))
        over = np.minimum(np.cumsum(cut), extra)
        f[order] -= np.diff(over, prepend=0)
        extra = int(f.sum()) - total
    return f


def encode(slot: np.ndarray, freq: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """(states, words) of one block, given as the table entries of its ids."""
    f = freq.astype(np.uint64)
    start = (np.cumsum(f) - f).astype(np.uint64)
    lanes = max(1, min(lanes, len(slot)))
    state = np.full(lanes, LOW, np.uint64)
    steps = -(-len(slot) // lanes)
    words = []
    scale = scale_of(len(freq))
    shift, bits = np.uint64(32), np.uint64(scale)
    for k in range(steps - 1, -1, -1):
        s = slot[k * lanes:(k + 1) * lanes]
        x, fs = state[:len(s)], f[s]
        full = x >= (fs << np.uint64(63 - scale))
        words.append(x[full][::-1].astype(np.uint32))
        x = np.where(full, x >> shift, x)
        q = x // fs
        state[:len(s)] = (q << bits) + (x - q * fs) + start[s]
    return state, np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)


def decode(n: int, symbols: np.ndarray, freq: np.ndarray, lookup: np.ndarray, states: np.ndarray,
           words: np.ndarray) -> np.ndarray:
    """The ids of one block; ``lookup`` has the table entry of each slot."""
    f = freq.astype(np.uint64)
    start = (np.cumsum(f) - f).astype(np.uint64)
    out = np.empty(n, np.uint32)
    state, lanes, at = states.copy(), len(states), 0
    scale = scale_of(len(freq))
    mask, bits, shift = np.uint64((1 << scale) - 1), np.uint64(scale), np.uint64(32)
    for k in range(-(-n // lanes) if lanes else 0):
        x = state[:min(lanes, n - k * lanes)]
        low = x & mask
        s = lookup[low]
        out[k * lanes:k * lanes + len(x)] = symbols[s]
        x = f[s] * (x >> bits) + low - start[s]
        need = np.flatnonzero(x < LOW)
        x[need] = (x[need] << shift) | words[at:at + len(need)]
        at += len(need)
        state[:len(x)] = x
    if at != len(words) or not (state == LOW).all():
        raise ValueError("a block does not decode to its checkpoint")
    return out


_HEAD, _HEAD_SIZE = "<4sHHIII", 20


def write_segment(ids: np.ndarray, ends: np.ndarray, block: int = BLOCK) -> bytes:
    """Code one segment's ids; ``ends`` are the ends of its documents, the last is len(ids)."""
    symbols, slot, counts = np.unique(ids, return_inverse=True, return_counts=True) if len(ids) and ids.max() > 1 << 22 \
        else _dense(ids)
    freq = scaled(counts)
    # whole documents per block: a block ends with the first document that fills it
    last, cuts = 0, []
    for e in ends.tolist():
        if e - last >= block:
            cuts.append(e)
            last = e
    if not cuts or cuts[-1] != len(ids):
        cuts.append(len(ids))
    body, offsets, a, d = [], [], 0, 0
    for e in cuts:
        to = int(np.searchsorted(ends, e, "right"))
        states, words = encode(slot[a:e], freq)
        raw = struct.pack("<IIII", to - d, e - a, len(states), len(words)) + b"".join((
            (ends[d:to] - a).astype("<u4").tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()))
        body.append(raw + struct.pack("<I", zlib.crc32(raw)))
        offsets.append(len(body[-1]))
        a, d = e, to
    packed = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    head = struct.pack(_HEAD, MAGIC, 1, scale_of(len(symbols)), len(symbols), len(cuts), len(packed)) + packed \
        + np.cumsum(offsets).astype("<u8").tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(body)


def _dense(ids: np.ndarray):
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    slots = np.zeros(len(counts), np.int64)
    slots[symbols] = np.arange(len(symbols))
    return symbols, slots[ids], counts[symbols]


def read_segment(raw: bytes, only: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, document ends) of all or some blocks; raises ValueError where a check fails."""
    if raw[:4] != MAGIC:
        raise ValueError("not a segment of this format")
    _, version, scale, n_sym, n_blocks, n_packed = struct.unpack_from(_HEAD, raw)
    top = _HEAD_SIZE + n_packed + 8 * n_blocks
    if version != 1 or scale != scale_of(n_sym) or struct.unpack_from("<I", raw, top)[0] != zlib.crc32(raw[:top]):
        raise ValueError("a segment's head does not match its checksum")
    table = np.frombuffer(zlib.decompress(raw[_HEAD_SIZE:_HEAD_SIZE + n_packed]), "<u4").astype(np.int64)
    symbols, freq = np.cumsum(table[:n_sym]), table[n_sym:]
    lookup = np.repeat(np.arange(n_sym), freq)
    ends = np.frombuffer(raw, "<u8", n_blocks, top - 8 * n_blocks).astype(np.int64)
    for k in range(n_blocks) if only is None else only:
        at = top + 4 + (int(ends[k - 1]) if k else 0)
        stop = top + 4 + int(ends[k])
        if len(raw) < stop or struct.unpack_from("<I", raw, stop - 4)[0] != zlib.crc32(raw[at:stop - 4]):
            raise ValueError(f"block {k} does not match its checksum")
        n_docs, n, lanes, n_words = struct.unpack_from("<IIII", raw, at)
        docs = np.frombuffer(raw, "<u4", n_docs, at + 16).astype(np.int64)
        states = np.frombuffer(raw, "<u8", lanes, at + 16 + 4 * n_docs).astype(np.uint64)
        words = np.frombuffer(raw, "<u4", n_words, at + 16 + 4 * n_docs + 8 * lanes)
        yield decode(n, symbols, freq, lookup, states, words), docs


# ---------------------------------------------------------------------- tokenizer
#: Bytes after a blank at which the tokenizer's pattern surely starts a new piece: not white
#: space, nor the first byte of white space beyond ASCII.
_STARTS = np.array([not (b <= 0x20 or b in (0x7F, 0x85, 0xA0, 0xC2, 0xE1, 0xE2, 0xE3)) for b in range(256)])


class Encoder:
    """Ids of whole texts by the tokenizers library, equal pieces encoded once."""

    def __init__(self, spec: str, cache: int = CACHE):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # byte-level: one character per byte
            self.size[i] = len(token)
        self.cache = cache
        self._reset()

    def _reset(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.flat, self.used = [0], np.zeros(0, np.uint32), 0
        self.offs = np.zeros(1, np.int64)

    def _add(self, keys: np.ndarray, texts: list[bytes]) -> None:
        ids: list[np.ndarray | None] = [None] * len(texts)
        joined = [i for i, t in enumerate(texts) if len(t) > 1 and t[0] == 0x20 and _STARTS[t[1]]]
        alone = sorted(set(range(len(texts))) - set(joined))
        for i, e in zip(alone, self._run([texts[i].decode() for i in alone]), strict=True):
            ids[i] = np.array(e.ids, np.uint32)
        groups = [joined[k:k + 1000] for k in range(0, len(joined), 1000)]
        for g, e in zip(groups, self._run([b"".join(texts[i] for i in g).decode() for g in groups]), strict=True):
            got = np.array(e.ids, np.uint32)
            cut = np.searchsorted(np.cumsum(self.size[got]), np.cumsum([len(texts[i]) for i in g])) + 1
            for i, part in zip(g, np.split(got, cut[:-1]), strict=True):
                ids[i] = part
        n = np.array([len(x) for x in ids])
        slots = np.arange(len(ids)) + len(self.offs) - 1
        self.offs = np.concatenate([self.offs, self.offs[-1] + np.cumsum(n)])
        self.flat = np.concatenate([self.flat, *ids])
        order = np.argsort(keys)
        where = np.searchsorted(self.keys, keys[order])
        self.keys, self.slots = np.insert(self.keys, where, keys[order]), np.insert(self.slots, where, slots[order])

    def _run(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text) of the texts in a buffer."""
        import pandas as pd

        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] = (data[:-1] == 0x20) & _STARTS[data[1:]]
        ends = offs[1:][np.diff(offs) > 0]
        cut[ends - 1] = False  # a text's last blank is not cut off
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
            self._add(keys[new], [raw[x:y] for x, y in zip(a, b, strict=True)])
        slot = self.slots[np.searchsorted(self.keys, keys)][code]
        n = self.offs[slot + 1] - self.offs[slot]
        end = np.cumsum(n)
        take = np.arange(end[-1]) + np.repeat(self.offs[slot] - (end - n), n)
        return self.flat[take], np.append(0, end)[np.searchsorted(starts, offs)]


def encoder(spec: str) -> Encoder:
    """One encoder per worker process; it holds one tokenizer at a time."""
    kept = process_cache("encoder")
    if spec not in kept:
        kept.clear()
        kept[spec] = Encoder(spec)
    return kept[spec]


# -------------------------------------------------------------------------- Spark
_SEGMENTS = pa.schema([("_range", pa.int64()), ("_segment", pa.int64()), ("_first", pa.int64()), ("_n", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])


def _code(shared, end_id: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, unpack = encoder(shared.value), zstandard.ZstdDecompressor().decompress
        here, number, first = None, 0, 0
        docs, parts, sizes, held, waiting, size = [], [], [], 0, [], 0

        def tokenise():
            nonlocal waiting, size, held
            if waiting:
                ids, at = encode_texts(*text_buffer(pa.array(waiting, pa.large_binary())))
                parts.append(np.insert(ids, at[1:], end_id))
                sizes.append(np.diff(at) + 1)
                held += len(parts[-1])
            waiting, size = [], 0

        def flush():
            nonlocal docs, parts, sizes, held, number, first
            if docs:
                payload = write_segment(np.concatenate(parts), np.cumsum(np.concatenate(sizes)))
                row = ([here], [number], [first], [held], [docs], [payload])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _SEGMENTS, strict=True)],
                                                 schema=_SEGMENTS)
                number, first = number + 1, first + held
            docs, parts, sizes, held = [], [], [], 0

        for b in batches:
            for r, i, packed in zip(*(col(b, x).to_pylist() for x in ("_range", "_id", "_packed")), strict=True):
                if r != here:
                    tokenise()
                    yield from flush()
                    here, number, first = r, 0, 0
                docs.append(i)
                waiting.append(unpack(packed))
                size += len(waiting[-1])
                if size >= min(PIECE_BYTES, segment):
                    tokenise()
                if held >= segment:
                    yield from flush()
        tokenise()
        yield from flush()

    return run


def write_tokens(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 segment: int = SEGMENT) -> DataFrame:
    """Segments (_range, _segment, _first, _n, doc_ids, payload) of all texts in ascending id order;
    ``tokenizer_json`` is the path of a byte-level tokenizer file."""
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kinds = "_range long, _segment long, _first long, _n long, doc_ids array<long>, payload binary"
    return in_id_order(id_text(docs, id_col, text_col)).mapInArrow(_code(spec, end_id, segment), kinds)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for base, names, raw in zip(*(col(b, x).to_pylist() for x in ("_base", "doc_ids", "payload")), strict=True):
            out, done = [], 0
            for ids, ends in read_segment(raw):
                ids, a = ids.astype("<u4"), 0
                for e in ends.tolist():
                    out.append((names[done], base, e - a, zlib.crc32(ids[a:e].tobytes())))
                    base, done, a = base + e - a, done + 1, e
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the segments."""
    ranges = segments.groupBy("_range").agg(F.sum("_n").alias("_n"))  # one row per range of ids
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # bounded: two rows per shuffle partition
    return (segments.join(F.broadcast(bases), "_range")
            .select((F.col("_before") + F.col("_first")).alias("_base"), "doc_ids", "payload")
            .mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, tokenizer_json: str, end_id: int) -> DataFrame:
    """Encode, write to the shared folder, read the files back and describe every document."""
    return read_documents(materialise(write_tokens(docs, tokenizer_json, end_id), "tokens"))
