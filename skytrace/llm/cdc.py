"""Document fingerprints from content-defined chunks.

A gear hash over the last 16 bytes marks cut points. Cuts are normalised: none before MIN
bytes, a strict mask up to NORMAL, a loose one after it, and a forced cut at MAX. The gear
window never reaches over the chunk's start (MIN equals the window), so a chunk depends on its
own bytes alone and chunks after an edit fall back into step. A fingerprint is the sequence of
(64-bit digest, length) of the chunks, written as hex; likeness is the containment of one
chunk digest set in the other, weighted by chunk length.

Neighbours in doc_id order are found without a global sort: rows are dealt to ranges of ids cut
at quantiles, each range also gets a copy of the row that follows its last one, and a task
streams through its ranges with one row carried over. Texts are shuffled once, packed.

Defined cases: null text is the empty text, whose fingerprint is empty; two empty
fingerprints are alike (1), an empty and another are not (0). Rows with one doc_id follow each
other in a fixed order of their texts. A null doc_id sorts as the lowest. A table with one
row is its own neighbour; one without rows gives none. Texts of any length are read whole, and edited and
fingerprinted one by one beyond WORK_CHARS. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import BYTE_VALUE, col, id_text, in_id_order, mix64, pieces, prefix, row_of, span_hash, text_buffer

WINDOW = MIN = 16
NORMAL, MAX = 32, 128
STRICT, LOOSE = np.uint32(0xFC000000), np.uint32(0xF0000000)  # 6 and 4 bits
_GEAR = (mix64(BYTE_VALUE) >> np.uint64(32)).astype(np.uint32)
#: Characters worked on at once inside a task (or one text and its successor).
WORK_CHARS = 2 << 20


def _gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the last 16 bytes at every position, by doubling the window."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        more = h.copy()
        more[k:] += h[:-k] << np.uint32(k) if len(h) > k else 0
        h = more
    return h


def chunk(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of the texts in a buffer: (digests, lengths, chunk offsets per text)."""
    h = _gear(data)
    strict, loose = np.flatnonzero((h & STRICT) == 0), np.flatnonzero((h & LOOSE) == 0)
    end = len(data) + MAX + 1
    strict, loose = np.append(strict, end), np.append(loose, end)
    at, stop = offs[:-1].copy(), offs[1:]
    rows = np.flatnonzero(at < stop)
    at, stop = at[rows], stop[rows]
    got_row, got_at, got_end = [], [], []
    while len(rows):  # the next cut of every unfinished text at once
        a = strict[np.searchsorted(strict, at + MIN - 1)] + 1
        b = loose[np.searchsorted(loose, at + NORMAL - 1)] + 1
        cut = np.where(a <= at + NORMAL - 1, a, np.minimum(b, at + MAX))
        cut = np.minimum(cut, stop)
        got_row.append(rows)
        got_at.append(at)
        got_end.append(cut)
        on = cut < stop
        rows, at, stop = rows[on], cut[on], stop[on]
    n = len(offs) - 1
    if not got_row:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    row, s, e = map(np.concatenate, (got_row, got_at, got_end))
    order = np.argsort(s, kind="stable")
    row, s, e = row[order], s[order], e[order]
    return span_hash(prefix(BYTE_VALUE[data]), s, e), e - s, np.searchsorted(row, np.arange(n + 1))


def to_text(digests: np.ndarray, lengths: np.ndarray, offs: np.ndarray) -> list[str]:
    """Fingerprints: 16 hex digits of the digest and 2 of the length for each chunk."""
    rec = np.zeros(len(digests), np.dtype([("d", ">u8"), ("n", "u1")]))
    rec["d"], rec["n"] = digests, lengths
    raw = rec.tobytes()
    return [raw[9 * a:9 * b].hex() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def containment(digests: np.ndarray, lengths: np.ndarray, row: np.ndarray, other_digests: np.ndarray,
                other_row: np.ndarray, n: int) -> np.ndarray:
    """Per row number, the share of its distinct chunks' bytes that the other side's row also has."""
    key = mix64(digests + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    other = mix64(other_digests + other_row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    key, first = np.unique(key, return_index=True)
    own, weight = row[first], lengths[first].astype(float)
    other = np.sort(other)
    at = np.searchsorted(other, key)
    shared = np.zeros(len(key), bool)
    inside = at < len(other)
    shared[inside] = other[at[inside]] == key[inside]
    total = np.bincount(own, weight, n)
    common = np.bincount(own, weight * shared, n)
    neither = (total == 0) & (np.bincount(other_row, minlength=n)[:n] == 0)
    return np.where(neither, 1.0, common / np.maximum(total, 1))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                  ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (range, copy, id, text), each but the last followed by its successor if in one range."""
    mine = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    texts = [r[3] for r in rows]
    edited = [texts[i][:len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][:len(texts[i]) // 3] for i in mine]
    raw = [t.encode() for t in edited]
    data, offs = text_buffer(pa.array([t.encode() for t in texts] + raw, pa.large_binary()))
    digest, length, at = chunk(data, offs)
    row = row_of(at)
    own, n = np.array(mine, np.int64), len(rows)
    slot = np.full(len(texts) + len(edited) + 1, -1)
    slot[own] = np.arange(len(own))
    to_edited, to_next = slot.copy(), slot.copy()
    to_edited[n:n + len(own)] = np.arange(len(own))
    to_next[:] = -1
    to_next[own + 1] = np.arange(len(own))
    is_own, is_edited, is_next = slot[row] >= 0, row >= n, to_next[row] >= 0
    a, b = digest[is_own], length[is_own]
    near_edited = containment(a, b, slot[row[is_own]], digest[is_edited], to_edited[row[is_edited]], len(own))
    near_next = containment(a, b, slot[row[is_own]], digest[is_next], to_next[row[is_next]], len(own))
    prints = to_text(digest, length, at)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((
        [rows[i][2] for i in mine], [len(texts[i]) for i in mine], [hashlib.sha256(t).hexdigest() for t in raw],
        [prints[i] for i in mine], prints[n:], near_edited, near_next), _OUT, strict=True)], schema=_OUT)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    rows, size = [], 0
    for b in batches:
        for r in zip(*(col(b, x).to_pylist() for x in ("_range", "_copy", "_id", "_packed")), strict=True):
            if r[1] and rows and rows[-1][1] and rows[-1][0] == r[0]:
                continue  # only the first of the copies follows
            rows.append((*r[:3], unpack(r[3]).decode()))
            size += len(rows[-1][3])
            if size > WORK_CHARS and len(rows) > 1:
                yield _compare(rows)
                rows = rows[-1:]
                size = len(rows[0][3])
    if rows:
        yield _compare(rows)


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: fingerprints of the text and of its edited form (the last third of the
    code points replaced by the first as many of the next document, descending id), with the
    containment of the text's fingerprint in the edited one and in the next document's."""
    spec = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")
    return in_id_order(id_text(docs, id_col, text_col), with_next=True).mapInArrow(_stream, spec)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every text; no shuffle."""
    def run(batches):
        for b in pieces(batches, max_bytes=WORK_CHARS):
            yield pa.RecordBatch.from_arrays([col(b, "_id"), pa.array(to_text(*chunk(*text_buffer(col(b, "_text")))))],
                                             names=["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")
