"""Benchmark decontamination with suffix arrays over the training shards.

A shard is a slice of an Arrow batch. Its words become numbers of the benchmark's vocabulary (0
for any other word), and its suffix array holds the word positions in the order of their next
DEPTH words. Positions whose run of benchmark words is shorter than the shortest window can
match nothing and are left out. Every suffix of every benchmark item is then binary-searched by
its first window, which gives all its verbatim occurrences with their places; occurrences on
one diagonal chain to longest matches. No document leaves its task, so nothing is shuffled.

The benchmark is the stated query set. It reaches the tasks in blocks of at most BLOCK_BYTES of
text; further blocks are further passes chained in the same tasks, so any size is exact.

Defined cases: null and empty texts have no words, and items without words match nothing. An
item of fewer than DEPTH words is one window. Repeated documents keep one row each; rows that
repeat an item count once by its item_id (a null id is the text "null").
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, byte_hashes, col, pieces, row_and, row_and_text, row_of, text_buffer, with_text, word_spans

DEPTH = 13
BLOCK_BYTES = 32 << 20
#: Text bytes handled at once inside a task.
WORK_BYTES = 1 << 19
_MATCH = "array<struct<item_id:string,item_pos:int,doc_pos:int,length:int>>"
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("item_pos", pa.int32()), ("doc_pos", pa.int32()),
                                  ("length", pa.int32())]))


def _words(arr) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the lower-cased words, word offsets per text)."""
    data, offs = text_buffer(arr)
    data = LOWER[data]
    starts, ends, at = word_spans(data, offs, ALNUM)
    return byte_hashes(data, starts, ends), at


def _keys(ids: np.ndarray, pos: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The DEPTH word numbers from each position as sortable bytes, 0 beyond ``stop``."""
    at = pos[:, None] + np.arange(DEPTH)
    keep = at < stop[:, None]
    out = np.where(keep, ids[np.where(keep, at, 0)], 0) if len(ids) else np.zeros(at.shape)
    return np.ascontiguousarray(out.astype(">u4")).view(f"S{4 * DEPTH}").ravel()


class Block:
    """Searchable windows of some benchmark items: what a task needs of them, in a few arrays."""

    def __init__(self, item_ids: list[str], texts: list[str]):
        hashes, at = _words(pa.array(texts, pa.large_string()))
        self.names = np.array(item_ids, object)
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes) + 1
        row = row_of(at)
        size = np.diff(at)
        pos = np.arange(len(ids)) - at[row] if len(ids) else np.zeros(0, np.int64)
        window = np.minimum(size[row], DEPTH)
        own = np.flatnonzero(pos + window <= size[row])  # suffixes that hold a whole window
        own = own[(pos[own] == 0) | (size[row[own]] >= DEPTH)]
        keys = _keys(ids, own, own + window[own])
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(order))  # of the suffixes with one window
        self.row, self.pos = row[own][order], pos[own][order]
        self.length = window[own][order][first].astype(np.int64)
        self.shortest = int(self.length.min()) if len(first) else 0
        pad = np.frombuffer(self.keys.tobytes(), ">u4").reshape(-1, DEPTH).copy()
        pad[np.arange(DEPTH) >= self.length[:, None]] = 0xFFFFFFFF
        self.upper = np.ascontiguousarray(pad).view(f"S{4 * DEPTH}").ravel()

    def occurrences(self, ids: np.ndarray, at: np.ndarray):
        """All (word position, window number) at which a window occurs in the shard's texts."""
        if not len(self.keys) or not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        breaks = np.unique(np.append(np.flatnonzero(ids == 0), at[1:]))
        pos = np.flatnonzero(ids)
        stop = breaks[np.searchsorted(breaks, pos, "right")] if len(breaks) else pos
        long = stop - pos >= self.shortest
        pos, stop = pos[long], stop[long]
        keys = _keys(ids, pos, stop)
        suffix = np.argsort(keys, kind="stable")  # the shard's suffix array
        ordered = keys[suffix]
        low, high = np.searchsorted(ordered, self.keys), np.searchsorted(ordered, self.upper, "right")
        count = np.maximum(high - low, 0)
        window = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        return pos[suffix[low[window] + nth]], window

    def matches(self, ids: np.ndarray, at: np.ndarray):
        """Longest matches (text row, item row, item position, word position, length)."""
        where, window = self.occurrences(ids, at)
        many = self.first[window + 1] - self.first[window]
        entry = np.repeat(self.first[window], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        where, length = np.repeat(where, many), np.repeat(self.length[window], many)
        item, item_pos = self.row[entry], self.pos[entry]
        text = np.searchsorted(at, where, "right") - 1
        order = np.lexsort((where, where - item_pos, item, text))
        text, item, item_pos, where, length = (x[order] for x in (text, item, item_pos, where, length))
        chain = np.ones(len(where), bool)  # starts of runs of neighbouring windows on one diagonal
        same = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (where[1:] == where[:-1] + 1)
        chain[1:] = ~(same & (item_pos[1:] == item_pos[:-1] + 1))
        start = np.flatnonzero(chain)
        end = np.append(start[1:], len(where)) - 1
        return text[start], item[start], item_pos[start], where[start] - at[text[start]], \
            (where[end] + length[end] - where[start]) if len(start) else start


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES):
    """The benchmark in blocks that each fit the bound (or hold one hash class of items)."""
    t = items.select(F.coalesce(items[id_col].cast("string"), F.lit("null")).alias("i"),
                     F.coalesce(items[text_col], F.lit("")).alias("t"))
    total = t.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = t.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else t
        rows = part.orderBy("i", "t").collect()  # bounded by block_bytes
        yield Block([r.i for r in rows], [r.t for r in rows])


def _search(shared, last: bool, text_col: str, separate: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for b in pieces(with_text(batches, text_col), max_bytes=WORK_BYTES):
            hashes, at = _words(col(b, "_text"))
            v = block.vocabulary
            ids = np.zeros(len(hashes), np.int64)
            if len(v) and len(hashes):
                spot = np.minimum(np.searchsorted(v, hashes), len(v) - 1)
                ids = np.where(v[spot] == hashes, spot + 1, 0)
            text, item, item_pos, pos, length = block.matches(ids, at)
            found = col(b, "_found").to_pylist() if "_found" in b.schema.names else [[] for _ in range(b.num_rows)]
            for t, name, p, q, n in zip(text.tolist(), block.names[item], item_pos.tolist(), pos.tolist(),
                                        length.tolist(), strict=True):
                found[t].append({"item_id": name, "item_pos": p, "doc_pos": q, "length": n})
            kept = ["_row", *(["_text"] if separate else [])]
            out = [*(col(b, x) for x in kept), pa.array(found, _MATCH_TYPE)]
            names = [*kept, "_found"]
            if last:
                out = [out[0], pa.array(np.diff(at)), pa.array([_covered(f) for f in found], pa.int64()), out[-1]]
                names = ["_row", "n_words", "n_hit", "_found"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def _covered(found: list[dict]) -> int:
    """Words inside any of the matches."""
    n = end = 0
    for a, size in sorted((m["doc_pos"], m["length"]) for m in found):
        n += max(0, a + size - max(a, end))
        end = max(end, a + size)
    return n


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document as struct ``_row`` with n_words, n_hit (words inside a window's occurrence),
    matches (longest verbatim matches with their places) and contaminated."""
    spark = docs.sparkSession
    out = row_and_text(docs, text_col)
    separate = "_text" in out.columns
    found = [spark.sparkContext.broadcast(b) for b in blocks(items, item_id, item_text, block_bytes)]
    for k, b in enumerate(found):
        last = k == len(found) - 1
        spec = row_and(out, ("n_words long, n_hit long, " if last else "_text string, " if separate else "") + f"_found {_MATCH}")
        out = out.mapInArrow(_search(b, last, text_col, separate), spec)
    return out.select("_row", "n_words", "n_hit", F.col("_found").alias("matches"),
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    kept = contamination(docs, items, text_col).filter(~F.col("contaminated"))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
