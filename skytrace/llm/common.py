"""Shared pieces: Arrow text buffers, vectorised word spans and 64-bit hashes, table readers.

Text is handled as the UTF-8 buffer of an Arrow column, so a batch costs a few numpy passes
and no Python string per word. Words are runs of bytes of one class; every byte above 0x7F
belongs to the word class of each contract used here, so byte runs equal code-point runs.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes handled at once inside a task; a longer single text is a piece of its own.
PIECE_BYTES = 2 << 20

U64 = np.uint64
_P = U64(0x9E3779B97F4A7C15 | 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by the path Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under names no extra column can clash with; null text is empty."""
    return df.select(df[id_col].cast("long").alias("_id"), F.coalesce(df[text_col], F.lit("")).alias("_text"))


def named(column: str) -> Column:
    """A column by its own name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_row(docs: DataFrame) -> Column:
    """All columns as struct ``_row``, which no name inside can clash with."""
    return F.struct(*[named(c) for c in docs.columns]).alias("_row")


def row_and(rows: DataFrame, kinds: str) -> StructType:
    """The schema of ``_row`` followed by the columns ``kinds``."""
    return StructType([rows.schema["_row"], *StructType.fromDDL(kinds).fields])


def row_and_text(docs: DataFrame, text_col: str) -> DataFrame:
    """Struct ``_row``, and ``_text`` only where the row does not hold it as a string already: a task gets a text once."""
    if dict(docs.dtypes).get(text_col) == "string":
        return docs.select(whole_row(docs))
    return docs.select(whole_row(docs), F.coalesce(docs[text_col], F.lit("")).alias("_text"))


def with_text(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """Batches of :func:`row_and_text` with ``_text`` in each, that of the row without a copy."""
    for b in batches:
        if "_text" not in b.schema.names:
            b = pa.RecordBatch.from_arrays([*b.columns, col(b, "_row").field(text_col)], names=[*b.schema.names, "_text"])
        yield b


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


# ------------------------------------------------------------------ Arrow text buffers
def text_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    n = len(arr)
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(off, np.int64 if large else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), offs - offs[0]
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "_text",
           max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into zero-copy slices of at most ``max_bytes`` of text (or one row)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, offs = text_buffer(b.column(b.schema.get_field_index(column)))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(offs, offs[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def col(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def int_col(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values with 0 for null, null mask) without a detour through float."""
    a = col(batch, name)
    null = np.asarray(a.is_null()) if a.null_count else np.zeros(len(a), bool)
    return np.asarray(a.fill_null(0) if a.null_count else a), null


def nullable(values: np.ndarray, null: np.ndarray, kind=None) -> pa.Array:
    return pa.array(values, type=kind, mask=null if null.any() else None)


# ------------------------------------------------------------------------ hashing
def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, elementwise on uint64 (wraps)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * U64(0xD1B54A32D192ED03))
_INV = U64(pow(int(_P), -1, 1 << 64))


def process_cache(name: str) -> dict:
    """A dict that lives as long as the worker process. (The package travels to the workers by
    value, so its own module globals are new in every task.)"""
    home = sys.modules.setdefault("skytrace_process_cache", types.ModuleType("skytrace_process_cache"))
    return home.__dict__.setdefault(name, {})


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n."""
    kept = process_cache("powers")
    if kept.get("n", 0) < n:
        size = -(-n // (1 << 18)) << 18
        for name, p in (("up", _P), ("down", _INV)):
            a = np.full(size, p, np.uint64)
            a[0] = 1
            kept[name] = np.multiply.accumulate(a)
        kept["n"] = size
    return kept["up"][:n], kept["down"][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """H with H[j]-H[i] = sum of values[i:j]*P**k; feed to :func:`span_hash`."""
    up, _ = _powers(len(values) + 1)
    h = np.empty(len(values) + 1, np.uint64)
    h[0] = 0
    np.cumsum(values * up[:len(values)], out=h[1:])
    return h


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the value spans [start, end), equal for equal content anywhere."""
    _, down = _powers(len(h))
    return mix64((h[end] - h[start]) * down[start] + (end - start).astype(np.uint64) * U64(0xA24BAED4963EE407))


# ------------------------------------------------------------------------ words
def byte_class(member) -> np.ndarray:
    return np.array([bool(member(b)) for b in range(256)])


#: Contract words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Contract words of letters, digits and everything beyond ASCII.
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def word_spans(data: np.ndarray, offs: np.ndarray, members: np.ndarray):
    """(starts, ends, word_offs): byte spans of the words, and where each row's words begin."""
    is_word = members[data]
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True  # a row's first byte never continues the row before
    start = is_word.copy()
    start[1:] &= ~is_word[:-1] | first[1:-1]
    end = is_word
    end[:-1] &= ~is_word[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    return span_hash(prefix(BYTE_VALUE[data]), starts, ends)


#: Longer spans are hashed one by one.
_LONG_SPAN = 1 << 10


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, mixed eight bytes a round. Unlike a polynomial modulo 2**64, equal hashes of
    different spans cannot be built from the spans' structure."""
    size = ends - starts
    h = mix64(size.astype(np.uint64) * _P)
    if not len(starts):
        return h
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    low = np.append((np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1), ~np.uint64(0))
    for i in np.flatnonzero(size > _LONG_SPAN):
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    live = np.flatnonzero((size > 0) & (size <= _LONG_SPAN))
    at, left, state = starts[live], size[live], h[live]
    while len(live):
        state = mix64(state ^ ((eight[at] & low[np.minimum(left, 8)]) * _P))
        h[live] = state
        on = left > 8
        live, at, left, state = live[on], at[on] + 8, left[on] - 8, state[on]
    return h


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from ``a`` equal those from ``b``, eight bytes a round. ``data`` has 8 spare bytes."""
    eight = np.ndarray((len(data) - 7,), "<u8", data.data, strides=(1,))
    low = (np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))) - np.uint64(1)
    equal, live, at = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(live):
        left = size[live] - at
        differ = eight[a[live] + at] ^ eight[b[live] + at]
        differ = np.where(left >= 8, differ, differ & low[np.clip(left, 0, 7)])
        equal[live[differ != 0]] = False
        live, at = live[(differ == 0) & (left > 8)], at + 8
    return equal


def row_of(offs: np.ndarray) -> np.ndarray:
    """Row number of every element of a ragged array with these offsets."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


# ------------------------------------------------------------------ packed texts
def packed(docs: DataFrame, *keys: str) -> DataFrame:
    """``docs`` (the long columns ``keys`` and _text) with the text compressed, for a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = pa.array([pack(t.encode()) for t in col(b, "_text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(col(b, k) for k in keys), texts], names=[*keys, "_packed"])

    return docs.select(*keys, "_text").mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", _packed binary")


def unpacked(batches: Iterator[pa.RecordBatch], work: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches of packed texts -> (slice of the batch, its texts) of about ``work`` bytes of text."""
    unpack = zstandard.ZstdDecompressor().decompress
    for b in batches:
        texts, size, first = [], 0, 0
        for i, raw in enumerate(col(b, "_packed")):
            texts.append(unpack(raw.as_py()))
            size += len(texts[-1])
            if size >= work or i == b.num_rows - 1:
                yield b.slice(first, len(texts)), texts
                texts, size, first = [], 0, i + 1


# ------------------------------------------------------------------ rows in id order
def _pack(tops: list[int], with_next: bool):
    """Rows dealt to the range of their id, packed. ``tops[i]`` is the greatest id of range i, which
    ``with_next`` also sends to the range above, that of the highest range to the lowest."""
    bounds = np.array(tops, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            rows: list[tuple] = []
            for i, text in zip(col(b, "_id").to_pylist(), col(b, "_text").to_pylist(), strict=True):
                r = 0 if i is None or not len(bounds) else int(np.searchsorted(bounds, i))
                packed = pack(text.encode())
                rows.append((r, 0, i, packed))
                if with_next and (not len(bounds) or i == tops[r]):
                    rows.append(((r + 1) % max(len(tops), 1), 1, i, packed))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.binary()),
                                                    strict=True)], names=["_range", "_copy", "_id", "_packed"])

    return run


def in_id_order(docs: DataFrame, with_next: bool = False, n_ranges: int | None = None) -> DataFrame:
    """(_id, _text) -> (_range, _copy, _id, _packed), with one shuffle of packed texts and no global sort.

    Ids are cut to ranges at quantiles (by default two for each shuffle partition); range r is partition r, so
    ids ascend over the partitions, and each is sorted by id. ``with_next`` sorts by descending id and ends a
    range with copies (_copy = 1) of the rows of which the first follows its last row in the
    whole table's descending order (after the table's last: its first).
    """
    n_ranges = n_ranges or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [(i + 1) / n_ranges for i in range(n_ranges)]
    top, cuts = docs.select(F.max("_id"), F.approx_percentile("_id", shares, 100 * n_ranges)).first()
    tops = sorted({*(cuts or []), top} - {None})  # ids of the table, so no range is empty
    by = F.desc_nulls_last("_id") if with_next else F.asc_nulls_first("_id")
    return (docs.mapInArrow(_pack(tops, with_next), "_range long, _copy int, _id long, _packed binary")
            .repartitionById(max(len(tops), 1), F.col("_range").cast("int")).sortWithinPartitions("_range", "_copy", by, "_packed"))
