"""Removal of repeated passages by seed and extend.

A window is WINDOW consecutive words. In each window the least hash of its GRAM-word grams is the
anchor (leftmost of ties), so equal windows have equal anchors at the same place: winnowing keeps
about one gram in seven, and every repeated window is found by joining documents on anchors.

A seed is an anchor's occurrence extended both ways as far as windows keep that anchor: a segment
of up to WINDOW - GRAM + 1 windows. The seeds of one anchor are joined:

1. Equal extensions: all occurrences of a segment but the first are repeats, whole.
2. Where an anchor has several different extensions, the match ends inside them; the first
   occurrence of each is extended window by window, and all occurrences of a window but the
   first are repeats.
3. Per document, repeated windows that touch or overlap are one maximal repeat.

The outcome is exact: a window is repeated if and only if its words also start earlier, by
(doc_id, position). What one task already knows to be a later occurrence is marked before the
shuffle, so a passage that a third of all documents share sends one row per batch to its key.
Texts travel packed, once to the documents' open segments and once to their repeats.

Defined cases: null and short texts have no windows. A null doc_id counts as the lowest. Rows with
one doc_id and different texts are ordered by the texts' checksum, rows with equal texts too get
equal results (neither is earlier). Texts of any length are read whole. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import (NOT_SPACE, byte_hashes, col, id_text, mix64, packed, pieces, prefix, row_of, span_hash, text_buffer,
                     unpacked, word_spans)

WINDOW, GRAM = 20, 8
#: A place is a window's or segment's first word times PLACE plus the number of windows.
PLACE = 64
_NO_ID = -(1 << 63)
_SEEDS = "_anchor long, _segment long, _id long, _version long, _place long, _again boolean"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = id_text(docs, id_col, text_col)
    return d.select(F.coalesce("_id", F.lit(_NO_ID)).alias("_id"),
                    F.crc32(F.col("_text").cast("binary")).alias("_version"), "_text")


def _segments(words: np.ndarray, at: np.ndarray, window: int, gram: int):
    """(anchor hash, segment hash, row, first window, windows) of all segments of ragged words."""
    n = np.diff(at)
    h = prefix(words)
    count = np.maximum(n - window + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    first = np.arange(count.sum()) + np.repeat(at[:-1] - (np.cumsum(count) - count), count)
    if not len(first):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    spots = np.arange(len(words) - gram + 1)
    grams = span_hash(h, spots, spots + gram)
    width = window - gram + 1
    least, have = grams, 1
    while have < width:
        shift = min(have, width - have)
        least = np.minimum(least[:-shift], least[shift:])
        have += shift
    least, owner = least[first], np.zeros(len(first), np.int64)
    for j in range(width - 1, -1, -1):
        np.copyto(owner, first + j, where=grams[first + j] == least)
    new = np.ones(len(first), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (first[1:] != first[:-1] + 1)
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(first)))
    a, r = first[start], row[start]
    return grams[owner[start]], span_hash(h, a, a + size + window - 1), r, a - at[r], size


def _again(key: np.ndarray, ids: np.ndarray, versions: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which rows have an earlier (id, version, place) with the same key among these rows."""
    order = np.lexsort((place, versions, ids, key))
    out = np.zeros(len(key), bool)
    k, i, v, p = (x[order] for x in (key, ids, versions, place))
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    out[order] = (i != i[head]) | (v != v[head]) | (p != p[head])
    return out


def _words(arr) -> tuple[np.ndarray, np.ndarray]:
    data, offs = text_buffer(arr)
    starts, ends, at = word_spans(data, offs, NOT_SPACE)
    return byte_hashes(data, starts, ends), at


def _rows(anchor, segment, ids, versions, place) -> pa.RecordBatch:
    """Seeds; one known to be a later occurrence is dealt by its document, away from its anchor."""
    again = _again(segment, ids, versions, place)
    anchor = np.where(again, mix64(ids.view(np.uint64) + place.astype(np.uint64)), anchor)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor.view(np.int64)), pa.array(segment.view(np.int64)), pa.array(ids), pa.array(versions),
         pa.array(place), pa.array(again)], names=["_anchor", "_segment", "_id", "_version", "_place", "_again"])


def _seed(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            words, at = _words(col(b, "_text"))
            anchor, segment, row, start, size = _segments(words, at, window, gram)
            if len(row):
                yield _rows(anchor, segment, np.asarray(col(b, "_id"))[row], np.asarray(col(b, "_version"))[row],
                            start * PLACE + size)

    return run


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, windows) of the batch's lists of places; null lists are empty."""
    lists = col(batch, "_places")
    n = np.asarray(lists.value_lengths().fill_null(0))
    flat = np.asarray(lists.flatten())
    return np.repeat(np.arange(batch.num_rows), n), flat // PLACE, flat % PLACE


def _ramp(n: np.ndarray) -> np.ndarray:
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _extend(window: int):
    """The open segments of documents -> their windows, keyed by the hash of a window's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in unpacked(batches):
            words, at = _words(pa.array(texts, pa.large_binary()))
            row, start, size = _places(b)
            row, start = np.repeat(row, size), np.repeat(start, size) + _ramp(size)
            spot = at[row] + start
            key = span_hash(prefix(words), spot, spot + window)
            yield _rows(key, key, np.asarray(col(b, "_id"))[row], np.asarray(col(b, "_version"))[row],
                        start * PLACE + 1)

    return run


def _remove(window: int):
    """Documents with their repeated places -> words, maximal repeats and the text that is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in unpacked(batches):
            data, offs = text_buffer(pa.array(texts, pa.large_binary()))
            starts, ends, at = word_spans(data, offs, NOT_SPACE)
            row, start, size = _places(b)
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, at[row] + start, 1)
            np.add.at(step, at[row] + start + size + window - 1, -1)
            gone = np.cumsum(step[:-1]) > 0
            doc = row_of(at)
            edge = np.zeros(len(gone) + 1, bool)
            edge[at] = True
            head = gone & (~np.append(False, gone[:-1]) | edge[:-1])
            tail = gone & (~np.append(gone[1:], False) | edge[1:])
            h, t = np.flatnonzero(head), np.flatnonzero(tail) + 1
            spans = np.column_stack([h - at[doc[h]], t - at[doc[h]]])
            cut = np.searchsorted(h, at)
            kept_text, raw, keep = [], data.tobytes(), ~gone
            for i in range(b.num_rows):
                k = np.flatnonzero(keep[at[i]:at[i + 1]]) + at[i]
                kept_text.append(b" ".join([raw[x:y] for x, y in zip(starts[k].tolist(), ends[k].tolist(), strict=True)]))
            removed = np.bincount(doc, gone, b.num_rows).astype(np.int64) if len(doc) else np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([
                col(b, "_id"), pa.array(np.diff(at)), pa.array(removed),
                pa.array([[{"start": x, "end": y} for x, y in spans[cut[i]:cut[i + 1]].tolist()] for i in range(b.num_rows)],
                         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array([x.decode() for x in kept_text], pa.string()),
            ], names=["_id", "n_words", "n_removed", "repeats", "kept"])

    return run


def _later(seeds: DataFrame) -> DataFrame:
    """Seeds dealt by anchor, with _rank of the occurrence among its segment's and whether the anchor
    has several segments (_many)."""
    dealt = seeds.repartition("_anchor")
    order = Window.partitionBy("_anchor", "_segment").orderBy("_id", "_version", "_place")
    whole = Window.partitionBy("_anchor")
    return (dealt.withColumn("_rank", F.when(F.col("_again"), 2).otherwise(F.rank().over(order)))
            .withColumn("_many", F.min("_segment").over(whole) != F.max("_segment").over(whole)))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, repeats (maximal repeats as word positions
    [start, end)) and kept (the words that are left, joined by blanks)."""
    d = _keyed(docs, id_col, text_col)
    seeds = _later(d.mapInArrow(_seed(window, gram), _SEEDS))
    # later occurrences, and first occurrences whose anchor also extends in another way
    found = materialise(seeds.filter((F.col("_rank") > 1) | F.col("_many"))
                        .select("_id", "_version", "_place", (F.col("_rank") > 1).alias("_repeat")), "segments")
    places = F.collect_list("_place").alias("_places")  # at most the windows of one document
    open_ = found.filter("not _repeat").groupBy("_id", "_version").agg(places)
    texts = packed(d, "_id", "_version")
    windows = texts.join(open_, ["_id", "_version"]).mapInArrow(_extend(window), _SEEDS)
    again = _later(windows).filter("_rank > 1").select("_id", "_version", "_place")
    repeats = found.filter("_repeat").select("_id", "_version", "_place").unionByName(again)
    repeats = materialise(repeats.distinct().groupBy("_id", "_version").agg(places), "repeats")
    out = texts.join(repeats, ["_id", "_version"], "left").mapInArrow(
        _remove(window), "_id long, n_words long, n_removed long, repeats array<struct<start:int,`end`:int>>, kept string")
    return out.select(F.nullif("_id", F.lit(_NO_ID)).alias(id_col), "n_words", "n_removed", "repeats", "kept")
