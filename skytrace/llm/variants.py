"""Spelling variant grouping: words one edit apart, found by FM-index search schemes.

``words`` counts the distinct words of all texts. ``near_pairs`` finds, for every word, all words
one inserted, deleted or replaced code point away: such a word shares the left or the right half of the
query, so words are dealt to blocks by their possible halves (the halves of the queries that may meet them,
two lengths a side), each block is indexed (``fmindex``), and a query searches only the block of its
half, exactly over that half and with one error over the other. A half that more than ``BLOCK`` words share
gets as many blocks as it needs, all searched by its queries, so no index grows with the vocabulary. A block's
index is built from at most about two ``BLOCK`` words; its queries stream past it.

A word's form is its near word of largest count (ties: smallest in code-point order) if that count is at
least ``FACTOR`` times its own; its root is the end of the chain of forms. Counts rise by that factor a
link, so chains are short and have no cycles; they are followed link by link.

Defined cases: a null or empty text has no words; a null id counts as the empty text in the edited
runs. Repeated rows count each. Runs of any length are read whole. No documents: no rows. Other
columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import LOWER, col, pieces, row_of, same_bytes, text_buffer, word_spans
from .fmindex import Index, Words, one_error

MIN_LENGTH, MIN_COUNT, FACTOR = 7, 2, 10
#: One run in EDIT_ONE_IN, by its hash, loses a code point.
EDIT_ONE_IN = 31
BLOCK, QUERIES = 1 << 15, 1 << 12

# ------------------------------------------------------------------------- counting words


def _crc_steps() -> np.ndarray:
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    return step


_CRC = _crc_steps()
_LONG = 64  # longer runs are hashed one by one


def crc32_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span, continued from the crc32 values ``before``; a byte of all spans at a time."""
    order = np.argsort(-sizes, kind="stable")
    at, size = starts[order], sizes[order]
    state = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-size, -_LONG))  # these many are longer than _LONG
    for i in range(long):
        raw = data[at[i]:at[i] + size[i]].tobytes()
        state[i] = zlib.crc32(raw, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for k in range(int(size[long:].max(initial=0))):
        to = int(np.searchsorted(-size, -k))
        s = state[long:to]
        state[long:to] = _CRC[(s ^ data[at[long:to] + k]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _runs(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, row offsets, lengths in code points) of the runs [A-Za-z\\u00C0-\\u00FF]+. Of UTF-8 these
    are the letters' own bytes and each byte C3 with the byte behind it."""
    lead = data == 0xC3
    inside = lead | ((data | 0x20) - np.uint8(0x61) < 26)
    inside[1:] |= lead[:-1]
    starts, ends, at = word_spans(inside.astype(np.uint8), offs, np.array([False, True]))
    before = np.append(0, np.cumsum(lead))
    return starts, ends, at, ends - starts - (before[ends] - before[starts])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        data, offs = text_buffer(col(b, "_text"))
        data = LOWER[data]
        starts, ends, at, length = _runs(data, offs)
        row = row_of(at)
        long = length >= MIN_LENGTH
        starts, ends, length, row = starts[long], ends[long], length[long], row[long]
        ids = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in col(b, "_id").to_pylist()], np.uint32)
        h = crc32_spans(data, starts, ends - starts, ids[row])
        edit = h % np.uint32(EDIT_ONE_IN) == 0
        edited = []
        for s, e, n, drop in zip(starts[edit], ends[edit], length[edit], h[edit] % length[edit].astype(np.uint32), strict=True):
            if n > MIN_LENGTH:
                word = data[s:e].tobytes().decode()
                edited.append(word[:drop] + word[drop + 1:])
        starts, ends = starts[~edit], ends[~edit]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        kept = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        cut = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
        whole = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(kept))])
        counted = pc.value_counts(pa.chunked_array([whole, pa.array(edited, pa.string())]))
        if len(counted):
            yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "n"])


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all distinct words with at least MIN_COUNT occurrences."""
    d = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    return (d.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


# ------------------------------------------------------------------------- near words
LEFT, RIGHT = 0, 1  # the half that is matched exactly


def _halves(side: int, size: Column) -> Column:
    """The lengths of that half of all queries that a word of ``size`` may be near to."""
    half = (lambda m: F.floor(m / 2)) if side == LEFT else (lambda m: m - F.floor(m / 2))
    return F.array_distinct(F.array(half(size - 1), half(size), half(size + 1)))


def _keyed(vocabulary: DataFrame, query: bool) -> DataFrame:
    """(_key, _side, _query, word, n): a row for each half under which a word is asked for, or found."""
    size = F.length("word")
    out = None
    for side in (LEFT, RIGHT):
        own = F.floor(size / 2) if side == LEFT else size - F.floor(size / 2)
        d = vocabulary.select("word", "n", F.explode(F.array(own) if query else _halves(side, size)).alias("_half"))
        half = F.expr("left(word, int(_half))" if side == LEFT else "right(word, int(_half))")
        d = d.select(F.xxhash64(F.lit(side), half).alias("_key"), F.lit(side).alias("_side"), F.lit(query).alias("_query"), "word", "n")
        out = d if out is None else out.unionByName(d)
    return out


class _Block:
    """A block's words, indexed when the first query comes."""

    def __init__(self):
        self.parts: list[pa.RecordBatch] = []
        self.index = None

    def search(self, side: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.index is None:
            t = pa.Table.from_batches(self.parts).combine_chunks()
            raw = [w.encode("latin-1") for w in t["word"].to_pylist()]
            keep = np.unique(np.array(raw, object), return_index=True)[1]  # a word stands under several halves
            self.words = t.take(pa.array(keep))
            self.forward = Words.of([raw[i] for i in keep])
            self.index, self.parts = Index(self.forward.reversed() if side == LEFT else self.forward), []
        raw = [w.encode("latin-1") for w in col(batch, "word").to_pylist()]
        asked = Words.of(raw)
        half = asked.size // 2
        if side == LEFT:
            q, w = one_error(self.index, asked.reversed(), half)
        else:
            q, w = one_error(self.index, asked, asked.size - half)
            # words with the same left half are found by the other search
            longer = self.forward.size[w] >= half[q]
            a, b = np.append(asked.data, np.zeros(8, np.uint8)), np.append(self.forward.data, np.zeros(8, np.uint8))
            both = np.concatenate([a, b])
            same = same_bytes(both, asked.offs[q], len(a) + np.minimum(self.forward.offs[w], len(self.forward.data)),
                              np.where(longer, half[q], 0))
            q, w = q[~(same & longer)], w[~(same & longer)]
        yield pa.RecordBatch.from_arrays(
            [col(batch, "word").take(pa.array(q)), self.words["word"].combine_chunks().take(pa.array(w)),
             self.words["n"].combine_chunks().take(pa.array(w))], names=["word", "near", "near_n"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, those of the index before the queries."""
    at, block = None, None
    for b in batches:
        keys = np.stack([np.asarray(col(b, x)).astype(np.int64) for x in ("_block", "_salt", "_side", "_query")])
        cuts = np.append(np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))), b.num_rows)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if at != tuple(keys[:3, i]):
                at, block = tuple(keys[:3, i]), _Block()
            if not keys[3, i]:
                block.parts.append(b.slice(i, j - i).select(["word", "n"]))
            elif block.parts or block.index is not None:
                for k in range(i, j, QUERIES):
                    yield from block.search(int(keys[2, i]), b.slice(k, min(QUERIES, j - k)))


def near_pairs(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, in both directions, each once."""
    index, asked = _keyed(vocabulary, False), _keyed(vocabulary, True)
    n_blocks = max(1, math.ceil(8 * vocabulary.count() / block))  # four rows a word
    hot = (index.groupBy("_key").agg(F.count("*").alias("_c")).filter(F.col("_c") > block)
           .select("_key", F.ceil(F.col("_c") / block).cast("int").alias("_salts")))  # one row in ``block`` at most

    def dealt(rows: DataFrame, salts: Column) -> DataFrame:
        rows = rows.join(F.broadcast(hot), "_key", "left")
        return rows.select(F.when(F.col("_salts").isNull(), F.pmod(F.xxhash64("_key"), F.lit(n_blocks))).otherwise(F.col("_key"))
                           .alias("_block"), F.explode(salts).alias("_salt"), "_side", "_query", "word", "n")

    own = F.coalesce(F.pmod(F.xxhash64("word"), F.col("_salts")), F.lit(-1)).cast("int")
    every = F.coalesce(F.sequence(F.lit(0), F.col("_salts") - 1), F.array(F.lit(-1)))
    rows = dealt(index, F.array(own)).unionByName(dealt(asked, every))
    parts = max(n_blocks, int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.repartition(parts, "_block", "_salt", "_side").sortWithinPartitions("_block", "_salt", "_side", "_query")
            .mapInArrow(_search, "word string, near string, near_n long"))


# ------------------------------------------------------------------------- forms
def _roots(links: DataFrame, most: int) -> DataFrame:
    """(word, form) -> (word, root). A form counts FACTOR times its word at least, so ``most`` bounds the links of a
    chain; each after the first is one join. No table is written between them: each would be a small file a task."""
    at, then = links.select("word", F.col("form").alias("root")), links.select(F.col("word").alias("root"), "form")
    reached = MIN_COUNT * FACTOR * FACTOR  # the least count behind two links
    while reached <= most:
        at = at.join(then, "root", "left").select("word", F.coalesce("form", "root").alias("root"))
        reached *= FACTOR
    return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocabulary = materialise(words(docs, id_col, text_col), "vocabulary")
    near = near_pairs(vocabulary).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    out = vocabulary.join(near, "word", "left")
    takes = -F.col("_best.less") >= FACTOR * F.col("n")
    out = materialise(out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(takes, F.col("_best.near")).alias("form"),
                                 F.when(takes, -F.col("_best.less")).alias("form_n")), "forms")
    most = out.agg(F.max("n")).first()[0] or 0
    roots = _roots(out.filter("form is not null"), most)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
