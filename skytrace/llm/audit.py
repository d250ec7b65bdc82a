"""Filter interaction audit: what each document filter removes, alone and after the others.

One table-driven finite-state pass over the UTF-8 bytes of a text counts its words, capitals, code
points and symbols. ``STEP`` gives the state after a byte class (in a word or not) and ``EMIT`` the
outputs of (state, class); as the state after a byte depends on that byte's class alone, a whole batch
of texts takes the step at once. The word spans go into an open-addressed hash table in which an
entry counts as equal only when its bytes are equal; its size is the number of distinct words.

Filters: A too few words, B too few distinct ones, C too many capitals, D a forbidden symbol, E a copy of a
document of smaller id. Copies are equal by SHA-256. Of a group of copies only counts leave the tasks, so a
group of any size is a few rows after the first partial aggregate; each document ends as one of 32
failure masks, and a row of the audit is a sum over masks.

Defined cases: a null text is empty, a null part is the empty string. A document without id is not a copy
of another and makes none one; repeated rows of one id are not copies of each other. A document
has a label value 1 if any labels row of its id has. No documents: no rows. Texts of any length are read
whole, one at a time beyond ``PIECE_BYTES``. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_class, col, mix64, pieces, row_of, same_bytes, text_buffer, word_hashes

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3  # words, percent of words, percent of code points

# ----------------------------------------------------------------- the transducer
#: Byte classes: blank, letter A-Z, forbidden symbol, further byte of a code point, any other byte.
BLANK, CAPITAL, SYMBOL, FURTHER, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[byte_class(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)] = BLANK
KIND[byte_class(lambda b: 0x41 <= b <= 0x5A)] = CAPITAL
KIND[byte_class(lambda b: b in SYMBOLS)] = SYMBOL
KIND[byte_class(lambda b: 0x80 <= b <= 0xBF)] = FURTHER

OUT, IN = 0, 1
STEP = np.array([OUT, IN, IN, IN, IN], np.uint8)  # by class; the same from either state
STARTS, ENDS, IS_POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16
_OF_CLASS = np.array([IS_POINT, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, 0, IS_POINT], np.uint8)
EMIT = np.stack([_OF_CLASS | np.where(STEP == IN, STARTS, 0), _OF_CLASS | np.where(STEP == OUT, ENDS, 0)]).astype(np.uint8)


def transduce(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(outputs of every byte, starts and ends of the words); each row begins in state OUT and its end
    ends a word."""
    kind = KIND[data]
    after = STEP[kind]
    before = np.empty_like(after)
    before[1:], before[:1] = after[:-1], OUT
    edge = offs[:-1][np.diff(offs) > 0]
    open_end = edge[1:][before[edge[1:]] == IN]  # rows whose text ends inside a word
    before[edge] = OUT
    out = EMIT[before, kind]
    ends = np.concatenate([np.flatnonzero(out & ENDS), open_end, [len(data)] if len(data) and after[-1] == IN else []])
    return out, np.flatnonzero(out & STARTS), np.sort(ends).astype(np.int64)


def first_of_row(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray,
                 keys: np.ndarray | None = None) -> np.ndarray:
    """Whether each word span is the one that its row holds in the hash table (one span for each
    distinct word of a row). Equality is by bytes; the hash only chooses the slot."""
    n = len(starts)
    if not n:
        return np.zeros(0, bool)
    padded = np.append(data, np.zeros(8, np.uint8))
    keys = word_hashes(data, starts, ends) if keys is None else keys
    size, mask = ends - starts, (1 << int(2 * n - 1).bit_length()) - 1
    slot = (mix64(keys + mix64(row.astype(np.uint64))) & np.uint64(mask)).astype(np.int64)
    held, holds, live = np.full(mask + 1, -1), np.zeros(n, bool), np.arange(n)
    while len(live):
        at = slot[live]
        free = held[at] < 0
        held[at[free]] = live[free]  # one of the spans that want a free slot gets it
        there = held[at]
        holds[live[there == live]] = True
        alike = (row[there] == row[live]) & (size[there] == size[live])
        alike[alike] = same_bytes(padded, starts[there[alike]], starts[live[alike]], size[live[alike]])
        live = live[~alike]  # a holder is alike to itself
        slot[live] = (slot[live] + 1) & mask
    return holds


def text_counts(arr) -> dict[str, np.ndarray]:
    """words, distinct, capitals, points and symbols of every text of an Arrow array."""
    data, offs = text_buffer(arr)
    out, starts, ends = transduce(data, offs)
    at = np.searchsorted(starts, offs)

    def per_row(bit: int) -> np.ndarray:
        spots = np.flatnonzero(out & bit)
        return np.diff(np.searchsorted(spots, offs))

    row = row_of(at)
    new = first_of_row(data, starts, ends, row)
    return {"words": np.diff(at), "distinct": np.bincount(row[new], minlength=len(offs) - 1),
            "capitals": per_row(IS_CAPITAL), "points": per_row(IS_POINT), "symbols": per_row(IS_SYMBOL)}


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        c = text_counts(col(b, "_text"))
        fails = [c["words"] < MIN_WORDS, 100 * c["distinct"] < MIN_DISTINCT * c["words"],
                 100 * c["capitals"] > MAX_CAPITALS * c["points"], c["symbols"] > 0]
        mask = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
        yield pa.RecordBatch.from_arrays([*(col(b, x) for x in ("_id", "_part", "_digest")), pa.array(mask, pa.int32())],
                                         names=["_id", "_part", "_digest", "_mask"])


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """_part, _mask (bit k: fails filter k), _good, _toxic, _n: documents counted by what they fail."""
    text = F.coalesce(docs[text_col], F.lit(""))
    d = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("_part"),
                    F.unhex(F.sha2(text.cast("binary"), 256)).alias("_digest"), text.alias("_text"))
    d = d.mapInArrow(_masks, "_id long, _part string, _digest binary, _mask int")
    has = lambda c: F.max(F.coalesce(labels[c] == 1, F.lit(False)))
    marks = (labels.filter(labels[id_col].isNotNull()).groupBy(labels[id_col].cast("long").alias("_id"))
             .agg(has("quality").alias("_good"), has("toxic").alias("_toxic")))
    kind = ["_digest", "_part", "_mask", "_good", "_toxic"]
    d = (d.join(marks, "_id", "left")
         .select("_id", "_digest", "_part", "_mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("_good", "_toxic")]))
    # rows of one id first, so that the least id of a group of copies comes with the number of its rows
    rows = d.groupBy("_id", *kind).agg(F.count("*").alias("_n"))
    named = F.when(F.col("_id").isNotNull(), F.struct("_id", "_n"))
    groups = rows.groupBy(*kind).agg(F.sum("_n").alias("_n"), F.min(named).alias("_least"),
                                     F.sum(F.when(F.col("_id").isNull(), F.col("_n")).otherwise(0)).alias("_nameless"))
    first = groups.groupBy("_digest").agg(F.min("_least._id").alias("_first"))
    groups = groups.join(first, "_digest")
    originals = F.col("_nameless") + F.when(F.col("_least._id") == F.col("_first"), F.col("_least._n")).otherwise(0)
    copies = 1 << FILTERS.index("E")
    split = F.explode(F.array(F.struct(F.col("_mask").alias("m"), originals.alias("n")),
                              F.struct((F.col("_mask") + copies).alias("m"), (F.col("_n") - originals).alias("n"))))
    return (groups.select("_part", "_good", "_toxic", split.alias("_s")).filter("_s.n > 0")
            .groupBy("_part", F.col("_s.m").alias("_mask"), "_good", "_toxic").agg(F.sum("_s.n").alias("_n")))


def _bit(c: str) -> int:
    return 1 << FILTERS.index(c)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    by_mask = failures(docs, labels, part).groupBy("_part", "_mask").agg(
        F.sum("_n").alias("_n"), *[F.sum(F.when(F.col(c), F.col("_n")).otherwise(0)).alias(c) for c in ("_good", "_toxic")])
    # what a step does depends on its filter and on the set of filters before it alone
    steps = [(before, _bit(c)) for before in range(32) for c in FILTERS if not before & _bit(c)]
    choice = F.explode(F.array(*[F.lit(s * 32 + f) for s, f in steps])).alias("_choice")
    each = by_mask.select("*", choice).select("*", F.floor(F.col("_choice") / 32).cast("int").alias("_before"),
                                              (F.col("_choice") % 32).alias("_filter"))
    fails = F.col("_mask").bitwiseAND(F.col("_filter")) != 0
    gone = F.col("_mask").bitwiseAND(F.col("_before")) != 0

    def total(when: Column, of: str = "_n") -> Column:
        return F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long")

    done = each.groupBy("_part", "_before", "_filter").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("_mask") == F.col("_filter")).alias("unique_fails"), total(fails & ~gone, "_good").alias("good_lost"),
        total(fails & ~gone, "_toxic").alias("toxic_lost"))
    orders = [("".join(p), k + 1, sum(_bit(c) for c in p[:k]), _bit(p[k])) for p in permutations(FILTERS) for k in range(5)]
    plan = docs.sparkSession.createDataFrame(orders, "filter_order string, step int, _before int, _filter int")
    out = done.join(F.broadcast(plan), ["_before", "_filter"])  # 600 rows
    return out.select(F.col("_part").alias("part"), "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                      "good_lost", "toxic_lost",
                      F.sum("removed").over(Window.partitionBy("_part", "_filter")).alias("shapley"))
