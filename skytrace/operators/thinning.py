"""Greedy minimum-gap thinning (rate limit / resample) per key, exact, one path for every size.

Semantics, per key in arrival order, starting with ``last = 0``: a row is kept iff
``ts < last`` (an unsigned difference wraps, so backward jumps are kept) or
``ts - last >= gap``; a kept row sets ``last = ts``. A gap of 0 keeps every row.

1. The input is evaluated once: its rows, or where there are further columns all of it with a row id, are written.
2. (keys, order, ts) are range-partitioned and sorted; ranges are balanced whatever the order values are, and cut
   through a hot key. One Python pass folds every key that begins in a range; its kept rows are decided. The
   first key of a range may have begun in another one: its rows stay open, and their stretch is summarised as
   a function of the state that enters, as rows (value, exit) of its running extremes. Decided, open and
   summary rows are written together; dropped rows are not.
3. Per key, the summaries are streamed in range order, which gives each range its entry state.
4. Open rows are replayed range by range from that state (one broadcast row a range).

A kept row's successor is the first later row outside [ts, ts + gap); it is found for all rows at
once by descending block extremes (n log n in numpy, any order of ts), and the kept rows are
the path of successors, marked by pointer doubling. Rows travel as Arrow, so keys keep their
type; null keys are one key. Ties in the order column go by ts; rows without ts are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import materialise

#: Rows of one key whose summary a task holds at once; a longer stretch has several.
STRETCH_ROWS = 1 << 18
_ROW, _ENTRY, _ID = "_thin_row", "_thin_entry", "_thin_id"
_TOP = np.iinfo(np.int64).max


def rate_to_gap_us(rate_hz: float) -> int:
    """Rate limit in Hz -> equivalent minimum gap in µs (``1e6/rate > dt`` drops; 0 keeps all)."""
    if not rate_hz:
        return 0
    return max(1, math.ceil(1.0e6 / rate_hz))


# ---------------------------------------------------------------------------- the fold
def _first_outside(ts: np.ndarray, start: np.ndarray, stop: np.ndarray, low: np.ndarray, gap: int) -> np.ndarray:
    """Per query, the first position from ``start`` whose ts is outside [low, low + gap), else ``stop``."""
    n = len(ts)
    high = np.where(low > _TOP - gap, _TOP, low + gap)
    levels = [(ts, ts)]
    while 2 ** len(levels) <= n:
        a, b = levels[-1]
        w = 2 ** (len(levels) - 1)
        levels.append((np.minimum(a[:-w], a[w:]), np.maximum(b[:-w], b[w:])))
    pos = start.copy()
    for k in range(len(levels) - 1, -1, -1):
        a, b = levels[k]
        at = np.minimum(pos, len(a) - 1)
        skip = (pos + 2 ** k <= stop) & (a[at] >= low) & (b[at] < high)
        pos[skip] += 2 ** k
    return pos


def fold_runs(ts: np.ndarray, starts: np.ndarray, entry: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Fold many runs at once: run r is ``ts[starts[r]:starts[r + 1]]`` and is entered with the state
    ``entry[r]``. Returns (keep flags, state after each run)."""
    n = len(ts)
    keep = np.zeros(n, bool)
    if not n:
        return keep, entry.copy()
    ends = np.append(starts[1:], n)
    if gap <= 0:
        keep[:] = True
        return keep, ts[ends - 1]
    stop = np.repeat(ends, ends - starts)
    jump = np.append(_first_outside(ts, np.arange(1, n + 1), stop, ts, gap), n)
    jump[:-1][jump[:-1] == stop] = n  # left the run
    first = _first_outside(ts, starts, ends, entry, gap)
    keep = np.zeros(n + 1, bool)
    keep[first[first < ends]] = True
    steps = [jump]
    while (steps[-1] < n).any():
        steps.append(steps[-1][steps[-1]])
    for step in reversed(steps):
        keep[step[np.flatnonzero(keep)]] = True
    keep = keep[:-1]
    spots = np.flatnonzero(keep)
    last = np.searchsorted(spots, ends) - 1
    some = (last >= 0) & (spots[np.maximum(last, 0)] >= starts) if len(spots) else np.zeros(len(starts), bool)
    out = entry.copy()
    out[some] = ts[spots[last[some]]]
    return keep, out


def fold_keep(ts: np.ndarray, gap: int, last: int = 0) -> np.ndarray:
    """Keep flags of one series in arrival order, entered with the state ``last``."""
    return fold_runs(np.asarray(ts, np.int64), np.array([0]), np.array([last]), int(gap))[0]


def summary(ts: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, exit) rows of a stretch: entered with state s, the first value outside [s, s + gap)
    tells the exit state; without one the state stays s. Only running extremes can be first."""
    low, high = np.minimum.accumulate(ts), np.maximum.accumulate(ts)
    new = np.ones(len(ts), bool)
    new[1:] = (low[1:] < low[:-1]) | (high[1:] > high[:-1])
    n = len(ts)
    jump = _first_outside(ts, np.arange(1, n + 1), np.full(n, n), ts, gap)
    end = np.where(jump >= n, np.arange(n), jump)
    while not np.array_equal(further := end[end], end):
        end = further
    spots = np.flatnonzero(new)
    # a row kept whatever the state (gap away from its predecessor) leaves nothing to the entry
    sure = np.flatnonzero(np.abs(np.diff(ts)) >= gap)
    if len(sure):
        spots = spots[spots <= sure[0] + 1]
        if not len(spots) or spots[-1] != sure[0] + 1:
            spots = np.append(spots, sure[0] + 1)
    return ts[spots], ts[end[spots]]


# ----------------------------------------------------------------------------- batches
def _changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where the key differs from the row before (null equals null); the first row counts as new."""
    out = np.zeros(batch.num_rows, bool)
    out[:1] = True
    for k in keys:
        a = batch.column(batch.schema.get_field_index(k))
        x, y = a.slice(1), a.slice(0, max(len(a) - 1, 0))
        differs = pc.fill_null(pc.not_equal(x, y), False)
        out[1:] |= np.asarray(pc.or_(differs, pc.xor(pc.is_null(x), pc.is_null(y))))
    return out


def _key(batch: pa.RecordBatch, keys: list[str], row: int) -> tuple:
    return tuple(batch.column(batch.schema.get_field_index(k))[row].as_py() for k in keys)


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(batch.schema.get_field_index(name))).astype(np.int64, copy=False)


#: Marks of written rows, and kinds of summary rows.
DECIDED, OPEN, SUMMARY = 1, 2, 3
RANGE_HEAD, STRETCH_HEAD, VALUE, KNOWN = 0, 1, 2, 3
_EXTRA = {"_mark": pa.int32(), "_part": pa.int32(), _ROW: pa.int64(), "_kind": pa.int32(), "_value": pa.int64(), "_exit": pa.int64()}
_EXTRA_DDL = f"_mark int, _part int, {_ROW} long, _kind int, _value long, _exit long"


def _named(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


class _Range:
    """The rows of one range, in order: keys that begin in it are folded at once, its first key stays open."""

    def __init__(self, part: int, keys: list[str], cols: list[str], gap: int, stretch: int):
        self.part, self.keys, self.cols, self.gap, self.stretch = part, keys, cols, gap, stretch
        self.key, self.state, self.first = None, 0, True
        self.rows = self.steps = 0
        self.held: list[np.ndarray] = []
        self.own = None

    def _out(self, batch: pa.RecordBatch, mark: int, **extra) -> pa.RecordBatch:
        n = batch.num_rows
        extra |= {"_mark": np.full(n, mark, np.int32), "_part": np.full(n, self.part, np.int32)}
        more = [pa.array(extra[c], t) if c in extra else pa.nulls(n, t) for c, t in _EXTRA.items()]
        return pa.RecordBatch.from_arrays([*(_named(batch, c) for c in self.cols), *more], names=[*self.cols, *_EXTRA])

    def _summary(self, kind: list[int], value, exit_) -> pa.RecordBatch:
        same = self.own.take(pa.array(np.zeros(len(kind), np.int64)))
        steps = np.arange(self.steps, self.steps + len(kind))
        self.steps += len(kind)
        return self._out(same, SUMMARY, **{_ROW: steps, "_kind": kind, "_value": value, "_exit": exit_})

    def close(self) -> pa.RecordBatch:
        """The summary of the open rows since the last one."""
        value, exit_ = summary(np.concatenate(self.held), self.gap)
        kind = [STRETCH_HEAD if self.steps else RANGE_HEAD] + [VALUE] * len(value)
        self.held = []
        return self._summary(kind, np.append(0, value), np.append(0, exit_))

    def feed(self, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ts, new = _longs(b, "_thin_ts"), _changes(b, self.keys)
        new[0] = self.key is not None and _key(b, self.keys, 0) != self.key
        at = 0
        if self.first:
            if self.own is None:
                self.own = b.slice(0, 1)
            at = int(new.argmax()) if new.any() else b.num_rows
            if at:
                yield self._out(b.slice(0, at), OPEN, **{_ROW: np.arange(self.rows, self.rows + at)})
                self.held.append(ts[:at])
                if sum(map(len, self.held)) >= self.stretch:
                    yield self.close()
            if at < b.num_rows:
                if self.held:
                    yield self.close()
                self.first = False
        self.rows += at
        if at < b.num_rows:
            starts = np.flatnonzero(new[at:])
            entry = np.zeros(len(starts), np.int64)
            if not len(starts) or starts[0]:
                starts, entry = np.append(0, starts), np.append(self.state, entry)
            keep, after = fold_runs(ts[at:], starts, entry, self.gap)
            self.state, self.own = int(after[-1]), b.slice(b.num_rows - 1)
            if keep.any():
                yield self._out(b.slice(at).filter(pa.array(keep)), DECIDED)
        self.key = _key(b, self.keys, b.num_rows - 1)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield self.close()
        if not self.first:  # the last key began in this range, so the state it leaves is known
            yield self._summary([KNOWN], [0], [self.state])


def _fold(keys: list[str], cols: list[str], gap: int, stretch: int):
    """Sorted rows of one range -> its decided, open and summary rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = _Range(TaskContext.get().partitionId(), keys, cols, gap, stretch)
        for b in batches:
            if b.num_rows:
                yield from here.feed(b)
        yield from here.end()

    return run


def _stitch(keys: list[str], gap: int):
    """Summaries sorted by (keys, _part, step) -> (_part, state that enters the range's first key)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, 0, True
        for b in batches:
            if not b.num_rows:
                continue
            out, new = [], _changes(b, keys)
            new[0] = key is None or _key(b, keys, 0) != key
            for fresh, part, kind, value, exit_ in zip(new.tolist(), *(_named(b, c).to_pylist() for c in ("_part", "_kind", "_value", "_exit")), strict=True):
                state = 0 if fresh else state
                if kind == KNOWN:
                    state = exit_
                elif kind == VALUE:
                    if not done and (value < state or value - state >= gap):
                        state, done = exit_, True
                else:
                    done = False
                    if kind == RANGE_HEAD:
                        out.append((part, state))
            key = _key(b, keys, b.num_rows - 1)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64()), strict=True)],
                                                 names=["_part", _ENTRY])

    return run


def _replay(gap: int, cols: list[str]):
    """Open rows sorted by (_part, row), each with the state that enters its range -> those that are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            parts, ts, given = _longs(b, "_part"), _longs(b, "_thin_ts"), _longs(b, _ENTRY)
            starts = np.flatnonzero(np.append(parts[0] != part, parts[1:] != parts[:-1]))
            entry = given[starts]
            if not len(starts) or starts[0]:
                starts, entry = np.append(0, starts), np.append(state, entry)
            keep, after = fold_runs(ts, starts, entry, gap)
            part, state = parts[-1], int(after[-1])
            if keep.any():
                yield b.select(cols).filter(pa.array(keep))

    return run


def thin(df: DataFrame, keys: list[str], order: str, ts: str, gap_us: int, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Rows of ``df`` kept by greedy minimum-gap thinning per ``keys`` in ``order``.

    The input and the folded rows are written to the shared folder when this is called. Columns other than ``keys``,
    ``order`` and ``ts`` do not take part: they are joined back to the rows that are kept. ``stretch_rows`` bounds
    what a summary holds; it does not change the result.
    """
    gap = int(gap_us)
    if gap <= 0:
        return df
    narrow = list(dict.fromkeys([*keys, order, ts]))
    wide = [c for c in df.columns if c not in narrow]
    base = df.filter(F.col(ts).isNotNull())
    if wide:
        base = base.withColumn(_ID, F.monotonically_increasing_id())
        narrow = [*narrow, _ID]
    base = materialise(base, "thin-input")
    by = [F.col(c).asc_nulls_first() for c in (*keys, order, ts)]
    rows = base.select(*narrow, F.col(ts).cast("long").alias("_thin_ts"))
    cols = rows.columns
    spec = StructType([*(StructField(f.name, f.dataType) for f in rows.schema), *StructType.fromDDL(_EXTRA_DDL).fields])
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = materialise(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(_fold(keys, cols, gap, stretch_rows), spec), "thin")
    steps = folded.filter(F.col("_mark") == SUMMARY).select(*keys, "_part", _ROW, "_kind", "_value", "_exit")
    entries = (steps.repartition(*keys).sortWithinPartitions(*keys, "_part", _ROW)
               .mapInArrow(_stitch(keys, gap), f"_part int, {_ENTRY} long"))  # one row a range
    open_ = folded.filter(F.col("_mark") == OPEN).select(*cols, "_part", _ROW).join(F.broadcast(entries), "_part")
    replayed = (open_.repartition("_part").sortWithinPartitions("_part", _ROW)
                .mapInArrow(_replay(gap, cols), StructType([StructField(f.name, f.dataType) for f in rows.schema])))
    kept = folded.filter(F.col("_mark") == DECIDED).select(*cols).unionByName(replayed)
    return base.join(kept.select(_ID), _ID, "left_semi").select(*df.columns) if wide else kept.select(*df.columns)


def downsample_rate(df: DataFrame, rate_hz: float, keys=("device_id", "message"), order="seq", ts="ts_us") -> DataFrame:
    """Pack-side rate limit: keep at most ``rate_hz`` records per second per key (0 keeps all)."""
    return thin(df, list(keys), order, ts, rate_to_gap_us(rate_hz))


def resample(df: DataFrame, resample_us: int, keys=("device_id", "message"), order="seq", ts="ts_us") -> DataFrame:
    """Unpack-side resample: drop while ``ts - last_kept < resample_us`` (0 keeps all)."""
    return thin(df, list(keys), order, ts, int(resample_us))
