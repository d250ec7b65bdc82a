"""Stateful streaming operators on Spark's arbitrary state (``transformWithState`` where nothing else is said, RocksDB state store).

* ``latest_records``: the newest N whole records of each key, as a log of changes;
* ``latest_state_stream``: at every frame the latest value of each field, per device (``applyInPandasWithState``, whose
  rows come as columns; the others are rebuilt row by row, which costs more the more columns there are);
* ``thin_events``: greedy minimum-gap thinning that passes its watermark on, so that windows can follow
  (``rate_packs``).

A key's rows of one micro-batch are ordered in its task; what they need at once is bounded by the size of a
micro-batch (``maxFilesPerTrigger``), the state by N records, one value a field, or one time a key. All
keep the keys of a bucket together (``streaming.buckets``). State is in RocksDB and
checkpointed, so a task that is run again, or a query that is restarted, gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import fields as FT
from ..operators.state import decoded_frames
from ..operators.thinning import rate_to_gap_us
from .buckets import BUCKETS, Keys, Thinned, bucketed, dense, in_order, restored

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def run_to_table(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available into a Parquet table (exactly once, by the sink's log), then stop."""
    with rocksdb_state(df.sparkSession):
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


# ------------------------------------------------------------------------- newest N records
class _LatestRecords(StatefulProcessor):
    """The newest records of a bucket's keys: the state holds, for each key, the orders and the rows of its records."""

    def __init__(self, columns: list[str], kinds: dict[str, str], keys: list[str], capacity: int):
        self.columns, self.capacity = columns, capacity
        self.keys = Keys(columns, kinds, keys)
        self.spec = f"{self.keys.state}, orders array<array<bigint>>, rows array<array<{kinds['_row']}>>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rings = handle.getValueState("rings", self.spec)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.rings.get() if self.rings.exists() else None
        known = self.keys.held(state)
        orders, records = ([], []) if state is None else (list(state[-2]), [[_plain(r) for r in held] for held in state[-1]])
        before = {}  # orders a key held, of the keys with new rows
        for pdf in rows:  # never more than the rings and one Arrow batch
            pdf.columns = self.columns
            at = self.keys.places(known, pdf)
            orders += [[] for _ in range(len(known) - len(orders))]
            records += [[] for _ in range(len(known) - len(records))]
            by = in_order(pdf, at, "_order")
            at = at[by]
            starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            stops = np.append(starts[1:], len(at))
            new_orders, new_rows = pdf["_order"].to_numpy()[by], pdf["_row"].to_numpy()[by]
            for k, i, j in zip(at[starts].tolist(), starts.tolist(), stops.tolist(), strict=True):
                before.setdefault(k, set(orders[k]))
                i = max(i, j - self.capacity)
                held = [*zip(orders[k], records[k], strict=True),
                        *((o, _plain(r)) for o, r in zip(new_orders[i:j].tolist(), new_rows[i:j], strict=True))]
                held = sorted(held, key=lambda x: x[0])[-self.capacity:]
                orders[k], records[k] = [o for o, _ in held], [r for _, r in held]
        columns = self.keys.columns_of(known)
        self.rings.update((*columns, orders, records))
        change = []
        for k, was in before.items():
            change += [(k, o, r, True) for o, r in zip(orders[k], records[k], strict=True) if o not in was]
            change += [(k, o, None, False) for o in sorted(was - set(orders[k]))]
        if change:
            out = pd.DataFrame({c: [v[k] for k, *_ in change] for c, v in zip(self.keys.columns, columns, strict=True)})
            out["_order"] = [o for _, o, _, _ in change]
            out["_row"] = [r for _, _, r, _ in change]
            out["_entered"] = [x for *_, x in change]
            yield out

    def close(self) -> None:
        pass


def _plain(row) -> tuple:
    return tuple(row) if isinstance(row, tuple) else tuple(row.values())


def latest_records(df: DataFrame, keys: list[str], order: str, capacity: int, buckets: int = BUCKETS) -> DataFrame:
    """Changes of the newest ``capacity`` records per key: (keys, _order, _row, _entered). A record that
    enters comes with all its columns; one that is pushed out with its ``order`` only. Keys without
    new records give nothing. ``order`` values are distinct within a key."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    rows = dense(df.select(*keys, F.col(order).cast("long").alias("_order"), row.alias("_row")))
    rows = bucketed(rows, keys, buckets)
    kinds = dict(rows.dtypes)
    processor = _LatestRecords(rows.columns, kinds, keys, capacity)
    out = ", ".join(f"`{c}` {kinds[c]}" for c in processor.keys.columns) + f", _order bigint, _row {kinds['_row']}, _entered boolean"
    changes = rows.groupBy("_bucket").transformWithStateInPandas(processor, out, "append", "none")
    return restored(changes, df.select(*keys), "_order", "_row", "_entered")


def current_records(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The records that entered and have not been pushed out, with their columns and ``idx`` (0 = oldest)."""
    from pyspark.sql import Window

    by = [*keys, "_order"]
    gone = changes.filter("not _entered").select(*[F.col(c).alias(f"_gone_{c}") for c in by])
    same = [F.col(c).eqNullSafe(F.col(f"_gone_{c}")) for c in by]  # a null key is a key
    kept = changes.filter("_entered").join(gone, same, "left_anti")
    own = Window.partitionBy(*keys).orderBy("_order")
    return kept.select(*keys, "_row.*", (F.row_number().over(own) - 1).cast("bigint").alias("idx"))


# ------------------------------------------------------------------------- latest state
class _Carried:
    """Latest values of a bucket's keys. A frame comes with the fields of its own message alone, in slots that the
    messages share: numbers as doubles (decoded integers are below 2^53) with a bit in ``_valid`` for each that is not
    null, and texts. Rows that leave have every field, and bits in ``_has`` for the numbers that are known. The state holds
    the fields of each key, a row a field, and which of them are known.

    What is carried together is a unit, (number of a message, places of its fields): a whole message or one field.
    """

    def __init__(self, columns: list[str], kinds: dict[str, str], keys: list[str], passed: list[str], fields: dict[str, dict[str, str]], together: set[str]):
        self.columns, self.passed = columns, passed
        self.keys = Keys(columns, kinds, keys)
        self.places, self.slots = {}, []  # place of each field, numbers first; its (is a text, slot)
        for text in (False, True):
            for m, fl in fields.items():
                for k, f in enumerate(f for f, t in fl.items() if (t == "string") == text):
                    self.places[m, f] = len(self.slots)
                    self.slots.append((text, k))
        self.names = [f"{m}_{f}" for m, f in self.places]
        self.numbers = sum(not text for text, _ in self.slots)
        self.units, self.bits, self.leads = [], {}, {}  # bit of each number; the numbers it is read from
        for i, (m, fl) in enumerate(fields.items()):
            own = [self.places[m, f] for f in fl]
            self.units += [(i, own)] if m in together else [(i, [p]) for p in own]
            for p in own:
                if not self.slots[p][0]:
                    if m not in FT.UBX_FIELDS or p == own[0]:  # the fields of a UBX frame are never null
                        self.leads[p] = len(self.leads)
                    self.bits[p] = len(self.leads) - 1
        self.state = f"{self.keys.state}, numbers binary, known binary, texts array<array<string>>"

    def _held(self, state, old: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, known, texts) of ``n`` keys, of which the state has the first ``old``."""
        numbers, known = np.zeros((self.numbers, n)), np.zeros((len(self.slots), n), bool)
        texts = np.full((len(self.slots) - self.numbers, n), None, object)
        if old:
            held, which, words = state[len(self.keys.columns):]
            numbers[:, :old] = np.frombuffer(held, np.float64).reshape(-1, old)
            known[:, :old] = np.frombuffer(which, bool).reshape(-1, old)
            for i, v in enumerate(words):
                texts[i, :old] = v
        return numbers, known, texts

    def fold(self, pdfs: list[pd.DataFrame], state) -> tuple[Iterator[pd.DataFrame], tuple]:
        """(every row with its latest values, in pieces; state after them)"""
        pdf = pd.concat(pdfs, ignore_index=True)
        pdf.columns = self.columns  # names with a leading underscore come numbered
        seen = self.keys.held(state)
        old = len(seen)
        at = self.keys.places(seen, pdf)
        by = in_order(pdf, at, "_order")
        at, n, keys = at[by], len(pdf), len(seen)
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        stops = np.append(starts[1:], n) - 1
        begin = np.repeat(starts, stops - starts + 1)
        message, valid = pdf["_message"].to_numpy()[by], pdf["_valid"].to_numpy()[by]
        numbers, known, texts = self._held(state, old, keys)
        values, sources = {}, []
        for i, places in self.units:
            hit = message == i
            if len(places) == 1:
                text, slot = self.slots[places[0]]
                hit &= pdf[f"_t{slot}"].notna().to_numpy()[by] if text else (valid >> slot) & 1 == 1
            spots = np.flatnonzero(hit)
            last = np.maximum.accumulate(np.where(hit, np.arange(n), -1))
            # where the values of each row are: at its key's place in the state or, behind these, with the frames that have the unit
            source = np.where(last >= begin, keys + np.cumsum(hit) - 1, at)
            sources.append(source)
            for p in places:
                text, slot = self.slots[p]
                new = pdf[f"_t{slot}" if text else f"_n{slot}"].to_numpy()[by[spots]]
                held = texts[p - self.numbers] if text else numbers[p]
                value = np.concatenate([held, new])
                there = np.concatenate([known[p], ~pd.isna(new) if text else (valid[spots] >> slot) & 1 == 1])
                values[p] = value, there
                held[at[stops]], known[p, at[stops]] = value[source[stops]], there[source[stops]]
        rows = {c: pdf[c].to_numpy()[by] for c in self.passed}
        after = (*self.keys.columns_of(seen), numbers.tobytes(), known.tobytes(), [t.tolist() for t in texts])
        return self._rows(rows, values, sources, n), after

    def _rows(self, rows: dict[str, np.ndarray], values: dict, sources: list[np.ndarray], n: int) -> Iterator[pd.DataFrame]:
        for i in range(0, n, _PIECE):
            out = {c: v[i:i + _PIECE] for c, v in rows.items()}
            has = np.zeros(min(_PIECE, n - i), np.int64)
            for (_, places), source in zip(self.units, sources, strict=True):
                of = source[i:i + _PIECE]
                for p in places:
                    value, there = values[p]
                    out[self.names[p]] = value.take(of)
                    if p in self.leads:
                        has |= there.take(of).astype(np.int64) << self.leads[p]
            yield pd.DataFrame(out | {"_has": has.astype(np.float64)})


#: Rows that leave at once with all their fields.
_PIECE = 8192


def latest_state_stream(classified: DataFrame, selection: dict[str, list[str]], per_field: bool = True, keys=("device_id",),
                        order: str = "seq", compat: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """Streaming ``latest_state``: every frame with the latest value of each selected (message, field), across
    micro-batches that come in arrival order."""
    keys, base = list(keys), [*keys, "_order", "ts_us"]
    selection = {m: fl for m, fl in selection.items() if fl}
    decoded, _, _ = decoded_frames(classified, selection, False, compat)
    kinds = {m: {f.name: f.dataType.simpleString() for f in decoded.schema[m].dataType} for m in selection}
    known = F.coalesce(*[F.when(F.col(m).isNotNull(), i) for i, m in enumerate(selection)], F.lit(-1))
    slots = {}
    for m, fl in kinds.items():
        for text in (False, True):
            for k, f in enumerate(f for f, t in fl.items() if (t == "string") == text):
                slots.setdefault(f"_{'t' if text else 'n'}{k}", []).append(F.col(m)[f] if text else F.col(m)[f].cast("double"))
    rows = decoded.select(*keys, F.col(order).cast("long").alias("_order"), "ts_us", known.alias("_message"),
                          *[F.coalesce(*c).alias(s) for s, c in slots.items()])
    valid = [F.when(F.col(s).isNotNull(), F.lit(1 << int(s[2:])).cast("long")).otherwise(F.lit(0).cast("long")) for s in slots if s[1] == "n"]
    total = F.lit(0).cast("long")
    for v in valid:
        total = total.bitwiseOR(v)
    rows = rows.select(*base, "_message", total.alias("_valid"), *[F.coalesce(F.col(s), F.lit(0.0)).alias(s) if s[1] == "n" else F.col(s) for s in slots])
    frames, given = rows.select(*base), rows.columns[len(base):]
    rows = bucketed(dense(rows, given), keys, buckets)
    types = dict(rows.dtypes)
    passed = [c for c in rows.columns if c not in given and c != "_bucket"]
    spec = _Carried(rows.columns, types, keys, passed, kinds, {m for m in selection if not per_field or m in FT.UBX_FIELDS})

    def fold(key, pdfs, state):
        out, after = spec.fold(list(pdfs), state.get if state.exists else None)
        state.update(after)
        yield from out

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in passed), *(f"`{c}` {'string' if text else 'double'}" for c, (text, _) in zip(spec.names, spec.slots, strict=True)), "_has double"])
    carried = rows.groupBy("_bucket").applyInPandasWithState(fold, schema, spec.state, "append", GroupStateTimeout.NoTimeout)
    has = F.col("_has").cast("long")
    columns = []
    for m, fl in kinds.items():
        for f, t in fl.items():
            c, p = f"{m}_{f}", spec.places[m, f]
            value = F.coalesce(F.col(c), F.lit(float("nan"))) if t == "double" else F.col(c).cast(t)  # a NaN leaves pandas as a null
            columns.append((F.col(c) if t == "string" else F.when(has.bitwiseAND(F.lit(1 << spec.bits[p]).cast("long")) != 0, value)).alias(c))
    return restored(carried, frames, *columns).withColumnRenamed("_order", order)


# ------------------------------------------------------------------------- packs with a rate
class _Thin(StatefulProcessor):
    def __init__(self, thinned: Thinned):
        self.thinned = thinned

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.thinned.state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        keep, after = self.thinned.fold(list(rows), self.last.get() if self.last.exists() else None)
        self.last.update(after)
        yield keep

    def close(self) -> None:
        pass


def thin_events(df: DataFrame, keys: list[str], order: str, gap_us: int, event_time: str, buckets: int = BUCKETS) -> DataFrame:
    """Thinning of a stream whose ``event_time`` column has a watermark; kept rows carry it on. The least
    state is one time a key, kept as long as the query."""
    rows = bucketed(dense(df), keys, buckets)
    spec = Thinned(rows.columns, dict(rows.dtypes), keys, order, "ts_us", int(gap_us))
    kept = rows.groupBy("_bucket").transformWithStateInPandas(_Thin(spec), rows.schema, "append", "eventTime", eventTimeColumnName=event_time)
    return restored(kept, df)


def rate_packs(classified: DataFrame, rate_hz: float, pack: str = "1 day", delay: str = "1 hour", compat: bool = True) -> DataFrame:
    """Streaming packs of rate-limited records: thinning per (device, message), then event-time windows per device
    closed by the same watermark. Output = batch ``pack_build`` with a rate."""
    from .stream import _windowed_packs

    ok = (classified.filter((F.col("parse_result") == "OK") & F.col("message").isNotNull())
          .select("device_id", "message", "seq", "ts_us", "body", F.timestamp_micros("ts_us").alias("_et"))
          .withWatermark("_et", delay))
    kept = thin_events(ok, ["device_id", "message"], "seq", rate_to_gap_us(rate_hz), "_et") if rate_hz else ok
    return _windowed_packs(kept, pack, compat)


