"""Pack-typed records and their long value series (signals / strings / enums) + pivot back.

The pack schema follows the nested container of the replaced engine: numeric fields are
widened to BIGINT (unsigned) / INT (signed) / DOUBLE, and the high-precision parts of the
two HP messages are integer fields there, so their sub-unit values truncate to 0. The GGA
hemisphere letters and the GSA mode letter are kept (documented deviation).

The long series are one narrow branch per message over a frame lake partitioned by
message (partition pruning: each branch reads its own partition), no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields as FT
from ..functions import sqltext
from ..session import materialise
from .state import latest_n
from .thinning import resample

_PACK_TYPE = {"u4": "bigint", "u2": "bigint", "u1": "bigint", "i4": "int", "i2": "int", "i1": "int"}


def pack_fields(message: str) -> list[tuple[str, str]]:
    """(field, Spark type) of a pack record, after ``_inner_timestamp``."""
    if message == "GGA":
        return [("time", "string"), ("latitude", "double"), ("north_south", "string"), ("longitude", "double"),
                ("east_ovest", "string"), ("fix", "bigint"), ("satellites", "bigint"),
                ("horizontal_diluition_precision", "double"), ("altitude", "double"),
                ("age_of_correction", "double")]
    if message == "VTG":
        return [(c, "double") for c in FT.NMEA_COLUMNS["VTG"]]
    if message == "GSA":
        return [("mode", "string")] + [(c, "double") for c in FT.NMEA_COLUMNS["GSA"][1:]]
    out = []
    hp = {h for _, h in FT.HP_ADD.get(message, [])}
    for f in FT.UBX_FIELDS[message]:
        if f.name in hp:
            out.append((f.name, "int"))                      # integer field in the pack
        elif f.kind == "double" or f.kind == "trunc":
            out.append((f.name, "double"))
        else:
            t = _PACK_TYPE[f.wire]
            if message == "NAV_RELPOSNED" and f.name in ("iTOW", "flags"):
                t = "bigint"
            out.append((f.name, t))
    return out


def pack_values(message: str, compat: bool = True) -> dict[str, str]:
    """SQL of every pack field, pack-typed (``_inner_timestamp`` first)."""
    vals = sqltext.values(message, compat)
    out = {"_inner_timestamp": "CAST(ts_us AS BIGINT)"}
    for name, t in pack_fields(message):
        out[name] = f"CAST({vals[name]} AS {t.upper()})"
    return out


def pack_record(message: str, body: Column = None, ts: Column = None, compat: bool = True) -> Column:
    """struct(_inner_timestamp, <pack fields>) of a frame of ``message`` (columns body, ts_us)."""
    vals = pack_values(message, compat)
    return F.expr("named_struct(" + ", ".join(f"{sqltext.lit(n)}, {v}" for n, v in vals.items()) + ")")


def _series_values(message: str, rec: dict, kind: str) -> list[tuple[str, str]]:
    """(field, SQL value) of one record for signals (DOUBLE) / strings (STRING) / enums (BIGINT)."""
    items = []
    if kind == "signals":
        items.append(("_timestamp", f"CAST({rec['_inner_timestamp']} AS DOUBLE)"))
        for name, t in pack_fields(message):
            if t != "string":
                items.append((name, f"CAST({rec[name]} AS DOUBLE)"))
    elif kind == "strings":
        for name in FT.SERIES_STRINGS.get(message, []):
            if name == "fix_state":
                v = sqltext.fix_state_name(rec["fix"])
            elif name == "time":
                v = f"substring({rec['time']}, 1, 9)"
            else:
                v = rec[name]
            items.append((name, f"CAST({v} AS STRING)"))
    else:
        for name, src in FT.SERIES_ENUMS.get(message, []):
            items.append((name, f"CAST({rec[src]} AS BIGINT)"))
    return items


def series_long(classified: DataFrame, kind: str = "signals", compat: bool = True,
                messages=None) -> DataFrame:
    """Long value series ``(device_id, message, field, idx, value)`` of decoded OK frames.

    ``kind``: ``signals`` (DOUBLE, `_timestamp` included), ``strings`` or ``enums`` (BIGINT).
    ``message`` carries the short series label (GGA ... VELNED without ``NAV_``); ``idx`` is
    the frame's arrival key ``seq``.

    One narrow branch per message: decode into columns, then ``unpivot`` (an Expand over
    column references, so the decode projection keeps small per-field expressions). On a
    frame lake partitioned by ``message`` each branch reads only its own partition, so the
    whole reshape reads the data once.
    """
    messages = messages or FT.ALL_MESSAGES
    parts = []
    for m in messages:
        items = _series_values(m, pack_values(m, compat), kind)
        if not items:
            continue
        decoded = (classified.filter((F.col("message") == m) & (F.col("parse_result") == "OK"))
                   .select("device_id", F.lit(FT.SERIES_LABEL[m]).alias("message"), F.col("seq").alias("idx"),
                           *[F.expr(v).alias(n) for n, v in items]))
        branch = (decoded.unpivot(["device_id", "message", "idx"], [n for n, _ in items], "field", "value")
                  .select("device_id", "message", "field", "idx", "value"))
        parts.append(branch)
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def unpack_series(packs: DataFrame, kind: str = "signals", resample_us: int = 0, capacity: int = 2000) -> DataFrame:
    """Long value series ``(device_id, message, field, idx, value)`` from a pack table.

    The records of all lists are resampled per (device, message) in pack order, the newest
    ``capacity`` of each are kept, and their fields unpivoted. ``idx`` is the position among the
    kept ones, 0 = oldest. Thinning and retention run on one narrow table of record times; the
    values are joined to it by (device, message, pack, position).
    """
    lists = {m: packs.select("device_id", "pack_id", F.posexplode(FT.PACK_LIST[m]).alias("pos", "r")) for m in FT.ALL_MESSAGES}
    times = None
    for m, rows in lists.items():
        t = rows.select("device_id", F.lit(m).alias("message"), F.struct("pack_id", "pos").alias("seq"),
                        F.col("r._inner_timestamp").alias("ts_us"))
        times = t if times is None else times.unionByName(t)
    kept = latest_n(resample(times, resample_us), capacity=capacity).select("device_id", "message", "seq", "idx")
    kept = materialise(kept, "retained")
    out = None
    for m, rows in lists.items():
        rec = {"_inner_timestamp": "r._inner_timestamp"} | {n: f"r.`{n}`" for n, _ in pack_fields(m)}
        items = _series_values(m, rec, kind)
        if not items:
            continue
        mine = kept.filter(F.col("message") == m).drop("message")
        cols = (rows.withColumn("seq", F.struct("pack_id", "pos")).join(mine, ["device_id", "seq"])
                .select("device_id", F.lit(FT.SERIES_LABEL[m]).alias("message"), "idx", *[F.expr(v).alias(n) for n, v in items]))
        part = (cols.unpivot(["device_id", "message", "idx"], [n for n, _ in items], "field", "value")
                .select("device_id", "message", "field", "idx", "value"))
        out = part if out is None else out.unionByName(part)
    return out


def series_pivot(series: DataFrame, message: str) -> DataFrame:
    """Rebuild the table of one message from its long signals: one row per (device_id, idx).

    The long rows are exchanged by (device_id, idx) before they are grouped, so a task's hash table holds the whole
    rows of one partition, a column a field; ``pivot`` would first group by field too, in the task that reads.
    """
    label = FT.SERIES_LABEL[message]
    names = ["_timestamp"] + [n for n, t in pack_fields(message) if t != "string"]
    at = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("field")).cast("int").alias("_at")
    rows = series.filter(F.col("message") == label).select("device_id", "idx", at, "value").repartition("device_id", "idx")
    values = [F.first(F.when(F.col("_at") == i, F.col("value")), ignorenulls=True).alias(n) for i, n in enumerate(names, 1)]
    return rows.groupBy("device_id", "idx").agg(*values)


def aligned_series(classified: DataFrame, capacity: int = 2000, compat: bool = True, messages=None) -> DataFrame:
    """Per device a ``map<message, map<field, array<double>>>`` (column ``series``) of the newest ``capacity`` records of
    each message, oldest first. All arrays of a message are aligned: element k of any field belongs to
    element k of its ``_timestamp``. Retention is cut per (device, message) before anything is grouped."""
    ok = classified.filter((F.col("parse_result") == "OK") & F.col("message").isNotNull())
    kept = latest_n(ok.select("device_id", "message", "seq", "ts_us", "body"), capacity=capacity)
    out = None
    for m in messages or FT.ALL_MESSAGES:
        items = _series_values(m, pack_values(m, compat), "signals")
        rows = kept.filter(F.col("message") == m).select("device_id", F.struct("idx", *[F.expr(v).alias(n) for n, v in items]).alias("_r"))
        rows = rows.groupBy("device_id").agg(F.sort_array(F.collect_list("_r")).alias("_rs"))
        arrays = F.map_from_arrays(F.array(*[F.lit(n) for n, _ in items]), F.array(*[F.col(f"_rs.`{n}`") for n, _ in items]))
        part = rows.select("device_id", F.struct(F.lit(FT.SERIES_LABEL[m]).alias("key"), arrays.alias("value")).alias("_entry"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("device_id").agg(F.map_from_entries(F.collect_list("_entry")).alias("series"))


def series_slice(series: Column, message: str, field: str, start: int, n: int) -> Column:
    """Up to ``n`` values of one field from position ``start`` (0 = oldest) of an aligned series; null without the field."""
    values = F.try_element_at(F.try_element_at(series, F.lit(message)), F.lit(field))
    return F.slice(values, start + 1, n)
