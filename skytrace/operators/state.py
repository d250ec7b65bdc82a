"""Per-device state over arrival order: latest-known values, latest-N retention, buffer
read-outs, trimming and elapsed time. All are built-in window functions or aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fields as FT
from ..functions import sqltext
from ..functions.fields import RING_CAPACITY
from ..session import materialise
from .scan import running_last


def latest_state(classified: DataFrame, selection: dict[str, list[str]], per_field: bool = True,
                 keys=("device_id",), order: str = "seq", compat: bool = True) -> DataFrame:
    """At every frame, the most recent decoded value of each selected (message, field).

    ``per_field=True`` carries every field forward on its own, so a sentence with missing
    trailing tokens keeps the older values of those fields (the overwrite-in-place slot
    behaviour); ``per_field=False`` takes the latest record of each message as a whole.
    Output columns: keys, ``seq``, ``ts_us``, ``<message>_<field>``.

    Frames are decoded once, each message as one struct, and carried by windows over bounded chunks of a device
    (``scan``), however hot it is and whatever its sequence numbers. The fields of a UBX frame that parses are never null
    (fixed layout, bytes beyond the end are zeros), so they are carried together in both modes.
    """
    keys = list(keys)
    rows, columns, whole = decoded_frames(classified, selection, per_field, compat)
    carried = running_last(rows.select(*keys, order, "ts_us", *columns), keys, order, columns)
    return carried.select(*keys, order, "ts_us", *[(F.col(f"`{m}`.`{f}`") if m in whole else F.col(f"`{m}_{f}`")).alias(f"{m}_{f}")
                                                   for m, fl in selection.items() for f in fl])


def decoded_frames(classified: DataFrame, selection: dict[str, list[str]], per_field: bool, compat: bool):
    """(frames with decoded columns that are null but on frames of their message, names of these columns, messages that
    are one struct column). The others have a column ``<message>_<field>`` for each field. Sentences are split into tokens once."""
    hit = {m: (F.col("parse_result") == "OK") & (F.col("message") == m) for m in selection}
    whole = [m for m, fields in selection.items() if fields and (not per_field or m in FT.UBX_FIELDS)]
    nmea = (F.col("parse_result") == "OK") & F.col("message").isin([m for m in selection if m not in FT.UBX_FIELDS])
    columns = {}
    for m, fields in selection.items():
        vals = sqltext.values(m, compat, toks="_tokens")
        if m in whole:
            columns[m] = F.when(hit[m], F.expr("named_struct(" + ", ".join(f"'{f}', {vals[f]}" for f in fields) + ")"))
        else:
            columns |= {f"{m}_{f}": F.when(hit[m], F.expr(vals[f])) for f in fields}
    rows = classified.withColumn("_tokens", F.when(nmea, F.expr(sqltext.tokens())))
    return rows.select(*classified.columns, *[v.alias(c) for c, v in columns.items()]), list(columns), whole


def _ranked(df: DataFrame, keys, order):
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w))


def latest_n(df: DataFrame, keys=("device_id", "message"), order: str = "seq",
             capacity: int = RING_CAPACITY) -> DataFrame:
    """Keep the newest ``capacity`` rows per key (pushing into a full ring evicts the oldest).

    The ``row_number() <= N`` filter is planned as a WindowGroupLimit, which trims each
    partition to N rows per key before the final window sort.
    Adds ``idx``: the ring position, 0 = oldest retained row.
    """
    keys = list(keys)
    kept = _ranked(df, keys, order).filter(F.col("_rn") <= capacity)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return kept.withColumn("idx", (size - F.col("_rn")).cast("bigint")).drop("_rn")


def buffer_readout(df: DataFrame, value: str, keys=("device_id", "message"), order: str = "seq",
                   capacity: int = RING_CAPACITY, at_index: int = 0) -> DataFrame:
    """Read-outs of the retained series of ``value`` per key.

    first / last retained value, size, available, empty, full, the element at ``at_index``
    (an index at or past size returns the last element) and the eviction counter
    ``(pushes - N)+ mod N``.
    """
    keys = list(keys)
    df = materialise(df.select(*dict.fromkeys([*keys, order, value])), "pushed")  # read twice, computed once
    pushes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("pushes"))
    kept = latest_n(df, keys, order, capacity)
    agg = kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("size"),
        F.min_by(F.col(value), F.col(order)).alias("first"),
        F.max_by(F.col(value), F.col(order)).alias("last"),
        F.max(F.when(F.col("idx") == at_index, F.col(value))).alias("_at"),
    )
    return (agg.join(pushes, keys)
            .select(*keys, "first", "last",
                    F.col("size").cast("bigint").alias("size"),
                    (F.lit(capacity) - F.col("size")).cast("bigint").alias("available"),
                    (F.col("size") == 0).alias("empty"),
                    (F.col("size") == capacity).alias("full"),
                    F.coalesce(F.col("_at"), F.col("last")).alias(f"at_{at_index}"),
                    F.pmod(F.greatest(F.col("pushes") - capacity, F.lit(0)), F.lit(capacity))
                    .cast("bigint").alias("offset")))


def trim_series(df: DataFrame, keys=("device_id", "message"), order: str = "seq",
                capacity: int = RING_CAPACITY, drop_oldest: int = 0, drop_newest: int = 0) -> DataFrame:
    """Retained series minus its ``drop_oldest`` oldest and ``drop_newest`` newest rows."""
    kept = latest_n(df, keys, order, capacity)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return (kept.withColumn("_size", size)
            .filter((F.col("idx") >= drop_oldest) & (F.col("idx") < F.col("_size") - drop_newest))
            .drop("_size"))


def elapsed_us(df: DataFrame, keys=("device_id",), order: str = "seq", ts: str = "ts_us") -> DataFrame:
    """Microseconds since the first record of each capture/device in arrival order.

    The first timestamp per key is an aggregate (map-side partial ``min_by``, skew-safe) joined
    back on the key; a hot key on the large side is split by AQE's skew-join handling.
    """
    keys = list(keys)
    first = df.groupBy(*keys).agg(F.min_by(F.col(ts), F.col(order)).alias("_first_ts"))
    return (df.join(first, keys, "left").withColumn("elapsed_us", F.col(ts) - F.col("_first_ts"))
            .drop("_first_ts"))
