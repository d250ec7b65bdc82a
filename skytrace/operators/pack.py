"""Nested packs: nine ordered lists of pack-typed records per (device, pack window).

Build: one groupBy over the classified frames with nine ``collect_list`` aggregates (one
shuffle on (device_id, pack_id)); the list order is the arrival order (sorted by seq).
A pack's size is bounded by the caller's pack window, exactly as the caller of the replaced
engine decides when to ship a pack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fields as FT
from .reshape import pack_fields, pack_record
from .thinning import downsample_rate


def pack_build(classified: DataFrame, pack_us: int, rate_hz: float = 0, compat: bool = True) -> DataFrame:
    """``(device_id, pack_id, gga, vtg, gsa, dop, pvt, hpposecef, hpposllh, relposned, velned)``.

    Records are rate-limited per (device_id, message) first (``rate_hz`` = 0 keeps all);
    ``pack_id = floor(ts_us / pack_us)``.
    """
    ok = classified.filter((F.col("parse_result") == "OK") & F.col("message").isNotNull())
    if rate_hz:
        ok = downsample_rate(ok, rate_hz)
    ok = ok.withColumn("pack_id", F.floor(F.col("ts_us") / F.lit(pack_us)).cast("bigint"))
    # one narrow branch per message fills its own list column (small expressions, pruned
    # partitions on a message-partitioned lake); one groupBy builds all nine lists
    branches = []
    for m in FT.ALL_MESSAGES:
        cols = [F.col("device_id"), F.col("pack_id")]
        for other in FT.ALL_MESSAGES:
            if other == m:
                rec = pack_record(m, F.col("body"), F.col("ts_us"), compat)
                cols.append(F.struct(F.col("seq").alias("seq"), rec.alias("rec")).alias(FT.PACK_LIST[other]))
            else:
                cols.append(F.lit(None).cast(_item_type(other)).alias(FT.PACK_LIST[other]))
        branches.append(ok.filter(F.col("message") == m).select(*cols))
    items = branches[0]
    for b_ in branches[1:]:
        items = items.unionByName(b_)
    aggs = [F.transform(F.sort_array(F.collect_list(FT.PACK_LIST[m])), lambda x: x["rec"]).alias(FT.PACK_LIST[m])
            for m in FT.ALL_MESSAGES]
    return items.groupBy("device_id", "pack_id").agg(*aggs)


def _item_type(message: str) -> str:
    fields = ", ".join(f"`{n}`: {t}" for n, t in [("_inner_timestamp", "bigint")] + pack_fields(message))
    return f"struct<seq: bigint, rec: struct<{fields}>>"


def pack_explode(packs: DataFrame, message: str) -> DataFrame:
    """Typed rows of one list, in list order: ``device_id, pack_id, pos, _inner_timestamp, ...``."""
    lst = FT.PACK_LIST[message]
    return (packs.select("device_id", "pack_id", F.posexplode(lst).alias("pos", "r"))
            .select("device_id", "pack_id", "pos", "r.*"))


def pack_entries(packs: DataFrame) -> DataFrame:
    """All list entries as ``(device_id, pack_id, message, pos, _inner_timestamp)``."""
    def entry(m):
        return lambda r, i: F.struct(F.lit(m).alias("message"), i.cast("bigint").alias("pos"),
                                     r["_inner_timestamp"].alias("_inner_timestamp"))

    parts = [F.transform(F.col(FT.PACK_LIST[m]), entry(m)) for m in FT.ALL_MESSAGES]
    return (packs.select("device_id", "pack_id", F.inline(F.concat(*parts)))
            .select("device_id", "pack_id", "message", "pos", "_inner_timestamp"))


def pack_long(packs: DataFrame) -> DataFrame:
    """Every field of every packed record: ``(device_id, pack_id, message, pos, field, value, text)``, numbers in
    ``value`` (DOUBLE) and strings in ``text``. Each list is a branch that reads its own column alone."""
    out = None
    for m in FT.ALL_MESSAGES:
        fields = [("_inner_timestamp", "bigint"), *pack_fields(m)]
        items = ", ".join(f"named_struct('field', '{n}', 'value', " + (f"CAST(NULL AS DOUBLE), 'text', r.`{n}`)" if t == "string" else
                          f"CAST(r.`{n}` AS DOUBLE), 'text', CAST(NULL AS STRING))") for n, t in fields)
        part = (packs.select("device_id", "pack_id", F.posexplode(FT.PACK_LIST[m]).alias("pos", "r"))
                .select("device_id", "pack_id", F.lit(m).alias("message"), F.col("pos").cast("bigint").alias("pos"), F.expr(f"inline(array({items}))")))
        out = part if out is None else out.unionByName(part)
    return out


def pack_sizes(packs: DataFrame) -> DataFrame:
    """List sizes per pack as ``(device_id, pack_id, message, n)``."""
    stack = ", ".join(f"'{m}', cast(size({FT.PACK_LIST[m]}) as bigint)" for m in FT.ALL_MESSAGES)
    return packs.selectExpr("device_id", "pack_id", f"stack({len(FT.ALL_MESSAGES)}, {stack}) as (message, n)")
