"""Per-message CSV outputs (``GPS_<NAME>.csv``) with fixed C-printf row formatting.

Doubles are rounded as C rounds them, from their exact binary value (``fixed_text``); Java's formatter rounds the shortest
decimal form instead and differs on ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fields as FT
from ..operators.decode import decode


def field_formats(message: str) -> list[str]:
    if message in FT.UBX_FIELDS:
        return [f.fmt for f in FT.UBX_FIELDS[message]]
    return list(FT.NMEA_FORMATS[message])


_SPLIT = 134217729.0  # 2**27 + 1: splits a double into two halves whose products are exact


def _halves(x: float) -> tuple[float, float]:
    high = _SPLIT * x - (_SPLIT * x - x)
    return high, x - high


def fixed_text(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """``df`` with every double column of ``digits`` replaced by its text with that many decimals, the exact binary value
    rounded half to even as C's ``%.<n>f`` does. Native expressions only: the fraction times 10^n is formed as a double
    and its exact error (Dekker's product), and the nearest integer is corrected by exact comparisons. Exact below
    2^63; beyond it the digits of Java's formatter are kept. Null stays null."""
    def steps(c: str, n: int) -> list[dict[str, str]]:
        x, (high, low) = f"`{c}`", _halves(10.0 ** n)
        a, w, f, p, s, h, r, l, d, e, k = (f"`_{name}_{c}`" for name in "awfpshrldek")
        odd = f"CAST({r} AS BIGINT) % 2 <> 0"
        minus = f"({x} < 0 OR CAST({x} AS STRING) = '-0.0')"
        carry = f"{k} = {10 ** n}"
        return [  # each step is a projection of its own, so that nothing is evaluated twice
            {a: f"CASE WHEN NOT isnan({x}) AND abs({x}) < {2.0 ** 63!r}D THEN abs({x}) ELSE 0D END"},
            {w: f"floor({a})", f: f"{a} - CAST(floor({a}) AS DOUBLE)"},
            {p: f"{f} * {10.0 ** n!r}D", s: f"{_SPLIT!r}D * {f}"},
            {h: f"{s} - ({s} - {f})", r: f"rint({p})"},
            {l: f"{f} - {h}", d: f"{p} - {r}"},
            {e: f"-((({h} * {high!r}D - {p}) + {h} * {low!r}D + {l} * {high!r}D) + {l} * {low!r}D)"},
            # the exact product is p - e: a half or more above r, or below; d - 0.5 and d + 0.5 are exact; odd r moves on ties
            {k: f"CAST({r} AS BIGINT) + CASE WHEN {d} - 0.5D > {e} OR ({d} - 0.5D = {e} AND {odd}) THEN 1 "
                f"WHEN {d} + 0.5D < {e} OR ({d} + 0.5D = {e} AND {odd}) THEN -1 ELSE 0 END"},
            {x: f"CASE WHEN isnan({x}) THEN 'nan' WHEN {x} = double('inf') THEN 'inf' WHEN {x} = double('-inf') THEN '-inf' "
                f"WHEN abs({x}) >= {2.0 ** 63!r}D THEN format_string('%.{n}f', {x}) "
                f"WHEN {x} IS NOT NULL THEN concat(CASE WHEN {minus} THEN '-' ELSE '' END, "
                f"CAST({w} + CASE WHEN {carry} THEN 1 ELSE 0 END AS STRING), '.', "
                f"lpad(CAST(CASE WHEN {carry} THEN 0 ELSE {k} END AS STRING), {n}, '0')) END"}]

    out, plans = df, [steps(c, n) for c, n in digits.items()]
    for step in zip(*plans, strict=True):
        new = {name: sql for one in step for name, sql in one.items()}
        out = out.selectExpr(*[f"`{c}`" for c in out.columns if f"`{c}`" not in new], *[f"{sql} AS {name}" for name, sql in new.items()])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def _digits(fmt: str) -> int | None:
    """Decimals of a C float format, None for other formats."""
    inner = fmt.strip('"')
    if not inner.endswith("f"):
        return None
    return int(inner[2:-1]) if "." in inner else 6


def format_rows(decoded: DataFrame, message: str) -> DataFrame:
    """``(device_id, seq, line)``: the CSV row text of each decoded record (NULL -> empty)."""
    formats = dict(zip(FT.columns(message), field_formats(message), strict=True))
    texts = fixed_text(decoded, {c: _digits(f) for c, f in formats.items() if _digits(f) is not None})
    parts = [F.col("_timestamp").cast("string")]
    for name, fmt in formats.items():
        v = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.lit('"'), v, F.lit('"')) if fmt.startswith('"') else v, F.lit("")))
    return texts.select("device_id", "seq", F.concat_ws(",", *parts).alias("line"))


def header_line(message: str) -> str:
    return ",".join(["_timestamp"] + FT.columns(message))


def write_frame_lake(classified: DataFrame, path: str) -> None:
    """Classified frames written once, partitioned by message (enables partition pruning).

    All frames are kept (unmatched ones land in the NULL partition), so every downstream
    operator can start from the lake instead of classifying (and checksumming) again. Rows are rebalanced by message
    first, so that a partition is a few files of even size however many tasks classified, and a frequent message is split.
    """
    classified.hint("rebalance", "message").write.mode("overwrite").partitionBy("message").parquet(path)


def csv_fanout(spark: SparkSession, lake: str, out: str, compat: bool = True) -> dict[str, str]:
    """Nine ``GPS_<NAME>.csv`` CSV outputs (overwrite, header = `_timestamp` + fields in order).

    Each output scans only its own ``message=`` partition of the frame lake. The row text is
    pre-formatted, so the single output column is named after the whole header line and the
    writer's separator is a control character that never occurs in the data.
    """
    frames = spark.read.parquet(lake)
    paths = {}
    for m in FT.ALL_MESSAGES:
        dec = decode(frames.filter(F.col("message") == m), m, compat)
        rows = format_rows(dec, m).select(F.col("line").alias(header_line(m)))
        p = f"{out.rstrip('/')}/GPS_{m}.csv"
        (rows.write.mode("overwrite").option("header", True).option("sep", "\u0001")
         .option("quote", "\u0000").option("escapeQuotes", False).option("quoteAll", False)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(p))
        paths[m] = p
    return paths


def write_clustered(frames: DataFrame, path: str, name: str, keys: list[str], order: str, buckets: int) -> DataFrame:
    """Frames written once as table ``name`` in ``buckets`` files by ``keys``, each sorted by (keys, ``order``): aggregates,
    joins and windows by the keys then need no exchange of the frames. All rows of a key are in one
    bucket, so this is for tables of many devices of like size."""
    (frames.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys, order).option("path", path).format("parquet")
     .mode("overwrite").saveAsTable(name))
    return frames.sparkSession.table(name)
