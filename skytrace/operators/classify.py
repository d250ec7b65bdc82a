"""Frame classification (NMEA/UBX message match), checksum validation and parse status.

Everything is a narrow projection: the 9-entry message dimension is a literal CASE, not a
join, so classification never shuffles and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binary import ubx_checksum_ok, ubx_checksum_ok_vectorized
from ..functions.fields import NMEA_MESSAGES, UBX_IDS, UBX_NAV_CLASS
from ..functions.text import latin1


def nmea_message(body: Column) -> Column:
    """Sentence id prefix test: only the first three characters are compared."""
    head = F.substring(latin1(body), 1, 3)
    expr = None
    for m in ["GGA", "GSA", "VTG"]:
        assert m in NMEA_MESSAGES
        expr = F.when(head == m, F.lit(m)) if expr is None else expr.when(head == m, F.lit(m))
    return expr


def ubx_message(body: Column) -> Column:
    """Class 0x01 (NAV) and one of the six supported ids."""
    class_id = F.hex(F.substring(body, 1, 2))
    expr = None
    for name, mid in UBX_IDS.items():
        key = f"{UBX_NAV_CLASS:02X}{mid:02X}"
        expr = F.when(class_id == key, F.lit(name)) if expr is None else expr.when(class_id == key, F.lit(name))
    return expr


def match_message(protocol: Column, body: Column) -> Column:
    """Message name of a frame, NULL when protocol or message id is unsupported."""
    return F.when(protocol == "NMEA", nmea_message(body)).when(protocol == "UBX", ubx_message(body))


def classify(frames: DataFrame, compat: bool = True, checksum: str = "vectorized") -> DataFrame:
    """Add ``message`` and ``parse_result`` (OK | NO_MATCH | CHECKSUM) to complete frames.

    NMEA sentences never fail (their checksum is not verified); a UBX frame fails with
    CHECKSUM when its Fletcher checksum does not match. ``checksum``: "vectorized" (Arrow
    batched pandas UDF, default) or "expression" (pure JVM higher-order functions). Frames whose status is not OK
    (no frame / incomplete) keep NULL in both columns.
    """
    ok = F.col("status") == "OK"
    msg = F.when(ok, match_message(F.col("protocol"), F.col("body")))
    ubx = (F.col("protocol") == "UBX") & F.col("message").isNotNull()
    if checksum == "vectorized" and compat:
        # only matched UBX bodies cross to Python
        ck_ok = F.col("_ck_ok")
    else:
        ck_ok = ubx_checksum_ok(F.col("body"), compat)
    result = (F.when(~ok, F.lit(None).cast("string"))
              .when(F.col("message").isNull(), F.lit("NO_MATCH"))
              .when(ubx & ~ck_ok, F.lit("CHECKSUM"))
              .otherwise(F.lit("OK")))
    out = frames.withColumn("message", msg)
    if checksum == "vectorized" and compat:
        out = out.withColumn("_ck_ok", ubx_checksum_ok_vectorized(F.when(ubx, F.col("body"))))
    return out.withColumn("parse_result", result).drop("_ck_ok")
