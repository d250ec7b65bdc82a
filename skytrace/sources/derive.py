"""Frame tables derived from an ordinary event table.

The benchmark tables carry no receiver captures, so a frame table is derived row by row
from ``events`` with Spark column expressions (a narrow projection, no shuffle):

* ``device_id = user_id``, ``seq = event_id``, ``ts_us`` = epoch microseconds of ``ts``;
* message slot ``event_id % 11``: 0-2 the NMEA sentences, 3-8 the UBX messages, 9 an
  unsupported UBX message, 10 an unsupported NMEA sentence;
* field values from ``event_id`` (e) and ``v = round(value * 100)`` / ``s = v - 25000``;
* every 97th UBX frame gets a corrupted checksum.

The raw-value formulas are plain SQL text so that an independent SQL oracle can compute
the expected decoded values from ``events`` without decoding bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.contract import CORRUPT_EVERY, UBX_IDS, UBX_PAYLOAD_LEN, WIRE_BYTES, wire_layout

SLOTS = ["GGA", "VTG", "GSA", "NAV_DOP", "NAV_PVT", "NAV_HPPOSECEF", "NAV_HPPOSLLH",
         "NAV_RELPOSNED", "NAV_VELNED", "UBX_OTHER", "NMEA_OTHER"]


def _le_hex_sql(value_sql: str, wire: str) -> str:
    n = WIRE_BYTES[wire]
    be = f"lpad(hex(pmod(CAST({value_sql} AS BIGINT), {1 << (8 * n)})), {2 * n}, '0')"
    if n == 1:
        return be
    return "concat(" + ", ".join(f"substr({be}, {2 * k + 1}, 2)" for k in reversed(range(n))) + ")"


def _core_hex_sql(cls: int, mid: int, payload: list[str], length: int) -> str:
    head = f"'{cls:02X}{mid:02X}{length & 0xFF:02X}{length >> 8:02X}'"
    return "concat(" + ", ".join([head] + payload) + ")"


def _payload_sql(message: str) -> list[str]:
    length = UBX_PAYLOAD_LEN[message]
    parts, pos = [], 0
    for _, off, wire, sql in sorted(wire_layout(message), key=lambda x: x[1]):
        if off > pos:
            parts.append("'" + "00" * (off - pos) + "'")
        parts.append(_le_hex_sql(sql, wire))
        pos = off + WIRE_BYTES[wire]
    if length > pos:
        parts.append("'" + "00" * (length - pos) + "'")
    return parts


def _ubx_core_sqls() -> list[str]:
    """One expression per UBX slot (NULL on other slots): small, separately compiled pieces."""
    out = []
    for k, name in enumerate(SLOTS):
        if name in UBX_IDS:
            out.append(f"(CASE WHEN slot = {k} THEN "
                       f"{_core_hex_sql(1, UBX_IDS[name], _payload_sql(name), UBX_PAYLOAD_LEN[name])} END)")
    other = [_le_hex_sql("e", "u4"), _le_hex_sql("v", "u4")]
    out.append(f"(CASE WHEN slot = 9 THEN (CASE WHEN e % 2 = 0 THEN {_core_hex_sql(1, 0x35, other, 8)} "
               f"ELSE {_core_hex_sql(2, 0x07, other, 8)} END) END)")
    return out


_TIME = ("format_string('%02d%02d%02d.%02d', (ts_us div 3600000000) % 24, (ts_us div 60000000) % 60, "
         "(ts_us div 1000000) % 60, (ts_us % 1000000) div 10000)")
_LAT = "format_string('%02d%02d.%04d', e % 90, v % 60, (e * 37) % 10000)"
_NS = "(CASE WHEN e % 29 = 0 THEN '' WHEN e % 2 = 0 THEN 'N' ELSE 'S' END)"
_LON = "format_string('%03d%02d.%04d', e % 180, (v * 7) % 60, (e * 53 + v) % 10000)"
_EW = "(CASE WHEN (e div 2) % 2 = 0 THEN 'E' ELSE 'W' END)"
_AGE = "(CASE WHEN e % 3 = 0 THEN '' ELSE format_string('%d.%d', e % 5, v % 10) END)"


def _sentence_sql() -> str:
    gga_full = (f"concat_ws(',', 'GGA', {_TIME}, {_LAT}, {_NS}, {_LON}, {_EW}, CAST(e % 7 AS STRING), "
                f"format_string('%02d', v % 13), format_string('%d.%d', v % 10, e % 10), "
                f"format_string('%d.%d', v, e % 10), 'M', '46.9', 'M', {_AGE}, '0000')")
    gga_short = f"concat_ws(',', 'GGA', {_TIME}, {_LAT}, {_NS}, {_LON})"
    vtg = ("concat_ws(',', 'VTG', format_string('%d.%d', v % 360, e % 10), 'T', "
           "format_string('%d.%d', (v + 13) % 360, (e + 3) % 10), 'M', format_string('%d.%d', v % 100, e % 10), "
           "'N', format_string('%d.%d', v % 200, (e + 7) % 10), 'K', 'A')")
    sats = ", ".join(f"(CASE WHEN (e + {j}) % 3 = 0 THEN '' ELSE format_string('%02d', (e + {j}) % 32) END)"
                     for j in range(12))
    gsa = (f"concat_ws(',', 'GSA', (CASE WHEN e % 37 = 0 THEN '' WHEN e % 2 = 0 THEN 'A' ELSE 'M' END), "
           f"CAST(e % 3 + 1 AS STRING), {sats}, format_string('%d.%d', v % 50, e % 10), "
           f"format_string('%d.%d', (v + 1) % 50, (e + 1) % 10), format_string('%d.%d', (v + 2) % 50, (e + 2) % 10))")
    rmc = (f"concat_ws(',', 'RMC', {_TIME}, 'A', {_LAT}, {_NS}, {_LON}, {_EW}, '0.5', '54.7', '191194', "
           f"'020.3', 'E')")
    return (f"(CASE slot WHEN 0 THEN (CASE WHEN e % 31 = 0 THEN {gga_short} ELSE {gga_full} END) "
            f"WHEN 1 THEN {vtg} WHEN 2 THEN {gsa} WHEN 10 THEN {rmc} END)")


def _trailer_batch(core: pd.Series, text: pd.Series) -> pd.Series:
    """Per row: hex of the two UBX Fletcher bytes of ``core`` (hex), or of the NMEA XOR of ``text``."""
    out = []
    for c, t in zip(core, text):
        if c is not None:
            b = np.frombuffer(bytes.fromhex(c), dtype=np.uint8).astype(np.int64)
            n = len(b)
            a = int(b.sum() % 256)
            w = int((b * (n - np.arange(n))).sum() % 256)
            out.append(f"{a:02X}{w:02X}")
        elif t is not None:
            x = np.bitwise_xor.reduce(np.frombuffer(t.encode("latin-1"), dtype=np.uint8)) if t else 0
            out.append(f"{int(x):02X}")
        else:
            out.append(None)
    return pd.Series(out, dtype="object")


_TRAILER: dict = {}


def _trailer_udf():
    if "t" not in _TRAILER:
        _TRAILER["t"] = F.pandas_udf(_trailer_batch, "string")
    return _TRAILER["t"]


def frames_from_events(events: DataFrame) -> DataFrame:
    """Frame table ``(device_id, seq, ts_us, protocol, start_seq, body, body_len, truncated, status)``.

    A narrow projection written as SQL text, plus one Arrow-batched pass that appends the
    checksum trailers (Fletcher bytes for UBX, XOR for NMEA).
    """
    base = events.selectExpr(
        "event_id AS e", "user_id AS device_id", "unix_micros(CAST(ts AS TIMESTAMP)) AS ts_us",
        "CAST(round(value * 100) AS BIGINT) AS v",
    ).selectExpr("*", "v - 25000 AS s", "e % 11 AS slot")
    parts = _ubx_core_sqls()
    staged = base.selectExpr("*", *[f"{sql} AS _c{i}" for i, sql in enumerate(parts)], f"{_sentence_sql()} AS t")
    staged = staged.selectExpr("*", "coalesce(" + ", ".join(f"_c{i}" for i in range(len(parts))) + ") AS core")
    staged = staged.withColumn("trailer", _trailer_udf()(F.col("core"), F.concat(F.lit("GP"), F.col("t"))))
    is_nmea = "slot IN (0, 1, 2, 10)"
    ck_b = ("lpad(hex(pmod(CAST(conv(substr(trailer, 3, 2), 16, 10) AS INT) + "
            f"(CASE WHEN e % {CORRUPT_EVERY} = 0 THEN 1 ELSE 0 END), 256)), 2, '0')")
    return staged.selectExpr(
        "device_id", "e AS seq", "ts_us",
        f"CASE WHEN {is_nmea} THEN 'NMEA' ELSE 'UBX' END AS protocol",
        f"CASE WHEN {is_nmea} THEN X'244750' ELSE X'B562' END AS start_seq",
        f"CASE WHEN {is_nmea} THEN encode(concat(t, '*', trailer), 'ISO-8859-1') "
        f"ELSE unhex(concat(core, substr(trailer, 1, 2), {ck_b})) END AS body",
    ).selectExpr("*", "octet_length(body) AS body_len", "false AS truncated", "'OK' AS status")
