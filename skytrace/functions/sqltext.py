"""The decode expressions as Spark SQL text.

Building a wide decoder call by call through the Python API costs one gateway round trip per
function node (seconds for a 31-field message); the same expression as SQL text is parsed
by the JVM in one call. The semantics are identical to the Column builders in ``binary``,
``text`` and ``names``.
"""

from __future__ import annotations

from . import fields as FT
from .fields import WIRE_BYTES

_BLANK = r"[ \t\n\x0B\f\r]*"
DOUBLE_RE = "^" + _BLANK + r"([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf(?:inity)?|nan)))"
LONG_RE = "^" + _BLANK + r"([+-]?[0-9]+)"


def lit(s: str) -> str:
    """SQL string literal (backslash-escaped, as Spark's parser expects by default)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dbl(x: float) -> str:
    return f"CAST({lit(repr(float(x)))} AS DOUBLE)"


def le_int(body: str, offset: int, wire: str) -> str:
    """Little-endian integer at a byte offset; bytes beyond the end count as zero. The text names ``body`` once a byte
    and no value twice: inside a CASE nothing is shared, so what stands there twice is computed twice."""
    n = WIRE_BYTES[wire]
    pieces = ", ".join(f"substr({body}, {offset + k + 1}, 1)" for k in reversed(range(n)))
    raw = f"CAST(conv(hex(concat(X'00', {pieces})), 16, 10) AS BIGINT)"
    if wire.startswith("i"):
        half = 1 << (8 * n - 1)
        raw = f"(({raw} ^ {half}L) - {half}L)"
    return raw


def ubx_values(message: str, compat: bool = True, body: str = "body") -> dict[str, str]:
    """Column name -> SQL of the decoded UBX fields (output order)."""
    raw, val = {}, {}
    for f in FT.UBX_FIELDS[message]:
        wire = f.wire
        if not compat and message == "NAV_PVT" and f.name in FT.PVT_SPEC_WIDTH:
            wire = FT.PVT_SPEC_WIDTH[f.name]
        raw[f.name] = le_int(body, 4 + f.offset, wire)
    for f in FT.UBX_FIELDS[message]:
        r = raw[f.name]
        if f.kind == "int":
            val[f.name] = f"CAST({r} AS {FT.spark_type(message, f.name).upper()})"
        elif f.kind == "trunc":
            val[f.name] = f"CAST(CAST({r} AS DOUBLE) * {dbl(f.scale)} AS BIGINT)"
        else:
            val[f.name] = f"(CAST({r} AS DOUBLE) * {dbl(f.scale)})"
    for main, hp in FT.HP_ADD.get(message, []):
        val[main] = f"({val[main]} + {val[hp]})"
    out = {f.name: val[f.name] for f in FT.UBX_FIELDS[message]}
    if not compat and message == "NAV_HPPOSECEF":
        out["pAcc_m"] = f"(CAST({raw['pAcc']} AS DOUBLE) * {dbl(1e-4)})"
    return out


def numeric_prefix(t: str) -> str:
    m = f"regexp_extract({t}, {lit(DOUBLE_RE)}, 1)"
    return f"(CASE WHEN {t} IS NULL THEN CAST(NULL AS DOUBLE) ELSE coalesce(try_cast({m} AS DOUBLE), 0D) END)"


def integer_prefix_u8(t: str) -> str:
    m = f"regexp_extract({t}, {lit(LONG_RE)}, 1)"
    sat = f"(CASE WHEN startswith({m}, '-') THEN {-(1 << 63)}L ELSE {(1 << 63) - 1}L END)"
    v = f"(CASE WHEN {m} = '' THEN 0L ELSE coalesce(try_cast({m} AS BIGINT), {sat}) END)"
    return f"CAST(CASE WHEN {t} IS NULL THEN NULL ELSE pmod({v}, 256) END AS SMALLINT)"


def deg_min_to_deg(v: str) -> str:
    d = f"CAST(floor({v} / 100.0D) AS DOUBLE)"
    return f"({d} + ({v} - {d} * 100.0D) / 60.0D)"


def case_name(code: str, table: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in table.items())
    return f"(CASE WHEN {code} IS NULL THEN CAST(NULL AS STRING) ELSE (CASE {code} {whens} ELSE {lit(default)} END) END)"


def fix_state_name(code: str) -> str:
    return case_name(code, FT.FIX_STATE_NAMES, FT.FIX_STATE_UNKNOWN)


def tokens(body: str = "body") -> str:
    """The comma tokens of a sentence."""
    return f"split(decode({body}, 'ISO-8859-1'), ',', -1)"


def nmea_values(message: str, body: str = "body", toks: str | None = None) -> dict[str, str]:
    """Column name -> SQL of the decoded NMEA fields (output order). ``toks`` names a column that holds the ``tokens``."""
    line = f"decode({body}, 'ISO-8859-1')"
    toks = toks or tokens(body)
    val = {}
    for name, k, kind in FT.NMEA_FIELDS[message]:
        t = f"try_element_at({toks}, {k + 1})"
        if kind == "time":
            pos = f"instr({line}, ',')"
            val[name] = f"(CASE WHEN {t} IS NOT NULL AND {pos} > 0 THEN substring({line}, {pos} + 1, 9) END)"
        elif kind == "deg":
            val[name] = deg_min_to_deg(numeric_prefix(t))
        elif kind == "char":
            val[name] = (f"(CASE WHEN {t} IS NULL THEN CAST(NULL AS STRING) WHEN {t} <> '' THEN substring({t}, 1, 1) "
                         f"WHEN size({toks}) = {k + 1} THEN '' ELSE ',' END)")
        elif kind == "int":
            val[name] = integer_prefix_u8(t)
        else:
            val[name] = numeric_prefix(t)
    if message == "GGA":
        val["fix_state"] = fix_state_name(val["fix"])
    return {c: f"CAST({val[c]} AS {FT.spark_type(message, c).upper()})" for c in FT.NMEA_COLUMNS[message]}


def values(message: str, compat: bool = True, body: str = "body", toks: str | None = None) -> dict[str, str]:
    if message in FT.UBX_FIELDS:
        return ubx_values(message, compat, body)
    return nmea_values(message, body, toks)
