"""Independent SQL oracles (DuckDB dialect) for the registered queries.

The oracle never decodes bytes: it recomputes the expected values from ``events`` with the
generation formulas and the field tables of ``contract``, which the engine does not use, with plain arithmetic,
``printf`` and window functions. UBX bytes and Fletcher checksums are rebuilt arithmetically.
"""

from __future__ import annotations

from . import contract as FT
from .contract import CORRUPT_EVERY, pack_fields, raw_sql, wire_layout

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
N = 3
SLOT = {"GGA": 0, "VTG": 1, "GSA": 2, "NAV_DOP": 3, "NAV_PVT": 4, "NAV_HPPOSECEF": 5, "NAV_HPPOSLLH": 6,
        "NAV_RELPOSNED": 7, "NAV_VELNED": 8}
DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR"}


def _d(x: float) -> str:
    return f"CAST('{repr(float(x))}' AS DOUBLE)"


BASE = f"""base AS (
  SELECT event_id AS e, user_id AS device_id, epoch_us(ts) AS ts_us,
         CAST(round(value * 100) AS BIGINT) AS v,
         CAST(round(value * 100) AS BIGINT) - 25000 AS s,
         event_id % 11 AS slot
  FROM events)"""

_TIME = ("printf('%02d%02d%02d.%02d', (ts_us // 3600000000) % 24, (ts_us // 60000000) % 60, "
         "(ts_us // 1000000) % 60, (ts_us % 1000000) // 10000)")
_LAT = "printf('%02d%02d.%04d', e % 90, v % 60, (e * 37) % 10000)"
_NS = "(CASE WHEN e % 29 = 0 THEN '' WHEN e % 2 = 0 THEN 'N' ELSE 'S' END)"
_LON = "printf('%03d%02d.%04d', e % 180, (v * 7) % 60, (e * 53 + v) % 10000)"
_EW = "(CASE WHEN (e // 2) % 2 = 0 THEN 'E' ELSE 'W' END)"
_AGE = "(CASE WHEN e % 3 = 0 THEN '' ELSE printf('%d.%d', e % 5, v % 10) END)"


def _nmea_text() -> str:
    gga_full = (f"concat_ws(',', 'GGA', {_TIME}, {_LAT}, {_NS}, {_LON}, {_EW}, CAST(e % 7 AS VARCHAR), "
                f"printf('%02d', v % 13), printf('%d.%d', v % 10, e % 10), printf('%d.%d', v, e % 10), "
                f"'M', '46.9', 'M', {_AGE}, '0000')")
    gga_short = f"concat_ws(',', 'GGA', {_TIME}, {_LAT}, {_NS}, {_LON})"
    vtg = ("concat_ws(',', 'VTG', printf('%d.%d', v % 360, e % 10), 'T', printf('%d.%d', (v + 13) % 360, (e + 3) % 10), "
           "'M', printf('%d.%d', v % 100, e % 10), 'N', printf('%d.%d', v % 200, (e + 7) % 10), 'K', 'A')")
    sats = ", ".join(f"(CASE WHEN (e + {j}) % 3 = 0 THEN '' ELSE printf('%02d', (e + {j}) % 32) END)" for j in range(12))
    gsa = (f"concat_ws(',', 'GSA', (CASE WHEN e % 37 = 0 THEN '' WHEN e % 2 = 0 THEN 'A' ELSE 'M' END), "
           f"CAST(e % 3 + 1 AS VARCHAR), {sats}, printf('%d.%d', v % 50, e % 10), "
           f"printf('%d.%d', (v + 1) % 50, (e + 1) % 10), printf('%d.%d', (v + 2) % 50, (e + 2) % 10))")
    rmc = (f"concat_ws(',', 'RMC', {_TIME}, 'A', {_LAT}, {_NS}, {_LON}, {_EW}, '0.5', '54.7', '191194', "
           f"'020.3', 'E')")
    return (f"CASE slot WHEN 0 THEN (CASE WHEN e % 31 = 0 THEN {gga_short} ELSE {gga_full} END) "
            f"WHEN 1 THEN {vtg} WHEN 2 THEN {gsa} WHEN 10 THEN {rmc} END")


def _u(sql: str, nbytes: int) -> str:
    m = 1 << (8 * nbytes)
    return f"((({sql}) % {m} + {m}) % {m})"


def ubx_bytes(message: str) -> list[str]:
    """SQL integer expression of every byte of the body before the checksum."""
    length = FT.UBX_PAYLOAD_LEN[message]
    out = ["1", str(FT.UBX_IDS[message]), str(length & 0xFF), str(length >> 8)]
    payload = ["0"] * length
    for _, off, wire, sql in wire_layout(message):
        n = FT.WIRE_BYTES[wire]
        u = _u(sql, n)
        for k in range(n):
            payload[off + k] = f"(({u} >> {8 * k}) & 255)"
    return out + payload


def _other_bytes(cls: int, mid: int) -> list[str]:
    out = [str(cls), str(mid), "8", "0"]
    for sql in ("e", "v"):
        u = _u(sql, 4)
        out += [f"(({u} >> {8 * k}) & 255)" for k in range(4)]
    return out


def _fletcher(bs: list[str]) -> tuple[str, str]:
    n = len(bs)
    a = "(" + " + ".join(bs) + ") % 256"
    b = "(" + " + ".join(f"{n - p} * {x}" for p, x in enumerate(bs)) + ") % 256"
    return a, b


def _hex(bs: list[str]) -> str:
    return "concat(" + ", ".join(f"printf('%02X', {x})" for x in bs) + ")"


def _ubx_case(fn) -> str:
    parts = [f"WHEN {SLOT[m]} THEN {fn(ubx_bytes(m))}" for m in FT.UBX_MESSAGES]
    other = f"(CASE WHEN e % 2 = 0 THEN {fn(_other_bytes(1, 0x35))} ELSE {fn(_other_bytes(2, 7))} END)"
    return f"(CASE slot {' '.join(parts)} WHEN 9 THEN {other} END)"


def frames_cte() -> str:
    """base + classification + NMEA text + UBX header/checksum + body hex."""
    ck_a = _ubx_case(lambda bs: _fletcher(bs)[0])
    ck_b = _ubx_case(lambda bs: _fletcher(bs)[1])
    core_hex = _ubx_case(_hex)
    plen = "(CASE slot " + " ".join(f"WHEN {SLOT[m]} THEN {FT.UBX_PAYLOAD_LEN[m]}" for m in FT.UBX_MESSAGES) + " WHEN 9 THEN 8 END)"
    msg = "(CASE slot " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in SLOT.items()) + " END)"
    xor = "list_reduce(list_transform(string_split('GP' || t, ''), lambda c: ascii(c)), lambda a, b: xor(a, b))"
    return f"""{BASE},
fr0 AS (
  SELECT *, CASE WHEN slot IN (0, 1, 2, 10) THEN 'NMEA' ELSE 'UBX' END AS protocol,
         {msg} AS message,
         CASE WHEN slot IN (9, 10) THEN 'NO_MATCH' WHEN slot BETWEEN 3 AND 8 AND e % {CORRUPT_EVERY} = 0
              THEN 'CHECKSUM' ELSE 'OK' END AS parse_result,
         {_nmea_text()} AS t,
         {plen} AS plen,
         {ck_a} AS ck_a, {ck_b} AS ck_b0, {core_hex} AS core_hex
  FROM base),
fr AS (
  SELECT *, CASE WHEN t IS NOT NULL THEN t || '*' || printf('%02X', {xor}) END AS text,
         CASE WHEN e % {CORRUPT_EVERY} = 0 AND ck_b0 IS NOT NULL THEN (ck_b0 + 1) % 256 ELSE ck_b0 END AS ck_b
  FROM fr0),
fx AS (
  SELECT *, CASE WHEN protocol = 'UBX' THEN core_hex || printf('%02X', ck_a) || printf('%02X', ck_b)
                 ELSE hex(text) END AS body_hex,
         CASE WHEN protocol = 'UBX' THEN plen + 6 ELSE length(text) END AS body_len
  FROM fr)"""


def _with(body: str) -> str:
    return f"WITH {frames_cte()}\n{body}"


# ---------------------------------------------------------------- expected decoded values
def ubx_expected(message: str) -> list[tuple[str, str]]:
    """(column, SQL) of the decoded UBX columns in output order."""
    vals = {}
    fl = FT.UBX_FIELDS[message]
    for i, f in enumerate(fl):
        raw = raw_sql(i, f.wire)
        if message == "NAV_PVT" and f.name in ("magDec", "magAcc"):
            continue
        if f.kind == "int":
            vals[f.name] = f"CAST({raw} AS {DUCK[FT.spark_type(message, f.name)]})"
        elif f.kind == "trunc":
            vals[f.name] = f"CAST(trunc(CAST({raw} AS DOUBLE) * {_d(f.scale)}) AS BIGINT)"
        else:
            vals[f.name] = f"CAST({raw} AS DOUBLE) * {_d(f.scale)}"
    if message == "NAV_PVT":
        idx = {f.name: i for i, f in enumerate(fl)}
        dec16 = _u(raw_sql(idx["magDec"], "i2"), 2)
        acc16 = _u(raw_sql(idx["magAcc"], "u2"), 2)
        a, b = _fletcher(ubx_bytes("NAV_PVT"))
        u32 = f"({dec16} + 65536 * {acc16})"
        vals["magDec"] = f"CAST(CASE WHEN {u32} >= 2147483648 THEN {u32} - 4294967296 ELSE {u32} END AS DOUBLE) * {_d(0.01)}"
        vals["magAcc"] = f"CAST({acc16} + 65536 * ({a}) + 16777216 * ({b}) AS DOUBLE) * {_d(0.01)}"
    for main, hp in FT.HP_ADD.get(message, []):
        vals[main] = f"({vals[main]} + {vals[hp]})"
    return [(f.name, vals[f.name]) for f in fl]


def _dd(num: str, den: int = 10) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE))"


def _deg(x: str) -> str:
    d = f"floor({x} / CAST(100 AS DOUBLE))"
    return f"({d} + ({x} - {d} * CAST(100 AS DOUBLE)) / CAST(60 AS DOUBLE))"


LAT_RAW = _dd("(e % 90) * 1000000 + (v % 60) * 10000 + (e * 37) % 10000", 10000)
LON_RAW = _dd("(e % 180) * 1000000 + ((v * 7) % 60) * 10000 + (e * 53 + v) % 10000", 10000)


def _fix_state(fix: str) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in FT.FIX_STATE_NAMES.items())
    return f"(CASE WHEN {fix} IS NULL THEN NULL ELSE (CASE {fix} {cases} ELSE '{FT.FIX_STATE_UNKNOWN}' END) END)"


def nmea_expected(message: str) -> list[tuple[str, str]]:
    short = "e % 31 = 0"
    if message == "GGA":
        def tail(x):
            return f"(CASE WHEN {short} THEN NULL ELSE {x} END)"
        fix = tail("CAST(e % 7 AS SMALLINT)")
        return [
            ("time", _TIME),
            ("latitude", _deg(LAT_RAW)),
            ("north_south", "(CASE WHEN e % 29 = 0 THEN ',' WHEN e % 2 = 0 THEN 'N' ELSE 'S' END)"),
            ("longitude", _deg(LON_RAW)),
            ("east_ovest", tail(_EW)),
            ("fix", fix),
            ("satellites", tail("CAST(v % 13 AS SMALLINT)")),
            ("horizontal_diluition_precision", tail(_dd("(v % 10) * 10 + e % 10"))),
            ("fix_state", _fix_state(fix)),
            ("altitude", tail(_dd("v * 10 + e % 10"))),
            ("age_of_correction", tail(f"(CASE WHEN e % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE {_dd('(e % 5) * 10 + v % 10')} END)")),
        ]
    if message == "VTG":
        return [("course_over_ground_degrees", _dd("(v % 360) * 10 + e % 10")),
                ("course_over_ground_degrees_magnetic", _dd("((v + 13) % 360) * 10 + (e + 3) % 10")),
                ("speed_kmh", _dd("(v % 200) * 10 + (e + 7) % 10"))]
    return [("mode", "(CASE WHEN e % 37 = 0 THEN ',' WHEN e % 2 = 0 THEN 'A' ELSE 'M' END)"),
            ("position_diluition_precision", _dd("(v % 50) * 10 + e % 10")),
            ("horizontal_diluition_precision", _dd("((v + 1) % 50) * 10 + (e + 1) % 10")),
            ("vertical_diluition_precision", _dd("((v + 2) % 50) * 10 + (e + 2) % 10"))]


def expected(message: str) -> list[tuple[str, str]]:
    return ubx_expected(message) if message in FT.UBX_FIELDS else nmea_expected(message)


def _ok(message: str) -> str:
    return f"slot = {SLOT[message]} AND parse_result = 'OK'"


def decode_sql(message: str) -> str:
    cols = ", ".join(f"{sql} AS \"{name}\"" for name, sql in expected(message))
    return f"WITH {BASE}\nSELECT device_id, e AS seq, ts_us AS _timestamp, {cols} FROM ({_parse_base()}) x WHERE {_ok(message)}"


def _parse_base() -> str:
    return (f"SELECT *, CASE WHEN slot IN (9, 10) THEN 'NO_MATCH' WHEN slot BETWEEN 3 AND 8 "
            f"AND e % {CORRUPT_EVERY} = 0 THEN 'CHECKSUM' ELSE 'OK' END AS parse_result FROM base")


def _with_base(body: str) -> str:
    return f"WITH {BASE}, pb AS ({_parse_base()})\n{body}"


def _fmt_sql(fmt: str, x: str) -> str:
    q = fmt.startswith('"')
    inner = fmt.strip('"')
    v = f"printf('{inner}', {x})"
    if q:
        v = f"('\"' || {v} || '\"')"
    return f"coalesce({v}, '')"


def format_sql(message: str) -> str:
    if message in FT.UBX_FIELDS:
        fmts = [f.fmt for f in FT.UBX_FIELDS[message]]
    else:
        fmts = FT.NMEA_FORMATS[message]
    parts = [_fmt_sql("%d", "ts_us")] + [_fmt_sql(f, sql) for f, (_, sql) in zip(fmts, expected(message))]
    line = " || ',' || ".join(parts)
    return _with_base(f"SELECT device_id, e AS seq, {line} AS line FROM pb WHERE {_ok(message)}")


# -------------------------------------------------------------------------------- thinning
def thin_sql(gap_us: int, keys: list[str], where: str = "TRUE") -> str:
    kcols = ", ".join(keys)
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    on_c = " AND ".join(f"c.{k} = n.{k}" for k in keys)
    sel = ", ".join(f"c.{k}" for k in keys)
    return f"""WITH RECURSIVE {BASE}, pb AS ({_parse_base()}),
s AS (SELECT device_id, (CASE slot {' '.join(f"WHEN {v} THEN '{k}'" for k, v in SLOT.items())} END) AS message,
             e AS seq, ts_us FROM pb WHERE {where}),
t AS (SELECT *, ts_us + {gap_us} AS target FROM s),
nx AS (SELECT a.{kcols.replace(', ', ', a.')}, a.seq, min(b.seq) AS nseq FROM t a LEFT JOIN s b ON {on} AND b.ts_us >= a.target
        GROUP BY a.{kcols.replace(', ', ', a.')}, a.seq),
st AS (SELECT {kcols}, min(seq) AS seq FROM s WHERE ts_us >= {gap_us} GROUP BY {kcols}),
chain AS (
  SELECT {kcols}, seq FROM st
  UNION ALL
  SELECT {sel}, n.nseq AS seq FROM chain c JOIN nx n ON {on_c} AND c.seq = n.seq WHERE n.nseq IS NOT NULL)
SELECT s.{kcols.replace(', ', ', s.')}, s.seq, s.ts_us FROM chain JOIN s USING ({kcols}, seq)"""


# --------------------------------------------------------------------------------- oracles
def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["decode_quality"] = _with("SELECT device_id, protocol, message, parse_result, count(*) AS frames FROM fx GROUP BY ALL")
    o["stream_decode"] = o["decode_quality"]
    o["parse_status"] = _with("SELECT device_id, e AS seq, protocol, message, parse_result FROM fx")
    o["match_nmea"] = _with("SELECT device_id, e AS seq, message, true AS nmea_checksum_ok FROM fx WHERE protocol = 'NMEA'")
    o["match_ubx"] = _with(
        "SELECT device_id, e AS seq, CAST(CASE WHEN slot = 9 AND e % 2 = 1 THEN 2 ELSE 1 END AS BIGINT) AS cls, "
        "CAST(CASE slot " + " ".join(f"WHEN {SLOT[m]} THEN {FT.UBX_IDS[m]}" for m in FT.UBX_MESSAGES)
        + " WHEN 9 THEN (CASE WHEN e % 2 = 0 THEN 53 ELSE 7 END) END AS BIGINT) AS msg_id, message FROM fx WHERE protocol = 'UBX'")
    o["match_unsupported"] = _with("SELECT device_id, e AS seq, protocol FROM fx WHERE parse_result = 'NO_MATCH'")
    o["ubx_checksum"] = _with(f"SELECT device_id, e AS seq, CAST(plen AS BIGINT) AS length, e % {CORRUPT_EVERY} <> 0 AS checksum_ok "
                              "FROM fx WHERE protocol = 'UBX'")
    o["ubx_header"] = _with(
        "SELECT device_id, e AS seq, CAST(CASE WHEN slot = 9 AND e % 2 = 1 THEN 2 ELSE 1 END AS BIGINT) AS cls, "
        "CAST(CASE slot " + " ".join(f"WHEN {SLOT[m]} THEN {FT.UBX_IDS[m]}" for m in FT.UBX_MESSAGES)
        + " WHEN 9 THEN (CASE WHEN e % 2 = 0 THEN 53 ELSE 7 END) END AS BIGINT) AS msg_id, "
        "CAST(plen AS BIGINT) AS length, CAST(ck_a AS BIGINT) AS ck_a, CAST(ck_b AS BIGINT) AS ck_b FROM fx WHERE protocol = 'UBX'")
    code = ("CASE WHEN message IS NULL THEN -1 " + " ".join(
        f"WHEN message = '{m}' THEN {i}" for i, m in enumerate(FT.NMEA_MESSAGES)) + " " + " ".join(
        f"WHEN message = '{m}' THEN {i}" for i, m in enumerate(FT.UBX_MESSAGES)) + " END")
    o["message_names"] = _with(
        f"SELECT device_id, e AS seq, protocol, CAST({code} AS BIGINT) AS code, "
        f"CASE WHEN message IS NOT NULL THEN message WHEN protocol = 'NMEA' THEN '{FT.NMEA_UNKNOWN}' "
        f"ELSE '{FT.UBX_UNKNOWN}' END AS name FROM fx")
    pcode = "CASE parse_result " + " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(FT.PARSE_RESULTS)) + " END"
    o["parse_result_names"] = _with(
        f"SELECT CAST({pcode} AS BIGINT) AS parse_code, parse_result, count(*) AS frames FROM fx GROUP BY ALL")
    for m in FT.ALL_MESSAGES:
        o["decode_" + m.replace("NAV_", "").lower()] = decode_sql(m)
        o["format_" + m.replace("NAV_", "").lower()] = format_sql(m)
    # little-endian reads over the first payload bytes of OK UBX frames
    cases_u4, cases_b5, cases_b4 = [], [], []
    for m in FT.UBX_MESSAGES:
        bs = ubx_bytes(m)
        cases_u4.append(f"WHEN {SLOT[m]} THEN {bs[4]} + 256 * {bs[5]} + 65536 * {bs[6]} + 16777216 * {bs[7]}")
        cases_b5.append(f"WHEN {SLOT[m]} THEN {bs[5]} + 256 * {bs[6]}")
        cases_b4.append(f"WHEN {SLOT[m]} THEN {bs[4]}")
    u4 = "(CASE slot " + " ".join(cases_u4) + " END)"
    u2 = "(CASE slot " + " ".join(cases_b5) + " END)"
    u1 = "(CASE slot " + " ".join(cases_b4) + " END)"
    o["le_fields"] = _with(
        f"SELECT device_id, e AS seq, CAST(1 AS BIGINT) AS u1_0, CAST(plen AS BIGINT) AS u2_2, CAST({u4} AS BIGINT) AS u4_4, "
        f"CAST(CASE WHEN {u4} >= 2147483648 THEN {u4} - 4294967296 ELSE {u4} END AS BIGINT) AS i4_4, "
        f"CAST(CASE WHEN {u1} >= 128 THEN {u1} - 256 ELSE {u1} END AS BIGINT) AS i1_4, "
        f"CAST(CASE WHEN {u2} >= 32768 THEN {u2} - 65536 ELSE {u2} END AS BIGINT) AS i2_5 "
        "FROM fx WHERE protocol = 'UBX' AND parse_result = 'OK'")
    toks = ("SELECT device_id, e AS seq, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS k, unnest(arr) AS token "
            "FROM (SELECT device_id, e, string_split(text, ',') AS arr FROM fx WHERE protocol = 'NMEA')")
    o["tokenize_sentence"] = _with(toks)
    num = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)"
    o["numeric_prefix"] = _with(
        f"SELECT device_id, seq, k, coalesce(TRY_CAST(regexp_extract(token, '{num}', 1) AS DOUBLE), CAST(0 AS DOUBLE)) AS value "
        f"FROM ({toks}) WHERE k >= 1")
    o["deg_min_to_deg"] = _with_base(
        f"SELECT device_id, e AS seq, {LAT_RAW} AS lat_raw, {_deg(LAT_RAW)} AS latitude, {LON_RAW} AS lon_raw, "
        f"{_deg(LON_RAW)} AS longitude FROM pb WHERE slot = 0")
    gga = dict(nmea_expected("GGA"))
    o["fix_state_name"] = _with_base(f"SELECT device_id, e AS seq, {gga['fix']} AS fix, {gga['fix_state']} AS fix_state FROM pb WHERE slot = 0")
    o["fix_mode_name"] = _with_base(
        "SELECT device_id, e AS seq, CAST(e % 3 + 1 AS BIGINT) AS fix_mode, "
        f"CASE e % 3 + 1 WHEN 1 THEN '{FT.FIX_MODE_NAMES[1]}' WHEN 2 THEN '{FT.FIX_MODE_NAMES[2]}' "
        f"ELSE '{FT.FIX_MODE_UNKNOWN}' END AS fix_mode_name FROM pb WHERE slot = 2")
    # thinning
    o["thin_1h"] = thin_sql(HOUR_US, ["device_id"])
    o["thin_48h"] = thin_sql(48 * HOUR_US, ["device_id"])
    o["thin_all"] = thin_sql(1000 * HOUR_US, ["device_id"])
    o["thin_48h_chunked"] = o["thin_48h"]
    wide = "CASE WHEN device_id % 7 <> 0 THEN device_id + 9007199254740992 ELSE -1 END"
    o["thin_null_keys"] = ("SELECT nullif(device_id, -1) AS device_id, seq, ts_us FROM ("
                           + thin_sql(HOUR_US, ["device_id"]).replace("s AS (SELECT device_id,", f"s AS (SELECT {wide} AS device_id,", 1) + ")")
    o["stream_thin_message"] = thin_sql(6 * HOUR_US, ["device_id", "message"], "parse_result = 'OK'")
    o["stream_thin"] = thin_sql(6 * HOUR_US, ["device_id"])
    o["downsample_rate"] = thin_sql(HOUR_US, ["device_id", "message"], "parse_result = 'OK'").replace(
        "SELECT s.device_id, s.message, s.seq, s.ts_us", "SELECT s.device_id, s.message, s.seq, s.ts_us")
    o["resample_us"] = thin_sql(6 * HOUR_US, ["device_id", "message"], "parse_result = 'OK'")
    # state
    sel = {"GGA": ["latitude", "fix", "age_of_correction"], "VTG": ["speed_kmh"], "GSA": ["mode"],
           "NAV_DOP": ["gDOP"], "NAV_PVT": ["lon"], "NAV_HPPOSECEF": ["ecefX"], "NAV_HPPOSLLH": ["lat"],
           "NAV_RELPOSNED": ["relPosN"], "NAV_VELNED": ["speed"]}
    w = "OVER (PARTITION BY device_id ORDER BY e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cols = []
    for m, fl in sel.items():
        ex = dict(expected(m))
        for f in fl:
            cols.append(f"last_value(CASE WHEN {_ok(m)} THEN {ex[f]} END IGNORE NULLS) {w} AS \"{m}_{f}\"")
    o["latest_state"] = _with_base(f"SELECT device_id, e AS seq, ts_us, {', '.join(cols)} FROM pb")
    msg = "(CASE slot " + " ".join(f"WHEN {v} THEN '{k}'" for k, v in SLOT.items()) + " END)"
    series = (f"SELECT device_id, {msg} AS message, e AS seq, ts_us FROM pb WHERE parse_result = 'OK'")
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY device_id, message ORDER BY seq DESC) AS rn, "
              f"count(*) OVER (PARTITION BY device_id, message) AS cnt FROM ({series})")
    o["latest_n"] = _with_base(
        f"SELECT device_id, message, seq, CAST(least(cnt, {N}) - rn AS BIGINT) AS idx FROM ({ranked}) WHERE rn <= {N}")
    o["trim_series"] = _with_base(
        f"SELECT device_id, message, seq, idx FROM (SELECT device_id, message, seq, least(cnt, {N}) AS size, "
        f"CAST(least(cnt, {N}) - rn AS BIGINT) AS idx FROM ({ranked}) WHERE rn <= {N}) WHERE idx >= 1 AND idx < size - 1")
    o["buffer_readout"] = _with_base(
        f"SELECT device_id, message, max(CASE WHEN rn = least(cnt, {N}) THEN ts_us END) AS first, "
        f"max(CASE WHEN rn = 1 THEN ts_us END) AS last, CAST(least(max(cnt), {N}) AS BIGINT) AS size, "
        f"CAST({N} - least(max(cnt), {N}) AS BIGINT) AS available, false AS empty, least(max(cnt), {N}) = {N} AS full, "
        f"coalesce(max(CASE WHEN least(cnt, {N}) - rn = 1 THEN ts_us END), max(CASE WHEN rn = 1 THEN ts_us END)) AS at_1, "
        f"CAST(greatest(max(cnt) - {N}, 0) % {N} AS BIGINT) AS \"offset\" FROM ({ranked}) GROUP BY device_id, message")
    o["stream_latest_n"] = _with(
        f"SELECT device_id, message, seq, idx, ts_us, protocol, body_hex FROM (SELECT device_id, message, e AS seq, ts_us, protocol, body_hex, "
        f"CAST(least(count(*) OVER (PARTITION BY device_id, message), {N}) - row_number() OVER (PARTITION BY device_id, message ORDER BY e DESC) "
        f"AS BIGINT) AS idx FROM fx WHERE parse_result = 'OK') WHERE idx >= 0")
    every, records = [], []
    for m in FT.ALL_MESSAGES:
        every += [f"last_value(CASE WHEN {_ok(m)} THEN {x} END IGNORE NULLS) {w} AS \"{m}_{f}\"" for f, x in expected(m)]
        whole = "struct_pack(" + ", ".join(f"\"{f}\" := {x}" for f, x in expected(m)) + ")"
        records.append((m, f"last_value(CASE WHEN {_ok(m)} THEN {whole} END IGNORE NULLS) {w} AS \"{m}\""))
    o["latest_state_all"] = _with_base(f"SELECT device_id, e AS seq, ts_us, {', '.join(every)} FROM pb")
    o["stream_latest_state"] = o["latest_state_all"]
    o["latest_record_all"] = _with_base(
        "SELECT device_id, seq, ts_us, " + ", ".join(f"\"{m}\".\"{f}\" AS \"{m}_{f}\"" for m in FT.ALL_MESSAGES for f, _ in expected(m))
        + f" FROM (SELECT device_id, e AS seq, ts_us, {', '.join(x for _, x in records)} FROM pb)")
    o["stream_arrival"] = f"WITH {BASE} SELECT device_id, e AS seq, e % 5 = 0 AS stamped, CASE WHEN e % 5 <> 0 THEN ts_us END AS ts_us FROM base"
    o["elapsed_us"] = _with_base(
        "SELECT device_id, e AS seq, ts_us - first_value(ts_us) OVER (PARTITION BY device_id ORDER BY e "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS elapsed_us FROM base")
    o["latest_n_clustered"] = o["latest_n"]
    o["elapsed_us_clustered"] = _with_base(
        "SELECT device_id, e AS seq, ts_us - first_value(ts_us) OVER (PARTITION BY device_id ORDER BY e "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS elapsed_us FROM pb WHERE parse_result = 'OK'")
    # long series
    o["signals_long"] = _with_base(" UNION ALL ".join(_signal_parts()))
    o["strings_long"] = _with_base(" UNION ALL ".join(_string_parts()))
    o["enums_long"] = _with_base(
        f"SELECT device_id, 'GGA' AS message, 'fix_state' AS field, e AS idx, CAST({gga['fix']} AS BIGINT) AS value "
        "FROM pb WHERE slot = 0 AND parse_result = 'OK'")
    dop = [("_timestamp", "CAST(ts_us AS DOUBLE)")] + [(n, f"CAST({x} AS DOUBLE)") for n, x in expected("NAV_DOP")]
    o["series_pivot"] = _with_base(
        "SELECT device_id, e AS idx, " + ", ".join(f"{x} AS \"{n}\"" for n, x in dop) + f" FROM pb WHERE {_ok('NAV_DOP')}")
    for m in FT.ALL_MESSAGES:
        if m != "NAV_DOP":
            ex = dict(expected(m))
            items = [("_timestamp", "CAST(ts_us AS DOUBLE)")] + [(n, _pack_value(m, n, ex[n])) for n, t in _numbers(m)]
            o["series_pivot_" + m.replace("NAV_", "").lower()] = _with_base(
                "SELECT device_id, e AS idx, " + ", ".join(f"{x} AS \"{n}\"" for n, x in items) + f" FROM pb WHERE {_ok(m)}")
    newest = (f"SELECT g.device_id, g.message, g.field, CAST(least(r.cnt, {N}) - r.rn AS BIGINT) AS idx, CAST(r.ts_us AS DOUBLE) AS timestamp, g.value "
              f"FROM ({o['signals_long']}) g JOIN ({_with_base(ranked)}) r ON r.device_id = g.device_id AND r.seq = g.idx WHERE r.rn <= {N}")
    o["aligned_series"] = newest
    o["series_slice"] = (f"SELECT device_id, message, field, idx - 1 AS k, value FROM ({newest}) WHERE idx IN (1, 2) AND (message, field) IN "
                         "(('GGA', 'latitude'), ('PVT', 'lon'), ('DOP', 'gDOP'), ('VELNED', 'speed'))")
    # packs
    okm = f"SELECT device_id, ts_us // {DAY_US} AS pack_id, {msg} AS message, e AS seq, ts_us FROM pb WHERE parse_result = 'OK'"
    names = ", ".join(f"('{m}')" for m in FT.ALL_MESSAGES)
    o["pack_sizes"] = _with_base(
        f"SELECT p.device_id, CAST(p.pack_id AS BIGINT) AS pack_id, m.message, CAST(count(o.seq) AS BIGINT) AS n "
        f"FROM (SELECT DISTINCT device_id, pack_id FROM ({okm})) p CROSS JOIN (VALUES {names}) m(message) "
        f"LEFT JOIN ({okm}) o ON o.device_id = p.device_id AND o.pack_id = p.pack_id AND o.message = m.message "
        "GROUP BY ALL")
    o["pack_build"] = _with_base(
        f"SELECT device_id, CAST(pack_id AS BIGINT) AS pack_id, message, CAST(count(*) AS BIGINT) AS n, "
        f"min(ts_us) AS first_ts, max(ts_us) AS last_ts FROM ({okm}) GROUP BY ALL")
    o["pack_build_rate"] = (f"SELECT device_id, CAST(ts_us // {DAY_US} AS BIGINT) AS pack_id, message, CAST(count(*) AS BIGINT) AS n, "
                            f"min(ts_us) AS first_ts, max(ts_us) AS last_ts FROM ({o['downsample_rate']}) GROUP BY ALL")
    labels = ", ".join(f"('{m}', '{FT.SERIES_LABEL[m]}')" for m in FT.ALL_MESSAGES)
    for kind in ("signals", "strings", "enums"):
        o[f"unpack_{kind}"] = (
            f"SELECT g.device_id, g.message, g.field, CAST(least(k.cnt, {N}) - k.rn AS BIGINT) AS idx, g.value FROM ({o[kind + '_long']}) g "
            "JOIN (SELECT r.device_id, l.label, r.seq, count(*) OVER (PARTITION BY r.device_id, r.message) AS cnt, "
            "row_number() OVER (PARTITION BY r.device_id, r.message ORDER BY r.seq DESC) AS rn "
            f"FROM ({o['resample_us']}) r JOIN (VALUES {labels}) l(m, label) ON l.m = r.message) k "
            f"ON k.device_id = g.device_id AND k.label = g.message AND k.seq = g.idx WHERE k.rn <= {N}")
    o["pack_explode"] = _with_base(
        f"SELECT device_id, CAST(pack_id AS BIGINT) AS pack_id, message, "
        f"CAST(row_number() OVER (PARTITION BY device_id, pack_id, message ORDER BY seq) - 1 AS BIGINT) AS pos, "
        f"ts_us AS _inner_timestamp FROM ({okm})")
    o["pack_fields"] = _with_base(_pack_rows("SELECT * FROM pb WHERE parse_result = 'OK'"))
    kept = f"SELECT pb.* FROM pb JOIN ({o['downsample_rate']}) k ON k.seq = pb.e"
    o["pack_fields_rate"] = _with_base(_pack_rows(kept))
    o["stream_packs_rate"] = o["pack_fields_rate"]
    # sinks and sources
    outputs = []
    for m in FT.ALL_MESSAGES:
        head = ",".join(["_timestamp", *FT.columns(m)])
        outputs.append(f"SELECT 'GPS_{m}.csv' AS output, '{head}' AS line UNION ALL SELECT 'GPS_{m}.csv', line "
                       f"FROM ({o['format_' + m.replace('NAV_', '').lower()]})")
    o["csv_fanout"] = " UNION ALL ".join(outputs)
    o["stream_csv_fanout"] = o["csv_fanout"]
    o["stream_quality"] = o["decode_quality"]
    raw_hex = "CASE WHEN protocol = 'UBX' THEN 'B562' || body_hex ELSE '244750' || body_hex || '0D0A' END"
    o["raw_reemit"] = _with(f"SELECT device_id, e AS seq, {raw_hex} AS raw_hex FROM fx")
    recno = "CAST(row_number() OVER (PARTITION BY device_id ORDER BY e) - 1 AS BIGINT)"
    o["capture_scan"] = _with(f"SELECT device_id, {recno} AS rec_no, ts_us, {raw_hex} AS raw_hex FROM fx")
    like = "28" + "1234567890123456".encode().hex().upper() + "29"
    odd_hex = (f"CASE WHEN protocol = 'UBX' AND length(body_hex) >= 48 THEN 'B562' || substr(body_hex, 1, 8) || '{like}' "
               f"|| substr(body_hex, 45) ELSE {raw_hex} END")
    o["capture_headers"] = _with(f"SELECT device_id, {recno} AS rec_no, ts_us, {odd_hex} AS raw_hex FROM fx")
    o["capture_headers_split"] = o["capture_headers"]
    o["capture_scan_split"] = o["capture_scan"]
    o["deframe"] = _with(
        f"SELECT device_id, {recno} AS rec_no, ts_us, protocol, CASE WHEN protocol = 'UBX' THEN 'B562' ELSE '244750' END "
        "AS start_hex, body_hex, CAST(body_len AS BIGINT) AS body_len, false AS truncated, 'OK' AS status FROM fx")
    o["deframe_split"] = o["deframe"]
    o["stream_capture"] = _with(
        "SELECT device_id, ts_us, protocol, CASE WHEN protocol = 'UBX' THEN 'B562' ELSE '244750' END "
        "AS start_hex, body_hex, CAST(body_len AS BIGINT) AS body_len, false AS truncated, 'OK' AS status FROM fx")
    # a record is lost when an odd number of cut frames stand right before it: the last of them is read on into it
    o["capture_unfinished"] = _with(
        f"SELECT device_id, CAST(row_number() OVER (PARTITION BY device_id ORDER BY e) - 1 AS BIGINT) AS rec_no, ts_us, "
        "own || CASE WHEN cut AND behind IS NOT NULL THEN behind ELSE '' END AS raw_hex, "
        "CASE WHEN cut AND behind IS NULL THEN 'INCOMPLETE' ELSE 'OK' END AS status FROM ("
        "SELECT *, rn - 1 - coalesce(max(CASE WHEN NOT cut THEN rn END) OVER (PARTITION BY device_id ORDER BY e "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cuts, lead('28' || hex(printf('%016d', ts_us)) || '29' || own) "
        "OVER (PARTITION BY device_id ORDER BY e) AS behind FROM ("
        "SELECT device_id, e, ts_us, protocol = 'UBX' AND e % 5 = 0 AS cut, row_number() OVER (PARTITION BY device_id ORDER BY e) AS rn, "
        f"CASE WHEN protocol = 'UBX' AND e % 5 = 0 THEN left({raw_hex}, length({raw_hex}) - 16) ELSE {raw_hex} END AS own FROM fx)) WHERE cuts % 2 = 0")
    full = "(length(text) + 1 + 200 + (e * 7) % 150)"
    wide = "(body_len + 200 + (e * 7) % 150)"
    o["deframe_truncate"] = _with(
        f"SELECT device_id, {recno} AS rec_no, CAST(least(CASE WHEN protocol = 'NMEA' THEN {full} ELSE {wide} END, 299) AS BIGINT) AS body_len, "
        f"CASE WHEN protocol = 'NMEA' THEN {full} >= 299 ELSE {wide} > 299 END AS truncated, 'OK' AS status FROM fx")
    o["deframe_incomplete"] = _with(
        "SELECT device_id, status, count(*) AS records FROM (SELECT device_id, CASE WHEN e = max(e) OVER "
        "(PARTITION BY device_id) THEN 'INCOMPLETE' ELSE 'OK' END AS status FROM fx) GROUP BY ALL")
    return o


def _pack_value(message: str, name: str, x: str) -> str:
    hp = {h for _, h in FT.HP_ADD.get(message, [])}
    if name in hp:
        return f"CAST(CAST(trunc({x}) AS INTEGER) AS DOUBLE)"
    return f"CAST({x} AS DOUBLE)"


def _signal_parts() -> list[str]:
    parts = []
    for m in FT.ALL_MESSAGES:
        ex = dict(expected(m))
        lab = FT.SERIES_LABEL[m]
        items = [("_timestamp", "CAST(ts_us AS DOUBLE)")]
        for name, t in pack_fields(m):
            if t != "string":
                items.append((name, _pack_value(m, name, ex[name])))
        for name, x in items:
            parts.append(f"SELECT device_id, '{lab}' AS message, '{name}' AS field, e AS idx, {x} AS value "
                         f"FROM pb WHERE {_ok(m)}")
    return parts


def _string_parts() -> list[str]:
    parts = []
    for m, names in FT.SERIES_STRINGS.items():
        ex = dict(expected(m))
        for name in names:
            parts.append(f"SELECT device_id, '{FT.SERIES_LABEL[m]}' AS message, '{name}' AS field, e AS idx, "
                         f"CAST({ex[name]} AS VARCHAR) AS value FROM pb WHERE {_ok(m)}")
    return parts


def _numbers(message: str) -> list[tuple[str, str]]:
    return [(n, t) for n, t in pack_fields(message) if t != "string"]


def _pack_rows(rows: str) -> str:
    """Every field of every record of daily packs of ``rows`` (columns of pb)."""
    parts = []
    for m in FT.ALL_MESSAGES:
        ex = dict(expected(m))
        fields = [("_inner_timestamp", "CAST(ts_us AS DOUBLE)", "NULL")]
        fields += [(n, "NULL", ex[n]) if t == "string" else (n, _pack_value(m, n, ex[n]), "NULL") for n, t in pack_fields(m)]
        parts.append(
            f"SELECT device_id, CAST(ts_us // {DAY_US} AS BIGINT) AS pack_id, '{m}' AS message, "
            f"CAST(row_number() OVER (PARTITION BY device_id, ts_us // {DAY_US} ORDER BY e) - 1 AS BIGINT) AS pos, "
            "unnest([" + ", ".join(f"'{n}'" for n, _, _ in fields) + "]) AS field, "
            "unnest([" + ", ".join(f"CAST({v} AS DOUBLE)" for _, v, _ in fields) + "]) AS value, "
            "unnest([" + ", ".join(f"CAST({t} AS VARCHAR)" for _, _, t in fields) + f"]) AS text FROM ({rows}) WHERE slot = {SLOT[m]}")
    return " UNION ALL ".join(parts)
