"""Declarative message layouts.

FIXED VALUES (must equal the receiver protocol contract and the output contract
of the engine being replaced): message ids, byte offsets, wire types, scales,
printf formats and column spellings (including `diluition` and `east_ovest`).
Everything else in the package is generated from these tables.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- FIXED VALUES
NMEA_MESSAGES = ["GGA", "VTG", "GSA"]
UBX_MESSAGES = ["NAV_DOP", "NAV_PVT", "NAV_HPPOSECEF", "NAV_HPPOSLLH", "NAV_RELPOSNED", "NAV_VELNED"]
ALL_MESSAGES = NMEA_MESSAGES + UBX_MESSAGES
UBX_NAV_CLASS = 0x01
UBX_IDS = {
    "NAV_DOP": 0x04,
    "NAV_PVT": 0x07,
    "NAV_HPPOSECEF": 0x13,
    "NAV_HPPOSLLH": 0x14,
    "NAV_RELPOSNED": 0x3C,
    "NAV_VELNED": 0x12,
}
# short labels used by the value-series (signals/enums/strings) outputs
SERIES_LABEL = {
    "GGA": "GGA", "VTG": "VTG", "GSA": "GSA",
    "NAV_DOP": "DOP", "NAV_PVT": "PVT", "NAV_HPPOSECEF": "HPPOSECEF",
    "NAV_HPPOSLLH": "HPPOSLLH", "NAV_RELPOSNED": "RELPOSNED", "NAV_VELNED": "VELNED",
}
# lower-case list names of the nested pack
PACK_LIST = {
    "GGA": "gga", "VTG": "vtg", "GSA": "gsa",
    "NAV_DOP": "dop", "NAV_PVT": "pvt", "NAV_HPPOSECEF": "hpposecef",
    "NAV_HPPOSLLH": "hpposllh", "NAV_RELPOSNED": "relposned", "NAV_VELNED": "velned",
}
MAX_LINE = 300          # frame buffer incl. terminator; 299 body bytes usable
RING_CAPACITY = 2000    # latest-N retention of value series

FIX_STATE_NAMES = {
    0: "FIX NOT AVAILABLE OR INVALID",
    1: "Standard GPS (2D/3D)",
    2: "DIFFERENTIAL GPS",
    3: "RTK Fixed",
    4: "RTK Float",
    5: "DEAD RECKONING MODE FIX VALID",
}
FIX_STATE_UNKNOWN = "unknown FIX STATE"
FIX_MODE_NAMES = {0: "FIX NOT AVAILABLE", 1: "2D", 2: "3D"}
FIX_MODE_UNKNOWN = "unknown FIX MODE"
NMEA_UNKNOWN = "unkown NMEA message"
UBX_UNKNOWN = "unknown UBX message"
PARSE_RESULTS = ["OK", "NO_MATCH", "MESSAGE_EMPTY", "MESAGE_LENGTH", "MESSAGE_UNDEFINED", "FIELD_ERROR", "CHECKSUM"]
PARSE_RESULT_UNKNOWN = "unknown PARSE RESULT"


@dataclass(frozen=True)
class Field:
    name: str
    offset: int        # byte offset inside the UBX payload
    wire: str          # u1 u2 u4 i1 i2 i4 (little endian)
    kind: str          # "int" -> integer column, "double" -> scaled double, "trunc" -> scaled then truncated
    scale: float
    fmt: str           # C printf format used by the CSV rows


def _f(name, offset, wire, kind, scale, fmt):
    return Field(name, offset, wire, kind, scale, fmt)


# (name, payload offset, wire type, kind, scale, printf format)
UBX_FIELDS = {
    "NAV_DOP": [
        _f("iTOW", 0, "u4", "int", 1, "%d"),
        _f("gDOP", 4, "u2", "double", 0.01, "%f"),
        _f("pDOP", 6, "u2", "double", 0.01, "%f"),
        _f("tDOP", 8, "u2", "double", 0.01, "%f"),
        _f("vDOP", 10, "u2", "double", 0.01, "%f"),
        _f("hDOP", 12, "u2", "double", 0.01, "%f"),
        _f("nDOP", 14, "u2", "double", 0.01, "%f"),
        _f("eDOP", 16, "u2", "double", 0.01, "%f"),
    ],
    "NAV_PVT": [
        _f("iTOW", 0, "u4", "int", 1, "%d"),
        _f("year", 4, "u2", "int", 1, "%d"),
        _f("month", 6, "u1", "int", 1, "%d"),
        _f("day", 7, "u1", "int", 1, "%d"),
        _f("hour", 8, "u1", "int", 1, "%d"),
        _f("min", 9, "u1", "int", 1, "%d"),
        _f("sec", 10, "u1", "int", 1, "%d"),
        _f("valid", 11, "u1", "int", 1, "%d"),
        _f("tAcc", 12, "u4", "int", 1, "%d"),
        _f("nano", 16, "i4", "int", 1, "%d"),
        _f("fixType", 20, "u1", "int", 1, "%d"),
        _f("flags", 21, "u1", "int", 1, "%d"),
        _f("flags2", 22, "u1", "int", 1, "%d"),
        _f("numSV", 23, "u1", "int", 1, "%d"),
        _f("lon", 24, "i4", "double", 1e-7, "%.7f"),
        _f("lat", 28, "i4", "double", 1e-7, "%.7f"),
        _f("height", 32, "i4", "double", 1e-3, "%f"),
        _f("hMSL", 36, "i4", "double", 1e-3, "%f"),
        _f("hAcc", 40, "u4", "double", 1e-3, "%f"),
        _f("vAcc", 44, "u4", "double", 1e-3, "%f"),
        _f("velN", 48, "i4", "double", 1e-3, "%f"),
        _f("velE", 52, "i4", "double", 1e-3, "%f"),
        _f("velD", 56, "i4", "double", 1e-3, "%f"),
        _f("gSpeed", 60, "i4", "double", 1e-3, "%f"),
        _f("headMot", 64, "i4", "double", 1e-5, "%f"),
        _f("sAcc", 68, "u4", "double", 1e-3, "%f"),
        _f("headAcc", 72, "u4", "double", 1e-5, "%f"),
        _f("pDOP", 76, "u2", "double", 0.01, "%f"),
        _f("headVeh", 84, "i4", "double", 1e-5, "%f"),
        _f("magDec", 88, "i4", "double", 1e-2, "%f"),   # 4-byte read: defect kept in compat mode
        _f("magAcc", 90, "u4", "double", 1e-2, "%f"),   # 4-byte read: reaches the checksum bytes
    ],
    "NAV_HPPOSECEF": [
        _f("version", 0, "u1", "int", 1, "%d"),
        _f("iTOW", 4, "u4", "int", 1, "%d"),
        _f("ecefX", 8, "i4", "double", 1e-2, "%f"),
        _f("ecefY", 12, "i4", "double", 1e-2, "%f"),
        _f("ecefZ", 16, "i4", "double", 1e-2, "%f"),
        _f("ecefXHp", 20, "i1", "double", 1e-4, "%f"),
        _f("ecefYHp", 21, "i1", "double", 1e-4, "%f"),
        _f("ecefZHp", 22, "i1", "double", 1e-4, "%f"),
        _f("pAcc", 24, "u4", "trunc", 1e-4, "%d"),
    ],
    "NAV_HPPOSLLH": [
        _f("version", 0, "u1", "int", 1, "%d"),
        _f("iTOW", 4, "u4", "int", 1, "%d"),
        _f("lon", 8, "i4", "double", 1e-7, "%.9f"),
        _f("lat", 12, "i4", "double", 1e-7, "%.9f"),
        _f("height", 16, "i4", "double", 1e-3, "%f"),
        _f("hMSL", 20, "i4", "double", 1e-3, "%f"),
        _f("lonHp", 24, "i1", "double", 1e-9, "%.9f"),
        _f("latHp", 25, "i1", "double", 1e-9, "%.9f"),
        _f("heightHp", 26, "i1", "double", 1e-4, "%f"),
        _f("hMSLHp", 27, "i1", "double", 1e-4, "%f"),
        _f("hAcc", 28, "u4", "double", 1e-4, "%f"),
        _f("vAcc", 32, "u4", "double", 1e-4, "%f"),
    ],
    "NAV_RELPOSNED": [
        _f("version", 0, "u1", "int", 1, "%d"),
        _f("refStationId", 2, "u2", "int", 1, "%d"),
        _f("iTOW", 4, "u4", "int", 1, "%d"),
        _f("relPosN", 8, "i4", "double", 0.01, "%f"),
        _f("relPosE", 12, "i4", "double", 0.01, "%f"),
        _f("relPosD", 16, "i4", "double", 0.01, "%f"),
        _f("relPosLength", 20, "i4", "double", 0.01, "%f"),
        _f("relPosHeading", 24, "i4", "double", 1e-5, "%f"),
        _f("relPosHPN", 32, "i1", "double", 1e-4, "%f"),
        _f("relPosHPE", 33, "i1", "double", 1e-4, "%f"),
        _f("relPosHPD", 34, "i1", "double", 1e-4, "%f"),
        _f("relPosHPLength", 35, "i1", "double", 1e-4, "%f"),
        _f("accN", 36, "u4", "double", 1e-4, "%f"),
        _f("accE", 40, "u4", "double", 1e-4, "%f"),
        _f("accD", 44, "u4", "double", 1e-4, "%f"),
        _f("accLength", 48, "u4", "double", 1e-4, "%f"),
        _f("accHeading", 52, "u4", "double", 1e-5, "%f"),
        _f("flags", 60, "u4", "int", 1, "%d"),
    ],
    "NAV_VELNED": [
        _f("iTOW", 0, "u4", "int", 1, "%d"),
        _f("velN", 4, "i4", "double", 1e-2, "%f"),
        _f("velE", 8, "i4", "double", 1e-2, "%f"),
        _f("velD", 12, "i4", "double", 1e-2, "%f"),
        _f("speed", 16, "u4", "double", 1e-2, "%f"),
        _f("gSpeed", 20, "u4", "double", 1e-2, "%f"),
        _f("heading", 24, "i4", "double", 1e-5, "%f"),
        _f("sAcc", 28, "u4", "double", 1e-2, "%f"),
        _f("cAcc", 32, "u4", "double", 1e-5, "%f"),
    ],
}
# high-precision parts added to their main component after scaling
HP_ADD = {
    "NAV_HPPOSECEF": [("ecefX", "ecefXHp"), ("ecefY", "ecefYHp"), ("ecefZ", "ecefZHp")],
    "NAV_HPPOSLLH": [("lon", "lonHp"), ("lat", "latHp"), ("height", "heightHp"), ("hMSL", "hMSLHp")],
}
# payload lengths of the protocol specification (used when encoding frames)
UBX_PAYLOAD_LEN = {
    "NAV_DOP": 18, "NAV_PVT": 92, "NAV_HPPOSECEF": 28, "NAV_HPPOSLLH": 36,
    "NAV_RELPOSNED": 64, "NAV_VELNED": 36,
}
# the protocol's own widths for the two PVT fields the compat decoder over-reads
PVT_SPEC_WIDTH = {"magDec": "i2", "magAcc": "u2"}

# NMEA token layout: (column, token index, kind); kinds: time, deg (ddmm.m),
# char, int (strtol into uint8), double (strtod)
NMEA_FIELDS = {
    "GGA": [
        ("time", 1, "time"),
        ("latitude", 2, "deg"),
        ("north_south", 3, "char"),
        ("longitude", 4, "deg"),
        ("east_ovest", 5, "char"),
        ("fix", 6, "int"),
        ("satellites", 7, "int"),
        ("horizontal_diluition_precision", 8, "double"),
        ("altitude", 9, "double"),
        ("age_of_correction", 13, "double"),
    ],
    "VTG": [
        ("course_over_ground_degrees", 1, "double"),
        ("course_over_ground_degrees_magnetic", 3, "double"),
        ("speed_kmh", 7, "double"),
    ],
    "GSA": [
        ("mode", 1, "char"),
        ("position_diluition_precision", 15, "double"),
        ("horizontal_diluition_precision", 16, "double"),
        ("vertical_diluition_precision", 17, "double"),
    ],
}
# CSV column order of each output (after `_timestamp`)
NMEA_COLUMNS = {
    "GGA": ["time", "latitude", "north_south", "longitude", "east_ovest", "fix", "satellites",
            "horizontal_diluition_precision", "fix_state", "altitude", "age_of_correction"],
    "VTG": ["course_over_ground_degrees", "course_over_ground_degrees_magnetic", "speed_kmh"],
    "GSA": ["mode", "position_diluition_precision", "horizontal_diluition_precision",
            "vertical_diluition_precision"],
}
NMEA_FORMATS = {
    "GGA": ['"%s"', "%.9f", "%s", "%.9f", "%s", "%d", "%d", "%.9f", '"%s"', "%.9f", "%.9f"],
    "VTG": ["%.9f", "%.9f", "%.9f"],
    "GSA": ["%s", "%.9f", "%.9f", "%.9f"],
}
# value-series split of GGA (strings / enums); all other numeric columns are signals
SERIES_STRINGS = {"GGA": ["time", "north_south", "east_ovest", "fix_state"], "GSA": ["mode"]}
SERIES_ENUMS = {"GGA": [("fix_state", "fix")]}
# ------------------------------------------------------------ end FIXED VALUES

WIRE_BYTES = {"u1": 1, "i1": 1, "u2": 2, "i2": 2, "u4": 4, "i4": 4}


def columns(message: str) -> list[str]:
    """Decoded column names of a message in output (CSV header) order."""
    if message in UBX_FIELDS:
        return [f.name for f in UBX_FIELDS[message]]
    return list(NMEA_COLUMNS[message])


def spark_type(message: str, col: str) -> str:
    """Spark SQL type of a decoded column."""
    if message in UBX_FIELDS:
        f = next(x for x in UBX_FIELDS[message] if x.name == col)
        if f.kind == "double":
            return "double"
        if f.kind == "trunc":
            return "bigint"
        return {"u4": "bigint", "i4": "int", "u2": "int", "i2": "smallint", "u1": "smallint", "i1": "smallint"}[f.wire]
    if col in ("time", "north_south", "east_ovest", "fix_state", "mode"):
        return "string"
    if col in ("fix", "satellites"):
        return "smallint"
    return "double"
