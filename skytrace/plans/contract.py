"""What a receiver writes and what the outputs must hold, stated apart from the engine's own tables.

``sources.derive`` writes frames by these layouts and ``plans.oracle`` states the expected values by them; the engine
decodes by ``functions.fields``. A wrong offset, type, scale, format or name there therefore shows as a
difference. Nothing here is imported from the engine.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- FIXED VALUES
# message, id and payload bytes; its fields: name, offset, wire type (little endian), decoded as, scale, printf format,
# column type, type in a pack
UBX = """
NAV_DOP 0x04 18
  iTOW 0 u4 int 1 %d bigint bigint
  gDOP 4 u2 double 0.01 %f double double
  pDOP 6 u2 double 0.01 %f double double
  tDOP 8 u2 double 0.01 %f double double
  vDOP 10 u2 double 0.01 %f double double
  hDOP 12 u2 double 0.01 %f double double
  nDOP 14 u2 double 0.01 %f double double
  eDOP 16 u2 double 0.01 %f double double
NAV_PVT 0x07 92
  iTOW 0 u4 int 1 %d bigint bigint
  year 4 u2 int 1 %d int bigint
  month 6 u1 int 1 %d smallint bigint
  day 7 u1 int 1 %d smallint bigint
  hour 8 u1 int 1 %d smallint bigint
  min 9 u1 int 1 %d smallint bigint
  sec 10 u1 int 1 %d smallint bigint
  valid 11 u1 int 1 %d smallint bigint
  tAcc 12 u4 int 1 %d bigint bigint
  nano 16 i4 int 1 %d int int
  fixType 20 u1 int 1 %d smallint bigint
  flags 21 u1 int 1 %d smallint bigint
  flags2 22 u1 int 1 %d smallint bigint
  numSV 23 u1 int 1 %d smallint bigint
  lon 24 i4 double 1e-07 %.7f double double
  lat 28 i4 double 1e-07 %.7f double double
  height 32 i4 double 0.001 %f double double
  hMSL 36 i4 double 0.001 %f double double
  hAcc 40 u4 double 0.001 %f double double
  vAcc 44 u4 double 0.001 %f double double
  velN 48 i4 double 0.001 %f double double
  velE 52 i4 double 0.001 %f double double
  velD 56 i4 double 0.001 %f double double
  gSpeed 60 i4 double 0.001 %f double double
  headMot 64 i4 double 1e-05 %f double double
  sAcc 68 u4 double 0.001 %f double double
  headAcc 72 u4 double 1e-05 %f double double
  pDOP 76 u2 double 0.01 %f double double
  headVeh 84 i4 double 1e-05 %f double double
  magDec 88 i2 double 0.01 %f double double
  magAcc 90 u2 double 0.01 %f double double
NAV_HPPOSECEF 0x13 28
  version 0 u1 int 1 %d smallint bigint
  iTOW 4 u4 int 1 %d bigint bigint
  ecefX 8 i4 double 0.01 %f double double
  ecefY 12 i4 double 0.01 %f double double
  ecefZ 16 i4 double 0.01 %f double double
  ecefXHp 20 i1 double 0.0001 %f double int
  ecefYHp 21 i1 double 0.0001 %f double int
  ecefZHp 22 i1 double 0.0001 %f double int
  pAcc 24 u4 trunc 0.0001 %d bigint double
NAV_HPPOSLLH 0x14 36
  version 0 u1 int 1 %d smallint bigint
  iTOW 4 u4 int 1 %d bigint bigint
  lon 8 i4 double 1e-07 %.9f double double
  lat 12 i4 double 1e-07 %.9f double double
  height 16 i4 double 0.001 %f double double
  hMSL 20 i4 double 0.001 %f double double
  lonHp 24 i1 double 1e-09 %.9f double int
  latHp 25 i1 double 1e-09 %.9f double int
  heightHp 26 i1 double 0.0001 %f double int
  hMSLHp 27 i1 double 0.0001 %f double int
  hAcc 28 u4 double 0.0001 %f double double
  vAcc 32 u4 double 0.0001 %f double double
NAV_RELPOSNED 0x3C 64
  version 0 u1 int 1 %d smallint bigint
  refStationId 2 u2 int 1 %d int bigint
  iTOW 4 u4 int 1 %d bigint bigint
  relPosN 8 i4 double 0.01 %f double double
  relPosE 12 i4 double 0.01 %f double double
  relPosD 16 i4 double 0.01 %f double double
  relPosLength 20 i4 double 0.01 %f double double
  relPosHeading 24 i4 double 1e-05 %f double double
  relPosHPN 32 i1 double 0.0001 %f double double
  relPosHPE 33 i1 double 0.0001 %f double double
  relPosHPD 34 i1 double 0.0001 %f double double
  relPosHPLength 35 i1 double 0.0001 %f double double
  accN 36 u4 double 0.0001 %f double double
  accE 40 u4 double 0.0001 %f double double
  accD 44 u4 double 0.0001 %f double double
  accLength 48 u4 double 0.0001 %f double double
  accHeading 52 u4 double 1e-05 %f double double
  flags 60 u4 int 1 %d bigint bigint
NAV_VELNED 0x12 36
  iTOW 0 u4 int 1 %d bigint bigint
  velN 4 i4 double 0.01 %f double double
  velE 8 i4 double 0.01 %f double double
  velD 12 i4 double 0.01 %f double double
  speed 16 u4 double 0.01 %f double double
  gSpeed 20 u4 double 0.01 %f double double
  heading 24 i4 double 1e-05 %f double double
  sAcc 28 u4 double 0.01 %f double double
  cAcc 32 u4 double 1e-05 %f double double
"""
# message; its columns in output order: name, printf format, column type, type in a pack (-: not packed)
NMEA = """
GGA
  time "%s" string string
  latitude %.9f double double
  north_south %s string string
  longitude %.9f double double
  east_ovest %s string string
  fix %d smallint bigint
  satellites %d smallint bigint
  horizontal_diluition_precision %.9f double double
  fix_state "%s" string -
  altitude %.9f double double
  age_of_correction %.9f double double
VTG
  course_over_ground_degrees %.9f double double
  course_over_ground_degrees_magnetic %.9f double double
  speed_kmh %.9f double double
GSA
  mode %s string string
  position_diluition_precision %.9f double double
  horizontal_diluition_precision %.9f double double
  vertical_diluition_precision %.9f double double
"""
HP_ADD = {"NAV_HPPOSECEF": [("ecefX", "ecefXHp"), ("ecefY", "ecefYHp"), ("ecefZ", "ecefZHp")],
          "NAV_HPPOSLLH": [("lon", "lonHp"), ("lat", "latHp"), ("height", "heightHp"), ("hMSL", "hMSLHp")]}
FIX_STATE_NAMES = {0: 'FIX NOT AVAILABLE OR INVALID', 1: 'Standard GPS (2D/3D)', 2: 'DIFFERENTIAL GPS', 3: 'RTK Fixed', 4: 'RTK Float', 5: 'DEAD RECKONING MODE FIX VALID'}
FIX_STATE_UNKNOWN = 'unknown FIX STATE'
FIX_MODE_NAMES = {0: 'FIX NOT AVAILABLE', 1: '2D', 2: '3D'}
FIX_MODE_UNKNOWN = 'unknown FIX MODE'
NMEA_UNKNOWN, UBX_UNKNOWN = 'unkown NMEA message', 'unknown UBX message'
PARSE_RESULTS = ['OK', 'NO_MATCH', 'MESSAGE_EMPTY', 'MESAGE_LENGTH', 'MESSAGE_UNDEFINED', 'FIELD_ERROR', 'CHECKSUM']
SERIES_STRINGS = {'GGA': ['time', 'north_south', 'east_ovest', 'fix_state'], 'GSA': ['mode']}
# ------------------------------------------------------------ end FIXED VALUES

WIRE_BYTES = {"u1": 1, "i1": 1, "u2": 2, "i2": 2, "u4": 4, "i4": 4}
CORRUPT_EVERY = 97  # of the derived UBX frames one in so many has a wrong checksum


@dataclass(frozen=True)
class Field:
    name: str
    offset: int
    wire: str
    kind: str
    scale: float
    fmt: str
    column: str
    pack: str


UBX_FIELDS: dict[str, list[Field]] = {}
UBX_IDS: dict[str, int] = {}
UBX_PAYLOAD_LEN: dict[str, int] = {}
for _line in UBX.strip().splitlines():
    _w = _line.split()
    if not _line.startswith(" "):
        _m = _w[0]
        UBX_IDS[_m], UBX_PAYLOAD_LEN[_m], UBX_FIELDS[_m] = int(_w[1], 16), int(_w[2]), []
    else:
        UBX_FIELDS[_m].append(Field(_w[0], int(_w[1]), _w[2], _w[3], float(_w[4]), *_w[5:]))
NMEA_COLUMNS: dict[str, list[tuple[str, str, str, str]]] = {}
for _line in NMEA.strip().splitlines():
    if not _line.startswith(" "):
        _m = _line
        NMEA_COLUMNS[_m] = []
    else:
        NMEA_COLUMNS[_m].append(tuple(_line.split()))
NMEA_FORMATS = {m: [c[1] for c in cs] for m, cs in NMEA_COLUMNS.items()}
NMEA_MESSAGES, UBX_MESSAGES = list(NMEA_COLUMNS), list(UBX_FIELDS)
ALL_MESSAGES = NMEA_MESSAGES + UBX_MESSAGES
SERIES_LABEL = {m: m.replace("NAV_", "") for m in ALL_MESSAGES}


def columns(message: str) -> list[str]:
    return [f.name for f in UBX_FIELDS[message]] if message in UBX_FIELDS else [c[0] for c in NMEA_COLUMNS[message]]


def spark_type(message: str, name: str) -> str:
    if message in UBX_FIELDS:
        return next(f.column for f in UBX_FIELDS[message] if f.name == name)
    return next(c[2] for c in NMEA_COLUMNS[message] if c[0] == name)


def pack_fields(message: str) -> list[tuple[str, str]]:
    if message in UBX_FIELDS:
        return [(f.name, f.pack) for f in UBX_FIELDS[message]]
    return [(c[0], c[3]) for c in NMEA_COLUMNS[message] if c[3] != "-"]


def raw_sql(i: int, wire: str) -> str:
    """Raw integer of field number ``i`` with wire type ``wire`` (SQL valid in Spark and DuckDB)."""
    return {
        "u4": f"(e + {i} * v)",
        "u2": f"((v + {i}) % 65536)",
        "u1": f"((e + {i}) % 256)",
        "i4": f"(s * 60000 + {i})",
        "i2": f"(s + {i})",
        "i1": f"((e + {i}) % 256 - 128)",
    }[wire]


def wire_layout(message: str) -> list[tuple[str, int, str, str]]:
    """(name, offset, wire type, raw SQL) of each field as a receiver writes it."""
    return [(f.name, f.offset, f.wire, raw_sql(i, f.wire)) for i, f in enumerate(UBX_FIELDS[message])]
