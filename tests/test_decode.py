"""Golden vectors per message and per defect (FIXTURES.md §4)."""

import pytest

from frame_rows import make_frames
from skytrace.operators.classify import classify
from skytrace.operators.decode import decode

GOLD = {
    "NAV_DOP": "0104120040e2010096008c00820078006e0064005a0082d4",
    "NAV_VELNED": "0112240040e2010006ffffff7d000000fdffffff18010000170100006825ea000c00000090d00300ebf1",
    "NAV_HPPOSLLH": "011424000000000040e20100074ea106f566751b121203007a560200d343fb03b0360000204e0000a429",
    "NAV_HPPOSECEF": "01131c000000000040e20100d2fae61924971705cfbfb8e40cde630039300000d5d5",
    "NAV_RELPOSNED": "013c400001004d0040e20100e803000030f8ffff1e000000bc080000b985c4010000000005fa07f8640000006e00"
                     "00007800000082000000c8af000000000000370100005ddc",
    "NAV_PVT": "01075c0040e20100e807010203040507190000002efbffff0301ea0c074ea106f566751b121203007a560200840300"
               "007805000050fbffff540100000f000000df0400001482fa005000000090d003008c00000000000000803efa003601"
               "2d0025db",
}


def one(spark, proto, body, message, compat=True):
    c = classify(make_frames(spark, [(proto, body)]))
    rows = decode(c, message, compat).collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_dop(spark):
    r = one(spark, "UBX", bytes.fromhex(GOLD["NAV_DOP"]), "NAV_DOP")
    assert r["iTOW"] == 123456
    assert [r[k] for k in ["gDOP", "tDOP", "vDOP", "hDOP", "nDOP", "eDOP"]] == [1.5, 1.3, 1.2, 1.1, 1.0, 0.9]
    assert r["pDOP"] == 140 * 0.01


def test_velned(spark):
    r = one(spark, "UBX", bytes.fromhex(GOLD["NAV_VELNED"]), "NAV_VELNED")
    assert r["velN"] == -2.5 and r["velE"] == 125 * 1e-2 and r["velD"] == -3 * 1e-2
    assert r["heading"] == 153.45000000000002 and r["cAcc"] == 2.5


def test_hpposllh_adds_hp(spark):
    r = one(spark, "UBX", bytes.fromhex(GOLD["NAV_HPPOSLLH"]), "NAV_HPPOSLLH")
    assert r["lon"] == 11.123456655 and r["lat"] == 46.067890167
    assert r["height"] == 201.23350000000002 and r["hMSL"] == 153.21030000000002
    assert r["hAcc"] == 1.4000000000000001 and r["vAcc"] == 20000 * 1e-4


def test_hpposecef_adds_hp_and_truncates_pacc(spark):
    r = one(spark, "UBX", bytes.fromhex(GOLD["NAV_HPPOSECEF"]), "NAV_HPPOSECEF")
    assert (r["ecefX"], r["ecefY"], r["ecefZ"]) == (4345678.9012, 854320.9966, -4576543.2001)
    assert r["pAcc"] == 1


def test_relposned_no_hp_addition(spark):
    r = one(spark, "UBX", bytes.fromhex(GOLD["NAV_RELPOSNED"]), "NAV_RELPOSNED")
    assert r["refStationId"] == 77 and r["relPosN"] == 1000 * 0.01 and r["relPosE"] == -2000 * 0.01
    assert r["relPosHeading"] == 29656505 * 1e-5 and r["flags"] == 311
    assert (r["relPosHPN"], r["relPosHPE"]) == (5 * 1e-4, -6 * 1e-4)


def test_pvt_compat_overread_and_spec(spark):
    r = one(spark, "UBX", bytes.fromhex(GOLD["NAV_PVT"]), "NAV_PVT")
    assert (r["year"], r["month"], r["day"], r["hour"], r["min"], r["sec"]) == (2024, 1, 2, 3, 4, 5)
    assert r["nano"] == -1234 and r["fixType"] == 3 and r["numSV"] == 12
    assert r["magDec"] == 29494.3 and r["magAcc"] == 36766351.81
    r2 = one(spark, "UBX", bytes.fromhex(GOLD["NAV_PVT"]), "NAV_PVT", compat=False)
    assert r2["magDec"] == 3.1 and r2["magAcc"] == 0.45


def test_gga(spark):
    r = one(spark, "NMEA", b"GGA,123519.00,4807.038,N,01131.000,E,1,08,0.9,545.4,M,46.9,M,,*47", "GGA")
    assert r["time"] == "123519.00" and "%.9f" % r["latitude"] == "48.117300000"
    assert "%.9f" % r["longitude"] == "11.516666667" and r["north_south"] == "N" and r["east_ovest"] == "E"
    assert r["fix"] == 1 and r["satellites"] == 8 and r["horizontal_diluition_precision"] == 0.9
    assert r["altitude"] == 545.4 and r["age_of_correction"] == 0.0 and r["fix_state"] == "Standard GPS (2D/3D)"


def test_gga_empty_tokens(spark):
    r = one(spark, "NMEA", b"GGA,,,,,,0,00,,,M,,M,,", "GGA")
    assert r["latitude"] == 0.0 and r["north_south"] == "," and r["east_ovest"] == ","
    assert r["time"] == ",,,,,0,00"


def test_gga_missing_tokens_are_null(spark):
    r = one(spark, "NMEA", b"GGA,123519.00,4807.038", "GGA")
    assert r["time"] == "123519.00" and r["longitude"] is None and r["fix"] is None


def test_vtg_gsa(spark):
    r = one(spark, "NMEA", b"VTG,054.7,T,034.4,M,005.5,N,010.2,K*48", "VTG")
    assert (r["course_over_ground_degrees"], r["course_over_ground_degrees_magnetic"], r["speed_kmh"]) == (54.7, 34.4, 10.2)
    r = one(spark, "NMEA", b"GSA,A,3,04,05,,09,12,,,24,,,,,2.5,1.3,2.1*39", "GSA")
    assert r["mode"] == "A" and r["position_diluition_precision"] == 2.5 and r["vertical_diluition_precision"] == 2.1


@pytest.mark.parametrize("checksum", ["vectorized", "expression"])
def test_parse_results(spark, checksum):
    bad = bytearray(bytes.fromhex(GOLD["NAV_DOP"]))
    bad[-1] = (bad[-1] + 1) % 256
    nav35 = bytes([1, 0x35, 0, 0])
    a = sum(nav35) % 256
    b = sum((4 - i) * x for i, x in enumerate(nav35)) % 256
    rows = [("UBX", bytes(bad)), ("UBX", nav35 + bytes([a, b])), ("NMEA", b"RMC,1,2"),
            ("UBX", bytes.fromhex(GOLD["NAV_DOP"])), ("NMEA", b"GSA,A")]
    got = [r.parse_result for r in classify(make_frames(spark, rows), checksum=checksum).orderBy("seq").collect()]
    assert got == ["CHECKSUM", "NO_MATCH", "NO_MATCH", "OK", "OK"]


def test_short_payload_reads_checksum_then_zeros(spark):
    payload = bytes.fromhex("40e20100")
    core = bytes([1, 4, 4, 0]) + payload
    a = sum(core) % 256
    b = sum((len(core) - i) * x for i, x in enumerate(core)) % 256
    r = one(spark, "UBX", core + bytes([a, b]), "NAV_DOP")
    assert r["iTOW"] == 123456 and r["gDOP"] == (a + 256 * b) * 0.01 and r["pDOP"] == 0.0


def test_oversize_declared_length_fails(spark):
    body = bytes([1, 4, 0x90, 0x01]) + bytes(295)
    got = classify(make_frames(spark, [("UBX", body)])).collect()[0]
    assert got.parse_result == "CHECKSUM"
