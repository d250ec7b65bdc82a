"""Frame tables for tests."""

FRAME_SCHEMA = ("device_id long, seq long, ts_us long, protocol string, start_seq binary, body binary, "
                "body_len int, truncated boolean, status string")


def make_frames(spark, rows):
    """rows: (protocol, body bytes[, ts_us]) -> frame DataFrame on device 1 in order."""
    out = []
    for i, r in enumerate(rows):
        proto, body = r[0], r[1]
        ts = r[2] if len(r) > 2 else 1_000_000 + i
        start = bytes([0xB5, 0x62]) if proto == "UBX" else b"$GP"
        out.append((1, i, ts, proto, start, body, len(body), False, "OK"))
    return spark.createDataFrame(out, FRAME_SCHEMA)
