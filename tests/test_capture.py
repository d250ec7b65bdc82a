"""Capture scan and deframing edge cases (resync, CR/LF, oversize, incomplete, '(' in payload)."""

import glob
import os
import random
import re
import tempfile
import time

import pyarrow.fs as pafs
import pytest

from skytrace.sinks.raw import write_captures
from skytrace.sources import records as R
from skytrace.sources.capture import deframe, scan_captures


def write(tmp, name, data):
    with open(os.path.join(tmp, name), "wb") as f:
        f.write(data)


def rec(ts, frame):
    return b"(" + b"%016d" % ts + b")" + frame


UBX = bytes.fromhex("b5620104120040e2010096008c00820078006e0064005a0082d4")


def run(spark, data):
    tmp = tempfile.mkdtemp(prefix="skytrace-test-")
    write(tmp, "c1.cap", data)
    return deframe(scan_captures(spark, tmp)).orderBy("rec_no").collect()


def test_roundtrip_and_paren_in_payload(spark):
    ubx28 = bytes.fromhex("b562010412002840e2010096008c00820078006e0064005a00")
    data = b"junk" + rec(1, UBX) + rec(2, b"$GPGGA,1,2\r\n") + rec(3, ubx28)
    r = run(spark, data)
    assert [x.rec_no for x in r] == [0, 1, 2]
    assert r[0].protocol == "UBX" and r[0].body == UBX[2:] and r[0].status == "OK"
    assert r[1].protocol == "NMEA" and r[1].body == b"GGA,1,2" and r[1].start_seq == b"$GP"


def test_resync_quirk(spark):
    r = run(spark, rec(1, b"\xb5" + UBX) + rec(2, b"$$GPGGA,1\r\n") + rec(3, b"x$GPVTG,1\r\n"))
    assert [x.status for x in r] == ["NO_FRAME", "NO_FRAME", "OK"]


def test_cr_lf_rules(spark):
    r = run(spark, rec(1, b"$GPGGA,1\r2\n3\r\n"))
    assert r[0].body == b"GGA,12\n3"


def test_oversize_and_incomplete(spark):
    long = b"$GPGSA," + b"Z" * 400 + b"\r\n"
    r = run(spark, rec(1, long) + rec(2, UBX[:10]))
    assert r[0].status == "OK" and r[0].truncated and r[0].body_len == 299
    assert r[1].status == "INCOMPLETE"


def brute_records(data):
    """(ts, raw) of each record, read byte for byte from the start."""
    heads = [m.start() for m in re.finditer(rb"\((?=\d{16}\))", data)]
    sync = re.compile(rb"(?s)(?:[^\xb5$]++|\xb5[^b]|\$[^GP])*+(\xb5b|\$[GP].)")
    real, claimed = [], 0
    for k, h in enumerate(heads):
        if h < claimed:
            continue
        real.append(h)
        m = sync.match(data[h + 18:heads[k + 1] if k + 1 < len(heads) else len(data)])
        if m and m[1] == b"\xb5b":
            at = h + 18 + m.start(1)
            n = int.from_bytes(data[at + 4:at + 6], "little") if at + 6 <= len(data) else 1 << 40
            claimed = at + 2 + min(n + 6, 299)
    return [(int(data[h + 1:h + 17]), data[h + 18:e]) for h, e in zip(real, real[1:] + [len(data)], strict=True)]


def noisy_capture(rng, records=60):
    """Frames of all kinds with junk, header-like payloads, cut frames and stray sync and header bytes."""
    like = b"(1234567890123456)"
    data = b"junk(x" * rng.randrange(3)
    for i in range(records):
        payload = b"".join(rng.choice([like, b"\xb5b", b"$GP", b"(", b"ab", b"\xb5", b"\r\n"]) for _ in range(rng.choice([0, 2, 9, 30])))
        frame = rng.choice([b"\xb5b\x01\x04" + len(payload).to_bytes(2, "little") + payload + b"\0\0", b"$GPGGA,1," + payload + b"\r\n", payload,
                            b"\xb5b\x01\x04\xff\x00" + payload, b"xx\xb5\xb5b" + payload])
        if rng.random() < 0.3:
            frame = frame[:rng.randrange(len(frame) + 1)]
        data += rec(1000 + i, frame) + b"z" * rng.choice([0, 0, 0, 5, 2000])
    return data


def test_any_ranges_give_the_records_of_a_reading_from_the_start():
    for seed in range(15):
        rng = random.Random(seed)
        data = noisy_capture(rng)
        tmp = tempfile.mkdtemp(prefix="skytrace-ranges-")
        write(tmp, "c.cap", data)
        fs, root = pafs.FileSystem.from_uri(tmp)
        want = brute_records(data)
        for size in (rng.randrange(15, 90), 1024, 1 << 20):
            capture = R.Capture(fs, f"{root}/c.cap", len(data))
            got = []
            for start in range(0, len(data), size):
                for buf, heads, ends, _ in R.records(capture, start, min(start + size, len(data)), chunk=rng.choice([64, 700, 1 << 20])):
                    got += [(int(t), buf[h + 18:e].tobytes()) for t, h, e in zip(R.times(buf, heads), heads, ends, strict=True)]
            assert got == want, (seed, size)


def test_ranges_of_1_kb_equal_one_range(spark):
    rng = random.Random(5)
    tmp = tempfile.mkdtemp(prefix="skytrace-split-")
    data = {f"c{k}": noisy_capture(rng, 300) for k in range(3)}
    for name, raw in data.items():
        write(tmp, f"{name}.cap", raw)
    write(tmp, "_tmp.cap", rec(1, UBX))  # not a capture
    want = sorted((name, k, ts, raw) for name, d in data.items() for k, (ts, raw) in enumerate(brute_records(d)))
    for size in (1024, 1 << 25):
        got = scan_captures(spark, tmp, range_bytes=size)
        assert sorted((r.capture_id, r.rec_no, r.ts_us, bytes(r.raw)) for r in got.collect()) == want
    assert scan_captures(spark, tempfile.mkdtemp(prefix="skytrace-none-")).collect() == []


def test_a_capture_cut_anywhere_grows_to_the_same_records():
    """Whatever the steps in which a file grows, the deliveries together are the frames of the whole file."""
    for seed in range(15):
        rng = random.Random(seed)
        data = noisy_capture(rng, 25) + b"z" * 400 + rec(9, UBX)
        tmp = tempfile.mkdtemp(prefix="skytrace-grow-")
        fs, root = pafs.FileSystem.from_uri(tmp)
        done, got = 0, []
        for size in [*sorted(rng.sample(range(1, len(data)), 12)), len(data)]:
            write(tmp, "c.cap", data[:size])
            end = R.finished_end(R.Capture(fs, f"{root}/c.cap", size), done)
            assert done <= end <= size
            for buf, heads, ends, _ in R.records(R.Capture(fs, f"{root}/c.cap", end), done, end, done):
                got += [(int(t), buf[h + 18:e].tobytes()) for t, h, e in zip(R.times(buf, heads), heads, ends, strict=True)]
            done = end
        assert done == len(data)
        want = brute_records(data)
        assert [t for t, _ in got] == [t for t, _ in want]
        assert all(w.startswith(g) for (_, g), (_, w) in zip(got, want, strict=True))


def test_captures_appear_only_when_the_job_succeeds(spark):
    tmp = tempfile.mkdtemp(prefix="skytrace-commit-")

    def slow(b):
        for t in b:
            if "bad" in t["capture_id"].tolist():
                time.sleep(2)  # the other task has written its file by then
                raise ValueError("killed half way")
            yield t

    rows = spark.createDataFrame([(f"c{k}", i, rec(i, UBX)) for k in range(4) for i in range(3)] + [("bad", 0, rec(1, UBX))],
                                 "capture_id string, seq long, record binary").repartition(4, "capture_id")
    with pytest.raises(Exception, match="killed half way"):
        write_captures(rows.mapInPandas(slow, rows.schema), tmp)
    assert glob.glob(f"{tmp}/**/*.cap", recursive=True) == []
    write_captures(rows.filter("capture_id != 'bad'"), tmp)
    assert sorted(os.listdir(tmp)) == [f"c{k}.cap" for k in range(4)]
    assert [x.rec_no for x in scan_captures(spark, tmp).filter("capture_id = 'c2'").collect()] == [0, 1, 2]


def test_header_like_payload_stays_in_its_frame(spark):
    """UBX payloads with header-like bytes, also several in a row, an incomplete frame and a real header after it."""
    like = b"(1234567890123456)"
    frame = lambda payload: b"\xb5b\x01\x04" + len(payload).to_bytes(2, "little") + payload + b"\x00\x00"
    frames = [UBX, frame(like), frame(like * 5 + b"x"), frame(b"ab" + like + b"cd"), b"$GPGGA,1\r\n", frame(like)]
    data = b"".join(rec(i + 1, f) for i, f in enumerate(frames)) + rec(7, UBX[:8]) + rec(8, b"$GPVTG,1\r\n")
    tmp = tempfile.mkdtemp(prefix="skytrace-test-")
    write(tmp, "c1.cap", data)
    for size in (64, 1 << 20):
        got = scan_captures(spark, tmp, range_bytes=size).orderBy("rec_no").collect()
        assert [bytes(r.raw) for r in got[:6]] == frames and [r.ts_us for r in got[:6]] == [1, 2, 3, 4, 5, 6]
        # an unfinished frame reads on by its length: what follows is its payload
        assert [r.rec_no for r in got] == list(range(len(got))) and got[6].raw.startswith(UBX[:8] + b"(0000")
