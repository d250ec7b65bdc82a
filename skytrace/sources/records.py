"""Where the records of a capture lie, worked out from any byte range of the file.

A capture is a sequence of records: a header ``(`` + 16 decimal digits (µs) + ``)``, then frame bytes. Bytes
that look like a header inside a UBX frame, by the length the frame declares, are payload; so whether a
header is real depends on the record before it. A frame reaches at most ``REACH`` bytes beyond the next
header-like bytes, hence a header that no earlier candidate's frame could cover is real whatever came
before. A range is read from such a *sure* header at or before its start, walks the candidates in
order, and owns the records that start inside it.

A UBX frame is read by its declared length even where the record behind it begins inside (a dropped
byte costs the next record, as it does a receiver's parser); NMEA sentences and records without a
frame end at the next header.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from ..functions.fields import MAX_LINE

HEADER = 18
BODY_MAX = MAX_LINE - 1
REACH = BODY_MAX + 2
_ENDLESS = np.int64(1) << 62
_SYNC = re.compile(rb"(?s)(?:[^\xb5$]++|\xb5[^b]|\$[^GP])*+(\xb5b|\$[GP].)")
_DIGITS = 10 ** np.arange(15, -1, -1, dtype=np.int64)


class Capture:
    """A capture file, read by ranges. ``end`` is where it counts as finished."""

    def __init__(self, fs, path: str, end: int):
        self.fs, self.path, self.end = fs, path, end

    def read(self, start: int, stop: int) -> np.ndarray:
        with self.fs.open_input_file(self.path) as f:
            return np.frombuffer(f.read_at(max(0, min(stop, self.end) - start), start), np.uint8)


def headers(data: np.ndarray) -> np.ndarray:
    """Positions of all bytes that look like a header."""
    at = np.flatnonzero(data == 0x28)
    at = at[at + HEADER <= len(data)]
    at = at[data[at + 17] == 0x29]
    if not len(at):
        return at
    digit = data[at[:, None] + np.arange(1, 17)] - np.uint8(48)
    return at[(digit < 10).all(1)]


def times(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (data[at[:, None] + np.arange(1, 17)].astype(np.int64) - 48) @ _DIGITS


def frame_ends(data: np.ndarray, at: np.ndarray, finished: bool) -> np.ndarray:
    """For each header, up to where a UBX frame behind it claims the bytes (without one: the header's end). A frame
    whose length bytes are missing claims all that follows, if the file is ``finished``."""
    n = len(data)
    first = at + HEADER
    stop = np.append(at[1:], n)[:len(at)]
    pad = np.append(data, np.zeros(8, np.uint8))
    a, b = pad[np.minimum(first, n)], pad[np.minimum(first + 1, n)]
    ubx = (a == 0xB5) & (b == 0x62) & (first + 1 < stop)
    nmea = (a == 0x24) & ((b == 0x47) | (b == 0x50)) & (first + 2 < stop)
    sync = np.where(ubx, first, -1)
    for i in np.flatnonzero(~ubx & ~nmea & (first < stop)):  # bytes before the frame: rare
        m = _SYNC.match(data[first[i]:stop[i]].tobytes())
        if m and m[1] == b"\xb5b":
            sync[i] = first[i] + m.start(1)
    low, high = pad[np.clip(sync + 4, 0, n)].astype(np.int64), pad[np.clip(sync + 5, 0, n)].astype(np.int64)
    ends = sync + 2 + np.minimum(low + 256 * high + 6, BODY_MAX)
    ends = np.where(sync + 5 < n, ends, _ENDLESS if finished else sync + REACH)
    return np.where(sync >= 0, ends, first)


def real(at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which headers start a record, the first of them being real."""
    out = np.ones(len(at), bool)
    for i in np.flatnonzero(at[1:] < ends[:-1]):  # frames that reach the next header
        if out[i]:
            out[i + 1:np.searchsorted(at, ends[i])] = False
    return out


def sure(at: np.ndarray, ends: np.ndarray, from_start: bool) -> np.ndarray:
    """Headers that no earlier candidate's frame can cover. What stands before the data may reach beyond the
    first header found, unless the data begins ``from_start``, a place known to be real."""
    if not len(at):
        return np.zeros(0, bool)
    before = np.maximum.accumulate(np.append(0 if from_start else at[0] + REACH, ends[:-1]))
    return at >= before


def anchor(capture: Capture, at: int, base: int = 0, look: int = 4096) -> int:
    """A place to read from: the last sure header at or before ``at``, else ``base``, a place known to be one."""
    while True:
        start = max(base, at - look)
        data = capture.read(start, at + HEADER + REACH)
        heads = headers(data)
        ok = sure(heads, frame_ends(data, heads, False), start == base) & (heads + start <= at)
        if ok.any():
            return start + int(heads[np.flatnonzero(ok)[-1]])
        if start == base:
            return base
        look *= 4


def records(capture: Capture, start: int, stop: int, base: int = 0, chunk: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The records that start in [start, stop), a chunk of the range at a time: (bytes, positions of the headers in
    them, ends of the records, place of the bytes in the file). ``base`` is a known record start."""
    at = anchor(capture, start, base) if start > base else base
    while at < min(stop, capture.end):
        ahead = min(chunk, stop - at + HEADER + 2 * REACH)
        while True:  # until the record that begins last in the chunk has an end
            data = capture.read(at, at + ahead)
            done = at + ahead >= capture.end
            heads = headers(data)
            ends = frame_ends(data, heads, done)
            heads = heads[real(heads, ends)]
            if done or len(heads) > 1:
                break
            ahead *= 2
        close = np.append(heads[1:], len(data))[:len(heads)]
        if not done:  # the last one may go on
            heads, close = heads[:-1], close[:-1]
        own = (heads + at >= start) & (heads + at < stop)
        if own.any():
            yield data, heads[own], close[own], at
        at = at + int(close[-1]) if len(close) and not done else capture.end


def finished_end(capture: Capture, base: int) -> int:
    """Up to where a growing capture can be delivered: the header of its last record, or the file's end if the frame
    behind that header is complete there. ``base`` is the end delivered before."""
    start = anchor(capture, capture.end, base)
    data = capture.read(start, capture.end)
    heads = headers(data)
    ends = frame_ends(data, heads, True)
    if not len(heads):
        return base
    k = int(np.flatnonzero(real(heads, ends))[-1])
    if ends[k] > heads[k] + HEADER:
        complete = ends[k] == len(data)
    else:
        tail = data[heads[k] + HEADER:].tobytes()
        m = _SYNC.match(tail)
        complete = bool(m) and m[1][:1] == b"$" and tail.find(b"\r\n", m.end(1)) == len(tail) - 2
    return capture.end if complete else start + int(heads[k])
