"""Words of many texts at once, as NumPy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time; a longer word makes its own, larger segment.
SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses, at least n of them."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SEGMENT + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, mask: int = 0xFF) -> np.ndarray:
    """A 64-bit hash of each span data[start:end], the same wherever the span lies."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    value = (total[end] - total[start]) * down[start]
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; NULL counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a run of rows: ``data[start:end]`` of word i, which belongs to row ``row[i]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)


def _runs(is_space: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without space; a run also ends at each cut."""
    inside = ~is_space
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    begin = inside & (~before | cut[:-1])
    start = np.flatnonzero(begin)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end


def segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT bytes that end at a row's end or before white space after a word."""
    at, n = 0, int(offsets[-1])
    while at < n:
        stop = min(n, at + SEGMENT)
        if stop < n:
            row_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if row_end > at:
                stop = row_end
            else:
                stop = _soft_end(data, at, stop, int(offsets[np.searchsorted(offsets, stop, "left")]))
        yield at, stop
        at = stop


def _soft_end(data: np.ndarray, at: int, stop: int, last: int) -> int:
    """The last place in (at, stop] where ASCII white space follows another ASCII byte, else the next one."""
    def places(lo: int, hi: int) -> np.ndarray:
        part = _SPACE[data[lo:hi]]
        return np.flatnonzero(part[1:] & ~part[:-1] & (data[lo : hi - 1] < 128)) + lo + 1

    found = places(at, stop)
    if len(found):
        return int(found[-1])
    while stop < last:
        reach = min(last, stop + SEGMENT)
        found = places(stop - 1, reach)
        if len(found):
            return int(found[0])
        stop = reach
    return last


def words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True, space: np.ndarray = _SPACE
) -> Iterator[Words]:
    """Words (runs of bytes other than space and \\t..\\r) in order, segment by segment.

    A-Z are lower-cased with ``lower``. Rows without words give none. ``space`` marks the bytes between
    words; it may add others to the default ones.
    """
    table = _LOWER if lower else None
    for lo, hi in segments(data, offsets):
        part = data[lo:hi]
        if table is not None:
            part = table[part]
        first = int(np.searchsorted(offsets, lo, "right")) - 1
        inner = offsets[(offsets > lo) & (offsets < hi)] - lo
        cut = np.zeros(len(part) + 1, bool)
        cut[inner] = True
        start, end = _runs(space[part], cut)
        row = np.searchsorted(offsets, start + lo, "right") - 1
        assert first >= 0
        yield Words(part, start, end, row)


def _unicode_space_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each position is a white space outside ASCII."""
    pad = np.concatenate([np.zeros(3, np.uint8), data])
    a, b, c = pad[at], pad[at + 1], pad[at + 2]
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    e280 = (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    other = (
        ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
        | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
        | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    )
    return two | e280 | other


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[Words]:
    """Every byte of every row, cut where ASCII white space follows a character that is no white space.

    A pattern that lets white space only begin a match, as byte-level vocabularies do, always ends a
    match there and needs nothing from the left of it; so pieces are encoded one by one.
    """
    for lo, hi in segments(data, offsets):
        part = data[lo:hi]
        space = _SPACE[part]
        begins = np.empty(len(part), bool)
        begins[0] = True
        np.logical_and(space[1:], ~space[:-1], out=begins[1:])
        at = np.flatnonzero(begins)[1:]
        at = at[part[at - 1] >= 0x80]
        begins[at[_unicode_space_before(part, at)]] = False
        begins[offsets[(offsets > lo) & (offsets < hi)] - lo] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(part))
        row = np.searchsorted(offsets, start + lo, "right") - 1
        yield Words(part, start, end, row)
