"""Words of many texts at once, as arrays over the bytes of an Arrow column: where they are, whose they are, and hashes of them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are worked on at once; a single longer text is cut between words. Arrays over them take some sixty times as many bytes.
BLOCK = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_table = np.random.default_rng(64).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes that separate words, as in [\x20\x09-\x0D].
SPACE_BYTES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER_BYTES = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = MULTIPLIER) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, modulo 2^64; at least ``n`` of each."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        known = _powers[base] = (both[0], both[1])
    return known


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def range_hashes(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the values of each range of ``x``, from one running sum: equal ranges have equal hashes wherever they are."""
    up, down = powers(len(x) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[: len(x)], dtype=np.uint64)))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins (one more for the end); null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words in order: first byte, end, text and hash; ``per_text`` says at which word each text begins (one more for the end)."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    per_text: np.ndarray


def cuts(data: np.ndarray, is_space: np.ndarray, block: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Stretches of about ``block`` bytes that end after a separator or at the end."""
    at = 0
    while at < len(data):
        stop = min(at + block, len(data))
        if stop < len(data):
            inside = np.flatnonzero(is_space[data[at:stop]])
            if len(inside):
                stop = at + int(inside[-1]) + 1
            else:  # a word longer than a block
                while stop < len(data) and not is_space[data[stop]]:
                    more = np.flatnonzero(is_space[data[stop : stop + block]])
                    stop = stop + int(more[0]) if len(more) else min(stop + block, len(data))
        yield at, stop
        at = stop


def words(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = SPACE_BYTES, letters: np.ndarray | None = None) -> Words:
    """Words of all texts. ``letters`` may map bytes to others before they are hashed (and nowhere else)."""
    table = _table if letters is None else _table[letters]
    begins, ends, hashes = [], [], []
    for a, b in cuts(data, is_space):
        part = data[a:b]
        inside = ~is_space[part]
        edge = np.zeros(len(part) + 1, bool)  # where a text begins
        edge[offsets[(offsets >= a) & (offsets <= b)] - a] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:-1]
        s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
        hashes.append(range_hashes(table[part], s, e))
        begins.append(s + a)
        ends.append(e + a)
    none = np.zeros(0, np.int64)
    start, end = (np.concatenate(x) if x else none for x in (begins, ends))
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(start, end, text, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.searchsorted(text, np.arange(len(offsets))))


def slide_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    n, size, y = len(x) - width + 1, 1, x
    while 2 * size <= width:
        y = np.minimum(y[: len(y) - size], y[size:])
        size *= 2
    return np.minimum(y[:n], y[width - size : width - size + n])
