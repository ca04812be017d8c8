"""A compressed FM-index over word numbers: a Burrows-Wheeler transform in a wavelet tree of code-length shape."""

from __future__ import annotations

import numpy as np

#: Suffixes are ordered by so many leading symbols; patterns may be as long.
DEPTH = 64


def suffix_order(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places of the suffixes in order of their first ``depth`` symbols, by doubling. The text must end in a symbol of its own that is least."""
    n = len(symbols)
    rank, size = symbols.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        key = rank[order]
        new = np.empty(n, np.int64)
        if size > 1:
            key = combined[order]
        new[order] = np.cumsum(np.concatenate(([False], key[1:] != key[:-1])))
        rank = new
        if size >= depth or rank[order[-1]] == n - 1:
            return order
        combined = rank * (n + 1)
        combined[:-size] += rank[size:] + 1
        order = np.argsort(combined, kind="stable")
        size *= 2


class Wavelet:
    """Ranks over a sequence. A symbol's path is a prefix code of about its information content, so frequent symbols lie on few levels."""

    def __init__(self, sequence: np.ndarray, size: int):
        n = len(sequence)
        count = np.bincount(sequence, minlength=size).astype(np.float64)
        length = np.zeros(size, np.int64)
        there = count > 0
        length[there] = np.maximum(1, np.ceil(np.log2(n / count[there]) - 1e-9)).astype(np.int64)
        self.length, self.levels = length, int(length.max(initial=0))
        # codes in order of length: each one's place among the whole is the sum of those before, so none begins another
        by_length = np.argsort(np.where(there, length, 99), kind="stable")
        width = np.where(there, np.int64(1) << (self.levels - length), 0)[by_length]
        self.code = np.zeros(size, np.int64)
        self.code[by_length] = np.cumsum(width) - width
        self.words, self.before, self.start = [], [], []
        now = self.code[sequence]
        rest = length[sequence]
        for level in range(self.levels):
            if level:
                keep = rest > level
                now, rest = now[keep], rest[keep]
                order = np.argsort(now >> (self.levels - level), kind="stable")
                now, rest = now[order], rest[order]
            prefix = now >> (self.levels - level)
            self.start.append(np.searchsorted(prefix, self.code >> (self.levels - level)).astype(np.int64))
            bits = ((now >> (self.levels - 1 - level)) & 1).astype(np.uint8)
            packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, np.uint8)), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))[:-1])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place; symbols must occur."""
        out = at.copy()
        todo = np.arange(len(symbol))
        for level in range(self.levels):
            todo = todo[self.length[symbol[todo]] > level]
            if not len(todo):
                break
            own = symbol[todo]
            first = self.start[level][own]
            ones = self._ones(level, first + out[todo]) - self._ones(level, first)
            bit = (self.code[own] >> (self.levels - 1 - level)) & 1
            out[todo] = np.where(bit == 1, ones, out[todo] - ones)
        return out


class FMIndex:
    """Backward search over a sequence of symbols from 1 on; 0 separates its parts."""

    def __init__(self, symbols: np.ndarray, depth: int = DEPTH):
        text = np.append(symbols + 1, 0)  # an end of its own, below the separators
        order = suffix_order(text, depth)
        self.n, self.size = len(text), int(text.max()) + 1
        self.tree = Wavelet(text[order - 1], self.size)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.size))))[:-1]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol before them."""
        own = symbol + 1
        both = self.tree.rank(np.concatenate([own, own]), np.concatenate([low, high]))
        return self.first[own] + both[: len(own)], self.first[own] + both[len(own) :]


def repeated_windows(index: FMIndex, text: np.ndarray, begin: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Which windows of each part of ``text`` the index has at least twice: a matrix of parts by window starts.

    Every part is a lane; all lanes read backwards in step. A reading ends at its least start or where the match statistic ends, that is
    where the pattern occurs only once. One that ends early rules out all windows around what it read, a long one settles all windows inside it; so lanes read
    turn by turn from the far end of their open windows and from the near one, and skip what a reading has settled.
    """
    lanes = len(begin)
    hit = np.zeros((lanes, int(max(0, sizes.max(initial=0) - window + 1))), bool)
    least, most = np.zeros(lanes, np.int64), sizes - window  # open window starts
    far = np.ones(lanes, bool)
    at = most + window - 1  # the next symbol to read
    low, high = np.zeros(lanes, np.int64), np.full(lanes, index.n, np.int64)
    columns = np.arange(hit.shape[1])
    live = np.flatnonzero(most >= 0)
    while len(live):
        new_low, new_high = index.extend(text[begin[live] + at[live]], low[live], high[live])
        twice = new_high - new_low >= 2
        low[live], high[live] = new_low, new_high
        through = twice & (at[live] == least[live])
        ended = live[~twice | through]
        at[live] -= 1
        if not len(ended):
            continue
        failed = at[ended] + 1  # where the pattern occurs once; one before the start if the reading went through
        failed[through[~twice | through]] -= 1
        near = ~far[ended]
        ends = np.where(near, least[ended] + window, most[ended] + window)
        # windows inside the match: from failed + 1 to ends - window
        hit[ended] |= (columns >= (failed + 1)[:, None]) & (columns <= (ends - window)[:, None])
        inside = failed + 1 <= ends - window
        # near: the window at `least` is settled if matched, else all starts up to where it failed; far: from the match on, or the last start alone
        least[ended] = np.where(near, np.where(inside, least[ended] + 1, failed + 1), least[ended])
        most[ended] = np.where(near, most[ended], np.where(inside, failed, most[ended] - 1))
        far[ended] = near
        at[ended] = np.where(near, most[ended] + window - 1, least[ended] + window - 1)
        low[ended], high[ended] = 0, index.n
        live = live[least[live] <= most[live]]
    return hit
