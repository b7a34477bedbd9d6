"""Recompression of token sequences: runs, then pairs, get names of their own, round by round.

A round replaces every maximal run of one symbol by a symbol, then every pair of
neighbours of which the first falls on the left side and the second on the right
side of that round's split of the symbols. A name is a hash of what it stands
for, so that all tasks name equal runs and pairs alike without a dictionary.

What happens inside a stretch depends on nothing outside it, except for the runs
and pairs at its ends. Stripping those, round by round, leaves the stretch's
interior: symbols that stand in every stretch of the same tokens at the same
place, wherever it lies. The longest interior symbol, which is the one least
likely to occur by chance, is the stretch's anchor.
"""

from __future__ import annotations

import numpy as np

#: bits of an anchor's rank that hold its place, so that of equal symbols the leftmost wins
PLACE_BITS = 22
U = np.uint64


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit name for an ordered pair of names."""
    h = a * U(0x9E3779B97F4A7C15) + np.atleast_1d(b) * U(0xC2B2AE3D27D4EB4F) + U(0x165667B19E3779F9)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(32)
    return h


def text_names(text: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit name for each word of ``text`` (bytes), given where it begins and its size."""
    if not len(begin):
        return np.empty(0, U)
    letter = mix(np.arange(256, dtype=U), U(3))
    power = np.r_[U(1), np.cumprod(np.full(int(size.max()), 0xD6E8FEB86659FD93, U))]
    # the byte after each word is a space: it adds the same to every word of a size
    whole = size + 1
    place = np.arange(int(whole.sum())) - np.repeat(np.cumsum(whole) - whole, whole)
    return mix(np.add.reduceat(letter[text] * power[place], begin), size.astype(U))


def rounds_of(length: int) -> int:
    """Rounds after which a stretch of ``length`` tokens mostly keeps an interior of some symbols."""
    return max(0, (length // 5).bit_length() - 1)


class Symbols:
    """Symbols of a block of texts at one level, with a separator after each text, and the interiors of stretches.

    ``begin`` and ``end`` hold, of every stretch still alive, its interior as a
    range of symbols; ``size`` is the length of each symbol in letters.
    """

    def __init__(self, names: np.ndarray, size: np.ndarray, separator: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.names, self.size, self.separator, self.begin, self.end = names, size, separator, begin, end
        self.place = np.arange(len(names))

    def _shrink(self, first: np.ndarray, names: np.ndarray, after_begin: np.ndarray, after_end: np.ndarray) -> None:
        self.names, self.separator, self.place = names, self.separator[first], self.place[first]
        self.size = np.add.reduceat(self.size, first)
        self.begin, self.end = after_begin[self.begin], after_end[self.end]

    def runs(self) -> None:
        """Every maximal run becomes a symbol; a stretch's first and last run may go on outside it."""
        s, p = self.names, self.separator
        first = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | p[1:] | p[:-1]])
        times = np.diff(np.r_[first, len(s)])
        run = np.repeat(np.arange(len(first)), times)
        names = np.where(times > 1, mix(s[first], times.astype(U)), s[first])
        self._shrink(first, names, np.minimum(np.r_[run, len(first)] + 1, len(first)), np.r_[0, run])

    def pairs(self, round_no: int) -> None:
        """Left-right neighbours become a symbol; a right symbol first or a left one last may pair outside."""
        s, p = self.names, self.separator
        is_left = (mix(s, U(round_no)) & U(1)).astype(bool) & ~p
        joined = is_left[:-1] & ~is_left[1:] & ~p[1:]
        first = np.flatnonzero(np.r_[True, ~joined])
        times = np.diff(np.r_[first, len(s)])
        pair = np.r_[np.repeat(np.arange(len(first)), times), len(first)]
        second = s[np.minimum(first + 1, len(s) - 1)]
        names = np.where(times > 1, mix(s[first], second + U(round_no)), s[first])
        after_begin = np.r_[np.where(is_left, pair[:-1], pair[1:]), len(first)]
        after_end = np.r_[0, np.where(is_left, pair[:-1], pair[1:])]
        self._shrink(first, names, after_begin, after_end)

    def longest(self, chosen: np.ndarray) -> np.ndarray:
        """The longest interior symbol of the chosen stretches; of equally long ones that of least hash, then the leftmost."""
        begin, end = self.begin[chosen], self.end[chosen]
        short = U(255) - np.minimum(self.size, 255).astype(U)
        hashed = mix(self.names, U(255)) >> U(8 + PLACE_BITS) << U(PLACE_BITS)
        ranks = [short << U(56) | hashed | np.arange(len(self.names), dtype=U)]
        reach = 1
        width = end - begin
        while 2 * reach <= (int(width.max()) if len(width) else 0):
            last = ranks[-1]
            ranks.append(np.minimum(last, np.r_[last[reach:], last[-1:].repeat(reach)]))
            reach *= 2
        level = np.frexp(width.astype(np.float64))[1] - 1  # of the largest power of two within
        best = np.empty(len(begin), U)
        for i, rank in enumerate(ranks):
            own = level == i
            best[own] = np.minimum(rank[begin[own]], rank[end[own] - (1 << i)])
        return (best & U((1 << PLACE_BITS) - 1)).astype(np.int64)


def anchors(names: np.ndarray, size: np.ndarray, separator: np.ndarray, windows: np.ndarray, length: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, place) of the anchor of every stretch of ``length`` tokens that starts at ``windows``."""
    key, place = np.empty(len(windows), U), np.empty(len(windows), np.int64)
    symbols = Symbols(names, size, separator, windows, windows + length)
    alive = np.arange(len(windows))

    def settle(level: int, chosen: np.ndarray) -> None:
        at = symbols.longest(chosen)
        key[alive[chosen]] = mix(symbols.names[at], U(level))
        place[alive[chosen]] = symbols.place[at]

    for half in range(2 * rounds):
        before = Symbols.__new__(Symbols)
        before.__dict__.update(symbols.__dict__)
        symbols.pairs(half) if half % 2 else symbols.runs()
        gone = symbols.begin >= symbols.end
        if gone.any():  # their interior of the level before is the last they have
            symbols, after = before, symbols
            settle(half, np.flatnonzero(gone))
            symbols = after
            alive, symbols.begin, symbols.end = alive[~gone], symbols.begin[~gone], symbols.end[~gone]
    settle(2 * rounds, np.arange(len(alive)))
    return key, place


def segments(names: np.ndarray, size: np.ndarray, separator: np.ndarray, windows: np.ndarray, length: int, rounds: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor's place, key) of every run of consecutive windows with one anchor."""
    if not len(windows):
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, U))
    key, place = anchors(names, size, separator, windows, length, rounds)
    new = np.r_[True, (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | (windows[1:] != windows[:-1] + 1)]
    first = np.flatnonzero(new)
    return windows[first], np.diff(np.r_[first, len(windows)]), place[first], key[first]
