"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

``induce`` scans buckets of first bytes in order, as the method does, but takes
everything a bucket holds at that moment in one vectorised step; entries that
fall into the bucket being scanned make up its next step. The steps of a bucket
are as many as the longest run of its byte.
"""

from __future__ import annotations

import numpy as np


def classify(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one. The last symbol must be the unique smallest."""
    n = len(text)
    rising = np.empty(n, dtype=bool)
    rising[-1] = True
    differs = text[1:] != text[:-1]
    # within a run of one symbol the type is that of the run's end
    end = np.where(differs, np.arange(n - 1), n - 2)
    end = np.minimum.accumulate(end[::-1])[::-1]
    rising[:-1] = text[end] < text[end + 1]
    return rising


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Suffix array induced from the leftmost-smaller suffixes ``seeds``, given in order."""
    n, symbols = len(text), int(text.max()) + 1
    order = np.full(n, -1, dtype=np.int64)
    ends = np.cumsum(np.bincount(text, minlength=symbols))
    starts = ends - np.bincount(text, minlength=symbols)

    # seeds at the ends of their buckets
    of_seed = text[seeds]
    seed_ends = np.searchsorted(of_seed, np.arange(symbols), "right")
    seed_starts = np.searchsorted(of_seed, np.arange(symbols), "left")

    def deal(found: np.ndarray, to: np.ndarray, step: int) -> None:
        """Put ``found`` into their buckets, in order, from ``to`` on in the direction of ``step``."""
        symbol = text[found]
        by = np.argsort(symbol, kind="stable")
        symbol, found = symbol[by], found[by]
        first = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]])
        sizes = np.diff(np.r_[first, len(symbol)])
        nth = np.arange(len(symbol)) - np.repeat(first, sizes)
        order[to[symbol] + step * nth] = found
        to[symbol[first]] += step * sizes

    def before(block: np.ndarray, kind: bool) -> np.ndarray:
        left = block[block > 0] - 1
        return left[small[left] == kind]

    # larger suffixes, left to right
    heads = starts.copy()
    for c in range(symbols):
        at = starts[c]
        while at < heads[c]:
            block = order[at : heads[c]]
            at = heads[c]
            if len(left := before(block, False)):
                deal(left, heads, 1)
        if len(left := before(seeds[seed_starts[c] : seed_ends[c]], False)):
            deal(left, heads, 1)
    # smaller suffixes, right to left
    tails = ends - 1
    order[0] = n - 1
    for c in range(symbols - 1, -1, -1):
        at = ends[c] - 1
        while at > tails[c]:
            block = order[tails[c] + 1 : at + 1][::-1]
            at = tails[c]
            if len(left := before(block, True)):
                deal(left, tails, -1)
        if len(left := before(order[starts[c] : heads[c]][::-1], True)):
            deal(left, tails, -1)
    return order


def _words(text: bytes) -> np.ndarray:
    """The eight bytes from every position on, as one integer; the text must end in eight spare bytes."""
    return np.ndarray(len(text) - 7, dtype="<u8", buffer=text, strides=(1,))


def _equal_spans(words: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ``sizes`` bytes from a and from b on agree."""
    same = np.ones(len(a), dtype=bool)
    at, done = np.arange(len(a)), 0
    while len(at):
        rest = sizes[at] - done
        mask = np.where(rest >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * np.clip(rest, 0, 7)).astype(np.uint64)) - np.uint64(1))
        agree = ((words[a[at] + done] ^ words[b[at] + done]) & mask) == 0
        same[at[~agree]] = False
        at = at[agree & (rest > 8)]
        done += 8
    return same


def _sort_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, right for at least ``depth`` names.

    The string's alphabet is as large as the string, so an induced scan would
    take one step per name; ranks of pairs, pairs of pairs ... are sorted instead.
    """
    rank, reach = names.astype(np.int64), 1
    while True:
        kinds = int(rank.max()) + 1
        if kinds == len(rank) or reach >= depth:
            return np.argsort(rank, kind="stable")
        after = np.zeros(len(rank), dtype=np.int64)
        after[:-reach] = rank[reach:] + 1
        _, rank = np.unique(rank * (kinds + 1) + after, return_inverse=True)
        reach *= 2


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` in order, right for their first ``depth`` bytes."""
    symbols = np.zeros(len(text) + 1, dtype=np.int16)
    symbols[:-1] = np.frombuffer(text, dtype=np.uint8)
    symbols[:-1] += 1
    small = classify(symbols)
    seeds = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(seeds) > 1:
        # one round of induction puts the leftmost-smaller substrings in order
        by_symbol = seeds[np.argsort(symbols[seeds], kind="stable")]
        rough = induce(symbols, small, by_symbol)
        is_seed = np.zeros(len(symbols), dtype=bool)
        is_seed[seeds] = True
        sorted_ = rough[is_seed[rough]]
        # equal neighbours share a name; each substring reaches to the next seed, that seed's byte included
        sizes = np.zeros(len(symbols), dtype=np.int64)
        sizes[seeds] = np.diff(np.r_[seeds, len(symbols)]) + 1
        a, b = sorted_[:-1], sorted_[1:]
        same = sizes[a] == sizes[b]
        at = np.flatnonzero(same)
        # nothing equals the substring that holds the end
        at = at[(a[at] + sizes[a[at]] <= len(text)) & (b[at] + sizes[b[at]] <= len(text))]
        same[:] = False
        same[at] = _equal_spans(_words(text + bytes(16)), a[at], b[at], sizes[a[at]])
        names = np.zeros(len(symbols), dtype=np.int64)
        names[sorted_] = np.r_[0, np.cumsum(~same)]
        # seeds are at least two bytes apart
        seeds = seeds[_sort_names(names[seeds], -(-depth // 2) + 1)]
    return induce(symbols, small, seeds)[1:]


def common_prefixes(text: bytes, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position: length of the prefix it shares with the suffix before it in order, and that suffix (-1: none).

    A position whose left neighbour agrees with its partner's left neighbour
    has one byte less than that neighbour; only the others are compared.
    """
    n = len(order)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    bytes_ = np.frombuffer(text, dtype=np.uint8)
    place = np.arange(n)
    chained = (before > 0) & (place > 0)
    chained[chained] = bytes_[place[chained] - 1] == bytes_[before[chained] - 1]
    # the neighbour's own partner must be the one next to ours, or its count says nothing
    chained[chained] = before[place[chained] - 1] == before[chained] - 1
    words = _words(text + bytes(16))
    at = np.flatnonzero(~chained & (before >= 0))
    reach = place.copy()  # position + shared length
    done = 0
    while len(at):
        x = words[at + done] ^ words[before[at] + done]
        low = (x & (~x + np.uint64(1))).astype(np.float64)  # the lowest differing bit
        shared = np.where(x == 0, 8, np.log2(np.where(x == 0, 1.0, low)).astype(np.int64) // 8)
        shared = np.minimum(shared, n - np.maximum(at, before[at]) - done)
        reach[at] = at + done + shared
        at = at[shared == 8]
        done += 8
        at = at[np.maximum(at, before[at]) + done < n]
    compared = np.maximum.accumulate(np.where(chained, 0, place))
    return reach[compared] - place, before
