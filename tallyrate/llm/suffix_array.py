"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are smaller (S) or larger (L) than their right neighbour; a leftmost smaller one (LMS)
follows an L. Sorting the LMS suffixes induces the order of all others in two linear sweeps over
the buckets of first symbols. The LMS suffixes are sorted by naming their substrings, which the
same sweeps sort, and by sorting the text of names. Sweeps over a small alphabet handle each
bucket in whole arrays; texts of names have large alphabets and take one step per suffix.
"""

from __future__ import annotations

import numpy as np

# Symbols up to which buckets are swept as arrays.
SMALL_ALPHABET = 2048


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an array of non-negative integers, in order."""
    if len(text) == 0:
        return np.zeros(0, np.int64)
    symbols = np.append(np.asarray(text, np.int64) + 1, 0)  # ends with the least symbol
    return _sorted(symbols, int(symbols.max()) + 1)[1:]


def _smaller(text: np.ndarray) -> np.ndarray:
    """True for S suffixes. Equal neighbours take the type of what follows them."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    at = np.arange(n)
    next_change = np.minimum.accumulate(np.where(differs, at, n)[::-1])[::-1]
    rises = np.append(text[:-1] < text[1:], True)
    return rises[next_change]


def _sorted(text: np.ndarray, alphabet: int) -> np.ndarray:
    if len(text) == 1:
        return np.zeros(1, np.int64)
    small = _smaller(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sweep = _sweep_arrays if alphabet <= SMALL_ALPHABET else _sweep_steps
    if len(lms) <= 1:
        return sweep(text, small, lms, alphabet)
    order = sweep(text, small, lms, alphabet)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    by_substring = order[is_lms[order]]
    rank = np.zeros(len(text), np.int64)
    names = _names(text, lms, by_substring)
    rank[by_substring] = names
    if names[-1] + 1 == len(lms):
        ordered = by_substring
    else:
        ordered = lms[_sorted(rank[lms], int(names[-1]) + 1)]
    return sweep(text, small, ordered, alphabet)


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Numbers of the LMS substrings in order; equal ones share a number."""
    length = np.ones(len(text), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    sizes = length[ordered]
    same = np.append(False, sizes[1:] == sizes[:-1])
    open_ = np.flatnonzero(same)
    offset = 0
    while len(open_):
        equal = text[ordered[open_] + offset] == text[ordered[open_ - 1] + offset]
        same[open_[~equal]] = False
        offset += 1
        open_ = open_[equal]
        open_ = open_[sizes[open_] > offset]
    return np.cumsum(~same) - 1


def _deal(waiting: list[list[np.ndarray]], places: np.ndarray, symbols: np.ndarray) -> None:
    """Append the places to the lists of their symbols, in order."""
    if len(places) == 0:
        return
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(places)]):
        waiting[symbols[start]].append(places[start:stop])


def _sweep_arrays(text: np.ndarray, small: np.ndarray, lms: np.ndarray, alphabet: int) -> np.ndarray:
    text = text.astype(np.int16 if alphabet <= 1 << 15 else np.int64)
    seeds: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    _deal(seeds, lms, text[lms])
    none = np.zeros(0, np.int64)

    def before(places: np.ndarray, want_small: bool) -> np.ndarray:
        left = places[places > 0] - 1
        return left[small[left] == want_small]

    waiting: list[list[np.ndarray]] = [[] for _ in range(alphabet)]
    large: list[np.ndarray] = []
    for symbol in range(alphabet):
        rounds = waiting[symbol]
        front = np.concatenate(rounds) if rounds else none
        found = [front]
        while len(front):
            left = before(front, False)
            own = text[left] == symbol
            _deal(waiting, left[~own], text[left[~own]])
            front = left[own]
            found.append(front)
        for places in seeds[symbol]:
            left = before(places, False)
            _deal(waiting, left, text[left])
        large.append(np.concatenate(found))

    waiting = [[] for _ in range(alphabet)]
    waiting[text[-1]].append(np.array([len(text) - 1]))
    out: list[np.ndarray] = []
    for symbol in range(alphabet - 1, -1, -1):
        rounds = waiting[symbol]
        front = np.concatenate(rounds) if rounds else none
        found = [front]
        while len(front):
            left = before(front, True)
            own = text[left] == symbol
            _deal(waiting, left[~own], text[left[~own]])
            front = left[own]
            found.append(front)
        left = before(large[symbol][::-1], True)
        _deal(waiting, left, text[left])
        out += [*found, large[symbol][::-1]]
    return np.concatenate(out)[::-1]


def _sweep_steps(text: np.ndarray, small: np.ndarray, lms: np.ndarray, alphabet: int) -> np.ndarray:
    n = len(text)
    ends = np.cumsum(np.bincount(text, minlength=alphabet))
    symbols, types = text.tolist(), small.tolist()
    order = [-1] * n
    tails = ends.tolist()
    for place in lms[::-1].tolist():
        symbol = symbols[place]
        tails[symbol] -= 1
        order[tails[symbol]] = place
    heads = [0, *ends[:-1].tolist()]
    for i in range(n):
        left = order[i] - 1
        if left >= 0 and not types[left]:
            symbol = symbols[left]
            order[heads[symbol]] = left
            heads[symbol] += 1
    tails = ends.tolist()
    for i in range(n - 1, -1, -1):
        left = order[i] - 1
        if left >= 0 and types[left]:
            symbol = symbols[left]
            tails[symbol] -= 1
            order[tails[symbol]] = left
    order[0] = n - 1
    return np.array(order, np.int64)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, cap: int, lane: int = 32) -> np.ndarray:
    """At each place, the length of the prefix that its suffix shares with the suffix before it
    in the order, up to `cap`. Along the text it falls by at most one per place; lanes of
    neighbouring places are followed side by side, several symbols at a time."""
    n = len(text)
    earlier = np.full(n, -1, np.int64)
    earlier[order[1:]] = order[:-1]
    padded = np.concatenate((text.astype(np.uint16), np.zeros(cap + 8, np.uint16)))
    words = sum(padded[i:len(padded) - 3 + i].astype(np.uint64) << np.uint64(16 * i) for i in range(4))
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    held = np.zeros(len(starts), np.int64)
    for step in range(min(lane, n)):
        places = starts + step
        live = places < n
        places = places[live]
        other = earlier[places]
        length = np.maximum(held[live] - 1, 0)
        length[other < 0] = 0
        length = np.minimum(length, n - np.maximum(places, other))
        go = np.flatnonzero((other >= 0) & (length < cap))
        while len(go):
            a, b = places[go] + length[go], other[go] + length[go]
            differ = words[np.minimum(a, len(words) - 1)] ^ words[np.minimum(b, len(words) - 1)]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 4, np.bitwise_count(low - np.uint64(1)) // 16)
            same = np.minimum(same.astype(np.int64), n - np.maximum(a, b))
            length[go] += same
            go = go[(same == 4) & (length[go] < cap)]
        out[places] = np.minimum(length, cap)
        held[live] = length
    return out
