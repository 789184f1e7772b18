"""Burrows-Wheeler transforms of shards of byte strings, merged without sorting suffixes again; repeated windows read off the merged order.

A string is a row of phrases: it is cut after places whose last GRAM bytes have a small hash, smaller than at the APART - 1 places before, and at one place the
caller names, which all its windows must reach at least CONTEXT bytes before. Symbols are phrases, ordered as byte strings, so that comparing rows of
symbols gives common prefixes in bytes. ``shard`` sorts the suffixes of its own strings and keeps their transform: for each suffix, in
order, the phrase before it. ``merge`` interleaves the transforms of any number of shards by refinement (Holt and McMillan, 2014): the interleave for prefixes of h + 1 phrases
is the stable sort, by symbol, of the transform under the interleave for h phrases. It ends when nothing changes. The round in which two
neighbours part is their common prefix (Egidi and Manzini, 2017).

``repeated`` finds, for each string, the windows of ``width`` bytes that another window equals, of any shard, string and place. A window is a piece of a phrase up to its first cut, then whole phrases, then a piece: pieces before a cut fall into classes of equal bytes by the
common endings of phrases, and behind the cut the merged order gives the common prefixes, whose neighbours decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GRAM = 8
APART = 16
CONTEXT = GRAM + APART - 1
CUT_BELOW = (1 << 64) // 24
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Shard:
    """strings: (start of each string in ``data``, with the end); cuts: for each string its starts of phrases and its end; bwt: numbers into ``phrases``, 0 where a string starts."""

    data: np.ndarray
    bounds: np.ndarray
    cuts: np.ndarray
    first: np.ndarray
    phrases: list[bytes]
    symbols: np.ndarray
    order: np.ndarray
    bwt: np.ndarray


def _places(data: np.ndarray, bounds: np.ndarray, forced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of phrases and ends of strings, ascending inside each string; where each string's begin)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(GRAM, np.uint8)])
    value = np.zeros(n, np.uint64)
    for k in range(GRAM):
        value |= padded[k : n + k].astype(np.uint64) << np.uint64(8 * k)
    value = (value ^ (value >> np.uint64(29))) * _FACTOR
    value ^= value >> np.uint64(32)
    hit = np.flatnonzero(value < np.uint64(CUT_BELOW))
    hit = hit[hit >= APART - 1]
    for k in range(1, APART):
        hit = hit[value[hit] < value[hit - k]]
    # The cut comes after these bytes; all that decides it lies inside its string.
    string = np.searchsorted(bounds, hit - APART + 1, "right") - 1
    hit += GRAM
    hit = hit[hit < bounds[string + 1]]
    # A string end is also the next one's start: two entries with one value, so tell them apart by the string.
    owner = np.concatenate([np.searchsorted(bounds, hit, "right") - 1, np.arange(len(bounds) - 1), np.arange(len(bounds) - 1), np.arange(len(bounds) - 1)])
    place = np.concatenate([hit, bounds[:-1], forced, bounds[1:]])
    whole = np.unique(owner.astype(np.int64) * (n + 1) + place)
    owner, place = whole // (n + 1), whole % (n + 1)
    return place, np.searchsorted(owner, np.arange(len(bounds)))


def shard(strings: list[bytes], forced: list[int]) -> Shard:
    """The transform of the strings; each is also cut at its place in ``forced``."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    bounds = np.append(0, np.cumsum([len(s) for s in strings]))
    cuts, first = _places(data, bounds, bounds[:-1] + np.array(forced, np.int64))
    last = np.zeros(len(cuts), bool)
    last[first[1:] - 1] = True
    raw = data.tobytes()
    texts = [b"" if end else raw[a:b] for a, b, end in zip(cuts, np.append(cuts[1:], 0), last)]
    phrases = sorted(set(texts) - {b""})
    number = {p: i + 1 for i, p in enumerate(phrases)} | {b"": 0}
    symbols = np.fromiter((number[t] for t in texts), np.int64, len(texts))
    rank, step = symbols.copy(), 1
    longest = int(np.diff(first).max())
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(cuts))  # entries from here to the string's end, the end included
    while step < longest:
        ahead = np.where(left > step, rank[np.minimum(np.arange(len(rank)) + step, len(rank) - 1)], 0)
        rank = np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)[1]
        step *= 2
    order = np.argsort(rank, kind="stable")
    begins = np.zeros(len(cuts), bool)
    begins[first[:-1]] = True
    before = np.where(begins, 0, np.append(0, symbols[:-1]))
    return Shard(data, bounds, cuts, first, phrases, symbols, order, before[order])


def merge(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, list[bytes], list[np.ndarray]]:
    """(shard of each suffix in merged order, common phrases with the suffix before, all phrases, each shard's numbers of its own)."""
    phrases = sorted(set().union(*[s.phrases for s in shards]))
    number = {p: i + 1 for i, p in enumerate(phrases)}
    renamed = [np.append(0, np.fromiter((number[p] for p in s.phrases), np.int64, len(s.phrases))) for s in shards]
    sizes = [len(s.bwt) for s in shards]
    begin = np.append(0, np.cumsum(sizes))
    transform = np.concatenate([names[s.bwt] for s, names in zip(shards, renamed)])
    small = np.uint16 if len(shards) < 1 << 16 else np.int64
    owner, places = np.repeat(np.arange(len(shards), dtype=small), sizes), np.arange(sum(sizes))
    ends = np.repeat(np.arange(len(shards), dtype=small), [len(s.bounds) - 1 for s in shards])
    block, common = np.zeros(len(owner), np.int64), np.full(len(owner), -1)
    common[0] = 0
    longest = max(int(np.diff(s.first).max()) for s in shards)
    for h in range(longest + 1):
        # The suffixes of a shard keep their order: the next one of shard s stands where s is met next.
        taken = np.empty(len(owner), np.int64)
        taken[np.argsort(owner, kind="stable")] = places
        symbol = transform[taken]
        by = np.sort(symbol * len(owner) + places) % len(owner)  # stable
        after, symbol, old = owner[by], symbol[by], block[by]
        after[: len(ends)], old[: len(ends)] = ends, 0  # string ends: all alike, in the order of their shards
        parted = np.append(True, (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1]))
        new = parted & (common < 0)
        common[new] = h
        still = np.array_equal(after, owner)
        owner, block = after, np.cumsum(parted)
        if still and not new.any() and h:
            break
    common[common < 0] = longest  # equal to their ends
    return owner, common, phrases, renamed


def _common_bytes(texts: list[bytes], width: int) -> np.ndarray:
    """Common prefix of each of the strings with the one before, counted up to ``width``."""
    out = np.zeros(len(texts), np.int64)
    for at in range(0, len(texts), 1 << 14):
        part = texts[max(0, at - 1) : at + (1 << 14)]
        size = min(width, max(map(len, part)))
        grid = np.frombuffer(b"".join(t[:size].ljust(size, b"\0") for t in part), np.uint8).reshape(len(part), size)
        lengths = np.minimum(np.array([len(t) for t in part]), size)
        same = grid[1:] == grid[:-1]
        upto = np.where(same.all(axis=1), size, np.argmin(same, axis=1))
        got = np.minimum(upto, np.minimum(lengths[1:], lengths[:-1]))
        out[max(1, at) : max(1, at) + len(got)] = got
    return out


class _Least:
    """Least value of any range."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) - 1 <= len(values):
            half, row = 1 << len(self.rows) - 1, self.rows[-1]
            self.rows.append(np.minimum(row[:-half], row[half:]))
        self.grid = np.full((len(self.rows), len(values)), np.iinfo(np.int32).max, np.int32)
        for i, row in enumerate(self.rows):
            self.grid[i, : len(row)] = row

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Over lo to hi, both included; lo <= hi."""
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        return np.minimum(self.grid[level, lo], self.grid[level, hi - (1 << level) + 1])


def repeated(shards: list[Shard], width: int) -> list[np.ndarray]:
    """For each shard, over its bytes: whether the window of ``width`` bytes that starts there (inside its string) occurs elsewhere in some string."""
    owner, common, phrases, renamed = merge(shards)
    counts = [len(s.cuts) for s in shards]
    begin = np.append(0, np.cumsum(counts))
    bytes_before = np.append(0, np.cumsum([len(s.data) for s in shards]))
    # All shards' entries one after another: place of the cut, symbol, string bounds.
    place = np.concatenate([s.cuts + b for s, b in zip(shards, bytes_before)])
    symbol = np.concatenate([names[s.symbols] for s, names in zip(shards, renamed)])
    string_from = np.concatenate([np.repeat(s.bounds[:-1] + b, np.diff(s.first)) for s, b in zip(shards, bytes_before)])
    string_to = np.concatenate([np.repeat(s.bounds[1:] + b, np.diff(s.first)) for s, b in zip(shards, bytes_before)])
    last_of = np.concatenate([np.repeat(s.first[1:] - 1 + b, np.diff(s.first)) for s, b in zip(shards, begin)])
    entry = np.empty(len(owner), np.int64)
    entry[np.argsort(owner, kind="stable")] = np.concatenate([s.order + b for s, b in zip(shards, begin)])
    # Bytes in common with the suffix before: whole phrases, and the common prefix of the two phrases behind them.
    lead = _Least(_common_bytes(phrases, 2 * width)) if phrases else None
    a, b = entry[:-1], entry[1:]
    x, y = np.minimum(a + common[1:], last_of[a]), np.minimum(b + common[1:], last_of[b])
    left, right = symbol[x] - 1, symbol[y] - 1  # -1: the string ends
    part = np.zeros(len(a), np.int64)
    both = np.flatnonzero((left >= 0) & (right >= 0))
    part[both] = lead(left[both] + 1, right[both])
    shared = np.append(0, place[x] - place[a] + part)
    shared_least = _Least(shared.astype(np.int32))
    rank = np.empty(len(entry), np.int64)
    rank[entry] = np.arange(len(entry))
    # The piece before a cut may reach CONTEXT - 1 bytes into the phrase before: only then is the cut the first one that the window itself shows.
    previous = np.append(0, place[:-1])
    reach = np.maximum(string_from, np.where(previous <= string_from, string_from, previous - CONTEXT + 1))
    cut = np.flatnonzero(place > string_from)
    raw = np.concatenate([s.data for s in shards]).tobytes()
    pieces = [raw[a:b][::-1] for a, b in zip(reach[cut], place[cut])]
    endings = sorted(set(pieces))
    known = {p: i for i, p in enumerate(endings)}
    piece = np.fromiter((known[p] for p in pieces), np.int64, len(pieces))
    ending = _common_bytes(endings, 2 * width)
    flags = np.zeros(bytes_before[-1], bool)
    # Windows that start o bytes before their first cut.
    most = place[cut] - reach[cut]
    least = np.maximum(CONTEXT, place[cut] - string_to[cut] + width)
    alive = np.flatnonzero(least <= most)
    at_of, piece_of, place_of = rank[cut], piece, place[cut]
    for o in range(int(least[alive].min()), int(most[alive].max()) + 1) if len(alive) else ():
        some = alive[(least[alive] <= o) & (most[alive] >= o)]
        if len(some) < 2:
            continue
        kind = np.cumsum(ending < o)[piece_of[some]]  # a shorter string in between ends a class by itself
        by = np.argsort(kind * (len(rank) + 1) + at_of[some])
        some, kind = some[by], kind[by]
        at = at_of[some]
        close = np.flatnonzero(kind[1:] == kind[:-1])
        good = close[shared_least(at[close] + 1, at[close + 1]) >= width - o]
        flags[place_of[some[good]] - o] = True
        flags[place_of[some[good + 1]] - o] = True
    return [flags[a:b] for a, b in zip(bytes_before, bytes_before[1:])]
