"""Suffix arrays of byte strings by induced sorting, and their permuted common prefixes.

Suffixes are L (larger than the next one) or S (smaller). The leftmost S suffixes of each run are
sorted by sorting and naming the substrings between them, and recursively the string of names; all
other suffixes are induced from them in two scans. With few symbols, as in text, a scan handles one
symbol's bucket at a time with whole-array steps; with many symbols, as deeper in the recursion, it
goes element by element. Scans are linear in the length, up to the longest run of one symbol.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of an array of small integers in ascending order."""
    return _sort(np.asarray(text, np.int32), int(text.max()) + 1 if len(text) else 1)


def _sort(t: np.ndarray, symbols: int) -> np.ndarray:
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    small = _is_small(t)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    induce = _induce_buckets if symbols * 130 < n else _induce_each
    if not len(leftmost):
        return induce(t, symbols, small, leftmost)
    reduced = _name(t, small, leftmost)
    count = int(reduced.max()) + 1
    if count == len(leftmost):
        order = np.empty(count, np.int32)
        order[reduced] = np.arange(count, dtype=np.int32)
    else:
        order = _sort(reduced, count)
    return induce(t, symbols, small, leftmost[order])


def _is_small(t: np.ndarray) -> np.ndarray:
    """Suffix types: whether the next different symbol is greater; nothing follows the end."""
    n = len(t)
    change = np.empty(n, bool)
    change[:-1] = t[:-1] != t[1:]
    change[-1] = True
    at = np.where(change, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    after = np.append(t, -1)
    return after[at + 1] > t


def _name(t: np.ndarray, small: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Ranks of the substrings between leftmost-small positions, equal ones sharing a rank.

    Read with their types, no such substring is the beginning of another one. They are sorted by a few
    symbols at a time; a rank is the place of the first equal one, until further symbols tell them apart.
    """
    n, m = len(t), len(leftmost)
    keys = np.append(2 * t.astype(np.int64) + small + 1, 0)  # the end is less than any symbol
    size = np.diff(np.append(leftmost, n)) + 1
    bits = int(keys.max()).bit_length()
    take = max((62 - m.bit_length()) // bits, 1)
    rank = np.zeros(m, np.int64)
    open_, step = np.arange(m), 0
    while len(open_):
        packed, left, at = rank[open_], size[open_] - step, leftmost[open_] + step
        for k in range(take):
            packed = packed << bits | np.where(k < left, keys[np.minimum(at + k, n)], 0)
        order = np.argsort(packed, kind="stable")
        open_, packed = open_[order], packed[order]
        place = np.arange(len(open_))
        old = rank[open_]
        first_old = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        fresh = np.append(True, packed[1:] != packed[:-1])
        first = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[open_] = old + first - first_old
        alone = fresh & np.append(fresh[1:], True)
        step += take
        open_ = open_[~alone & (size[open_] > step)]
    return np.unique(rank, return_inverse=True)[1].astype(np.int32)


def _induce_buckets(t, symbols, small, sorted_leftmost):
    n = len(t)
    sizes = np.bincount(t, minlength=symbols)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, np.int32)
    by_symbol = sorted_leftmost[np.argsort(t[sorted_leftmost], kind="stable")]
    edges = np.searchsorted(t[by_symbol], np.arange(symbols + 1))

    head = starts.copy()
    sa[head[t[n - 1]]] = n - 1
    head[t[n - 1]] += 1
    for c in np.flatnonzero(sizes):
        at = starts[c]
        while at < head[c]:  # entries of this bucket may add to it
            batch = sa[at : head[c]] - 1
            at = head[c]
            batch = batch[batch >= 0]
            batch = batch[~small[batch] & (t[batch] == c)]
            sa[at : at + len(batch)] = batch
            head[c] = at + len(batch)
        source = np.concatenate((sa[starts[c] : head[c]], by_symbol[edges[c] : edges[c + 1]])) - 1
        source = source[source >= 0]
        symbol = t[source]
        keep = ~small[source] & (symbol > c)
        source, symbol = source[keep], symbol[keep]
        if len(source):
            order = np.argsort(symbol, kind="stable")
            source, symbol = source[order], symbol[order]
            first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
            lengths = np.diff(np.append(first, len(symbol)))
            within = np.arange(len(symbol)) - np.repeat(first, lengths)
            sa[head[symbol] + within] = source
            head[symbol[first]] += lengths

    tail = ends.copy()
    for c in np.flatnonzero(sizes)[::-1]:
        at = ends[c]
        while at > tail[c]:
            batch = sa[tail[c] : at][::-1] - 1
            at = tail[c]
            batch = batch[batch >= 0]
            batch = batch[small[batch] & (t[batch] == c)]
            sa[at - len(batch) : at] = batch[::-1]
            tail[c] = at - len(batch)
        source = np.concatenate((sa[tail[c] : ends[c]][::-1], sa[starts[c] : head[c]][::-1])) - 1
        source = source[source >= 0]
        symbol = t[source]
        keep = small[source] & (symbol < c)
        source, symbol = source[keep], symbol[keep]
        if len(source):
            order = np.argsort(symbol, kind="stable")
            source, symbol = source[order], symbol[order]
            first = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
            lengths = np.diff(np.append(first, len(symbol)))
            within = np.arange(len(symbol)) - np.repeat(first, lengths)
            sa[tail[symbol] - 1 - within] = source
            tail[symbol[first]] -= lengths
    return sa


def _induce_each(t, symbols, small, sorted_leftmost):
    n = len(t)
    sizes = np.bincount(t, minlength=symbols)
    ends = np.cumsum(sizes)
    # for each position the symbol before it if of the type in question, else -1; so for place -1
    before = np.append(t[-1:], t)[:n]
    is_small = np.append(True, small)[:n]
    large_before = np.append(np.where(is_small, -1, before), -1).tolist()
    is_small[0] = False
    small_before = np.append(np.where(is_small, before, -1), -1).tolist()
    sa = [-1] * n
    tail, head = ends.tolist(), (ends - sizes).tolist()
    for i, c in zip(sorted_leftmost[::-1].tolist(), t[sorted_leftmost[::-1]].tolist(), strict=True):
        tail[c] -= 1
        sa[tail[c]] = i
    c = int(t[n - 1])
    sa[head[c]] = n - 1
    head[c] += 1
    for i in sa:  # sees what it writes further on
        c = large_before[i]
        if c >= 0:
            at = head[c]
            sa[at] = i - 1
            head[c] = at + 1
    tail = ends.tolist()
    for i in reversed(sa):
        c = small_before[i]
        if c >= 0:
            at = tail[c] - 1
            sa[at] = i - 1
            tail[c] = at
    return np.array(sa, np.int32)


def permuted_prefixes(data: bytes, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the suffix before it in order (-1: none) and their common prefix length.

    If the symbols before both suffixes agree, the length is one less than that of the position
    before. Only the other positions are compared, eight bytes at a time, all of them together.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = data + bytes(16)
    words = np.empty(n + 8, np.uint64)
    for k in range(8):
        part = words[k::8]
        part[:] = np.frombuffer(padded, "<u8", len(part), k) if len(part) else 0
    t = np.frombuffer(data, np.uint8)
    at = np.arange(n)
    compare = before >= 0
    inner = compare & (before > 0) & (at > 0)
    follows = np.zeros(n, bool)
    follows[inner] = t[at[inner] - 1] == t[before[inner] - 1]
    own = np.flatnonzero(compare & ~follows)
    length = np.zeros(n, np.int64)
    open_, i, j = own, own.copy(), before[own]
    while len(open_):
        apart = words[np.minimum(i, n)] ^ words[np.minimum(j, n)]
        same = (apart == 0) & (np.maximum(i, j) + 8 <= n)
        low = apart[~same]
        bits = np.where(low == 0, 64, np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)))
        length[open_[~same]] += bits // 8
        open_, i, j = open_[same], i[same] + 8, j[same] + 8
        length[open_] += 8
    limit = n - np.maximum(own, before[own])
    length[own] = np.minimum(length[own], limit)
    # a position that follows takes the last compared length, less the distance
    base = np.where(follows, -1, at)
    base = np.maximum.accumulate(base)
    return before, np.maximum(length[base] - (at - base), 0)
