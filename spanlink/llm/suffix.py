"""Suffix arrays by two-stage sorting, in numpy, and the common prefixes of neighbours."""

from __future__ import annotations

import numpy as np


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one that starts after it; the last is not."""
    n = len(text)
    rises = np.zeros(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    decides = np.ones(n, bool)
    decides[:-1] = text[:-1] != text[1:]
    # in a run of one symbol the suffixes compare as its last does
    ends = np.flatnonzero(decides)
    return rises[ends[np.searchsorted(ends, np.arange(n))]]


def _words(text: np.ndarray) -> np.ndarray:
    """At each position the next seven symbols as one number; symbols fit 9 bits."""
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    n = len(text)
    out = np.zeros(n, np.uint64)
    for k in range(7):
        out = (out << np.uint64(9)) | padded[k : k + n]
    return out


def direct_sort(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places by the first `depth` symbols from there on: rounds of seven symbols, over what is still tied."""
    n = len(words)
    key = words[places]
    order = np.argsort(key, kind="stable")
    out, key = places[order], key[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    for at in range(7, depth, 7):
        tied = same.copy()
        tied[:-1] |= same[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        group = np.cumsum(~same[slots])
        here = out[slots]
        nxt = np.where(here + at < n, words[np.minimum(here + at, n - 1)], 0)
        order = np.lexsort((nxt, group))
        out[slots] = here[order]
        nxt, group = nxt[order], group[order]
        again = np.zeros(len(slots), bool)
        again[1:] = (group[1:] == group[:-1]) & (nxt[1:] == nxt[:-1])
        same[slots] = again
    return out


def suffix_array(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of suffixes in order of their first `depth` symbols at least: all, or those that `wanted` flags and few others.

    Suffixes smaller than their successors are sorted directly. Going through the buckets of first symbols upwards, each suffix
    found induces the one before it when that is larger: it comes next in the bucket of its own first symbol. A wanted larger one
    needs those after it, up to the first that is smaller than its successor, and no more.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    small = smaller_than_successor(text)
    kept = np.ones(n, bool)
    if wanted is not None:
        bases = np.append(np.flatnonzero(small), n - 1)
        needs = np.flatnonzero(wanted)
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, needs, 1)
        np.add.at(edge, bases[np.searchsorted(bases, needs)] + 1, -1)
        kept = np.cumsum(edge[:-1]) > 0
    direct = direct_sort(np.flatnonzero(small & kept), _words(text), depth)
    first = text[direct]
    symbols = np.flatnonzero(np.bincount(text))
    bounds = dict(zip(symbols.tolist(), zip(np.searchsorted(first, symbols).tolist(), np.searchsorted(first, symbols, side="right").tolist(), strict=True), strict=True))
    waiting: dict[int, list[np.ndarray]] = {c: [] for c in symbols.tolist()}
    if kept[-1]:
        waiting[int(text[-1])].append(np.array([n - 1]))
    out = []
    for c in symbols.tolist():
        # larger ones of this bucket, in the order induced; within the bucket they induce further ones, round by round
        part = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        rounds = []
        while len(part):
            rounds.append(part)
            before = part[part > 0] - 1
            part = before[(text[before] == c) & ~small[before] & kept[before]]
        a, b = bounds[c]
        whole = np.concatenate([*rounds, direct[a:b]])
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[(text[before] > c) & kept[before]]
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        for piece in np.split(before, cuts) if len(before) else ():
            waiting[int(text[piece[0]])].append(piece)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Symbols that each suffix in order has in common with the one before it, up to about `depth`; 0 for the first."""
    n, words = len(text), _words(text)
    lcp = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    at = 0
    while len(open_) and at < depth:
        a, b = order[open_ - 1] + at, order[open_] + at
        inside = (a < n) & (b < n)
        open_, a, b = open_[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        equal = differ == 0
        stop = differ[~equal]
        symbol = np.zeros(len(stop), np.int64)
        for k in range(1, 7):
            symbol += stop >> np.uint64(63 - 9 * k) == 0
        lcp[open_[~equal]] = at + symbol
        open_ = open_[equal]
        lcp[open_] = at + 7
        at += 7
    longest = n - np.maximum(order, np.concatenate([order[:1], order[:-1]]))
    return np.minimum(lcp, longest)
