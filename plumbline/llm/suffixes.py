"""Suffix ordering of byte texts by the difference cover modulo 3, to a limited depth."""

from __future__ import annotations

import numpy as np


def _name(*columns: np.ndarray) -> np.ndarray:
    """Names from 1 of rows of columns, in the rows' order; equal rows get equal names."""
    bits = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(bits) < 63:
        key = columns[0].astype(np.int64)
        for c, b in zip(columns[1:], bits[1:], strict=True):
            key = (key << b) | c
        return np.unique(key, return_inverse=True)[1] + 1
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def _merge_keys(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> np.ndarray:
    """How many rows of b, which are in order, come before each row of a."""
    names = _name(*[np.concatenate(x) for x in zip(a, b, strict=True)])
    return np.searchsorted(names[len(a[0]) :], names[: len(a[0])], "left")


def suffix_order(s: np.ndarray, limit: int, covered: int = 1) -> np.ndarray:
    """Suffix starts of s (symbols from 1) in order of their first limit symbols at least.

    Triples at starts 1 and 2 modulo 3 are sorted and named; the names' own
    suffixes are ordered by recursion until names differ or stand for limit
    symbols; the starts 0 modulo 3 are sorted by symbol and the rank after it;
    both orders are merged.
    """
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    x = np.concatenate((s.astype(np.int64), np.zeros(4, np.int64)))
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    names = _name(x[sample], x[sample + 1], x[sample + 2])
    if names.max() < len(sample) and covered * 3 < limit:
        order = suffix_order(names, limit, covered * 3)
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 4, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    ordered = sample[order]
    ordered = ordered[ordered < n]
    zeros = np.arange(0, n, 3)
    zeros = zeros[np.argsort(_name(x[zeros], rank[zeros + 1]), kind="stable")]
    first, second = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]
    at = np.arange(len(zeros))
    at += _merge_keys((x[zeros], rank[zeros + 1]), (x[first], rank[first + 1]))
    at += _merge_keys((x[zeros], x[zeros + 1], rank[zeros + 2]), (x[second], x[second + 1], rank[second + 2]))
    # two zeros may claim one place only if their first limit symbols are equal; keep their order
    at = np.maximum.accumulate(at - np.arange(len(at))) + np.arange(len(at))
    out = np.empty(n, np.int64)
    rest = np.ones(n, bool)
    rest[at] = False
    out[at], out[rest] = zeros, ordered
    return out


def equal_next(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether the length bytes from order[i] equal those from order[i + 1]."""
    a, b = order[:-1], order[1:]
    same = np.ones(len(a), bool)
    lanes = np.lib.stride_tricks.sliding_window_view(np.ascontiguousarray(data), 8)
    words = np.ascontiguousarray(lanes).view("<u8").ravel()
    for k in [*range(0, length - 7, 8), length - 8]:
        live = np.flatnonzero(same)
        if not len(live):
            break
        same[live] = words[a[live] + k] == words[b[live] + k]
    return same
