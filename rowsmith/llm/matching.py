"""Comparing many pairs of names at once: the answers of :mod:`.names`, on arrays instead of one pair after the other."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd

from .names import name_match, ratio

LETTERS = 64  # of a text that fits in one word of bits; longer texts are compared one by one
WORDS = 8  # of a name, likewise
TABLE = 1 << 19  # entries of the table of letters of the pairs compared at once


class _Texts:
    """Texts as slices of one array of letter numbers."""

    def __init__(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.codes, self.start, self.length = codes, start, length

    @classmethod
    def of(cls, texts: Sequence[str]) -> _Texts:
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        known = np.unique(points)
        return cls(np.searchsorted(known, points), np.cumsum(length) - length, length)

    def joined(self, ids: np.ndarray) -> _Texts:
        """By row of ``ids`` the texts of that numbers run together; -1 is none."""
        length = np.where(ids >= 0, self.length[ids], 0)
        flat = length.ravel()
        ends = np.cumsum(flat)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids].ravel() - ends + flat, flat)
        total = length.sum(1)
        return _Texts(self.codes[at], np.cumsum(total) - total, total)


def _common(x: _Texts, p: np.ndarray, y: _Texts, q: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the texts ``p`` of ``x`` and ``q`` of ``y`` (one alphabet), by words of bits; of ``x`` no longer than ``LETTERS``."""
    out = np.zeros(len(p), np.int64)
    letters = int(max(x.codes.max(initial=0), y.codes.max(initial=0))) + 1
    step = max(64, TABLE // letters)
    one = np.uint64(1)
    # those with texts of like lengths together, the longest first, so that what goes on is always the front
    order = np.argsort(-y.length[q], kind="stable")
    for k in range(0, len(p), step):
        part = order[k : k + step]
        sa, na, sb, nb = x.start[p[part]], x.length[p[part]], y.start[q[part]], y.length[q[part]]
        base = np.arange(len(part)) * letters
        at = np.zeros(len(part) * letters, np.uint64)
        for i in range(int(na.max(initial=0))):
            rows = np.nonzero(na > i)[0]
            at[base[rows] + x.codes[sa[rows] + i]] |= one << np.uint64(i)
        v = np.full(len(part), ~np.uint64(0))
        left = np.searchsorted(-nb, -np.arange(int(nb.max(initial=0))), side="left")  # texts longer than j
        for j, n in enumerate(left):
            w = v[:n]
            u = w & at[base[:n] + y.codes[sb[:n] + j]]
            v[:n] = (w + u) | (w - u)
        full = np.where(na >= 64, ~np.uint64(0), (one << np.minimum(na, 63).astype(np.uint64)) - one)
        out[part] = np.bitwise_count(~v & full)
    return out


def ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """:func:`.names.ratio` of each two texts."""
    known, ids = np.unique(np.array([*a, *b], dtype=object), return_inverse=True) if len(a) else (np.array([], object), np.zeros(0, int))
    x = _Texts.of(known.tolist())
    p, q = ids[: len(a)], ids[len(a) :]
    out = np.where(p == q, np.where(x.length[p] > 0, 1.0, 0.0), 0.0)
    short = x.length[p] <= LETTERS
    met = np.nonzero((p != q) & short)[0]
    out[met] = 2 * _common(x, p[met], x, q[met]) / (x.length[p[met]] + x.length[q[met]])
    for i in np.nonzero((p != q) & ~short)[0]:
        out[i] = ratio(a[i], b[i])
    return out


def _word_matches(words: list[str], texts: _Texts, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """:func:`.names.word_match` of the words ``p`` and ``q``."""
    swap = texts.length[p] > texts.length[q]
    p, q = np.where(swap, q, p), np.where(swap, p, q)
    m, n = texts.length[p], texts.length[q]
    out = (p == q).astype(float)
    first = texts.codes[texts.start]
    same = (p != q) & (first[p] == first[q])
    out[same & (m == 1)] = 0.7
    open_ = (p != q) & (m > 1) & (same | (2 * m >= 0.75 * (m + n)))
    open_ |= (p != q) & (m == 1) & ~same & (2 >= 0.75 * (m + n))
    met = np.nonzero(open_)[0]
    common = _common(texts, p[met], texts, q[met])
    r = 2 * common / (m[met] + n[met])
    out[met] = np.where(r >= 0.75, r, 0.0)
    for i in met[same[met] & (common == m[met])]:
        if words[q[i]].startswith(words[p[i]]):
            out[i] = 0.9
        elif m[i] <= 6 and m[i] < n[i]:
            out[i] = 0.8
    return out


def _sum(columns: np.ndarray) -> np.ndarray:
    """The sums of rows as :func:`sum` gives them, with what rounding loses carried along."""
    total, lost = np.zeros(len(columns)), np.zeros(len(columns))
    for j in range(columns.shape[1]):
        y = columns[:, j]
        t = total + y
        lost += np.where(np.abs(total) >= np.abs(y), (total - t) + y, (y - t) + total)
        total = t
    return total + lost


def _aligned(a: np.ndarray, b: np.ndarray, words: list[str], texts: _Texts, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share and ratio for rows of word numbers (-1: none), of at least one word on both sides."""
    rows, m, n = len(a), a.shape[1], b.shape[1]
    there = (a >= 0)[:, :, None] & (b >= 0)[:, None, :]
    cells = (a[:, :, None] * len(words) + b[:, None, :])[there]
    known, back = np.unique(cells, return_inverse=True)
    score = np.zeros((rows, m, n))
    score[there] = _word_matches(words, texts, known // len(words), known % len(words))[back]

    each = np.arange(rows)
    rank_a, rank_b = np.where(a >= 0, m + n + np.arange(m), 99), np.where(b >= 0, m + n + np.arange(n), 99)
    wa, wb = np.where(a >= 0, weight[a], 0.0), np.where(b >= 0, weight[b], 0.0)
    found_a, found_b = np.zeros((rows, min(m, n))), np.zeros((rows, min(m, n)))
    for r in range(min(m, n)):  # the best two words that are left; of equals the first
        best = score.reshape(rows, -1).argmax(1)
        i, j = best // n, best % n
        s = score[each, i, j]
        on = np.nonzero(s > 0)[0]
        if not len(on):
            break
        rank_a[on, i[on]] = rank_b[on, j[on]] = r
        found_a[on, r], found_b[on, r] = wa[on, i[on]] * s[on], wb[on, j[on]] * s[on]
        score[each, i, :] = 0
        score[each, :, j] = 0
    all_a, all_b = _sum(wa), _sum(wb)
    share = np.maximum(np.where(all_a <= all_b, _sum(found_a) / all_a, 0.0), np.where(all_b <= all_a, _sum(found_b) / all_b, 0.0))

    x, y = texts.joined(a), texts.joined(b)
    letters = x.length + y.length
    whole = 2 * _common(x, each, y, each) / letters
    turn_a, turn_b = np.argsort(rank_a, 1, kind="stable"), np.argsort(rank_b, 1, kind="stable")
    turned = np.nonzero((turn_a != np.arange(m)).any(1) | (turn_b != np.arange(n)).any(1))[0]
    ratio_ = whole.copy()
    if len(turned):
        x, y = texts.joined(np.take_along_axis(a[turned], turn_a[turned], 1)), texts.joined(np.take_along_axis(b[turned], turn_b[turned], 1))
        at = np.arange(len(turned))
        ratio_[turned] = np.maximum(whole[turned], 2 * _common(x, at, y, at) / letters[turned])
    share = np.where((share < 0.8) & (whole >= 0.85) & ((a >= 0).sum(1) != (b >= 0).sum(1)), np.maximum(share, whole), share)
    return np.where(whole == 1.0, 1.0, share), ratio_


def name_matches(a: Sequence[str], b: Sequence[str], weight: Callable[[str], float]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`.names.name_match` of each two names, given as words with blanks between: shares and ratios."""
    if not len(a):
        return np.zeros(0), np.zeros(0)
    ids, names = pd.factorize(np.concatenate([np.asarray(a, object), np.asarray(b, object)]))
    pairs, back = np.unique(ids[: len(a)] * len(names) + ids[len(a) :], return_inverse=True)
    p, q = pairs // len(names), pairs % len(names)
    split = [n.split() for n in names]
    count = np.fromiter(map(len, split), np.int64, len(split))
    letters = np.fromiter((len(n) for n in names), np.int64, len(names)) - np.maximum(count - 1, 0)
    plain = (count <= WORDS) & (letters <= LETTERS)
    share, lcs = np.zeros(len(pairs)), np.zeros(len(pairs))
    some = (count[p] > 0) & (count[q] > 0)
    for i in np.nonzero(some & ~(plain[p] & plain[q]))[0]:
        share[i], lcs[i] = name_match(tuple(split[p[i]]), tuple(split[q[i]]), weight)
    met = np.nonzero(some & plain[p] & plain[q])[0]
    if len(met):
        number: dict[str, int] = {}
        table = np.full((len(names), int(count[plain].max())), -1)
        for k in np.nonzero(plain)[0]:
            table[k, : count[k]] = [number.setdefault(w, len(number)) for w in split[k]]
        words = [*number]
        weights = np.fromiter(map(weight, words), float, len(words))
        left, right = table[p[met]], table[q[met]]
        share[met], lcs[met] = _aligned(left[:, : count[p[met]].max()], right[:, : count[q[met]].max()], words, _Texts.of(words), weights)
    return share[back], lcs[back]
