"""Similarities: one in Arrow batches, one native."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _lcs(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def token_sort(a: str | None, b: str | None) -> float:
    """0 to 100: twice the common subsequence of the sorted words over both lengths."""
    x, y = (" ".join(sorted(re.split(r"\s+", (t or "").strip()))) for t in (a, b))
    return 100.0 if x == y else 200.0 * _lcs(x, y) / (len(x) + len(y)) if x and y else 0.0


@F.pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_sort(x, y) for x, y in zip(a, b)])


def trigrams(x: Column) -> Column:
    """The trigrams of the words of ``x`` in order, each word with two blanks before and one behind."""
    words = F.filter(F.split(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    pads = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.flatten(F.transform(pads, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3)))))


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once: inside nested lambdas an expression would be computed again for each element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _term_trigrams(term: str) -> Column:
    words = re.findall(r"[^\W_]+", term.lower())
    grams = dict.fromkeys(p[i : i + 3] for p in (f"  {w} " for w in words) for i in range(len(p) - 2))
    return F.array(*map(F.lit, grams)) if grams else F.array().cast("array<string>")


def word_similarity(term: str, x: Column, floor: float = 0.0) -> Column:
    """Greatest similarity of the term's trigrams with those of any extent of ``x``; 0 without common ones, null for null.

    Extents need only begin and end at common trigrams, so the work is the square of the common
    ones.  No extent can be more similar than the share of the term's trigrams that ``x`` has at
    all: where that is not above ``floor`` the answer is 0 at once.
    """
    q = _term_trigrams(term)

    def score(t: Column) -> Column:
        def extents(at: Column) -> Column:
            def best(i: Column) -> Column:
                def over(j: Column) -> Column:
                    def of(part: Column) -> Column:
                        return _let(F.size(F.array_intersect(part, q)), lambda both: both / (F.size(part) + F.size(q) - both))

                    return _let(F.array_distinct(F.slice(t, i, j - i + 1)), of)

                return F.array_max(F.transform(F.filter(at, lambda j: j >= i), over))

            return F.coalesce(F.array_max(F.transform(at, best)), F.lit(0.0))

        hits = F.filter(F.transform(t, lambda g, i: F.when(F.array_contains(q, g), i + 1)), lambda i: i.isNotNull())
        bound = F.size(F.array_intersect(t, q)) / F.greatest(F.size(q), F.lit(1))
        return F.when(bound > floor, _let(hits, extents)).otherwise(F.lit(0.0))

    return F.when(x.isNotNull(), _let(trigrams(x), score).cast("double"))
