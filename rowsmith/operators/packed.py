"""Several values packed in one field.

Dictionary-guided segmentation.  A multi-pattern automaton finds every known
whole value in the text; a dynamic programme then picks the cheapest cover of
the text by known values, protected spans (quotes, parentheses) and free
pieces.  Delimiters inside a known value or a protected span separate nothing,
and known values may stand side by side with only a blank between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Certification codes and the names they stand for.
CERTIFICATIONS = (
    "MBE", "WBE", "MWBE", "DBE", "SBE", "VOSB", "SDVOSB", "DIBE", "LGBTBE", "ACDBE", "HUBZone", "8(a)",
    "Minority Business Enterprise", "Women Business Enterprise", "Disadvantaged Business Enterprise",
    "Small Business Enterprise", "Veteran Owned Small Business", "Service Disabled Veteran Owned Small Business",
    "Disability Inclusive Business Enterprise", "LGBT Business Enterprise", "Not Certified",
)
# Words for "nothing stated".
PLACEHOLDERS = ("n/a", "n / a", "na", "none", "null", "nan", "-", "--", "unknown")

_HARD = re.compile(r"\s*(?:[,;|•·\n\r\t/]|\s[+&]\s|\s(?i:and)\s)\s*(?:(?i:and)\s+(?=\S))?")
_NUMBER = re.compile(r"\(?\d{1,2}[.)]\s+")
_NEXT_NUMBER = re.compile(r"\s+\(?\d{1,2}[.)]\s+")
_BLANKS = re.compile(r"\s+")
_KNOWN, _FREE, _BLANK = 1.0, 3.0, 0.2


class Segmenter:
    """Splits texts by a dictionary of whole values (letter case ignored)."""

    def __init__(self, values: Iterable[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for value in values:
            key = value.strip().lower()
            if key and key.lower() == key:
                self.automaton.add_word(key, len(key))
        self.size = len(self.automaton)
        if self.size:
            self.automaton.make_automaton()
        self.split = lru_cache(maxsize=50_000)(self._split)

    def _known(self, text: str) -> dict[int, list[int]]:
        """Ends of the known values by their start; both ends stand at a blank, a mark or the rim."""
        low = text.lower()
        if not self.size or len(low) != len(text):
            return {}
        found: dict[int, list[int]] = {}
        for last, length in self.automaton.iter(low):
            a, b = last - length + 1, last + 1
            if (a == 0 or not _inner(text[a - 1])) and (b == len(text) or not _inner(text[b])):
                found.setdefault(a, []).append(b)
        return found

    def _split(self, text: str | None) -> tuple[str, ...]:
        s = (text or "").strip()
        if len(s) > 1 and s[0] + s[-1] in ("[]", "{}"):
            s = s[1:-1].strip()
        if not s or s.lower() in PLACEHOLDERS:
            return ()
        known = self._known(s)
        numbered = bool(_NUMBER.match(s))
        n = len(s)
        best: list[tuple[float, int, tuple[int, int] | None] | None] = [None] * (n + 1)
        best[0] = (0.0, 0, None)
        loose = [False] * (n + 1)  # reached by a blank only: a known value must follow
        for i in range(n + 1):
            if best[i] is None:
                continue
            cost = best[i][0]

            def reach(j: int, c: float, value: tuple[int, int] | None, soft: bool = False) -> None:
                if best[j] is None or c < best[j][0] - 1e-9:
                    best[j] = (c, i, value)
                    loose[j] = soft

            if i == n:
                break
            came = best[i][2]
            if came is None and not loose[i]:  # at the start of a piece
                m = _NUMBER.match(s, i) or _BLANKS.match(s, i)
                if m:  # a number in front of a value belongs to no value
                    reach(m.end(), cost, None)
                    continue
                m = _HARD.match(s, i)
                if m and m.end() > i:
                    reach(m.end(), cost, None)
                end = _protected(s, i)
                if end and _ends(s, end, numbered):
                    reach(end, cost + _KNOWN, (i, end))
                if not s[i].isspace():
                    j = self._free_end(s, i, known, numbered)
                    if j > i:
                        reach(j, cost + _FREE, (i, j))
            if came is None:
                for j in known.get(i, ()):
                    reach(j, cost + _KNOWN, (i, j))
            if came is not None:  # at the end of a value
                m = _HARD.match(s, i)
                if m and m.end() > i:
                    reach(m.end(), cost, None)
                if numbered and (m := _NEXT_NUMBER.match(s, i)):
                    reach(m.end(), cost, None)
                if m := _BLANKS.match(s, i):
                    if m.end() == n:
                        reach(n, cost, None)
                    elif came[1] in known.get(came[0], ()):
                        reach(m.end(), cost + _BLANK, None, True)
        if best[n] is None:
            return (s,)
        out, i = [], n
        while i > 0:
            _, back, value = best[i]
            if value:
                out.append(_unwrap(s[value[0] : value[1]]))
            i = back
        return tuple(x for x in reversed(out) if x)

    @staticmethod
    def _free_end(s: str, i: int, known: dict[int, list[int]], numbered: bool) -> int:
        """End of the piece from ``i``: the next delimiter outside parentheses, quotes and known values."""
        j = i
        while j < len(s):
            if s[j] == "(" and (close := _closing(s, j)):
                j = close
                continue
            if j > i and s[j - 1].isspace() and s[j] == '"' and (end := _protected(s, j)):
                j = end
                continue
            if j > i and (m := _HARD.match(s, j)) and m.end() > j:
                return j
            if numbered and j > i and _NEXT_NUMBER.match(s, j):
                return j
            if j == i and _HARD.match(s, j):
                return i
            j += 1
        return len(s)


def _inner(ch: str) -> bool:
    return ch.isalnum() or ch in "-+'’"


def _closing(s: str, i: int) -> int:
    """Index behind the parenthesis that closes the one at ``i``; 0 if it never closes."""
    for j in range(i + 1, len(s)):
        if s[j] == "(":
            return 0
        if s[j] == ")":
            return j + 1
    return 0


def _protected(s: str, i: int) -> int:
    """Index behind the quoted span that opens at ``i``; a doubled quote stays inside."""
    pairs = {'"': '"', "'": "'", "“": "”", "‘": "’"}
    close = pairs.get(s[i])
    if not close:
        return 0
    j = i + 1
    while j < len(s):
        if s[j] == close:
            if j + 1 < len(s) and s[j + 1] == close and close in "\"'":
                j += 2
                continue
            if close == '"' or _ends(s, j + 1, False):
                return j + 1
        j += 1
    return 0


def _ends(s: str, j: int, numbered: bool) -> bool:
    return j == len(s) or bool(_HARD.match(s, j)) or s[j:].isspace() or (numbered and bool(_NEXT_NUMBER.match(s, j)))


def _unwrap(piece: str) -> str:
    piece = piece.strip()
    if len(piece) > 1:
        if piece[0] == piece[-1] and piece[0] in "\"'":
            q = piece[0]
            return piece[1:-1].replace(q * 2, q).strip()
        if piece[0] + piece[-1] in ("“”", "‘’"):
            return piece[1:-1].strip()
    return piece


def known_values(df: DataFrame, field: str, fixed: Iterable[str], share: float = 1e-4, least: int = 3) -> list[str]:
    """The dictionary of one field: the fixed values and those that often stand alone.

    A text counts as standing alone if it holds no delimiter, or is one quoted
    span.  It enters when at least ``share`` of all rows (and ``least`` rows) hold
    it, so at most ``1 / share`` values can enter: that bounds what the driver and
    the broadcast automaton hold at any size of table.  Values that other
    known values cover side by side are packed texts themselves and stay out.
    """
    c = F.trim(F.col(field))
    quoted = F.regexp_extract(c, r"""^["'\[{]*["']([^"'\[\]{}]+)["']["'\]}]*$""", 1)
    plain = F.when(~c.rlike(r"""[,;|•·\n\r\t/"'\[\]{}+&]|(?i)\sand\s|^\(?\d{1,2}[.)]\s"""), c)
    value = F.when(F.length(quoted) > 0, quoted).otherwise(plain)
    total = df.count()
    rows = (
        df.select(F.lower(value).alias("v"))
        .where("length(v) between 2 and 80")
        .groupBy("v")
        .count()
        .where(F.col("count") >= max(least, int(total * share)))
        .select("v")
        .collect()
    )
    base = {v.strip().lower() for v in fixed}
    # fixed values with a mark inside protect it; those without still serve side by side
    mined = {r.v.strip() for r in rows} - base
    keep = set(base)
    for v in sorted(mined, key=lambda x: (x.count(" "), len(x))):
        words = v.split()
        cover = [True] + [False] * len(words)
        for j in range(1, len(words) + 1):
            cover[j] = any(cover[i] and " ".join(words[i:j]) in keep for i in range(j))
        if not cover[-1]:
            keep.add(v)
    return sorted(keep)


def split_packed(df: DataFrame, key: str, field: str | Column, values: Iterable[str], field_name: str) -> DataFrame:
    """One row per value of a packed field, with its place.

    Output: ``key``, ``field_name``, ``pos`` (int from 1), ``item``.  Null, blank and
    placeholder texts give no row; empty pieces give none and take no place;
    repeated values stay.  Extra columns of ``df`` are left out, so their names
    cannot clash.  Very long texts are split whole.
    """
    values = list(values)
    src = df.select(F.col(key).alias("k"), (F.col(field) if isinstance(field, str) else field).alias("t")).where("t is not null")
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg = Segmenter(values)
        for pdf in batches:
            items = [seg.split(t) for t in pdf["t"]]
            sizes = [len(x) for x in items]
            flat = [x for xs in items for x in xs]
            yield pd.DataFrame({
                "k": pdf["k"].repeat(sizes).to_numpy(),
                "pos": pd.Series([p for n in sizes for p in range(1, n + 1)], dtype="int32"),
                "item": pd.Series(flat, dtype="object"),
            })

    out = src.mapInPandas(run, f"k {key_type}, pos int, item string")
    return out.select(F.col("k").alias(key), F.lit(field_name).alias("field_name"), "pos", "item")


def split_fields(df: DataFrame, key: str, fields: dict[str, Iterable[str]]) -> DataFrame:
    """:func:`split_packed` over several fields, each by its own dictionary (fixed values given)."""
    out = None
    for field, fixed in fields.items():
        part = split_packed(df, key, field, known_values(df, field, fixed), field)
        out = part if out is None else out.unionAll(part)
    return out


def several_values(items: DataFrame, key: str) -> DataFrame:
    """Only the values of fields that hold two or more."""
    from pyspark.sql import Window

    n = F.max("pos").over(Window.partitionBy(key, "field_name"))
    return items.withColumn("n", n).where("n > 1").drop("n")
