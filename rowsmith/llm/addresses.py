"""Postal addresses of one place written differently.

Every address is read into a beam of parses.  The parses' streets make a
gazetteer: the spellings within a locality are clustered around the frequent
ones, and each cluster is one street.  Every address then takes the parse of
its beam that the gazetteer supports best, and addresses of one street and
number are one place unless type, side of town or unit speak against it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .canonical import levenshtein
from .names import fold

# Places and the other names people write for them; others are read from the texts.
PLACES = {
    "louisville": "lou lville", "lexington": "lex lexingtonfayette", "bowling green": "bg bowlinggrn", "owensboro": "oboro", "covington": "cov",
    "hopkinsville": "hoptown", "elizabethtown": "etown elizabethtn", "paducah": "", "frankfort": "frankfurt", "danville": "", "somerset": "",
    "georgetown": "gtown", "pikeville": "", "richmond": "", "murray": "", "ashland": "", "florence": "", "nicholasville": "", "shelbyville": "",
    "winchester": "", "bardstown": "", "berea": "beria", "mount sterling": "mtsterling", "saint matthews": "stmatthews", "fort mitchell": "ftmitchell",
    "cincinnati": "cinci cincy", "jeffersonville": "jeffville", "new albany": "nalbany", "nashville": "", "evansville": "", "henderson": "",
    "radcliff": "", "erlanger": "", "madisonville": "", "newport": "", "fort thomas": "ftthomas", "independence": "", "glasgow": "", "corbin": "",
}
# States by their written forms.
STATES = {
    "ky": "ky kentucky", "oh": "oh ohio", "in": "in indiana", "tn": "tn tennessee", "wv": "wv", "il": "il illinois", "mo": "mo missouri", "va": "va virginia",
}
# Kinds of streets by their written forms.
KINDS = {
    "street": "street st str", "avenue": "avenue ave av", "road": "road rd", "drive": "drive dr drv", "lane": "lane ln", "court": "court ct crt",
    "boulevard": "boulevard blvd boul", "parkway": "parkway pkwy pky", "pike": "pike pk", "place": "place pl", "way": "way", "circle": "circle cir",
    "terrace": "terrace ter", "highway": "highway hwy", "trail": "trail trl",
}
SIDES = {"n": "n north", "s": "s south", "e": "e east", "w": "w west", "ne": "ne northeast", "nw": "nw northwest", "se": "se southeast", "sw": "sw southwest"}
_ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
_STATE = {w: s for s, words in STATES.items() for w in words.split()}
_KIND = {w: k for k, words in KINDS.items() for w in words.split()}
_SIDE = {w: k for k, words in SIDES.items() for w in words.split()}
_TOWN = {re.sub(r"\W", "", w): town for town, other in PLACES.items() for w in [town, *other.split()]}
_UNIT = re.compile(r"(?:\b(?:suite|ste|unit|apt|apartment|room|rm)\b\.?\s*#?\s*|#\s*)([0-9]+\s?[a-z]?|[a-z])\b")
_BOX = re.compile(r"\bp\.?\s*o\.?\s*box\b|\bpost\s+office\s+box\b")
_ZIP = re.compile(r"(?<![\d#])(\d{5})(?:-\d{4}|\.0)?(?!\d)")
_NUMBER = re.compile(r"(?<![\w.#-])(\d{1,6})(?:\s?[-–]\s?\d{1,6}|[a-z])?(?![\w.-])(?=\s+\w)")  # the first of a range stands for it
_ROUTE = re.compile(r"^((?:us|u s|ky|kentucky|state|county|interstate|i)\b)?\s*(?:(?:highway|hwy|route|rte|rt|road)\b)?\s*(\d{1,4}[a-z]?)\b")
_ROUTE_OF = {"us": "us", "u s": "us", "interstate": "interstate", "i": "interstate", "county": "county", "state": "state", "ky": "state", "kentucky": "state"}
_GRID = re.compile(r"\b(calle|carrera|cra|cll|avenida)\.?\s+(\d+[a-z]?)\s*(?:#|no\.?)\s*(\d+)")  # street by number, house behind the mark
_OTHER = frozenset("suite ste unit apt apartment room rm floor fl building bldg lot rear plaza center centre square mall tower and the".split())
_NOISE = re.compile(r"\bn\s*/\s*a\b|\bunited states(?: of america)?\b|\busa\b|\bu\.s\.a?\.?(?=\W|$)")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


@dataclass(frozen=True)
class Parse:
    """One way to read an address; empty strings where nothing is said."""

    number: str
    side: str
    street: str
    kind: str
    unit: str
    town: str
    state: str
    zip: str
    prior: float


@lru_cache(maxsize=10_000)
def find_town(text: str) -> str:
    """The place meant by a text, typos allowed; "" if none."""
    key = re.sub(r"[\W_]", "", text)
    if key in _TOWN:
        return _TOWN[key]
    if len(key) < 5:
        return ""
    best = min(((levenshtein(key, k, 2), k) for k in _TOWN if len(k) > 4 and abs(len(k) - len(key)) < 3), default=(9, ""))
    return _TOWN[best[1]] if best[0] <= (1 if len(key) < 7 else 2) else ""


def _side(token: str) -> str:
    return _SIDE.get(token, "")


def _street(words: list[str]) -> str:
    out = "".join(words)
    if out in _ORDINALS:
        n = _ORDINALS.index(out) + 1
        return f"{n}{'st' if n == 1 else 'nd' if n == 2 else 'rd' if n == 3 else 'th'}"
    return out


def _read_tail(tokens: list[str]) -> tuple[str, str, bool]:
    """(town, state, all understood) of words that follow or surround a street."""
    state = ""
    words = list(tokens)
    for i in range(len(words) - 1, -1, -1):
        if words[i] in _STATE and (words[i] not in ("in",) or i in (0, len(words) - 1)):
            state = _STATE[words.pop(i)]
            break
    if not words:
        return "", state, True
    for n in (3, 2, 1):
        for i in range(len(words) - n, -1, -1):
            town = find_town(" ".join(words[i : i + n]))
            if town:
                return town, state, n == len(words)
    return "", state, False


@lru_cache(maxsize=5_000)
def parse_address(raw: str | None, city: str | None = None, state: str | None = None, beam: int = 4) -> tuple[Parse, ...]:
    """The ``beam`` best parses, best first; none for blank texts.

    A parse without a number or street says that none is given (a post box, a town).
    """
    text = fold(raw or "").replace("\xa0", " ")
    text = _NOISE.sub(" ", re.sub(r"[\n\r;|]+", ", ", text))
    text = re.sub(r"\s+", " ", text).strip(" ,.-")
    extra_town = (find_town(fold(city)) or _own_town([fold(city)])) if city else ""
    extra_state = _STATE.get(fold(state).strip(" ."), "") if state else ""
    if not text:
        return (Parse("", "", "", "", "", extra_town, extra_state, "", 0.0),) if extra_town else ()
    box = bool(_BOX.search(text))
    if box:
        text = re.sub(_BOX.pattern + r"\s*#?\s*\d*", " ", text)
    grid = _GRID.search(text)
    if grid and not box:
        text = f"{text[: grid.start()]} {grid.group(3)} {grid.group(1)}{grid.group(2)} {text[grid.end() :]}".strip()
    unit = ""
    if m := _UNIT.search(text):
        unit = m.group(1).replace(" ", "")
        text = text[: m.start()] + (", " if m.start() else "") + text[m.end() :]
    zips = list(_ZIP.finditer(text))
    code = None
    for m in reversed(zips):  # a house number may have five digits too
        before = _WORD.findall(text[: m.start()])
        follows = re.match(r"\s+[a-z0-9]", text[m.end() :])
        marked = m.end() - m.start() > 5
        if marked or (before and before[-1] in _STATE) or (not follows and before) or (not before and not follows):
            code = m
            break
    if code:
        rest = (text[: code.start()], text[code.end() :])
        text = f"{rest[0]} , {rest[1]}" if not rest[1].strip(" ,.-") else f"{rest[0]} {rest[1]}"
    zip5 = code.group(1) if code else ""
    segments = [s.strip(" .") for s in re.split(r",|\s-\s", text)]
    segments = [s for s in segments if s]
    out: list[Parse] = []
    for k, seg in enumerate(segments):
        m = None if box else _NUMBER.search(seg)
        if not m:
            continue
        others = [w for i, s in enumerate(segments) if i != k for w in _WORD.findall(s)]
        others += _WORD.findall(seg[: m.start()])
        town2, state2, _ = _read_tail(others)
        for prior, side, street, kind, tail in _street_readings(_WORD.findall(seg[m.end() :])):
            town1, state1, clean1 = _read_tail(tail)
            if tail and not (town1 or state1):
                prior -= 2.0
            elif tail and not clean1:
                prior -= 1.0
            town = extra_town or town1 or town2 or _own_town(segments[k + 1 :])
            out.append(Parse(m.group(1).lstrip("0") or "0", side, street, kind, unit, town, extra_state or state1 or state2, zip5, prior - 0.5 * k))
    if out:
        out.sort(key=lambda p: -p.prior)
        return tuple(dict.fromkeys(out))[:beam]
    town, st, _ = _read_tail([w for s in segments for w in _WORD.findall(s)])
    return (Parse("", "", "", "", unit, extra_town or town or ("" if box or len(segments) > 2 else _own_town(segments[:1] if len(segments) > 1 else [])), extra_state or st, zip5, 0.0),)


def _own_town(segments: list[str]) -> str:
    """The words of the last segment that can name a place which is not among ``PLACES``; "" if none can."""
    for seg in reversed(segments):
        words = _WORD.findall(seg)
        while words and words[-1] in _STATE:
            words.pop()
        if words and len("".join(words)) >= 4 and all(w.isalpha() and w not in _KIND and w not in _OTHER and w not in _SIDE for w in words):
            return " ".join(words)
    return ""


def _street_readings(tokens: list[str]) -> Iterator[tuple[float, str, str, str, list[str]]]:
    """(prior, side, street, kind, words behind) for the ways to read the words behind a number."""
    side, words = "", tokens
    if len(words) > 1 and _side(words[0]) and words[1] not in _KIND:
        side, words = _side(words[0]), words[1:]
    if m := _ROUTE.match(" ".join(words)):  # a numbered route: the system, where it is told, is the kind
        back = _WORD.findall(" ".join(words)[m.end() :])
        if m.end() > len(m.group(2)):  # a word for route stands before the number
            behind = _side(back[0]) if back and not side else ""
            yield 3.0, side or behind, f"route{m.group(2)}", _ROUTE_OF.get(m.group(1) or "", ""), back[1:] if behind else back
            return
    for n in (1, 2, 3):
        if n > len(words):
            return
        name, rest = words[:n], words[n:]
        if n > 1 and (name[-1] in _KIND or _side(name[-1])):
            return
        prior = 1.0 - 0.6 * (n - 1)
        kind = ""
        if rest and rest[0] in _KIND:
            kind, rest2 = _KIND[rest[0]], rest[1:]
            back = ""
            if rest2 and not side and _side(rest2[0]):
                back, rest2 = _side(rest2[0]), rest2[1:]
            yield prior + 1.0, side or back, _street(name), kind, rest2
        back, rest3 = "", rest
        if rest3 and not side and _side(rest3[0]):
            back, rest3 = _side(rest3[0]), rest3[1:]
        yield prior, side or back, _street(name), "", rest3


_PARSED = "number string, side string, street string, kind string, unit string, town string, state string, zip string, prior double"


def parse_table(df: DataFrame, keys: list[str], address: str, city: str | None = None, state: str | None = None) -> DataFrame:
    """The beams of all addresses: ``keys``, ``rank`` (0 is the best parse) and the parts; no row for blank texts."""
    none = F.lit(None).cast("string")
    src = df.select(*keys, F.col(address).alias("_a"), (F.col(city) if city else none).alias("_c"), (F.col(state) if state else none).alias("_s"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            beams = [parse_address(a, c, s) for a, c, s in zip(pdf["_a"], pdf["_c"], pdf["_s"])]
            sizes = [len(b) for b in beams]
            out = pdf[keys].loc[pdf.index.repeat(sizes)].reset_index(drop=True)
            out["rank"] = [i for n in sizes for i in range(n)]
            flat = [p for b in beams for p in b]
            for part in ("number", "side", "street", "kind", "unit", "town", "state", "zip", "prior"):
                out[part] = [getattr(p, part) for p in flat]
            yield out.astype({"rank": "int32"})

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return src.mapInPandas(run, f"{kinds}, rank int, {_PARSED}")


def with_locality(parsed: DataFrame) -> DataFrame:
    """Adds ``place``: the town, or the town that the ZIP stands for in these data, or the ZIP itself."""
    parsed = _like_towns(parsed)
    by_zip = parsed.where("rank = 0 and zip <> '' and town <> ''").groupBy("zip", "town").count()
    best = by_zip.groupBy("zip").agg(F.max_by("town", F.struct("count", "town")).alias("zip_town"))
    # one row per ZIP that occurs: at most 100,000
    joined = parsed.join(F.broadcast(best), "zip", "left")
    return joined.withColumn("place", F.when(F.col("town") != "", F.col("town")).otherwise(F.coalesce("zip_town", "zip"))).drop("zip_town")


def _like_towns(parsed: DataFrame) -> DataFrame:
    """Misspelt towns take the spelling most rows of these data give; listed towns stay."""
    seen = parsed.where("rank = 0 and town <> ''").groupBy(F.col("town").alias("street")).agg(F.count("*").cast("double").alias("n"))
    spelt = _hang(seen, []).where("up <> street").select(F.col("street").alias("town"), F.col("up").alias("_town")).where(~F.col("town").isin(*PLACES))
    return parsed.join(spelt, "town", "left").withColumn("town", F.coalesce("_town", "town")).drop("_town")


def _hang(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``street``, ``n``, ``up``: the head each spelling hangs on (itself where it is a head).

    Spellings that lose the same letter share a block; in each block the most
    frequent one is the head, and every other within two edits may hang on it.
    No pairs within a block are formed.
    """
    length = F.length("street")
    shorter = F.transform(F.sequence(F.lit(1), length), lambda i: F.concat(F.col("street").substr(F.lit(1), i - 1), F.col("street").substr(i + 1, length)))
    forms = F.when(length >= 5, F.concat(F.array("street"), shorter)).otherwise(F.array("street"))
    weight = F.struct("n", "street")
    blocks = counted.withColumn("form", F.explode(F.array_distinct(forms)))
    heads = blocks.groupBy(*keys, "form").agg(F.max(weight).alias("head"))
    near = F.levenshtein("street", "head.street") <= 2
    digits = F.regexp_extract("street", r"\d+", 0) == F.regexp_extract("head.street", r"\d+", 0)
    up = blocks.join(heads, [*keys, "form"]).where((F.col("head") > weight) & near & digits).groupBy(*keys, "street").agg(F.max("head").alias("head"))
    entry = counted.join(up, [*keys, "street"], "left").select(*keys, "street", "n", F.coalesce("head.street", "street").alias("up"))
    entry = cut(entry, "heads")
    above = entry.select(*keys, F.col("street").alias("up"), F.col("up").alias("next"))
    for _ in range(2):  # a head may hang on a head
        top = F.coalesce("next", "up")
        entry = entry.join(above, [*keys, "up"], "left").select(*keys, "street", "n", F.when(F.levenshtein("street", top) <= 3, top).otherwise(F.col("up")).alias("up"))
    return entry


def gazetteer(parsed: DataFrame) -> DataFrame:
    """``place``, ``street``, ``street_id`` and ``support`` of every spelling read at a place.

    Spellings hang first on the frequent names of all places (streets of one name
    exist in many), then, within the place, on what is frequent there.
    """
    seen = parsed.where("number <> '' and street <> '' and place <> ''")
    # every parse of the beam may be a street; a leading one counts fully, so that wrong readings stay rare
    counted = seen.groupBy("place", "street").agg(F.sum(F.when(F.col("rank") == 0, 1.0).otherwise(0.01)).alias("n"))
    counted = cut(counted, "spellings")
    common = _hang(counted.groupBy("street").agg(F.sum("n").alias("n")), []).select("street", F.col("up").alias("name"))
    named = counted.join(common, "street")
    local = _hang(named.groupBy("place", F.col("name").alias("street")).agg(F.sum("n").alias("n")), ["place"])
    local = local.select("place", F.col("street").alias("name"), F.col("up").alias("street_id"))
    support = F.sum("n").over(Window.partitionBy("place", "street_id"))
    return named.join(local, ["place", "name"]).select("place", "street", "street_id", support.alias("support"))


def resolve(parsed: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """The supported parse of each beam: ``keys``, ``place``, ``street_id``, ``number``, ``side``, ``kind``, ``unit``, ``zip``.

    An address without any locality takes the only place that has its street and number; where
    there are several, or none, its ``place`` is empty.
    """
    scored = parsed.where("number <> '' and street <> ''").join(entries, ["place", "street"], "left")
    score = F.col("prior") + F.least(F.log1p(F.coalesce("support", F.lit(0.0))), F.lit(4.0)) / 4
    best = scored.groupBy(*keys).agg(
        F.max(F.struct(score.alias("score"), (-F.col("rank")).alias("r"), "place", F.coalesce("street_id", "street").alias("street_id"), "number", "side", "kind", "unit", "zip", "street")).alias("b")
    )
    best = cut(best.select(*keys, "b.place", "b.street_id", "b.number", "b.side", "b.kind", "b.unit", "b.zip", "b.street"), "resolved")
    known = best.where("place <> ''").groupBy("street", "number").agg(F.min("place").alias("_p"), F.max("place").alias("_q"), F.min("street_id").alias("_s"))
    found = best.where("place = ''").join(known.where("_p = _q"), ["street", "number"], "left")
    cols = [*keys, "place", "street_id", "number", "side", "kind", "unit", "zip"]
    told = found.withColumn("place", F.coalesce("_p", "place")).withColumn("street_id", F.coalesce("_s", "street_id")).select(*cols)
    return best.where("place <> ''").select(*cols).unionByName(told)


def resolve_addresses(df: DataFrame, keys: list[str], address: str, city: str | None = None, state: str | None = None) -> DataFrame:
    """Street identifier, number and unit of every address that gives a number and a street.

    Rows whose address is null, blank, a post box or a town alone are not in the
    output; repeated rows stay as often as their keys differ; extra columns are
    left out, so their names cannot clash.
    """
    parsed = cut(with_locality(parse_table(df, keys, address, city, state)), "parsed")
    return resolve(parsed, gazetteer(parsed), keys)


def _agree(a: str, b: str):
    return (F.col(a) == "") | (F.col(b) == "") | (F.col(a) == F.col(b))


def same_place_pairs(resolved: DataFrame, texts: DataFrame, key: str = "id") -> DataFrame:
    """``id_a`` < ``id_b``: rows of one place whose texts differ as typed.

    Join on street identifier and number; unit, kind of street and side of town
    must agree where both are given.  Addresses of unknown place are in no pair.  ``texts``: ``key`` and ``text``.
    """
    both = resolved.where("place <> ''").join(texts.select(key, F.col("text")), key)
    a = both.select(*(F.col(c).alias(f"{c}_a") for c in both.columns))
    b = both.select(*(F.col(c).alias(f"{c}_b") for c in both.columns))
    on = [F.col(f"{c}_a") == F.col(f"{c}_b") for c in ("place", "street_id", "number")]
    pairs = a.join(b, [*on, F.col(f"{key}_a") < F.col(f"{key}_b"), F.col("text_a") != F.col("text_b")])
    pairs = pairs.where(_agree("unit_a", "unit_b") & _agree("kind_a", "kind_b") & _agree("side_a", "side_b"))
    return pairs.select(F.col(f"{key}_a").alias("id_a"), F.col(f"{key}_b").alias("id_b"))
