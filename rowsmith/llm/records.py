"""Rows of directories read into comparable records."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from .addresses import _BOX, find_town, parse_address
from .names import read_name

FIELDS = ("name", "phone", "website", "address", "city", "state", "note")
_SCHEMA = (
    "words array<string>, core string, legal boolean, site string, phone string, phone7 string, number string, street string, unit string, place string, zip string, fullness int"
)
_EXTENSION = re.compile(r"\s*(?:x|ext\.?)\s*\d+\s*$|\(\s*(?:office|home|cell|fax|mobile)\s*\)\s*$", re.I)
_IN_TOWN = re.compile(r"\bin ([A-Z][A-Za-z .']+?)\.?\s*$")
_PAGE = re.compile(r"/(?:index\.\w+|home|contact|about|about-us|es|en|fr)$")
COMMON_SHARE = 0.001  # words on at least this share of names are known to every executor: at most 1 / share x words per name


@lru_cache(maxsize=5_000)
def read_phone(raw: str | None) -> tuple[str, str]:
    """(ten digits, last seven digits); "" where they aren't given."""
    text = _EXTENSION.sub("", raw or "")
    digits = re.sub(r"\D", "", text)
    if len(digits) == 11 and digits[0] == "1":
        digits = digits[1:]
    if len(digits) == 10:
        return digits, digits[3:]
    return "", digits if len(digits) == 7 else ""


@lru_cache(maxsize=5_000)
def read_site(raw: str | None) -> str:
    """Host and path in lower case, without scheme, ``www.``, query, anchor and the path of a home page; "" for placeholders."""
    text = re.sub(r"^[a-z]+://", "", (raw or "").strip().lower())
    text = re.split(r"[?#\s]", text, maxsplit=1)[0]
    text = re.sub(r"^www\d?\.", "", text).rstrip("/")
    text = _PAGE.sub("", text).rstrip("/")
    return text if re.match(r"^[a-z0-9-]+(?:\.[a-z0-9-]+)+", text) else ""


def address_fullness(parse, raw: str | None) -> int:
    """3: street (or post box), town and ZIP; 2: one of town and ZIP missing; 1: less than that; 0: nothing."""
    if not parse or not (parse.town or parse.zip or parse.number):
        return 0
    if not (parse.number and parse.street) and not (raw and _BOX.search(raw.lower())):
        return 1
    return 1 + bool(parse.town) + bool(parse.zip)


def read_records(df: DataFrame, key: str, keep: dict[str, str] | None = None, **fields: str | None) -> DataFrame:
    """``key`` and the comparable parts of each row.

    ``fields`` names the columns for name, phone, website, address, city, state and
    note (a text that may end in "in TOWN."); missing ones are left out.  Nulls,
    blanks and placeholder words give empty parts.  Other columns are left out, but for
    those of ``keep`` (by their names in the result).
    """
    none = F.lit(None).cast("string")
    src = df.select(F.col(key).alias("id"), *((F.col(fields[f]) if fields.get(f) else none).alias(f) for f in FIELDS), *(F.col(c).alias(k) for k, c in (keep or {}).items()))
    kept = [*(keep or {})]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, phone, website, address, city, state, note in zip(*(pdf[f] for f in FIELDS)):
                n = read_name(name)
                p10, p7 = read_phone(phone)
                beam = parse_address(address, city, state)
                a = beam[0] if beam else None
                town = (a.town if a else "") or (find_town(city.lower()) if city else "")
                if not town and note and (m := _IN_TOWN.search(note)):
                    town = find_town(m.group(1).lower())
                out.append((
                    list(n.words), n.core, n.holding, read_site(website), p10, p7,
                    a.number if a else "", a.street if a else "", a.unit if a else "", town or n.town, a.zip if a else "", address_fullness(a, address),
                ))
            cols = [c.split()[0] for c in _SCHEMA.split(", ")]
            yield pd.concat([pdf[["id", *kept]].reset_index(drop=True), pd.DataFrame(out, columns=cols)], axis=1)

    kind = df.schema[key].dataType.simpleString()
    more = "".join(f"{k} {df.schema[c].dataType.simpleString()}, " for k, c in (keep or {}).items())
    return src.mapInPandas(run, f"id {kind}, {more}{_SCHEMA}")


def own_sites(records: DataFrame, least: int = 6) -> DataFrame:
    """Blanks the sites of pages that list many businesses.

    The names of one business mostly share a word, however they are typed; a page is shared if at
    least ``least`` rows name it and no word stands in half of their names.  The size of the page
    or of the table plays no part.
    """
    named = records.where("site <> ''")
    rows = named.groupBy("site").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    words = named.select("site", F.explode(F.array_distinct("words")).alias("w")).groupBy("site", "w").count().groupBy("site").agg(F.max("count").alias("top"))
    hubs = cut(rows.join(words, "site", "left").where(F.coalesce("top", F.lit(0)) * 2 < F.col("n")).select("site", F.lit(True).alias("hub")), "shared")
    some = F.broadcast(hubs) if hubs.count() <= 100_000 else hubs
    return records.join(some, "site", "left").withColumn("site", F.when(F.col("hub"), F.lit("")).otherwise(F.col("site"))).drop("hub")


def with_places(records: DataFrame) -> DataFrame:
    """Fills a missing place from the ZIP by the town most rows give for it (one row per ZIP is broadcast)."""
    best = (
        records.where("zip <> '' and place <> ''").groupBy("zip", "place").count()
        .groupBy("zip").agg(F.max_by("place", F.struct("count", "place")).alias("by_zip"))
    )
    filled = records.join(F.broadcast(best), "zip", "left")
    return filled.withColumn("place", F.when(F.col("place") != "", F.col("place")).otherwise(F.coalesce("by_zip", F.lit("")))).drop("by_zip")


def prepare(tables: list[tuple[DataFrame, str, dict[str, str]]], keep: dict[str, str] | None = None) -> DataFrame:
    """Records of several tables with a ``kind`` (0, 1, ... by table), written out once."""
    more = [*(keep or {}).values()]
    parts = [read_records(spread(df.select(key, *dict.fromkeys([*fields.values(), *more]))), key, keep, **fields).withColumn("kind", F.lit(i)) for i, (df, key, fields) in enumerate(tables)]
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p)
    raw = cut(raw, "records")
    return cut(with_places(own_sites(raw)), "records")


def word_weights(records: DataFrame) -> dict[str, float]:
    """Weights of the common words; every other word weighs 1.

    Only words on at least ``COMMON_SHARE`` of all names are collected.
    """
    total = records.count()
    least = max(10, int(total * COMMON_SHARE))
    rows = records.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count().where(F.col("count") >= least).collect()
    return {r.w: 0.3 if r["count"] >= max(12, 0.004 * total) else 0.6 for r in rows}
