"""Mapping of free-entered values to a canonical list.

Every value is searched in a BK-tree over the surface forms of the reference
entries (labels, their halves swapped, their cut forms, and other names of the
lexicon) under the Levenshtein metric; the triangle inequality prunes the
branches that cannot hold an entry within the threshold.  The tree of a small
list is broadcast; a long list is cut into shards, each shard answers for every
value, and the winners of the shards merge.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread

# Other names of ownership labels, by label.
OWNERSHIP_NAMES = {
    "Black-Owned": "black, blk, african, african american, afro american, afro, owned by a black family",
    "Women-Owned": "women, woman, female, female owner, lady, ladies, owned by women, mujeres, mujer",
    "Latine-Owned": "latine, latino, latina, latinx, hispanic, hispanic american, latin american, negocio latino, chicano, latin",
    "Asian-Owned": "asian, aapi, asian american, asian pacific, south asian, subcontinent asian american, pacific islander, korean",
    "LGBTQ+-Owned": "lgbtq, lgbt, lgbtqia, gay, lesbian, queer, bisexual, transgender",
    "Veteran-Owned": "veteran, veterans, vet, military veteran, army vet, ex military, military, army, service disabled veteran",
    "Native American-Owned": "native american, native, indigenous, tribal, american indian, first nations, alaska native",
    "Disability-Owned": "disability, disabled, disabled owner, owner with a disability, persons with disabilities, disabilities",
    "Muslim-Owned": "muslim, moslem, islamic, halal, muslim family, muslim owner",
    "Minority-Owned (general)": "minority, minorities, ethnic minority, general minority, minority general",
}
# Other names of industries, by label.
INDUSTRY_NAMES = {
    "Accounting and Finance": "accountant, bookkeeping, tax prep, cpa firm, payroll and taxes, acctg and finance, lender",
    "Architecture and Engineering": "architect, architecture firm, land surveyor, structural engineer, civil engineering, arch and eng",
    "Arts and Entertainment": "art gallery, theatre, dance studio, music and art, dj live shows, entertainer, musician",
    "Business Consulting": "consultant, management consulting, strategy consulting, startup advisor, biz consulting, consulting business",
    "Construction and Remodeling": "plumber, roofing contractor, general contractor, home builder, remodeler, constr remodel, electrician, painter, carpenter",
    "Education and Training": "school, tutoring, teaching, preschool, driving school, educational services, child care",
    "Food and Beverage": "restaurant, bakery, catering, coffee shop, food truck, soul food, food and bev, grocery",
    "Government and Public Services": "county office, city agency, public sector, municipal services, govt services",
    "Health and Wellness": "dentist, chiropractor, medical clinic, massage therapy, fitness gym, home health, therapist, spa",
    "Human Resources and DEI": "hr, hr consulting, diversity training, diversity equity and inclusion, hr and dei, human resource and dei, inclusion",
    "Information Technology": "it, it services, info tech, software developer, web development, computer repair, cybersecurity, tech support",
    "Insurance and Risk Management": "insurance broker, insurance agent, insurance agency, life insurance, ins and risk, risk mgmt and insurance",
    "Legal Services": "lawyer, attorney, law firm, legal, paralegal services, attorneys at law, mediator, notary",
    "Logistics and Transportation": "trucking, taxi, freight, courier, hauling, moving company, movers",
    "Manufacturing and Industrial": "manufacturer, machine shop, welding, fabrication, industrial supplies, mfg, plastics",
    "Marketing and Communications": "advertising, branding, marketing agency, pr firm, social media marketing, mktg comms",
    "Media and Publishing": "newspaper, radio, film production, photographer, publisher, podcast studio, video production",
    "Non-Profit and Social Services": "nonprofit, charity, social services, foundation charity, non profit org, 501c3, social work, shelter",
    "Real Estate and Property Management": "realtor, landlord, real estate, property manager, apartment rentals, appraiser, real estate and property mgmt",
    "Retail and E-Commerce": "retail, boutique, gift shop, clothing store, online shop, ecommerce, retail and ecommerce",
    "Staffing and Recruiting": "recruiter, temp agency, staffing agency, employment agency, head hunter, job placement",
    "Travel and Hospitality": "hotel, travel agency, tour company, event venue, bed and breakfast, airbnb host, lodging",
    "Other Professional Services": "janitorial, cleaning services, landscaping, lawn care, security guards, translation, other services professional",
}
# Words too common to point at an entry by themselves.
COMMON = frozenset(
    "and or of the a an for with by in at to from y owned owner business company agency firm services service shop store studio "
    "management professional other social general public american people online work website websites living without which stated saying "
    "ownership descent served entry fits faith office offices advice money about care home info".split()
)
_AND = re.compile(r"\s+y\s+|\s*[&+/]\s*|,\s*")
_PLUS = re.compile(r"-\+|\+(?=-)|(?<=\S)\+(?=\s|$)|(?<!\S)\+(?=\S)")
_TAIL = re.compile(r"(?:\s*\b(?:owned|owner|business))*$")
_WORD = re.compile(r"[^\W_]+")


def plain(value: str) -> str:
    """Words of a value in lower case, accents and marks removed, ``&``, ``+``, ``/`` and ``y`` read as "and"."""
    text = unicodedata.normalize("NFKD", value)
    text = "".join(ch for ch in text if not unicodedata.combining(ch)).replace("’", "'")
    text = _PLUS.sub("", text)  # a plus that stands at one word joins nothing
    text = _AND.sub(" and ", text.lower())
    text = re.sub(r"\b((?:[a-z]\.){2,})", lambda m: m.group(1).replace(".", ""), text)
    return " ".join(_WORD.findall(text)).removesuffix(" and").removeprefix("and ")


def _key(text: str) -> str:
    return text.replace(" ", "")


def levenshtein(a: str, b: str, limit: int | None = None) -> int:
    """Edit distance; with ``limit`` any number above it may come back as ``limit + 1``."""
    if a == b:
        return 0
    if limit is not None and abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, diag = i, i - 1
        row[0] = i
        low = i
        for j, y in enumerate(b, 1):
            up = row[j]
            left = min(up + 1, left + 1, diag + (x != y))
            diag = up
            row[j] = left
            if left < low:
                low = left
        if limit is not None and low > limit:
            return limit + 1
    return row[-1]


class BKTree:
    """Entries under the Levenshtein metric; ``search`` returns every entry within the threshold."""

    def __init__(self, entries: list[tuple[str, int, int]]):
        """``entries``: text, rank (0 is the label itself), id."""
        self.root: tuple[str, list, dict] | None = None
        for text, rank, entry in entries:
            self._add(text, rank, entry)

    def _add(self, text: str, rank: int, entry: int) -> None:
        if self.root is None:
            self.root = (text, [(rank, entry)], {})
            return
        node = self.root
        while True:
            d = levenshtein(text, node[0])
            if d == 0:
                if (rank, entry) not in node[1]:
                    node[1].append((rank, entry))
                return
            if d not in node[2]:
                node[2][d] = (text, [(rank, entry)], {})
                return
            node = node[2][d]

    def search(self, text: str, threshold: int) -> list[tuple[int, int, int]]:
        """(distance, rank, id) of the entries within ``threshold``, nearest first."""
        found, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            d = levenshtein(text, node[0])
            if d <= threshold:
                found += [(d, rank, entry) for rank, entry in node[1]]
            stack += [child for dist, child in node[2].items() if d - threshold <= dist <= d + threshold]
        return sorted(found)


def surface_forms(entries: list[tuple[int, str, str]], names: dict[str, str]) -> list[tuple[str, int, int]]:
    """(text, rank, id) of the forms an entry is written in: 0 label, 1 rearranged or named otherwise, 2 cut short."""
    forms: dict[tuple[str, int], int] = {}

    def put(text: str, rank: int, entry: int) -> None:
        key = (_key(text), entry)
        if key[0]:
            forms[key] = min(rank, forms.get(key, 9))

    for entry, label, _about in entries:
        base = plain(label)
        put(base, 0, entry)
        halves = base.split(" and ")
        if len(halves) == 2:
            put(f"{halves[1]} and {halves[0]}", 1, entry)
            put(" ".join(halves), 1, entry)
        if base.endswith(" general"):
            put(base.removesuffix(" general"), 1, entry)
        short = _key(base)
        for n in range(max(6, len(short) * 6 // 10), len(short)):
            put(short[:n], 2, entry)
        heads = [base.removesuffix(" owned")] if base.endswith(" owned") else []
        for name in [*heads, *(x.strip() for x in names.get(label, "").split(",") if x.strip())]:
            put(name, 1, entry)
            if label.lower().split(" (")[0].endswith("owned"):
                for form in ("{} owned", "{} owned business", "{} owner", "owned by {}", "owned by a {}", "{} american owned"):
                    put(form.format(name), 1, entry)
    return sorted((text, rank, entry) for (text, entry), rank in forms.items())


def word_forms(entries: list[tuple[int, str, str]], names: dict[str, str]) -> list[tuple[str, int, int]]:
    """(word, rank, id) of the words that point at one entry only: of its names (1) and of its description (2)."""
    owner: dict[str, set[int]] = {}
    rank: dict[str, int] = {}
    for entry, label, about in entries:
        for words, r in ((plain(label) + " " + plain(names.get(label, "")), 1), (plain(about or ""), 2)):
            for w in words.split():
                if len(w) > 2 and w not in COMMON:
                    owner.setdefault(w, set()).add(entry)
                    rank[w] = min(r, rank.get(w, 9))
    return sorted((w, rank[w], next(iter(ids))) for w, ids in owner.items() if len(ids) == 1)


def allowed(length: int) -> int:
    """Edits allowed for a text of so many letters."""
    return 0 if length < 5 else 1 if length < 8 else 2 if length < 20 else 3


class Matcher:
    """Finds the entry a value stands for within one shard of the list; ``words`` are those that point at one entry of the whole list."""

    def __init__(self, entries: list[tuple[int, str, str]], names: dict[str, str], words: list[tuple[str, int, int]] | None = None):
        self.whole = BKTree(surface_forms(entries, names))
        self.words = BKTree(word_forms(entries, names) if words is None else words)
        self.parts = lru_cache(maxsize=50_000)(self._parts)

    def _parts(self, value: str) -> tuple[tuple[int, int, int] | None, tuple[tuple[str, int, int, int], ...]]:
        """(distance, rank, id) of the best whole form, and word, distance, rank, id of the best entry of each word."""
        text = plain(value)
        q = _key(text)
        if not q:
            return None, ()
        # another name counts as typed wrongly only as far as its own letters carry it ("ask owner" is not "blk owner")
        hits = [h for h in self.whole.search(q, allowed(len(q))) if h[1] == 0 or h[0] <= allowed(len(q) - len(_TAIL.search(text).group()))]
        if hits:
            return hits[0], ()
        told = []
        for i, w in enumerate(text.split()):
            if len(w) > 2 and w not in COMMON and (got := self.words.search(w, allowed(len(w)) if len(w) > 5 else 0)):
                told.append((f"{i} {w}", *got[0]))
        return None, tuple(told)

    def find(self, value: str) -> int:
        """The id of the entry, 0 if none: the nearest whole form, else the entry that most words vote for."""
        whole, words = self.parts(value)
        return whole[2] if whole else elect(words)


def elect(words: tuple[tuple[str, int, int, int], ...]) -> int:
    votes: dict[int, float] = {}
    for _, d, rank, entry in words:
        votes[entry] = votes.get(entry, 0.0) + 3.0 - d - 0.5 * rank
    return min(votes, key=lambda e: (-votes[e], e)) if votes else 0


def match_canonical(
    items: DataFrame,
    entries: DataFrame,
    names: dict[str, dict[str, str]] | None = None,
    shard_size: int = 5_000,
) -> DataFrame:
    """The entry each item stands for.

    ``items``: any key columns with ``field_name`` and ``item``; ``entries``: ``value_id``,
    ``field_name``, ``label``, ``about``.  Output: ``items`` with ``value_id`` (0: stands for
    none).  An item that is null or blank stands for none.  Ties go to the smaller
    id; repeated rows stay; an empty list makes every answer 0.  Names of columns
    that clash with the output are refused.

    At most ``shard_size`` entries sit in one tree.  Longer lists are cut by id; each distinct item
    asks every shard in turn, and the winners merge: the nearest whole form of all shards, else for
    each word the nearest word of all shards.  Which words point at one entry only is found over the
    whole list, so the answers do not depend on the cut.
    """
    if "value_id" in items.columns:
        raise ValueError("items already has a column value_id")
    names = names if names is not None else {"minority_type": OWNERSHIP_NAMES, "industry": INDUSTRY_NAMES}
    listed = entries.select("field_name", F.col("value_id").cast("long").alias("value_id"), "label", "about").where("value_id is not null")
    shards = max(1, -(-entries.count() // shard_size))
    if shards == 1:
        rows = [tuple(r) for r in listed.collect()]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trees = _matchers(rows, names, None)
            for pdf in batches:
                yield pdf.assign(value_id=[trees[f].find(i) if f in trees and i else 0 for f, i in zip(pdf["field_name"], pdf["item"])])

        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
        return items.mapInPandas(run, f"{cols}, value_id long")
    owned = _owned_words(listed, names)
    asked = spread(items.where("item is not null").select("field_name", "item").distinct())
    cut_by = F.pmod(F.xxhash64("value_id"), F.lit(shards))
    found = None
    for n in range(shards):  # one shard at a time is known to the workers: at most some ``shard_size`` entries and their words
        part = [tuple(r) for r in listed.where(cut_by == n).collect()]
        words = [tuple(r) for r in owned.where(cut_by == n).collect()]
        one = asked.mapInPandas(_asking(part, words, names), "field_name string, item string, w string, d int, rank int, value_id long")
        found = one if found is None else found.unionByName(one)
    nearest = cut(found.groupBy("field_name", "item", "w").agg(F.min(F.struct("d", "rank", "value_id")).alias("m")), "nearest")
    whole = nearest.where("w = ''").select("field_name", "item", F.col("m.value_id").alias("_whole"))
    votes = nearest.where("w <> ''").groupBy("field_name", "item", "m.value_id").agg(F.sum(3.0 - F.col("m.d") - 0.5 * F.col("m.rank")).alias("v"))
    most = votes.groupBy("field_name", "item").agg(F.min(F.struct((-F.col("v")).alias("v"), "value_id"))["value_id"].alias("_vote"))
    won = whole.join(most, ["field_name", "item"], "full")
    out = items.alias("i").join(won.alias("w"), (F.col("i.field_name").eqNullSafe(F.col("w.field_name"))) & (F.col("i.item").eqNullSafe(F.col("w.item"))), "left")
    return out.select("i.*", F.coalesce("w._whole", "w._vote", F.lit(0)).cast("long").alias("value_id"))


def _matchers(rows: list[tuple], names: dict[str, dict[str, str]], words: list[tuple] | None) -> dict[str, Matcher]:
    by_field: dict[str, list[tuple[int, str, str]]] = {}
    for field, value_id, label, about in rows:
        by_field.setdefault(field, []).append((value_id, label, about))
    own = {f: [(w, rank, v) for field, v, w, rank in words if field == f] if words is not None else None for f in by_field}
    return {f: Matcher(e, names.get(f, {}), own[f]) for f, e in by_field.items()}


def _owned_words(listed: DataFrame, names: dict[str, dict[str, str]]) -> DataFrame:
    """``field_name``, ``value_id``, ``w``, ``rank``: the words that point at one entry of the whole list only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(f, v, w, r) for f, v, label, about in zip(pdf["field_name"], pdf["value_id"], pdf["label"], pdf["about"]) for w, r, _ in word_forms([(v, label, about)], names.get(f, {}))]
            yield pd.DataFrame(rows, columns=["field_name", "value_id", "w", "rank"])

    each = listed.mapInPandas(run, "field_name string, value_id long, w string, rank int")
    once = each.groupBy("field_name", "w").agg(F.min("value_id").alias("value_id"), F.max("value_id").alias("other"), F.min("rank").alias("rank"))
    return cut(once.where("value_id = other").select("field_name", "value_id", "w", "rank"), "words")


def _asking(rows: list[tuple], words: list[tuple], names: dict[str, dict[str, str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = _matchers(rows, names, words)
        for pdf in batches:
            out = []
            for f, i in zip(pdf["field_name"], pdf["item"]):
                if f in trees and i:
                    whole, told = trees[f].parts(i)
                    out += [(f, i, "", *whole)] if whole else [(f, i, *t) for t in told]
            yield pd.DataFrame(out, columns=["field_name", "item", "w", "d", "rank", "value_id"])

    return run


def not_exact(matched: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows whose item is not exactly the label of an entry of its field."""
    labels = entries.select("field_name", F.col("label").alias("item")).distinct()
    return matched.join(F.broadcast(labels) if labels.count() <= 50_000 else labels, ["field_name", "item"], "left_anti")
