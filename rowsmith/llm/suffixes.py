"""Variant spellings of names typed by people.

Suffix blocking: every word of a name is indexed by its suffixes of at least
four letters.  A suffix that few names share is a block.  A suffix that is too
common is first refined with the row's other fields (site, phone, last seven
digits, street number, place, another word) and also searched as a whole; of large blocks only the
pairs that a bound by letters leaves are written.  Pairs of a block are compared by the ratio of their
longest common subsequence, and accepted pairs form classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.alike import letter_masks, letters_apart, near_letters
from ..operators.components import connected_components
from ..session import clear, cut, slots, spread
from .matching import name_matches
from .records import word_weights

MIN_SUFFIX = 4
BLOCK = 40  # records a block may hold to be paired directly; larger ones meet by :func:`crowded`, with the same result
TILE = 2_000  # records of a large block that meet others in one task
# what a block's key says besides the suffix, as bits
RARE, SITE, PHONE, SEVEN, NUMBER, PLACE, NAME = 1, 2, 4, 8, 16, 32, 64


def representatives(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that differ in some compared field, ``id`` -> ``rep``): copies are compared once.

    Rows that say nothing are no copies of one another.
    """
    said = F.concat("core", "site", "phone", "phone7", "number") != ""
    sign = F.when(said, F.xxhash64("core", "site", "phone", "phone7", "number", "street", "unit", "place")).otherwise(F.xxhash64("id"))
    signed = records.select("id", sign.alias("sign"))
    member = cut(signed.join(signed.groupBy("sign").agg(F.min("id").alias("rep")), "sign").select("id", "rep"), "members")
    reps = records.join(member.where("id = rep").select("id"), "id")
    return reps, member


def telling(words: Column, common: list[str]) -> Column:
    """The three most telling words: rare ones first, then long ones."""
    rank = F.array_sort(F.transform(words, lambda w: F.struct(w.isin(common).alias("c"), (-F.length(w)).alias("l"), w.alias("w"))))
    return F.transform(F.slice(rank, 1, 3), lambda x: x["w"])


def with_suffix(words: str, size: int) -> Column:
    """Every word with the suffix of every other one: a typo in one word leaves the keys of the others."""
    return F.flatten(F.transform(words, lambda v: F.transform(F.filter(words, lambda w: w != v), lambda w: F.concat_ws(" ", v, F.right(w, F.lit(size))))))


def _keys(reps: DataFrame, common: list[str]) -> DataFrame:
    """``k`` (block key), ``bit``, ``rep``: the suffixes refined with the other fields of the row.

    A site or phone also makes a block without a suffix, for names mistyped at every end.
    Within a place, and for the name alone, a suffix is refined with another whole word of the
    name: a suffix by itself, or two of them, are common at any size of table.
    """
    words = F.filter(F.array_distinct("words"), lambda w: F.length(w) >= MIN_SUFFIX)
    last = lambda w: F.right(w, F.lit(MIN_SUFFIX))
    base = reps.select("id", "site", "phone", "phone7", "number", "place", F.array_distinct(F.transform(words, last)).alias("s"), telling(words, common).alias("t"))
    base = base.withColumn("near", with_suffix("t", MIN_SUFFIX)).withColumn("far", with_suffix("t", MIN_SUFFIX + 2)).withColumn("s0", F.array_append("s", F.lit("")))

    def keys(bit: int, parts: str, value: Column, there: Column) -> Column:
        made = F.transform(parts, lambda s: F.struct(F.xxhash64(F.lit(bit), s, value).alias("k"), F.lit(bit).alias("bit")))
        return F.when(there, made).otherwise(F.array().cast("array<struct<k:bigint,bit:int>>"))

    made = F.concat(
        keys(SITE, "s0", F.col("site"), F.col("site") != ""),
        keys(PHONE, "s0", F.col("phone"), F.col("phone") != ""),
        keys(SEVEN, "s", F.col("phone7"), F.col("phone7") != ""),
        keys(NUMBER, "s", F.concat_ws("@", "number", "place"), (F.col("number") != "") & (F.col("place") != "")),
        keys(PLACE, "near", F.col("place"), F.col("place") != ""),
        keys(NAME, "far", F.lit(""), F.lit(True)),
    )
    return base.select(F.explode(made).alias("x"), F.col("id").alias("rep")).select("x.k", "x.bit", "rep")


def _suffixes(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks of the suffixes that few records share, all lengths; ``k``, ``rep`` of the shortest suffixes that more share).

    Who shares a longer suffix shares the shortest one, so the common ones need be searched once.
    """
    words = F.filter(F.array_distinct("words"), lambda w: F.length(w) >= MIN_SUFFIX)
    suffixes = F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(MIN_SUFFIX), F.length(w)), lambda n: F.right(w, n)))))
    index = reps.select(F.explode(suffixes).alias("suffix"), F.col("id").alias("rep"))
    # counted with map-side combine: suffixes are few, rows are many
    sizes = cut(index.groupBy("suffix").count().where("count > 1"), "suffixes")
    rare = index.join(sizes.where(F.col("count") <= BLOCK).select("suffix"), "suffix").select(F.xxhash64(F.lit(RARE), "suffix").alias("k"), F.lit(RARE).alias("bit"), "rep")
    wide = sizes.where((F.col("count") > BLOCK) & (F.length("suffix") == MIN_SUFFIX)).select("suffix")
    return rare, index.join(wide, "suffix").select(F.xxhash64(F.lit(RARE), "suffix").alias("k"), "rep")


def candidates(reps: DataFrame, weights: dict[str, float], known: DataFrame) -> DataFrame:
    """``a`` < ``b`` and ``bits``: pairs of records that share a block, with what the blocks say.

    Records of blocks above ``BLOCK`` meet by :func:`crowded` and :func:`common_suffixes`, which write only
    the pairs that the rules could accept.  ``known``: :func:`light`.
    """
    common = [w for w, x in weights.items() if x < 0.5]
    rare, wide = _suffixes(reps)
    index = cut(_keys(reps, common).unionAll(rare), "index")
    # sizes are counted with map-side combine, so that a hot key is one row before it moves
    sizes = cut(index.groupBy("k").count().where("count > 1"), "sizes")
    small = cut(index.join(sizes.where(F.col("count") <= BLOCK).select("k"), "k"), "blocks")
    left = small.select("k", "bit", F.col("rep").alias("a"))
    right = small.select("k", F.col("rep").alias("b"))
    met = left.join(right, "k").where("a < b").select("a", "b", F.col("bit").alias("bits"))
    large = index.join(sizes.where(F.col("count") > BLOCK), "k").drop("count")
    met = met.unionByName(crowded(large, reps, common, known=known)).unionByName(common_suffixes(wide, reps, known))
    met = cut(met.groupBy("a", "b").agg(F.bit_or("bits").alias("bits")), "met")
    clear(index, small, sizes)
    return met


def crowded(blocks: DataFrame, reps: DataFrame, common: list[str], contained: bool = False, known: DataFrame | None = None) -> DataFrame:
    """``a`` < ``b``, ``bits`` (and ``size`` of the block): the pairs of large blocks (``k``, ``bit``, ``rep``) that :func:`plausible` keeps.

    Every pair of a block is looked at, whatever its size: its records are dealt to tiles, and each two
    tiles meet in a task of their own.  What cannot be alike enough is left out there, before it is written.
    For the rules of :func:`accepted` a site or phone only asks for the names: one record then stands
    for a name and the others hang on it (not with ``contained``, where every pair has a score of its own).
    ``known``: :func:`light` of the records, where it is there already.
    """
    known = light(reps, common, contained) if known is None else known
    bare = [c for c in blocks.columns if c not in ("k", "bit", "rep")]
    held = blocks
    stars = None
    if not contained:
        alone = F.col("bit").isin(SITE, PHONE)
        # the name in the order of its words; null joins nothing
        named = held.join(reps.select(F.col("id").alias("rep"), F.array_join("words", " ").alias("name")), "rep").withColumn("name", F.when(alone, F.col("name")))
        first = named.where(alone).groupBy("k", "name").agg(F.min("rep").alias("lead"))
        held = cut(named.join(first, ["k", "name"], "left").drop("name"), "crowded")
        stars = held.where("rep > lead").select(F.col("lead").alias("a"), F.col("rep").alias("b"), F.col("bit").alias("bits"), *bare)
        held = held.where("lead is null or rep = lead")
    tiles = held.groupBy("k").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    if contained:
        dealt = held.join(tiles, "k").withColumn("t", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
        side = lambda i, j: F.struct(F.xxhash64("k", i, j).alias("h"), F.when(i == j, 2).when(i == F.col("t"), 0).otherwise(1).alias("s"))
        own = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: side(F.least("t", j), F.greatest("t", j)))
        return cells(dealt.select(F.explode(own).alias("y"), "bit", "rep").select("y.h", "y.s", "bit", "rep"), known)
    held = held.join(known.withColumnRenamed("id", "rep"), "rep")
    dealt = held.join(tiles, "k").withColumn("t", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    one = dealt.select("k", "bit", *bare, F.col("t").alias("i"), F.explode(F.sequence("t", F.col("tiles") - 1)).alias("j"), F.col("rep").alias("a"), F.col("x").alias("xa"))
    two = dealt.select("k", F.explode(F.sequence(F.lit(0), "t")).alias("i"), F.col("t").alias("j"), F.col("rep").alias("b"), F.col("x").alias("xb"))
    met = one.withColumnRenamed("bit", "bits").hint("merge").join(two, ["k", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("a") < F.col("b"))).where(fits(contained))
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "bits", *bare)
    return met if stars is None else met.unionByName(stars)


def common_suffixes(wide: DataFrame, reps: DataFrame, known: DataFrame) -> DataFrame:
    """``a`` < ``b``, ``bits``: the pairs within blocks of common suffixes (``k``, ``rep``) that the rule for them could accept.

    It asks for a ratio of 0.86 (:func:`accepted`), for one place, site and number where both give one, so
    that records meet those of their place and, either way, those without.
    """
    base = known.join(reps.select("id", "place"), "id").select(F.col("id").alias("rep"), "place", "x.m", "x.n", F.array("x.site", "x.number").alias("f"))
    rows = wide.join(base, "rep")
    own = rows.where("place <> ''").select(F.xxhash64("k", "place").alias("g"), F.lit(3).alias("role"), "rep", "m", "n", "f")
    blank = rows.where("place = ''").select("k").distinct()
    other = rows.join(blank, "k").select(F.xxhash64("k", F.lit("")).alias("g"), F.when(F.col("place") == "", 3).otherwise(2).alias("role"), "rep", "m", "n", "f")
    met = near_letters(own.unionAll(other).withColumnRenamed("rep", "id"), 0.14)
    return met.select("a", "b", F.lit(RARE).alias("bits"))


def heads(reps: DataFrame) -> DataFrame:
    """``a``, ``b``, ``bits``: every record with the first one of the same name and field.

    The exact way for groups of any size: one edge per record, no pairs.
    """
    out = None
    for bit, field in ((SITE, "site"), (PHONE, "phone"), (PLACE, "place")):
        given = reps.where(f"{field} <> '' and core <> ''").select("core", field, "id")
        first = given.groupBy("core", field).agg(F.min("id").alias("a"))
        e = given.join(first, ["core", field]).select("a", F.col("id").alias("b"), F.lit(bit).alias("bits")).where("a < b")
        out = e if out is None else out.unionAll(e)
    return out


def _sign(field: str) -> Column:
    """A number for a text, 0 for an empty one."""
    return F.when(F.col(field) != "", F.xxhash64(field)).otherwise(F.lit(0).cast("long"))


def light(reps: DataFrame, common: list[str], contained: bool) -> DataFrame:
    """``id``, ``x``: what :func:`fits` asks of a record; ``x.r`` holds the rare words as bits."""
    name = F.array_join("words", "")
    asked = [letter_masks(name).alias("m"), F.length(name).alias("n"), F.col("street")]
    if contained:
        rare = F.filter(F.array_distinct("words"), lambda w: ~w.isin(common) & (F.length(w) > 3))
        bits = F.aggregate(rare, F.lit(0).cast("long"), lambda m, w: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(w), F.lit(64)))))
        asked += [F.transform(rare, lambda w: F.xxhash64(w)).alias("w"), bits.alias("r")]
    asked += [_sign(c).alias(c) for c in (("site", "number", "place", "phone", "phone7") if contained else ("site", "number", "place"))]
    return reps.select("id", F.struct(*asked).alias("x"))


def fits(contained: bool) -> Column:
    """Whether ``xa`` and ``xb``, which share what ``bits`` say, can be alike enough: see :func:`plausible`."""
    strong = F.col("bits").bitwiseAND(F.lit(SITE | PHONE | SEVEN)) > 0
    # the score takes streets for near by the ratio of their letters, whatever their length
    edits = "greatest(4, cast((length(xa.street) + length(xb.street)) * 0.25 as int))" if contained else "4"
    spot = (F.col("bits").bitwiseAND(F.lit(NUMBER)) > 0) & F.expr(f"levenshtein(xa.street, xb.street, {edits}) >= 0")
    apart, both = letters_apart("xa.m", "xb.m"), F.col("xa.n") + F.col("xb.n")
    fit = apart <= both * (0.25 if contained else 0.2) + 1e-9
    given = lambda c: (F.col(f"xa.{c}") != 0) & (F.col(f"xb.{c}") != 0)
    other = lambda c: given(c) & (F.col(f"xa.{c}") != F.col(f"xb.{c}"))
    if not contained:  # what the two rules by name ask besides
        here = F.col("bits").bitwiseAND(F.lit(PLACE)) > 0
        fit = fit & ~other("site") & ~other("number") & (here | (~other("place") & (apart <= both * 0.14 + 1e-9)))
    else:
        held = F.size(F.array_intersect("xa.w", "xb.w")) >= F.greatest(F.least(F.size("xa.w"), F.size("xb.w")) * 0.6, F.lit(1))
        fit = fit | ((F.col("xa.r").bitwiseAND(F.col("xb.r")) != 0) & held)
        # the most that collective.odds can give: at -3 and below it leaves a pair out
        same = lambda c: given(c) & ~other(c)
        most = F.when(same("site"), 5.0).when(other("site"), -6.0).otherwise(0.0) + F.when(apart <= both * 0.2 + 1e-9, 4.5).otherwise(2.5) - 4.0
        most += F.when(same("phone"), 5.0).when(given("phone"), -1.0).when(same("phone7"), 3.0).otherwise(0.0)
        most += F.when(same("place"), 1.0).when(other("place"), -3.0).otherwise(0.0)
        most += F.when(given("number") & (F.col("xa.place") == F.col("xb.place")), F.when(other("number"), -3.0).otherwise(3.5)).otherwise(0.0)
        return (most > -3.0) & (strong | spot | fit)
    return strong | spot | fit


_SIGNS = ("site", "number", "place", "phone", "phone7")
_MASKS = ("c1", "c2", "c3")
PAIRS = 1 << 17  # pairs whose facts are looked at together


def _close(x: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`fits` (contained) for the rows ``p`` and ``q``: places of the pairs that it keeps, or would for a near street, and whether it asks for that."""
    apart = np.zeros(len(p), np.int64)
    for c in _MASKS:
        apart += np.bitwise_count(x[c][p] ^ x[c][q])
    both = x["n"][p] + x["n"][q]
    sides = {c: (x[c][p], x[c][q]) for c in _SIGNS}
    given = {c: (u != 0) & (v != 0) for c, (u, v) in sides.items()}
    same = {c: given[c] & (u == v) for c, (u, v) in sides.items()}
    most = np.where(same["site"], 5.0, np.where(given["site"], -6.0, 0.0)) + np.where(apart <= both * 0.2 + 1e-9, 4.5, 2.5) - 4.0
    most += np.where(same["phone"], 5.0, np.where(given["phone"], -1.0, np.where(same["phone7"], 3.0, 0.0)))
    most += np.where(same["place"], 1.0, np.where(given["place"], -3.0, 0.0))
    most += np.where(given["number"] & (sides["place"][0] == sides["place"][1]), np.where(same["number"], 3.5, -3.0), 0.0)
    on = np.nonzero(most > -3.0)[0]
    p, q, bit = p[on], q[on], x["bit"][p[on]]
    sure = ((bit & (SITE | PHONE | SEVEN)) > 0) | (apart[on] <= both[on] * 0.25 + 1e-9)
    left = np.nonzero(~sure & ((x["r"][p] & x["r"][q]) != 0))[0]
    if len(left):
        u, v = p[left], q[left]
        many = x["words"][u], x["words"][v]
        held = np.zeros(len(left), np.int64)
        for i in range(int(many[0].max())):  # rare words are distinct
            rows = np.nonzero(many[0] > i)[0]
            word = x["w"][x["at"][u[rows]] + i]
            for j in range(int(many[1][rows].max())):
                there = np.nonzero(many[1][rows] > j)[0]
                held[rows[there]] += word[there] == x["w"][x["at"][v[rows[there]]] + j]
        sure[left] = held >= np.maximum(np.minimum(*many) * 0.6, 1.0)
    asked = ~sure & ((bit & NUMBER) > 0)
    kept = sure | asked
    return on[kept], asked[kept]


def cells(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``a`` < ``b``, ``bits``: the pairs of rows (``h``, ``s``, ``bit``, ``rep``) of one cell ``h`` that :func:`fits` (contained) keeps.

    Rows of ``s`` 0 meet those of 1, rows of 2 one another.  ``known``: :func:`light`.  The pairs of many cells are looked at
    at once, on arrays, and what is left out is never written.  A cell is held by one task; callers keep it at a few thousand rows.
    """
    kind = rows.schema["rep"].dataType.simpleString()
    numbers = ("bit", *_MASKS, "n", *_SIGNS, "r")
    facts = rows.join(known.withColumnRenamed("id", "rep"), "rep").select(
        "h", "s", "rep", "bit", *(F.col(f"x.m.{c}").alias(c) for c in _MASKS), *(F.col(f"x.{c}").alias(c) for c in ("n", *_SIGNS, "r", "w")),
        F.when(F.col("bit") == NUMBER, F.col("x.street")).alias("street"),
    )

    def pairs(t: pa.RecordBatch | pa.Table) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(t.to_batches()).combine_chunks() if isinstance(t, pa.Table) else pa.Table.from_batches([t])
        h, s, rep = (t[c].to_numpy() for c in ("h", "s", "rep"))
        x = {c: t[c].to_numpy() for c in numbers}
        listed = t["w"].combine_chunks()
        x["w"], x["words"] = listed.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        x["at"] = np.cumsum(x["words"]) - x["words"]
        place = np.arange(len(h))
        begin = np.concatenate([[True], h[1:] != h[:-1]])
        cell = np.cumsum(begin) - 1
        end = np.append(np.nonzero(begin)[0][1:], len(h))[cell]
        second = end - np.bincount(cell, s == 1).astype(np.int64)[cell]  # rows stand in the order of their side
        first = np.where(s == 0, second, place + 1)
        many = np.where(s == 1, 0, end - first)
        total = np.cumsum(many)
        i = 0
        while i < len(h):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, side="right")))
            c = many[i:j]
            p = np.repeat(place[i:j], c)
            q = np.arange(len(p)) + np.repeat(first[i:j] - np.cumsum(c) + c, c)
            at, asked = _close(x, p, q)
            p, q = p[at], q[at]
            u, v = rep[p], rep[q]
            street = (t["street"].take(pa.array(k, mask=~asked)).combine_chunks() for k in (p, q))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(x["bit"][p]), *street], ["a", "b", "bits", "sa", "sb"])
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last cell so far
        for part in batches:
            if not len(part):
                continue
            rest = pa.Table.from_batches([*(rest.to_batches() if rest else []), part])
            h = rest["h"].to_numpy()
            n = int(np.nonzero(np.append(True, h[1:] != h[:-1]))[0][-1])
            if n:
                yield from pairs(rest.slice(0, n))
                rest = rest.slice(n)
        if rest:
            yield from pairs(rest)

    met = facts.repartition(4 * slots(rows.sparkSession), "h").sortWithinPartitions("h", "s").mapInArrow(run, f"a {kind}, b {kind}, bits int, sa string, sb string")
    near = F.expr("sa is null or levenshtein(sa, sb, greatest(4, cast((length(sa) + length(sb)) * 0.25 as int))) >= 0")
    return met.where(near).where("a < b").select("a", "b", "bits")


def plausible(pairs: DataFrame, reps: DataFrame, common: list[str], contained: bool = False, known: DataFrame | None = None) -> DataFrame:
    """``pairs`` without those whose names cannot be alike enough, whatever the order of their words.

    A name's letters bound its longest common subsequence with another one: pairs that share
    only a place need a ratio of 0.8 (:func:`accepted`), so that at most a fifth of the letters of
    both may be unpaired, those that share pieces of the name 0.86 and no other place; no other site
    or number may stand against either.  A shared number needs a near street.
    ``contained``: the ratio is 0.75, and a name of whose rare words three in five stand in the other
    stays too, since neighbours may still speak for such a pair.
    """
    known = cut(light(reps, common, contained), "light") if known is None else known
    both = pairs.join(known.select(F.col("id").alias("a"), F.col("x").alias("xa")), "a").join(known.select(F.col("id").alias("b"), F.col("x").alias("xb")), "b")
    return both.where(fits(contained)).drop("xa", "xb")


def compare(pairs: DataFrame, reps: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds to each pair ``share`` and ``lcs`` (how well the names agree) and the fields that may speak against it."""
    fields = ("site", "phone", "place", "number", "street")
    side = lambda s: reps.select(F.col("id").alias(s), F.array_join("words", " ").alias(f"name_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in fields))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = lambda w: weights.get(w, 1.0)
        for part in batches:
            share, lcs = name_matches(part["name_a"].to_pylist(), part["name_b"].to_pylist(), weight)
            yield part.drop_columns(["name_a", "name_b"]).append_column("share", pa.array(share)).append_column("lcs", pa.array(lcs))

    kept = [f for f in both.schema if f.name not in ("name_a", "name_b")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return spread(both.select(*[f.name for f in kept], "name_a", "name_b")).mapInArrow(run, f"{schema}, share double, lcs double")


def _differ(field: str) -> Column:
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    return (a != "") & (b != "") & (a != b)


def weak() -> Column:
    """Nothing but the name joins the two, and the place of one is unknown."""
    return (F.col("bits").bitwiseAND(F.lit(SITE | PHONE | SEVEN | NUMBER)) == 0) & ((F.col("place_a") == "") | (F.col("place_b") == ""))


def accepted() -> Column:
    """The rule for a pair: the weaker what the rows share, the more alike the names must be."""
    has = lambda bit: F.col("bits").bitwiseAND(F.lit(bit)) > 0
    name = lambda share, lcs: (F.col("share") >= share) | (F.col("lcs") >= lcs)
    full = lambda share, lcs: (F.col("share") >= share) & (F.col("lcs") >= lcs)
    other_number = _differ("number")
    other_site, other_place, other_phone = _differ("site"), _differ("place"), _differ("phone")
    return (
        (has(SITE | PHONE) & name(0.35, 0.62))
        | (has(SEVEN) & name(0.6, 0.75) & ~other_phone & ~other_site)
        | (has(NUMBER) & name(0.6, 0.75) & ~other_site & (F.levenshtein("street_a", "street_b") <= 4))
        | (has(PLACE) & full(0.85, 0.8) & ~other_site & ~other_number)
        | (has(PLACE | NAME | RARE) & full(0.93, 0.86) & ~other_site & ~other_place & ~other_number & ((F.col("place_a") == F.col("place_b")) | ~other_phone))
    )


def settled(edges: DataFrame) -> DataFrame:
    """``a``, ``b`` of ``edges`` (``a``, ``b``, ``weak``, ``place_a``, ``site_a``, ``place_b``, ``site_b``) without those that would guess.

    A weak edge joins a record of unknown place by its name alone.  Where such a record
    has partners in several places, or with several sites, its name is that of several
    businesses, and none of its weak edges stays.
    """
    weak = edges.where("weak")
    blank = weak.where("place_a = ''").select(F.col("a").alias("n"), F.col("place_b").alias("p"), F.col("site_b").alias("s")).unionAll(
        weak.where("place_b = ''").select(F.col("b").alias("n"), F.col("place_a").alias("p"), F.col("site_a").alias("s"))
    )
    given = lambda c: F.when(F.col(c) != "", F.col(c))
    torn = blank.groupBy("n").agg(F.min(given("p")).alias("p0"), F.max(given("p")).alias("p1"), F.min(given("s")).alias("s0"), F.max(given("s")).alias("s1"))
    torn = torn.where("p0 <> p1 or s0 <> s1").select("n")
    kept = weak.join(torn.withColumnRenamed("n", "a"), "a", "left_anti").join(torn.withColumnRenamed("n", "b"), "b", "left_anti")
    return edges.where("not weak").select("a", "b").unionAll(kept.select("a", "b"))


def link_names(records: DataFrame) -> DataFrame:
    """``id``, ``entity``: class of each record whose name is a spelling of another's.

    Rows with an empty name are in no class.  A row that gives only the name of a
    holding agrees with no trade name; such names say nothing of the business, so
    they are in no class either (one that gives the trade name behind it is read by that).
    Repeated rows are in the class of their first copy.
    """
    named = records.where("core <> '' and not legal")
    reps, member = representatives(named)
    reps = cut(reps.drop("kind"), "reps")
    weights = word_weights(reps)
    common = [w for w, x in weights.items() if x < 0.5]
    known = cut(light(reps, common, contained=False), "light")
    judged = cut(compare(plausible(candidates(reps, weights, known), reps, common, known=known), reps, weights).where(accepted()).withColumn("weak", weak()).select("a", "b", "weak", "place_a", "site_a", "place_b", "site_b"), "judged")
    judged = settled(judged)
    site = lambda s: reps.select(F.col("id").alias(s), F.col("site").alias(f"site_{s}"), F.col("number").alias(f"number_{s}"))
    sure = (F.col("bits").bitwiseAND(F.lit(SITE | PHONE)) > 0) | ~_differ("number")
    exact = heads(reps).join(site("a"), "a").join(site("b"), "b").where(~_differ("site") & sure).select("a", "b")
    classes = connected_components(judged.unionAll(exact))
    return member.join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("entity"))


def spelling_pairs(entities: DataFrame, names: DataFrame) -> DataFrame:
    """``id_a`` < ``id_b``: rows of one class whose names differ as typed.  ``names``: ``id``, ``name``."""
    both = entities.join(names, "id")
    a = both.select("entity", F.col("id").alias("id_a"), F.col("name").alias("na"))
    b = both.select("entity", F.col("id").alias("id_b"), F.col("name").alias("nb"))
    return a.join(b, "entity").where("id_a < id_b and na <> nb").select("id_a", "id_b")
