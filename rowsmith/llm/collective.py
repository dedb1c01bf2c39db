"""Matching of entities across sources without keys.

Collective graph linkage.  Records that share a rare attribute (site, phone,
number and street, words of the name) are joined in a candidate graph.
Meta-blocking prunes the edges that no score could accept, by a bound that
costs little.  Each remaining edge gets a score from all attributes; then the
similarity of the neighbours is propagated along the graph until the scores are
stable, and the groups of linked records are read off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import clear, cut, spread
from .matching import name_matches, ratios
from .records import word_weights
from .suffixes import BLOCK, MIN_SUFFIX, NAME, NUMBER, PHONE, PLACE, SEVEN, SITE, cells, crowded, heads, light, representatives, settled, telling, with_suffix

ACCEPT = 0.5
ROUNDS = 100  # of propagation; scores only rise and are bounded, so that it ends long before
SHIFT = 0.01  # a score that moves less than this is stable


def attributes(reps: DataFrame, common: list[str]) -> DataFrame:
    """``k``, ``bit``, ``rep``: what a record can share with others, each once."""
    rare = F.array_sort(F.filter(F.array_distinct("words"), lambda w: (F.length(w) > 1) & ~w.isin(common)))
    base = reps.withColumn("r", rare).withColumn("t", telling(F.filter(F.array_distinct("words"), lambda w: F.length(w) >= MIN_SUFFIX), common))
    words, local = with_suffix("t", MIN_SUFFIX + 2), F.concat(F.col("r"), with_suffix("t", MIN_SUFFIX))
    spots = F.when((F.col("number") != "") & (F.col("place") != ""), F.array(F.concat_ws("@", "number", "place"))).otherwise(F.array().cast("array<string>"))
    one = lambda c: F.when(F.col(c) != "", F.array(F.col(c))).otherwise(F.array().cast("array<string>"))
    near = F.when(F.col("place") != "", F.transform(local, lambda w: F.concat_ws("@", w, "place"))).otherwise(F.array().cast("array<string>"))

    def keys(bit: int, values: Column) -> Column:
        return F.transform(F.array_distinct(values), lambda v: F.struct(F.xxhash64(F.lit(bit), v).alias("k"), F.lit(bit).alias("bit")))

    made = F.concat(
        keys(SITE, one("site")), keys(PHONE, one("phone")), keys(SEVEN, one("phone7")), keys(NUMBER, spots), keys(PLACE, near),
        keys(NAME, F.concat(words, one("core"))),
    )
    return base.select(F.explode(made).alias("x"), F.col("id").alias("rep")).select("x.k", "x.bit", "rep")


def candidate_graph(reps: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``a`` < ``b``, ``bits``: edges between records that share an attribute, but for those that can't be matches.

    Every pair of an attribute's records is looked at, whatever their number, and by the same rule: an attribute counts
    for a pair if :func:`.suffixes.fits` keeps the pair for it.  ``BLOCK`` only tells how the pairs are met: above it by
    tiles (:func:`.suffixes.crowded`), else at once; what the rule leaves out is never written.
    """
    common = [w for w, x in weights.items() if x < 0.5]
    index = cut(attributes(reps, common), "attributes")
    # sizes are counted with map-side combine; what no other record shares goes no further
    sized = cut(index.join(index.groupBy("k").agg(F.count("*").alias("df")).where("df > 1"), "k"), "sizes")
    known = cut(light(reps, common, contained=True), "light")
    small = sized.where(F.col("df") <= BLOCK).select(F.col("k").alias("h"), F.lit(2).alias("s"), "bit", "rep")
    edges = cells(small, known)
    large = crowded(sized.where(F.col("df") > BLOCK).drop("df"), reps, common, contained=True, known=known)
    exact = heads(reps.where("not legal"))
    graph = cut(edges.unionByName(large).unionByName(exact).groupBy("a", "b").agg(F.bit_or("bits").alias("bits")), "graph")
    clear(index, sized, known)
    return graph


def odds() -> tuple[Column, Column, Column]:
    """Log odds that two records (``ra``, ``rb``) are one entity, without what their names and streets say; what a near street adds, null where
    none can; whether one name is that of a holding."""
    has = lambda bit: F.col("bits").bitwiseAND(F.lit(bit)) > 0
    given = lambda c: (F.col(f"ra.{c}") != "") & (F.col(f"rb.{c}") != "")
    equal = lambda c: F.col(f"ra.{c}") == F.col(f"rb.{c}")
    o = F.when(has(SITE), 1.0).when(given("site") & ~equal("site"), -10.0).otherwise(-4.0)
    o += F.when(has(PHONE), 5.0).when(has(SEVEN) & ~given("phone"), 3.0).when(given("phone"), -1.0).otherwise(0.0)
    o += F.when(given("place"), F.when(equal("place"), 1.0).otherwise(-3.0)).otherwise(0.0)
    here = given("number") & equal("place")
    o += F.when(here & ~equal("number"), -3.0).otherwise(0.0)
    near = F.when(here & equal("number"), F.when(given("unit"), F.when(equal("unit"), 3.5).otherwise(0.5)).otherwise(2.5))
    return o, near, ~equal("legal")


def score(edges: DataFrame, reps: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds ``o``, the log odds of each edge."""
    fields = ("site", "phone", "place", "number", "street", "unit", "legal")
    side = lambda s: reps.select(F.col("id").alias(s), F.struct(F.array_join("words", " ").alias("name"), *fields).alias(f"r{s}"))
    both = spread(edges.join(side("a"), "a"), "b").join(side("b"), "b")
    kind = reps.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = lambda w: weights.get(w, 1.0)
        for part in batches:
            o, near, legal = (part[c].to_numpy(zero_copy_only=False) for c in ("o", "near", "legal"))
            met = np.nonzero(~np.isnan(near))[0]
            x, y = (part[c].take(pa.array(met)).to_pylist() for c in ("sa", "sb"))
            met = met[[i for i, r in enumerate(ratios(x, y)) if r >= 0.75 or x[i] == y[i]]]
            o = o.copy()
            o[met] += near[met]
            share, lcs = name_matches(part["na"].to_pylist(), part["nb"].to_pylist(), weight)
            rest = np.where((share >= 0.35) | (lcs >= 0.7), 0.0, np.where(legal, -0.5, -3.0))
            o += np.where((share >= 0.85) & (lcs >= 0.8), 4.5, np.where((share >= 0.6) | (lcs >= 0.75), 2.5, rest))
            yield pa.RecordBatch.from_arrays([part["a"], part["b"], pa.array(o)], ["a", "b", "o"])

    o, near, legal = odds()
    street = lambda s: F.when(near.isNotNull(), F.col(f"r{s}.street")).alias(f"s{s}")
    asked = both.select("a", "b", F.col("ra.name").alias("na"), F.col("rb.name").alias("nb"), street("a"), street("b"), o.alias("o"), near.alias("near"), legal.alias("legal"))
    return asked.mapInArrow(run, f"a {kind}, b {kind}, o double")


def propagate(scored: DataFrame) -> DataFrame:
    """``a``, ``b``, ``s``: scores after the similarity of neighbours has settled.

    An edge whose ends both match a third record gains; the gain is bounded, so that
    neighbours settle doubts but don't overrule what speaks against a match.
    Only matches of the last round support, and every record has few of those.
    """
    prob = 1 / (1 + F.exp(-F.col("o")))
    # what speaks clearly against a match stays out: no gain could lift it over the threshold
    base = cut(scored.where("o > -3"), "scored")
    current = cut(base.withColumn("s", prob), "round")
    for _ in range(ROUNDS):
        sure = current.where(F.col("s") >= ACCEPT)
        half = sure.select("a", "b", "s").unionAll(sure.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
        doubt = base.where("o < 4")
        one = half.select("a", F.col("b").alias("c"), F.col("s").alias("s1"))
        two = half.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("s").alias("s2"))
        support = doubt.join(one, "a").join(two, ["b", "c"]).groupBy("a", "b").agg(F.sum(F.least("s1", "s2")).alias("support"))
        gain = F.least(F.coalesce("support", F.lit(0.0)) * 1.5, F.lit(3.0))
        nxt = base.join(support, ["a", "b"], "left").select("a", "b", "o", (1 / (1 + F.exp(-(F.col("o") + gain)))).alias("s"))
        nxt = cut(nxt, "round")
        moved = nxt.join(current.select("a", "b", F.col("s").alias("was")), ["a", "b"]).where(F.abs(F.col("s") - F.col("was")) > SHIFT).limit(1).count()
        current = nxt
        if not moved:
            return current.select("a", "b", "s")
    raise RuntimeError("scores did not settle")


def link_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``id`` -> ``entity``, edges ``a``, ``b``, ``s``) of all records.

    Every record is in exactly one entity.  Copies are compared once; records that share
    nothing rare with any other stand alone.  Empty tables give empty results.
    """
    reps, member = representatives(records)
    reps = cut(reps, "reps")
    weights = word_weights(reps)
    graph = candidate_graph(reps, weights)
    edges = cut(propagate(score(graph, reps, weights)).where(F.col("s") >= ACCEPT), "links")
    side = lambda s: reps.select(F.col("id").alias(s), F.col("place").alias(f"place_{s}"), F.col("site").alias(f"site_{s}"))
    strong = F.col("bits").bitwiseAND(F.lit(SITE | PHONE | SEVEN | NUMBER)) > 0
    known = edges.join(graph.select("a", "b", "bits"), ["a", "b"]).join(side("a"), "a").join(side("b"), "b")
    known = cut(known.withColumn("weak", ~strong & ((F.col("place_a") == "") | (F.col("place_b") == ""))), "links")
    edges = cut(edges.join(settled(known), ["a", "b"], "left_semi"), "links")
    groups = connected_components(edges).withColumnRenamed("node", "rep")
    entity = member.join(groups, "rep", "left").select("id", "rep", F.coalesce("component", "rep").alias("entity"))
    return cut(entity, "entities"), edges


def cross_matches(entity: DataFrame, edges: DataFrame, kinds: DataFrame) -> DataFrame:
    """``left``, ``right``, ``confidence``: records of kind 0 beside those of kind 1 of the same entity.

    The confidence is the score of the link between the two (1 for copies of one text); where
    they are linked through others only, it is the smaller of their best scores.
    """
    both = entity.join(kinds.select("id", "kind"), "id")
    best = edges.select(F.col("a").alias("rep"), "s").unionAll(edges.select(F.col("b").alias("rep"), "s")).groupBy("rep").agg(F.max("s").alias("best"))
    both = both.join(best, "rep", "left")
    left = both.where("kind = 0").select("entity", F.col("id").alias("left"), F.col("rep").alias("ra"), F.col("best").alias("ba"))
    right = both.where("kind = 1").select("entity", F.col("id").alias("right"), F.col("rep").alias("rb"), F.col("best").alias("bb"))
    pairs = left.join(right, "entity").withColumn("a", F.least("ra", "rb")).withColumn("b", F.greatest("ra", "rb"))
    scored = pairs.join(edges, ["a", "b"], "left")
    sure = F.when(F.col("ra") == F.col("rb"), F.lit(1.0)).otherwise(F.coalesce("s", F.least("ba", "bb")))
    return scored.select("left", "right", F.round(sure, 6).alias("confidence"))
