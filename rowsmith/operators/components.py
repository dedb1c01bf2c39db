"""Connected components over an edge table, without collecting the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop_cut


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Smallest member id of every node's component.

    ``edges`` has two columns, ``a`` and ``b``, of one orderable type.  Rows with
    a null end and self loops carry no link and are ignored; repeated edges
    count once; an empty table gives an empty result.  Output: ``node``,
    ``component`` (one row per node that occurs in some edge).

    Alternates large-star and small-star contractions.  Each round is two
    shuffles over the edges that are left.  A hub is harmless: a star step keeps one
    edge per neighbour, minima are combined before they move, and the join with
    them can be split by key, so that no task must hold all neighbours of a node.
    """
    e = (
        edges.select("a", "b")
        .where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    e = cut(e, "edges")
    for _ in range(max_rounds):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.where("u <> v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(root, "u").select(F.explode(ends).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        nxt = cut(small, "edges")
        # the contraction has ended when every node hangs on one root and no root hangs on another
        tangled = (
            nxt.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root"))
            .unionAll(nxt.select(F.col("v").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("root")))
            .groupBy("n")
            .agg(F.sum("child").alias("child"), F.max("root").alias("root"))
            .where("child > 1 or (child > 0 and root > 0)")
            .limit(1)
            .count()
        )
        drop_cut(e)
        e = nxt
        if not tangled:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
    raise RuntimeError("components did not settle")
