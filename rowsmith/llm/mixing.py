"""Mixing of sources to target shares.

Documents are aggregated by membership pattern (the set of sources they belong
to).  A min-cost flow routes the patterns' tokens to the sources' quotas; the
k-th use of a document costs k - 1, so nothing repeats before everything that
can fill the quota has been used once.  The flow fixes, for each pattern and
source, how often every document is used and what part of the pattern is used
once more; that part is taken in the order of a seeded hash, the sources of a
pattern one behind the other, so that none repeats what another leaves unused.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4_096  # of the seeded order; the cut falls inside one of them
PATTERNS = 100_000  # membership patterns at most; more would mean that sources aren't sources


@dataclass
class Flow:
    """Tokens routed from pattern to source, and what each source lacks."""

    routed: dict[tuple[int, str], int]
    lacking: dict[str, int]


def route(patterns: list[tuple[tuple[str, ...], int]], quotas: dict[str, int], repeats: dict[str, int]) -> Flow:
    """Cheapest flow that fills the quotas as far as they can be filled.

    ``patterns``: sources and tokens of each pattern.  Successive shortest paths
    with potentials; a path goes pattern -> source -> sink or shifts load between
    sources that share patterns.
    """
    names = sorted(quotas)
    n = len(patterns) + len(names) + 2
    start, sink = n - 2, n - 1
    node = {s: len(patterns) + i for i, s in enumerate(names)}
    graph: list[list[list]] = [[] for _ in range(n)]  # [to, capacity, cost, back]

    def arc(a: int, b: int, cap: int, cost: int) -> list:
        x, y = [b, cap, cost, None], [a, 0, -cost, None]
        x[3], y[3] = y, x
        graph[a].append(x)
        graph[b].append(y)
        return x

    held: dict[tuple[int, str], list] = {}
    for p, (sources, tokens) in enumerate(patterns):
        mine = [s for s in sources if s in node]
        for k in range(sum(max(0, repeats[s]) for s in mine)):  # the k-th use of a document, for whichever source
            arc(start, p, tokens, k)
        for s in mine:
            held[p, s] = arc(p, node[s], tokens * max(0, repeats[s]), 0)
    ends = {s: arc(node[s], sink, quotas[s], 0) for s in names}
    potential = [0] * n
    while True:
        dist, via = [math.inf] * n, [None] * n
        dist[start] = 0
        heap = [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                if e[1] > 0 and (nd := d + e[2] + potential[u] - potential[e[0]]) < dist[e[0]]:
                    dist[e[0]], via[e[0]] = nd, e
                    heapq.heappush(heap, (nd, e[0]))
        if dist[sink] == math.inf:
            break
        potential = [p + (d if d < math.inf else 0) for p, d in zip(potential, dist)]
        path, u = [], sink
        while u != start:
            path.append(via[u])
            u = via[u][3][0]
        push = min(e[1] for e in path)
        for e in path:
            e[1] -= push
            e[3][1] += push
    return Flow({k: e[3][1] for k, e in held.items()}, {s: e[1] for s, e in ends.items()})


def mix_sources(
    sized: DataFrame, targets: DataFrame, key: str = "doc_id", sources: str = "sources", tokens: str = "tokens", seed: int = 7
) -> tuple[DataFrame, DataFrame]:
    """(mix, report) for documents with the array ``sources`` they belong to and their size in ``tokens``.

    The mix is as large as all documents together.  ``targets``: source, target_share,
    max_repeats; a repeated source keeps its largest share and repeats; null shares
    and repeats count as 0.  A document without a listed source counts in the size
    but is never used; null sizes count as 0.  Empty tables give empty results.

    mix: ``key``, ``source``, ``repeats`` (only used documents).  report, one row per
    source: target_share, target_tokens, own_tokens, mixed_tokens, actual_share,
    lacking_tokens.  The driver sees one row per pattern and per bucket of the order.
    """
    spark = sized.sparkSession
    wanted = {
        r.source: (r.share or 0.0, r.reps or 0)
        for r in targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("reps")).collect()
    }
    docs = sized.select(
        F.col(key).alias("_k"),
        F.coalesce(F.col(tokens), F.lit(0)).cast("long").alias("_n"),
        F.array_sort(F.array_distinct(F.filter(F.coalesce(F.col(sources), F.array().cast("array<string>")), lambda s: s.isin(*wanted) if wanted else F.lit(False)))).alias("_p"),
        F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(BUCKETS)).cast("int").alias("_b"),
        F.xxhash64(F.col(key), F.lit(seed + 1)).alias("_h"),
    )
    # one pass: sizes by pattern and bucket (patterns x BUCKETS rows at most)
    cells = docs.groupBy("_p", "_b").agg(F.sum("_n").alias("n"), F.count("*").alias("rows")).collect()
    size: dict[tuple[str, ...], int] = {}
    cell: dict[tuple[str, ...], dict[int, int]] = {}
    for r in cells:
        p = tuple(r["_p"])
        size[p] = size.get(p, 0) + r.n
        cell.setdefault(p, {})[r["_b"]] = r.n
    if len(size) > PATTERNS:
        raise ValueError(f"{len(size)} membership patterns; at most {PATTERNS} can be routed")
    total = sum(size.values())
    quotas = {s: math.ceil(share * total - 1e-6) for s, (share, _) in wanted.items()}
    patterns = sorted((p, n) for p, n in size.items() if p)
    flow = route(patterns, quotas, {s: r for s, (_, r) in wanted.items()})
    first = Window.partitionBy("_p", "_b").orderBy("_h", "_k")

    def locate(names: tuple[str, ...], at: int) -> tuple[int, int]:
        """Bucket, and tokens inside it, of a place in the pattern's order."""
        for b in range(BUCKETS):
            here = cell[names].get(b, 0)
            if at < here:
                return b, at
            at -= here
        return BUCKETS, 0

    def ended(names: tuple[str, ...], at: int) -> int:
        """The end of the document that holds the token before ``at``."""
        b, left = locate(names, at)
        if left == 0:
            return at
        pattern = F.array(*map(F.lit, names))
        ends = docs.where((F.col("_p") == pattern) & (F.col("_b") == b)).select(F.sum("_n").over(first.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
        return at + ends.where(F.col("end") >= left).agg(F.min("end")).first()[0] - left

    plan = []  # pattern, source, full uses, the places where its part begins and ends, whether it runs over the end
    begin: dict[tuple[str, ...], int] = {}
    for (p, s), f in flow.routed.items():
        names, n = patterns[p]
        if f <= 0 or n == 0:
            continue
        full, rest = divmod(f, n)
        if rest == 0:
            plan.append((list(names), s, int(full), 0, 0, -1, 0, False))
            continue
        start = ended(names, begin[names]) % n if names in begin else 0
        end = start + rest
        begin[names] = end - n if end > n else end
        plan.append((list(names), s, int(full), *locate(names, start), *locate(names, begin[names]), end > n))
    steps = spark.createDataFrame(plan, "_p array<string>, source string, full int, b0 int, t0 long, b1 int, t1 long, over boolean")
    used = docs.join(F.broadcast(steps), "_p")
    # only the buckets of the cuts are put in order: a 4096th of a pattern each
    order = Window.partitionBy("_p", "source", "_b").orderBy("_h", "_k").rowsBetween(Window.unboundedPreceding, -1)
    cuts = F.expr("(_b = b0 and t0 > 0) or (_b = b1 and t1 > 0)")
    inside = used.where(cuts).withColumn("before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    behind = F.expr("_b > b0 or (_b = b0 and before >= t0)")
    ahead = F.expr("_b < b1 or (_b = b1 and before < t1)")
    placed = used.where(~cuts).withColumn("before", F.lit(0).cast("long")).unionByName(inside)
    more = F.when(F.col("over"), behind | ahead).otherwise(behind & ahead).cast("int")
    mix = placed.withColumn("more", more).withColumn("repeats", F.col("full") + F.col("more")).where("repeats > 0")
    sums = mix.groupBy("source").agg(F.sum(F.col("_n") * F.col("repeats")).alias("mixed_tokens"))
    own = {s: sum(n for p, n in patterns if s in p) for s in wanted}
    rows = [(s, float(share), quotas[s], own[s], flow.lacking[s]) for s, (share, _) in sorted(wanted.items())]
    report = spark.createDataFrame(rows, "source string, target_share double, target_tokens long, own_tokens long, lacking_tokens long")
    report = report.join(F.broadcast(sums), "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    everything = F.sum("mixed_tokens").over(Window.partitionBy())
    report = report.withColumn("actual_share", F.when(everything > 0, F.col("mixed_tokens") / everything).otherwise(F.lit(0.0)))
    return mix.select(F.col("_k").alias(key), "source", "repeats"), report
