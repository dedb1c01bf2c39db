"""Evidence from searches and pages, models behind a protocol, and change sets."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_any, host, host_in, is_blank, site, text

# Words by which an outside service says that it will not go on, by kind.
HALTS = {"fatal": ["invalid api key", "unauthorized", "account", "forbidden"], "rate": ["rate limit", "too many requests", "429", "throttl"], "benign": ["no results", "hasn't returned any results"]}


class Model(Protocol):
    """Answers texts; results are recorded, so that reruns are stable.  No network is part of this package."""

    def __call__(self, texts: list[str]) -> list[str]: ...


class Rules:
    """The deterministic stand-in: the first rule with a word of the text answers."""

    def __init__(self, rules: list[tuple[str, list[str]]], default: str):
        self.rules, self.default = rules, default

    def __call__(self, texts: list[str]) -> list[str]:
        return [next((a for a, words in self.rules if any(w in (t or "").lower() for w in words)), self.default) for t in texts]


def answer(df: DataFrame, key: str, column: str | Column, model: Model, name: str = "answer") -> DataFrame:
    """``key`` and the model's answer, each distinct text asked once per batch."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            asked = list(dict.fromkeys(pdf["t"].fillna("")))
            known = dict(zip(asked, model(asked)))
            yield pd.DataFrame({"k": pdf["k"], "a": pdf["t"].fillna("").map(known)})

    src = df.select(F.col(key).alias("k"), (F.col(column) if isinstance(column, str) else column).alias("t"))
    return src.mapInPandas(run, f"k {kind}, a string").select(F.col("k").alias(key), F.col("a").alias(name))


def enrichment(df: DataFrame, field: str, needs_work: Column, model: Model, about: Column) -> DataFrame:
    """The change set of a field: ``id``, ``old``, ``new`` of the rows that need work and whose answer differs; "SKIP" changes nothing."""
    todo = df.where(needs_work).select("id", F.col(field).alias("old"), about.alias("about"))
    out = todo.select("id", "old").join(answer(todo, "id", "about", model, "new"), "id")
    return out.where((F.col("new") != "SKIP") & ~F.col("old").eqNullSafe(F.col("new")))


def services_need_work(column: str = "services_products", least: int = 25) -> Column:
    return F.length(F.trim(text(column))) < least


def first_acceptable(links: DataFrame, skip: list[str], keep: tuple[str, ...] = ("http",)) -> DataFrame:
    """``id``, ``link``: the first link of each row by position that leads to no listed host."""
    ok = F.lit(False)
    for k in keep:
        ok = ok | F.lower(text("link")).startswith(k)
    fit = links.where(ok & (host("link") != "") & ~host_in(host("link"), skip))
    return fit.groupBy("id").agg(F.min(F.struct("position", "link"))["link"].alias("link"))


def facts(results: DataFrame) -> DataFrame:
    """``id``, ``address``, ``phone``, ``website``: the knowledge panel of a raw search answer, else its first place."""
    get = lambda f: F.coalesce(F.get_json_object("raw", f"$.knowledge_graph.{f}"), F.get_json_object("raw", f"$.local_results[0].{f}"), F.get_json_object("raw", f"$.local_results.places[0].{f}"))
    return results.select("id", get("address").alias("address"), get("phone").alias("phone"), get("website").alias("website"))


def resolve(review: DataFrame, *evidence: DataFrame) -> DataFrame:
    """``id``, ``address``, ``phase``: the first evidence (in order) that gives an address; phase 0 where none does."""
    out = review.select("id")
    for i, e in enumerate(evidence, 1):
        out = out.join(e.where(~is_blank("address")).groupBy("id").agg(F.min("address").alias(f"_a{i}")), "id", "left")
    cols = [F.col(f"_a{i}") for i in range(1, len(evidence) + 1)]
    phase = F.coalesce(*(F.when(c.isNotNull(), i) for i, c in enumerate(cols, 1)), F.lit(0))
    return out.select("id", F.coalesce(*cols).alias("address"), phase.alias("phase"))


def tiers(found: DataFrame, social: list[str]) -> DataFrame:
    """``row_id``, ``tier``: A confirmed ownership, B own site and words of evidence, C the rest."""
    own = (site("website") != "") & ~host_in(host("website"), social)
    return found.select("row_id", F.when(F.size("labels") > 0, "A").when(own & (F.col("n_signals") > 0), "B").otherwise("C").alias("tier"))


def promote(queue: DataFrame, passes: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows promoted, rows that stay): kept rows of the target with a type and not promoted before; untyped ones stay."""
    kept = F.lower(F.trim(text("keep"))).isin("y", "yes", "true", "1", "keep")
    first = F.row_number().over(Window.partitionBy(F.lower(F.trim(text("business_name")))).orderBy("row_id"))
    known = passes.select(F.lower(F.trim(text("business_name"))).alias("_n")).distinct().withColumn("_old", F.lit(True))
    x = queue.withColumn("_k", kept).withColumn("_r", first).withColumn("_n", F.lower(F.trim(text("business_name")))).join(known, "_n", "left")
    go = F.col("_k") & (F.col("bucket") == target) & ~is_blank("minority_type") & (F.col("_r") == 1) & F.col("_old").isNull()
    stay = ~F.col("_k") | is_blank("minority_type")
    return x.where(go).select(*queue.columns), x.where(stay).select(*queue.columns)


def link_state(df: DataFrame, probes: DataFrame, social: list[str]) -> DataFrame:
    """``id``, ``status``: No Website for null, Active for social pages and answers below 400, else Inactive; blanks keep theirs."""
    p = probes.groupBy("website").agg(F.max("http_code").alias("_c"))
    x = df.select("id", "website", "status").join(p, "website", "left")
    live = host_in(host("website"), social) | (F.col("_c") < 400)
    state = F.when(F.col("website").isNull(), "No Website").when(F.trim(text("website")) == "", F.col("status")).when(F.coalesce(live, F.lit(False)), "Active").otherwise("Inactive")
    return x.select("id", state.alias("status"))


def halt_kind(message: Column | str) -> Column:
    """fatal, rate, benign or other."""
    low = F.lower(text(message))
    kind = F.lit("other")
    for name in reversed(HALTS):
        kind = F.when(contains_any(low, HALTS[name]), F.lit(name)).otherwise(kind)
    return kind


def budget(queries: DataFrame, cities: DataFrame, done: DataFrame, pages: int, cap: int) -> DataFrame:
    """``n_units``, ``n_done``, ``n_left``, ``n_allowed``: searches planned from two small lists, under a hard cap (a parameter of the service)."""
    n, c, d = (x.count() for x in (queries, cities, done.distinct()))
    left = max(n * c * pages - d, 0)
    return queries.sparkSession.createDataFrame([(n * c * pages, d, left, min(left, cap))], "n_units long, n_done long, n_left long, n_allowed long")
