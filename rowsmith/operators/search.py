"""Faceted, typo-tolerant, ranked and paged search."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import word_similarity
from ..functions.text import search_key

COLUMNS = [
    "id", "business_name", "address", "phone", "services_products", "website", "minority_type", "industry", "status",
    "kentucky_based", "certification_type",
]


@dataclass(frozen=True)
class Search:
    """Parameters; "All" and None leave a facet open, ``certification`` also takes "Any".  ``%`` and ``_`` are wildcards."""

    text: str | None = ""
    area: str | None = ""
    ownership: str | None = "All"
    industry: str | None = "All"
    certification: str | None = "All"
    limit: int = 24
    offset: int = 0
    fuzzy: bool = True
    name_floor: float = 0.45
    services_floor: float = 0.50


def _term(p: Search) -> tuple[str | None, str]:
    term = (p.text or "").strip() or None
    return term, "".join(ch for ch in (p.text or "").lower() if ch in "abcdefghijklmnopqrstuvwxyz0123456789")


def _facets(p: Search) -> Column:
    keep = F.lit(True)
    area = (p.area or "").strip()
    if area:
        keep = keep & F.coalesce(F.col("address").ilike(f"%{area}%"), F.lit(False))
    if p.ownership not in (None, "All"):
        keep = keep & F.coalesce(F.col("minority_type").ilike(f"%{p.ownership}%"), F.lit(False))
    if p.industry not in (None, "All"):
        keep = keep & F.coalesce(F.col("industry") == p.industry, F.lit(False))
    cert = F.coalesce(F.col("certification_type"), F.lit(""))
    if p.certification == "Any":
        keep = keep & ~F.trim(cert).isin("", "Unknown", "Not Certified")
    elif p.certification not in (None, "All"):
        wanted = p.certification.replace(" ", "")
        keep = keep & F.concat(F.lit(","), F.replace(cert, F.lit(" "), F.lit("")), F.lit(",")).ilike(f"%,{wanted},%")
    return keep


def matches(df: DataFrame, p: Search) -> DataFrame:
    """Rows that pass text and facets, with ``_hit`` and ``_score``.

    Cheap predicates decide first; the similarity of the services is only computed for rows
    they left open, that of the name once, for filter and ranking.
    """
    term, key = _term(p)
    rows = df.where(_facets(p))
    if term is None:
        return rows.withColumn("_hit", F.lit(False)).withColumn("_score", F.lit(0.0))
    services = F.coalesce("services_products", F.lit(""))
    hit = F.contains(search_key("business_name"), F.lit(key)) & F.col("business_name").isNotNull()
    cheap = hit | F.contains(search_key(services), F.lit(key)) | F.coalesce("industry", F.lit("")).ilike(f"%{term}%")
    rows = rows.withColumn("_hit", F.when(F.col("business_name").isNotNull(), hit)).withColumn("_cheap", cheap)
    rows = rows.withColumn("_score", word_similarity(term, F.col("business_name")))
    keep = F.col("_cheap")
    if p.fuzzy:
        keep = keep | (F.coalesce("_score", F.lit(0.0)) > p.name_floor) | F.when(F.col("_cheap"), True).otherwise(word_similarity(term, services, p.services_floor) > p.services_floor)
    return rows.where(keep).drop("_cheap")


def search(df: DataFrame, p: Search) -> DataFrame:
    """One page of the ranked matches, each row with the number of all matches.

    Nulls come first in the two descending keys and last in the name, ids break ties.  An
    offset beyond the end gives no rows.  The page is a limit over a sort, so each task keeps
    its best rows only; the total is a second aggregate, not a window over one partition.
    """
    found = matches(df, p)
    total = found.agg(F.count("*").alias("total_count"))
    page = found.orderBy(F.desc_nulls_first("_hit"), F.desc_nulls_first("_score"), F.asc_nulls_last("business_name"), "id").offset(p.offset).limit(p.limit)
    return page.select(*COLUMNS, total.scalar().alias("total_count"))


def suggest(df: DataFrame, term: str, limit: int = 5, floor: float = 0.3) -> DataFrame:
    """The ``limit`` distinct names nearest to a term."""
    names = df.where("business_name is not null").select("business_name").distinct()
    scored = names.withColumn("score", F.round(word_similarity(term, F.col("business_name")), 6)).where(F.col("score") > floor)
    return scored.orderBy(F.desc("score"), "business_name").limit(limit)


def facet_counts(df: DataFrame, certifications: list[str]) -> DataFrame:
    """Number of rows by certification filter, in one pass."""
    marks = [F.count_if(_facets(Search(certification=c))).alias(c) for c in ("All", "Any", *certifications)]
    wide = df.agg(*marks)
    pairs = F.array(*(F.struct(F.lit(c).alias("certification"), F.col(f"`{c}`").alias("n_rows")) for c in ("All", "Any", *certifications)))
    return wide.select(F.explode(pairs).alias("x")).select("x.*")


def numbered(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Keep-first: the first row of each ``key`` in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
