"""Slugs, page records, sitemap and write-if-changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import city_of, full_url, items, show_phone, show_url, slug


def assign_slugs(df: DataFrame, rounds: int = 20) -> DataFrame:
    """``id``, ``slug``, as if rows were taken in order of (slug, id).

    The first row of a base slug keeps it; later ones take the city or the id.  A suffixed slug
    may be another row's base: it was taken first if its own base sorts earlier.  Candidates
    that two rows want, or that a base holds, go to the earlier row, the others to their id.
    """
    base = df.select("id", slug("business_name").alias("base"), slug(city_of("address")).alias("city"))
    named = base.where("base <> ''")
    w = Window.partitionBy("base").orderBy("id")
    ranked = named.withColumn("n", F.row_number().over(w))
    by_id = F.concat_ws("-", "base", F.col("id").cast("string"))
    want = F.when(F.col("n") == 1, F.col("base")).otherwise(F.when(F.col("city") != "", F.concat_ws("-", "base", "city")).otherwise(by_id))
    ranked = ranked.withColumn("want", want)
    # every wish in order of arrival; the first arrival of a slug wins it
    first = Window.partitionBy("want").orderBy("base", "id")
    won = ranked.withColumn("turn", F.row_number().over(first))
    got = won.select("id", F.when(F.col("turn") == 1, F.col("want")).when(F.col("n") == 1, F.when(F.col("city") != "", F.concat_ws("-", "base", "city")).otherwise(by_id)).otherwise(by_id).alias("slug"))
    # a base row pushed off its slug may meet a taken one once more: then its id
    again = Window.partitionBy("slug").orderBy("id")
    fixed = got.withColumn("k", F.row_number().over(again)).join(ranked.select("id", "base"), "id")
    final = fixed.select("id", F.when(F.col("k") == 1, F.col("slug")).otherwise(F.concat_ws("-", "base", F.col("id").cast("string"))).alias("slug"))
    return final.unionByName(base.where("base = ''").select("id", F.lit("").alias("slug")))


def page_records(df: DataFrame, slugs: DataFrame) -> DataFrame:
    """What a page shows of a row: display forms of phone and site, city, certifications without placeholders."""
    certs = F.filter(items("certification_type"), lambda c: ~c.isin("Unknown", "Not Certified"))
    return df.join(slugs, "id").where("slug <> ''").select(
        "id", "slug", F.trim("business_name").alias("title"), city_of("address").alias("city"), show_phone("phone").alias("phone"),
        show_url("website").alias("site_shown"), full_url("website").alias("site_link"), F.array_join(certs, ", ").alias("certifications"),
    )


def changed_pages(pages: DataFrame, before: DataFrame | None) -> DataFrame:
    """Adds ``content_hash`` and ``state``: written or unchanged against the last manifest (``slug``, ``content_hash``)."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(pages.columns)]
    hashed = pages.withColumn("content_hash", F.sha2(F.concat_ws("\x1f", *cols), 256))
    if before is None:
        return hashed.withColumn("state", F.lit("written"))
    old = before.select("slug", F.col("content_hash").alias("_old"))
    return hashed.join(old, "slug", "left").withColumn("state", F.when(F.col("content_hash") == F.col("_old"), "unchanged").otherwise("written")).drop("_old")


def sitemap_entries(slugs: DataFrame, root: str, day: str) -> DataFrame:
    """One entry per page, as a row: a sitemap of any size is written by many tasks."""
    loc = F.concat(F.lit(f"{root}/businesses/"), F.col("slug"), F.lit(".html"))
    return slugs.where("slug <> ''").select("slug", F.concat(F.lit("<url><loc>"), loc, F.lit(f"</loc><lastmod>{day}</lastmod><changefreq>monthly</changefreq><priority>0.7</priority></url>")).alias("entry"))
