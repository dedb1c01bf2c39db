"""Incremental work: watermarks, time-to-live state and their streaming twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def past_mark(events: DataFrame, mark: str, at: str = "submitted_at", late_delay: str = "0 seconds") -> DataFrame:
    """Rows strictly behind the high-water mark; ``late_delay`` reads so much before it again (0: what came late is never seen)."""
    return events.where(F.col(at) > F.lit(mark).cast("timestamp_ntz") - F.expr(f"interval {late_delay}"))


def next_mark(events: DataFrame, at: str = "submitted_at") -> DataFrame:
    """The mark after a batch: the greatest time seen, skipped rows included."""
    return events.agg(F.max(at).alias("mark"))


def late_rows(events: DataFrame, order: str, at: str) -> DataFrame:
    """``order`` and how far a row lies behind the greatest time of the rows before it (only late rows).

    The running maximum is taken in two steps: within ranges of ``order``, then over the ranges' maxima.
    """
    size = 1_000
    e = events.select(order, at).withColumn("_g", F.floor(F.col(order) / size))
    tops = e.groupBy("_g").agg(F.max(at).alias("_t"))
    before = tops.withColumn("_b", F.max("_t").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1))).select("_g", "_b")
    own = F.max(at).over(Window.partitionBy("_g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    out = e.withColumn("_o", own).join(before, "_g", "left").withColumn("seen", F.greatest("_o", "_b"))
    lag = F.unix_micros(F.col("seen").cast("timestamp")) - F.unix_micros(F.col(at).cast("timestamp"))
    return out.where(F.col(at) < F.col("seen")).select(order, (lag / 1_000_000).cast("long").alias("late_seconds"))


def due(rows: DataFrame, state: DataFrame, key: str, now: str, days: int) -> DataFrame:
    """Rows not checked within ``days``; a time that can't be read counts as never checked."""
    s = state.groupBy(key).agg(F.max(F.try_to_timestamp(F.col("checked_at").cast("string"))).alias("_c"))
    fresh = s.where(F.col("_c") > F.lit(now).cast("timestamp") - F.expr(f"interval {days} days")).select(key)
    return rows.join(fresh, key, "left_anti")


def pending(units: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return units.join(done.select(*keys).distinct(), keys, "left_anti")


def stream(spark: SparkSession, path: str, schema, handle: Callable[[DataFrame, int], None], checkpoint: str, one_file: bool = True):
    """Runs ``handle`` over the new files below ``path`` once each; the checkpoint is the mark."""
    source = spark.readStream.schema(schema)
    if one_file:
        source = source.option("maxFilesPerTrigger", 1)
    query = source.parquet(path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def approve(live: DataFrame, submissions: DataFrame) -> DataFrame:
    """The live table after approved submissions: updates patch the row of the same name with their non-blank fields, new ones are appended.

    Of several updates of one name the latest non-blank value of a field holds; certifications are never taken.
    """
    fields = [c for c in ("address", "phone", "website", "services_products", "minority_type", "kentucky_based") if c in live.columns]
    ok = submissions.where("lower(status) = 'approved' and trim(business_name) <> ''")
    last = lambda f: F.max(F.when(F.trim(F.coalesce(f, F.lit(""))) != "", F.struct("submitted_at", "id", F.col(f).alias("v"))))["v"]
    updates = ok.where("submission_type = 'update'").groupBy("business_name").agg(*(last(f).alias(f"_p_{f}") for f in fields))
    patched = live.join(updates, "business_name", "left")
    patched = patched.select(*(F.coalesce(f"_p_{c}", c).alias(c) if c in fields else F.col(c) for c in live.columns))
    new = ok.where("submission_type = 'new'")
    extra = new.select(*(
        F.col(c) if c in (*fields, "business_name") else (-F.col("id")).alias("id") if c == "id" else F.lit("Active").alias(c) if c == "status"
        else F.lit("submission").alias(c) if c == "source" else F.lit(None).cast(live.schema[c].dataType).alias(c) for c in live.columns
    ))
    return patched.unionByName(extra)


def public_view(df: DataFrame) -> DataFrame:
    """What anyone may see: never the submitter's name or address."""
    return df.drop("submitter_name", "submitter_email")
