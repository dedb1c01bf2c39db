"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packed import known_values, split_packed
from ..session import cut
from . import addresses, canonical, collective, mixing, records, segments, subjects, suffixes, survivors, tokens


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_BUSINESS = {"name": "business_name", "phone": "phone", "website": "website", "address": "address", "note": "services_products"}
_CERTIFIED = {"name": "company_name", "phone": "phone", "website": "website", "address": "physical_address", "city": "city", "state": "state"}


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, c = _read(spark, sf_dir, "businesses"), _read(spark, sf_dir, "certifications")
    return records.prepare([(b, "id", _BUSINESS), (c, "cert_row_id", _CERTIFIED)])


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _read(spark, sf_dir, "businesses").select("id", F.col("business_name").alias("name"))
    return b.unionAll(_read(spark, sf_dir, "certifications").select("cert_row_id", "company_name"))


def _canonical(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    b, entries = _read(spark, sf_dir, "businesses"), _read(spark, sf_dir, "canonical_values")
    labels = [r.label for r in entries.where("field_name = 'minority_type'").select("label").collect()]  # a small list by contract
    types = split_packed(b, "id", "minority_type", known_values(b, "minority_type", labels), "minority_type")
    item = F.regexp_replace(F.trim(F.regexp_replace("industry", r"^[\s ]+|[\s ]+$", "")), r'^"(.*)"$', "$1")
    blank = F.lower(F.trim("industry")).isin("", "n/a", "none", "null", "nan", "unknown", "-")
    industry = b.where(F.col("industry").isNotNull() & ~blank).select("id", F.lit("industry").alias("field_name"), F.lit(1).alias("pos"), item.alias("item"))
    return canonical.match_canonical(types.unionByName(industry), entries), entries


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched, entries = _canonical(spark, sf_dir)
    return canonical.not_exact(matched, entries).select("id", "field_name", "pos", "value_id")


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands for no entry, with the number of rows that hold it."""
    matched, _ = _canonical(spark, sf_dir)
    return matched.where("value_id = 0").groupBy("field_name", "item").agg(F.count("*").alias("n_rows"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.spelling_pairs(suffixes.link_names(_both(spark, sf_dir)), _names(spark, sf_dir))


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    b = _read(spark, sf_dir, "businesses").select("id", "address", none.alias("city"), none.alias("state"))
    return b.unionAll(_read(spark, sf_dir, "certifications").select("cert_row_id", "physical_address", "city", "state"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _addresses(spark, sf_dir)
    resolved = addresses.resolve_addresses(rows, ["id"], "address", "city", "state")
    return addresses.same_place_pairs(resolved, rows.select("id", F.col("address").alias("text")))


def p4_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that gives a street, with its street identifier, number and unit."""
    resolved = addresses.resolve_addresses(_addresses(spark, sf_dir), ["id"], "address", "city", "state")
    return resolved.select("id", "place", "street_id", "number", "side", "kind", "unit")


def _survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _both(spark, sf_dir)
    entity, _ = collective.link_records(rec)
    own = rec.where("kind = 0")
    groups = cut(survivors.group_ids(entity.join(own.select("id"), "id").select("id", "entity")), "groups")
    values = survivors.field_values(_read(spark, sf_dir, "businesses"), own, _read(spark, sf_dir, "source_registry"))
    return survivors.survivors(cut(values, "values"), groups)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir).select(F.col("entity").alias("group_id"), "field_name", "id")


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each group."""
    return _survivors(spark, sf_dir).groupBy(F.col("entity").alias("group_id")).pivot("field_name", list(survivors.FIELDS)).agg(F.first("value"))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _both(spark, sf_dir)
    entity, edges = collective.link_records(rec)
    found = collective.cross_matches(entity, edges, rec)
    return found.select(F.col("left").alias("id"), F.col("right").alias("cert_row_id"), "confidence")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir).select("id", "cert_row_id")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matches(spark, sf_dir)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch by batch through the stored index; what words and shared pages are common is counted over the whole table."""
    rec = records.prepare([(_read(spark, sf_dir, "businesses_prepared"), "row_id", _BUSINESS)], {"batch": "batch_no"})
    common = [w for w, x in records.word_weights(rec).items() if x < 0.5]
    return segments.repeats(segments.load_batches(rec, common).firsts())


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_read(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _read(spark, sf_dir, "documents")
    sized = cut(tokens.count_tokens(docs, ["doc_id", "source"]).withColumn("sources", F.array("source")), "sized")
    return mixing.mix_sources(sized, _read(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = _mix(spark, sf_dir)
    return report.where("lacking_tokens > 0").select("source")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0]


def _subjects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parsed, labels = subjects.parse(_read(spark, sf_dir, "documents")), _read(spark, sf_dir, "subject_labels")
    models = subjects.train(parsed, _read(spark, sf_dir, "subjects"), labels)
    return subjects.assign(parsed, models), labels


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, labels = _subjects(spark, sf_dir)
    return found.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")


def p10_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by subject: the composition of the corpus."""
    return _subjects(spark, sf_dir)[0].groupBy("subject").agg(F.count("*").alias("n_docs"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        p2_found, p2_unmatched, p3_found, p4_found, p4_places, p5_found, p5_records, p6_found, p6_matches, p7_found,
        p8_ids, p9_found, p9_shares, p9_mix, p10_found, p10_counts,
    )
}
# none of these can be said in SQL on whole tables; tests/llm holds them against brute force, round trips and labels
ORACLES: dict[str, str] = {}
