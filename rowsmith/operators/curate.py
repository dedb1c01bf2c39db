"""Disposition of intake rows, suppression of known and denied ones, review support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import clean_address, detect_state, verdict, with_state
from ..functions.text import contains_any, count_any, dedup_name, first_any, flag_name, host, host_in, norm_name, row_key, site, text, validate_category

# Names of chains, matched as parts of lower-case names.
CHAINS = [
    "walmart", "starbucks", "mcdonald", "qdoba", "buc-ee", "hobby lobby", "lowe's", "lowes", "home depot", "jcpenney", "jc penney",
    "kay jewelers", "belk", "bealls", "t.j. maxx", "tj maxx", "planet fitness", "dollar general", "office depot", "rural king", "kroger",
    "target", "fedex", "u-haul", "uhaul", "enterprise rent", "great american cookies", "cheddar's", "mellow mushroom", "duluth trading",
    "plato's closet", "clothes mentor", "goodwill", "factory connection", "airgas", "ace hardware", "holiday inn", "baymont", "wyndham",
    "by ihg", "neil huffman", "harley-davidson", "mclane", "international paper", "jabil", "metalsa", "kruger packaging", "servpro",
    "fastsigns", "signarama", "golden corral", "bath & body works", "dwain taylor", "david taylor chrysler", "glockner", "identogo",
    "earthwise pet", "agave & rye", "uptown cheapskate", "keller williams", "el toro ip targeting",
]
# National brands, matched as parts of names without marks.
BRANDS = [
    "1st franklin financial", "liberty tax", "jackson hewitt", "beltone", "shred nations", "h&r block", "state farm", "allstate",
    "edward jones", "re/max", "remax", "century 21", "keller williams", "anytime fitness", "snap fitness", "great clips", "supercuts",
    "servpro", "matco tools", "cruise planners", "expedia cruises",
]
# Words that say who owns a business.
SIGNALS = [
    "black-owned", "black owned", "african american owned", "hispanic owned", "latino owned", "latina owned", "latinx", "latine",
    "asian owned", "asian-owned", "lgbtq", "queer owned", "queer-owned", "gay owned", "women-owned", "woman-owned", "women owned",
    "woman owned", "female owned", "veteran-owned", "veteran owned", "sdvosb", "vosb", "native american owned", "indigenous owned",
    "minority-owned", "minority owned", "mbe certified", "bipoc", "disability owned", "muslim owned", "wbenc", "nglcc", "dobe",
]
# Sources whose rows without an address are reviewed.
UNVERIFIED = ["organic", "social", "unknown", "category_maps", "category_web", "category_manual"]


def dispose(df: DataFrame, chains: list[str] = CHAINS) -> DataFrame:
    """Adds ``disposition`` and ``reason``: chain, then other state, then no address from an unverified source."""
    chain = contains_any(F.lower(text("business_name")), chains)
    review = (F.col("_state") == "blank") & F.coalesce("source", F.lit("unknown")).isin(UNVERIFIED)
    out = with_state(df).withColumnRenamed("_place", "_state").withColumn("_chain", chain).withColumn("_review", review)
    label = F.when(F.col("_chain") | (F.col("_state") == "other-state"), "Dropped").when(F.col("_review"), "Needs review").otherwise("Good to go")
    why = F.when(F.col("_chain"), "chain/franchise").when(F.col("_state") == "other-state", "out-of-state address").when(F.col("_review"), "no address, verify Kentucky").otherwise("")
    return out.withColumn("disposition", label).withColumn("reason", why).drop("_chain", "_state", "_review")


def seen_before(df: DataFrame, known: DataFrame, name_key, label: str) -> DataFrame:
    """Adds the flag ``label``: the row shares the name's key or a non-empty site with a row of ``known``.

    An OR of two equi-joins on distinct keys; an OR in one join would compare all pairs.
    """
    names = known.select(name_key("business_name").alias("_nk")).where("_nk <> ''").distinct().withColumn("_by_name", F.lit(True))
    sites = known.select(site("website").alias("_sk")).where("_sk <> ''").distinct().withColumn("_by_site", F.lit(True))
    out = df.withColumn("_nk", name_key("business_name")).withColumn("_sk", site("website"))
    out = out.join(names, "_nk", "left").join(sites, "_sk", "left")
    return out.withColumn(label, F.coalesce("_by_name", F.lit(False)) | F.coalesce("_by_site", F.lit(False))).drop("_nk", "_sk", "_by_name", "_by_site")


def prepare(intake: DataFrame, live: DataFrame, denied: DataFrame) -> DataFrame:
    """Disposition of every intake row; known rows, then denied ones, overwrite an earlier reason."""
    out = seen_before(seen_before(dispose(intake), live, dedup_name, "_known"), denied, norm_name, "_denied")
    out = out.withColumn("reason", F.when(F.col("_denied"), "denied before").when(F.col("_known"), "already live").otherwise(F.col("reason")))
    return out.withColumn("disposition", F.when(F.col("_denied") | F.col("_known"), "Dropped").otherwise(F.col("disposition"))).drop("_known", "_denied")


def grow_denylist(denied: DataFrame, dropped: DataFrame, automatic: list[str]) -> DataFrame:
    """The list with the rows dropped by hand appended; the first row of a key stays."""
    manual = dropped.where(~F.col("reason").isin(automatic)).select("business_name", "website", F.lit(1).alias("_g"), F.col("row_id").alias("_o"))
    old = denied.select("business_name", "website", F.lit(0).alias("_g"), F.col("row_id").alias("_o"))
    key = F.concat_ws("|", norm_name("business_name"), site("website"))
    first = F.min(F.struct("_g", "_o", "business_name", "website")).alias("f")
    return old.unionByName(manual).groupBy(key.alias("_k")).agg(first).select("f.business_name", "f.website")


def intake_gate(rows: DataFrame, known: DataFrame, chains: list[str] = CHAINS) -> DataFrame:
    """Adds ``drop_reason``: no name, seen, chain, other state, known, in this order; null for rows that pass.

    ``rows`` carry a total order in ``row_id``; the first row of a key is the one that isn't "seen".
    """
    out = rows.withColumn("_k", row_key("business_name", "website"))
    first = out.groupBy("_k").agg(F.min("row_id").alias("_first"))
    out = with_state(seen_before(out.join(first, "_k"), known, norm_name, "_known"))
    state = F.col("_place")
    why = (
        F.when(F.trim(text("business_name")) == "", "no name").when(F.col("row_id") > F.col("_first"), "seen").when(contains_any(F.lower(text("business_name")), chains), "chain")
        .when(state == "other-state", "other state").when(F.col("_known"), "known")
    )
    return out.withColumn("drop_reason", why).drop("_k", "_first", "_known", "_place")


def clean_plan(df: DataFrame) -> DataFrame:
    """``id``, ``old_address``, ``new_address``, ``set_null`` of the addresses that change."""
    out = df.select("id", F.col("address").alias("old_address"), clean_address("address").alias("new_address"))
    return out.where(F.col("old_address").isNotNull() & ~F.col("old_address").eqNullSafe(F.col("new_address"))).withColumn("set_null", F.col("new_address").isNull())


def purge_plan(df: DataFrame) -> DataFrame:
    """``id``, ``verdict``, ``state``, ``method``, ``mismatch`` (claims to be in the state but isn't)."""
    out = df.withColumn("_f", detect_state("address")).withColumn("verdict", verdict("address", F.col("_f")))
    claims = F.coalesce(F.col("kentucky_based") == "Yes", F.lit(False)) & (F.col("verdict") == "delete")
    return out.select("id", "verdict", "_f.state", "_f.method", claims.alias("mismatch"))


def flags(df: DataFrame, brands: list[str] = BRANDS) -> DataFrame:
    """``row_id``, ``n_flags``, ``review_flag``: native reasons for a second look, joined by "; "."""
    df = with_state(df.withColumn("_name", flag_name("business_name")))
    # counted with map-side combine and joined, so that a name of very many rows is in no one task
    seen = df.where("disposition = 'Good to go'").groupBy("_name").agg(F.count("*").alias("_n"))
    df = df.join(seen, "_name", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    n, brand, state = F.col("_n"), first_any(F.col("_name"), brands), F.col("_place")
    no_site = F.trim(text("website")) == ""
    each = F.array_compact(F.array(
        F.when(brand.isNotNull(), F.concat(F.lit("national brand? ("), brand, F.lit(")"))),
        F.when(n > 1, F.concat(n.cast("string"), F.lit(" locations - chain or multi-site?"))),
        F.when(F.trim(text("address")) == "", F.lit("no address")),
        F.when(state == "other-state", F.lit("OUT OF STATE")),
        F.when(state == "unclear", F.lit("no Kentucky signal in address")),
        F.when(no_site, F.lit("no website")),
    ))
    return df.withColumn("_e", each).select("row_id", F.size("_e").cast("int").alias("n_flags"), F.array_join("_e", "; ").alias("review_flag"))


def flag_tally(flagged: DataFrame) -> DataFrame:
    """How often each flag is raised, numbers and quoted parts set aside."""
    one = F.explode(F.split("review_flag", "; "))
    return flagged.where("n_flags > 0").select(one.alias("flag")).select(F.regexp_replace(F.regexp_replace("flag", r"\d+", "N"), r"\([^)]*\)", "(...)").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


def triage(df: DataFrame, corroborating: list[str], chains: list[str]) -> DataFrame:
    """``row_id``, ``triage``: Drop?, Strong or Review by name and place."""
    name = F.concat(F.lit(" "), F.lower(text("business_name")), F.lit(" "))
    home = F.lower(text("address")).rlike(r"\bky\b|kentucky")
    label = F.when(contains_any(name, chains), "Drop?").when(contains_any(name, corroborating) & home, "Strong").otherwise("Review")
    return df.select("row_id", label.alias("triage"))


def signal_scan(docs: DataFrame, signals: list[str] = SIGNALS, long: int = 6_000) -> DataFrame:
    """``doc_id``, ``n_signals``, ``is_list``: ownership words of a text; a long text with several is a list of businesses."""
    n = count_any(F.lower(text("text")), signals)
    return docs.select("doc_id", n.cast("int").alias("n_signals"), ((F.length(text("text")) > long) & (n >= 2)).alias("is_list"))


def skip_hosts(df: DataFrame, column: str, hosts: list[str], extensions: list[str]) -> DataFrame:
    """Adds ``host`` and ``skip``: no host, a listed host or one below it, or a file."""
    h = host(column)
    file = F.lit(False)
    for e in extensions:
        file = file | F.endswith(F.lower(text(column)), F.lit(e))
    return df.withColumn("host", h).withColumn("skip", (h == "") | host_in(h, hosts) | file)


def site_matches_name(name: Column | str, website: Column | str) -> Column:
    """Whether a word of four letters or more stands in the host's first label, or the label in a word; true without such words."""
    label = F.split_part(host(website), F.lit("."), F.lit(1))
    words = F.filter(F.split(flag_name(name), " +"), lambda w: F.length(w) >= 4)
    return (F.size(words) == 0) | ((label != "") & F.exists(words, lambda w: F.contains(label, w) | F.contains(w, label)))


def industry_of(df: DataFrame, categories: list[str], default: str) -> DataFrame:
    return df.select("id", validate_category("industry", categories, default).alias("category"))
