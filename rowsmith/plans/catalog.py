"""Queries of the core, each over its whole tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import text as T
from ..functions.html import fold_accents, page_text
from ..operators import curate, discovery, merge, publish
from ..operators.packed import CERTIFICATIONS, several_values, split_fields
from ..operators.search import COLUMNS, Search, facet_counts, matches, search, suggest
from ..streaming import incremental
from . import sql as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CATEGORIES_FROM = "industry"
LISTS = ["HRC", "KYTC", "KYFIN"]
# Ownership implied by an ethnicity or a certification.
BY_ETHNICITY = {
    "african american": "Black-Owned", "hispanic american": "Latine-Owned", "asian-pacific american": "Asian-Owned",
    "subcontinent asian american": "Asian-Owned", "asian": "Asian-Owned", "native american": "Native American-Owned",
}
BY_LABEL = {"WBE": "Women-Owned", "MWBE": "Women-Owned", "VOSB": "Veteran-Owned", "SDVOSB": "Veteran-Owned, Disability-Owned", "DIBE": "Disability-Owned", "LGBTBE": "LGBTQ+-Owned"}
HOSTS = ["bluegrass-market.example", "kentuckyana-notes.example", "facebook.com", "instagram.com"]
FILES = [".pdf", ".jpg", ".png", ".zip"]
DAY = "2025-01-01"


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "canonical_values").where("field_name = 'minority_type'").select("label").collect()  # a small list by contract
    fields = {"minority_type": [r.label for r in labels], "certification_type": CERTIFICATIONS}
    return split_fields(read(spark, sf_dir, "businesses"), "id", fields)


@query()
def p1_found(spark, sf_dir):
    return several_values(_packed(spark, sf_dir), "id")


# --- search ------------------------------------------------------------------------------------

_COLS = ", ".join(COLUMNS)


def _search_sql(p: Search) -> str:
    term = (p.text or "").strip()
    key = "".join(ch for ch in (p.text or "").lower() if ch.isalnum() and ch.isascii())
    where = ["true"]
    hit, score = "false", "0.0"
    if term:
        hit = f"contains({D.search_key('business_name')}, '{key}')"
        score = D.word_similarity(f"'{term}'", "business_name")
        cheap = f"(({hit}) and business_name is not null) or contains({D.search_key('services_products')}, '{key}') or coalesce(industry, '') ilike '%{term}%'"
        fuzzy = f" or coalesce({score}, 0) > 0.45 or {D.word_similarity(f"'{term}'", "coalesce(services_products, '')")} > 0.5" if p.fuzzy else ""
        where.append(f"({cheap}{fuzzy})")
        hit = f"case when business_name is not null then {hit} end"
    if p.area:
        where.append(f"coalesce(address ilike '%{p.area}%', false)")
    if p.ownership not in (None, "All"):
        where.append(f"coalesce(minority_type ilike '%{p.ownership}%', false)")
    if p.industry not in (None, "All"):
        where.append(f"coalesce(industry = '{p.industry}', false)")
    if p.certification == "Any":
        where.append("trim(coalesce(certification_type, '')) not in ('', 'Unknown', 'Not Certified')")
    elif p.certification not in (None, "All"):
        where.append(f"',' || replace(coalesce(certification_type, ''), ' ', '') || ',' ilike '%,{p.certification.replace(' ', '')},%'")
    return (
        f"select {_COLS}, count(*) over () as total_count from businesses where {' and '.join(where)} "
        f"order by {f'{hit} desc nulls first, {score} desc nulls first, ' if term else ''}business_name asc nulls last, id limit {p.limit} offset {p.offset}"
    )


def _search(name: str, p: Search) -> None:
    def run(spark, sf_dir):
        return search(read(spark, sf_dir, "businesses"), p)

    run.__name__ = name
    query(_search_sql(p))(run)


_search("search_text", Search(text="travel"))
_search("search_fuzzy", Search(text="Lorimfeld", limit=50))
_search("search_facets", Search(text="marketing", area="Lexington", ownership="Women-Owned", industry="Marketing and Communications"))
_search("search_cert_token", Search(certification="VOSB", limit=100))
_search("search_cert_any", Search(certification="Any", limit=100))
_search("search_paging", Search(text="consulting", limit=10, offset=20))
_search("search_no_letters", Search(text="!!!", limit=30))


@query(f"select * from (select business_name, round({D.word_similarity("'Talbiwood Traavel'", 'business_name')}, 6) as score from (select distinct business_name from businesses where business_name is not null)) where score > 0.3 order by score desc, business_name limit 5")
def suggest_names(spark, sf_dir):
    return suggest(read(spark, sf_dir, "businesses"), "Talbiwood Traavel")


@query(
    "select 'All' as certification, count(*) as n_rows from businesses union all select 'Any', count(*) from businesses where trim(coalesce(certification_type, '')) not in ('', 'Unknown', 'Not Certified')"
    + "".join(f" union all select '{c}', count(*) from businesses where ',' || replace(coalesce(certification_type, ''), ' ', '') || ',' ilike '%,{c},%'" for c in ("MBE", "WBE", "VOSB", "SDVOSB"))
)
def search_facet_counts(spark, sf_dir):
    return facet_counts(read(spark, sf_dir, "businesses"), ["MBE", "WBE", "VOSB", "SDVOSB"])


@query("select id, business_name, website from businesses where coalesce(address ilike '%Paducah%', false) and coalesce(minority_type ilike '%Black%', false)")
def search_export(spark, sf_dir):
    return matches(read(spark, sf_dir, "businesses"), Search(area="Paducah", ownership="Black")).select("id", "business_name", "website")


# --- keys --------------------------------------------------------------------------------------


@query(
    f"select id, {D.norm_name('business_name')} as norm_name, {D.dedup_name('business_name')} as dedup_name, {D.match_key('business_name')} as match_key, {D.flag_name('business_name')} as flag_name, "
    f"{D.search_key('business_name')} as search_key, {D.cluster_key('business_name')} as cluster_key, {D.slug('business_name')} as slug from businesses"
)
def name_keys(spark, sf_dir):
    b = read(spark, sf_dir, "businesses")
    kinds = {"norm_name": T.norm_name, "dedup_name": T.dedup_name, "match_key": T.match_key, "flag_name": T.flag_name, "search_key": T.search_key, "cluster_key": T.cluster_key, "slug": T.slug}
    return b.select("id", *(f("business_name").alias(n) for n, f in kinds.items()))


@query(f"select row_id, {D.site('website')} as site, {D.host('website')} as host, {D.row_key('business_name', 'website')} as row_key, {D.website_quality('website')} as quality from businesses_prepared")
def site_keys(spark, sf_dir):
    p = read(spark, sf_dir, "businesses_prepared")
    return p.select("row_id", T.site("website").alias("site"), T.host("website").alias("host"), T.row_key("business_name", "website").alias("row_key"), T.website_quality("website").alias("quality"))


@query(f"select id, {D.live_phone('phone')} as live_phone, {D.intake_phone('phone')} as intake_phone from businesses")
def phone_keys(spark, sf_dir):
    return read(spark, sf_dir, "businesses").select("id", T.live_phone("phone").alias("live_phone"), T.intake_phone("phone").alias("intake_phone"))


@query(f"select id, {D.norm_address('address')} as norm, {D.street_number(D.norm_address('address'))} as number, {D.address_quality('address')} as quality, {D.city_of('address')} as city from businesses")
def address_keys(spark, sf_dir):
    n = T.norm_address("address")
    return read(spark, sf_dir, "businesses").select("id", n.alias("norm"), T.street_number(n).alias("number"), T.address_quality("address").alias("quality"), T.city_of("address").alias("city"))


@query(f"select cert_row_id, {D.certifier_clean('website')} as website, {D.certifier_clean('phone')} as phone, {D.match_key('company_name')} as k from certifications")
def certifier_clean(spark, sf_dir):
    return read(spark, sf_dir, "certifications").select("cert_row_id", T.certifier_clean("website").alias("website"), T.certifier_clean("phone").alias("phone"), T.match_key("company_name").alias("k"))


# --- states and addresses ----------------------------------------------------------------------


@query(f"with {D.states_cte('businesses', 'id', 'address')} select id, state, method, state is not null and (method <> 'full_name' or state = 'KY') as confident from found")
def state_detect(spark, sf_dir):
    return read(spark, sf_dir, "businesses").select("id", geo.detect_state("address").alias("f")).select("id", "f.state", "f.method", "f.confident")


@query(f"with {D.states_cte('businesses', 'id', 'address')} select {D.verdict('address')} as verdict, count(*) as n, count(*) filter (kentucky_based = 'Yes' and {D.verdict('address')} = 'delete') as n_mismatch from found group by 1")
def state_verdict_counts(spark, sf_dir):
    return curate.purge_plan(read(spark, sf_dir, "businesses")).groupBy("verdict").agg(F.count("*").alias("n"), F.count_if("mismatch").alias("n_mismatch"))


@query(f"with {D.states_cte('businesses_prepared', 'row_id', 'address')} select row_id, {D.address_state('address')} as place from found")
def intake_state(spark, sf_dir):
    return geo.with_state(read(spark, sf_dir, "businesses_prepared")).select("row_id", F.col("_place").alias("place"))


@query(f"with n as (select id, address as old_address, {D.clean_address('address')} as new_address from businesses) select *, new_address is null as set_null from n where old_address is not null and old_address is distinct from new_address")
def address_clean(spark, sf_dir):
    return curate.clean_plan(read(spark, sf_dir, "businesses"))


@query(
    "select id, s.state from (select id, regexp_extract(address, '\\b(\\d{5})\\b', 1) as z from businesses) b join (values "
    + ", ".join(f"({a}, {b}, '{s}')" for a, b, s in geo.ZIP3)
    + ") s(lo, hi, state) on try_cast(left(b.z, 3) as int) between s.lo and s.hi"
)
def zip3_range(spark, sf_dir):
    z = F.regexp_extract("address", r"\b(\d{5})\b", 1)
    return read(spark, sf_dir, "businesses").select("id", geo.zip3_state(z).alias("state")).where("state is not null")


# --- intake ------------------------------------------------------------------------------------


@query(
    f"with {D.states_cte('businesses_prepared', 'row_id', 'address')}, p as (select b.row_id, {D.contains_any('lower(' + D.text('b.business_name') + ')', curate.CHAINS)} as chain, {D.address_state('f.address')} as st, coalesce(b.source, 'unknown') as src from businesses_prepared b join found f using (row_id)) "
    f"select row_id, case when chain or st = 'other-state' then 'Dropped' when st = 'blank' and src in ({D.quoted(curate.UNVERIFIED)}) then 'Needs review' else 'Good to go' end as disposition, "
    f"case when chain then 'chain/franchise' when st = 'other-state' then 'out-of-state address' when st = 'blank' and src in ({D.quoted(curate.UNVERIFIED)}) then 'no address, verify Kentucky' else '' end as reason from p"
)
def disposition(spark, sf_dir):
    return curate.dispose(read(spark, sf_dir, "businesses_prepared")).select("row_id", "disposition", "reason")


@query(
    f"with n as (select distinct {D.dedup_name('business_name')} as k from businesses), s as (select distinct {D.site('website')} as k from businesses), p as (select row_id, {D.dedup_name('business_name')} as nk, {D.site('website')} as sk from businesses_prepared) "
    "select row_id, (nk <> '' and nk in (select k from n)) or (sk <> '' and sk in (select k from s)) as known from p"
)
def skip_known(spark, sf_dir):
    return curate.seen_before(read(spark, sf_dir, "businesses_prepared"), read(spark, sf_dir, "businesses"), T.dedup_name, "known").select("row_id", "known")


@query(
    f"with d as (select {D.norm_name('business_name')} as nk, {D.site('website')} as sk from submissions where status = 'rejected'), p as (select row_id, {D.norm_name('business_name')} as nk, {D.site('website')} as sk from businesses_prepared) "
    "select row_id from p where (nk <> '' and nk in (select nk from d)) or (sk <> '' and sk in (select sk from d))"
)
def denylist(spark, sf_dir):
    denied = read(spark, sf_dir, "submissions").where("status = 'rejected'")
    return curate.seen_before(read(spark, sf_dir, "businesses_prepared"), denied, T.norm_name, "denied").where("denied").select("row_id")


@query(
    f"with a as (select business_name, website, 0 as g, row_id as o from businesses_prepared where batch_no = 1 and disposition = 'Dropped' union all select business_name, website, 1, row_id from businesses_prepared where batch_no > 1 and disposition = 'Dropped' and reason not in ('chain', 'other state')), "
    f"k as (select *, row_number() over (partition by {D.norm_name('business_name')} || '|' || {D.site('website')} order by g, o) as n from a) select business_name, website from k where n = 1"
)
def commit_drops(spark, sf_dir):
    p = read(spark, sf_dir, "businesses_prepared").where("disposition = 'Dropped'")
    return curate.grow_denylist(p.where("batch_no = 1"), p.where("batch_no > 1"), ["chain", "other state"])


@query(
    f"with {D.states_cte('businesses_prepared', 'row_id', 'address')}, p as (select b.*, {D.address_state('f.address')} as st, row_number() over (partition by {D.row_key('b.business_name', 'b.website')} order by row_id) as n, {D.norm_name('b.business_name')} as nk, {D.site('b.website')} as sk from businesses_prepared b join found f using (row_id)), "
    f"l as (select {D.norm_name('business_name')} as nk, {D.site('website')} as sk from businesses), r as (select row_id, case when trim({D.text('business_name')}) = '' then 'no name' when n > 1 then 'seen' when {D.contains_any('lower(' + D.text('business_name') + ')', curate.CHAINS)} then 'chain' when st = 'other-state' then 'other state' "
    "when (nk <> '' and nk in (select nk from l)) or (sk <> '' and sk in (select sk from l)) then 'known' end as drop_reason from p) select drop_reason, count(*) as n from r group by 1"
)
def intake_drop_reasons(spark, sf_dir):
    out = curate.intake_gate(read(spark, sf_dir, "businesses_prepared"), read(spark, sf_dir, "businesses"))
    return out.groupBy("drop_reason").agg(F.count("*").alias("n"))


@query(
    "with a as (select business_name, website, min(source) as via from sources_audit group by all) select p.row_id, coalesce(a.via, 'google_maps') as via from businesses_prepared p left join a on a.business_name = p.business_name and a.website = p.website"
)
def source_join(spark, sf_dir):
    a = read(spark, sf_dir, "sources_audit").groupBy("business_name", "website").agg(F.min("source").alias("via"))
    p = read(spark, sf_dir, "businesses_prepared").select("row_id", "business_name", "website")
    return p.join(a, ["business_name", "website"], "left").select("row_id", F.coalesce("via", F.lit("google_maps")).alias("via"))


@query("select distinct business_name, website, source, found_via from sources_audit")
def audit_dedup(spark, sf_dir):
    return read(spark, sf_dir, "sources_audit").distinct()


@query(f"select {D.host('found_via')} as host, count(*) as n from sources_audit group by 1")
def host_histogram(spark, sf_dir):
    return read(spark, sf_dir, "sources_audit").groupBy(T.host("found_via").alias("host")).agg(F.count("*").alias("n"))


@query(
    f"with h as (select id, website, {D.host('website')} as host from businesses) select id, host, host = '' or len(list_filter({D.listed(HOSTS)}, lambda d: host = d or ends_with(host, '.' || d))) > 0 or len(list_filter({D.listed(FILES)}, lambda e: ends_with(lower({D.text('website')}), e))) > 0 as skip from h"
)
def skip_hosts(spark, sf_dir):
    return curate.skip_hosts(read(spark, sf_dir, "businesses"), "website", HOSTS, FILES).select("id", "host", "skip")


@query(
    f"with w as (select id, string_split({D.host('website')}, '.')[1] as label, list_filter(string_split_regex({D.flag_name('business_name')}, ' +'), lambda w: length(w) >= 4) as words from businesses) "
    "select id, len(words) = 0 or (label <> '' and len(list_filter(words, lambda w: contains(label, w) or contains(w, label))) > 0) as fits from w"
)
def site_matches_name(spark, sf_dir):
    return read(spark, sf_dir, "businesses").select("id", curate.site_matches_name("business_name", "website").alias("fits"))


# --- review ------------------------------------------------------------------------------------

_FLAGS = (
    f"{D.states_cte('businesses_prepared', 'row_id', 'address')}, g as (select b.*, {D.address_state('f.address')} as st, {D.flag_name('b.business_name')} as nm from businesses_prepared b join found f using (row_id)), "
    f"c as (select *, count(*) filter (disposition = 'Good to go') over (partition by nm) as n, list_filter({D.listed(curate.BRANDS)}, lambda w: contains(nm, w))[1] as brand from g), "
    "e as (select row_id, list_filter([case when brand is not null then 'national brand? (' || brand || ')' end, case when n > 1 then n || ' locations - chain or multi-site?' end, "
    f"case when trim({D.text('address')}) = '' then 'no address' end, case when st = 'other-state' then 'OUT OF STATE' end, case when st = 'unclear' then 'no Kentucky signal in address' end, case when trim({D.text('website')}) = '' then 'no website' end], lambda x: x is not null) as l from c)"
)


@query(f"with {_FLAGS} select row_id, len(l)::int as n_flags, coalesce(array_to_string(l, '; '), '') as review_flag from e")
def review_flags(spark, sf_dir):
    return curate.flags(read(spark, sf_dir, "businesses_prepared"))


@query(f"with {_FLAGS} select {D.rep(D.rep('flag', r'\d+', 'N'), r'\([^)]*\)', '(...)')} as flag, count(*) as n from (select unnest(l) as flag from e) group by 1")
def flag_tally(spark, sf_dir):
    return curate.flag_tally(curate.flags(read(spark, sf_dir, "businesses_prepared")))


@query(
    f"select row_id, case when {D.contains_any(f"(' ' || lower({D.text('business_name')}) || ' ')", ['market'])} then 'Drop?' when {D.contains_any(f"(' ' || lower({D.text('business_name')}) || ' ')", ['bakery', 'kitchen', 'coffee'])} and regexp_matches(lower({D.text('address')}), '\\bky\\b|kentucky') then 'Strong' else 'Review' end as triage from businesses_prepared"
)
def triage(spark, sf_dir):
    return curate.triage(read(spark, sf_dir, "businesses_prepared"), ["bakery", "kitchen", "coffee"], ["market"])


@query(f"select doc_id, len(list_filter({D.listed(curate.SIGNALS)}, lambda w: contains(lower({D.text('text')}), w)))::int as n_signals, length({D.text('text')}) > 1000 and len(list_filter({D.listed(curate.SIGNALS)}, lambda w: contains(lower({D.text('text')}), w))) >= 2 as is_list from documents")
def signal_scan(spark, sf_dir):
    return curate.signal_scan(read(spark, sf_dir, "documents"), long=1_000)


@query(
    "with c as (select list(label order by value_id) as l from canonical_values where field_name = 'industry'), r as (select id, trim(regexp_replace(coalesce(industry, ''), '[\\s\\x{A0}]+$|^[\\s\\x{A0}]+', '', 'g')) as r from businesses) "
    "select id, coalesce(case when list_contains(l, r) then r end, list_filter(l, lambda c: lower(c) = lower(r))[1], list_filter(l, lambda c: contains(lower(r), lower(c)) or contains(lower(c), lower(r)))[1], 'Other Professional Services') as category from r, c"
)
def category_validate(spark, sf_dir):
    rows = read(spark, sf_dir, "canonical_values").where("field_name = 'industry'").orderBy("value_id").select("label").collect()  # a small list by contract
    return curate.industry_of(read(spark, sf_dir, "businesses"), [r.label for r in rows], "Other Professional Services")


@query("select doc_id, i::int as n, substr(text, i * 450 + 1, 500) as chunk from (select doc_id, text, unnest(range(0, ceil(length(text) / 450.0)::bigint)) as i from documents where length(text) > 0)")
def chunking(spark, sf_dir):
    d = read(spark, sf_dir, "documents").where("length(text) > 0")
    return d.select("doc_id", F.posexplode(T.chunks("text", 500, 50, 0)).alias("n", "chunk"))


@query()
def document_text(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", page_text("text").alias("plain"))


@query("select id, replace(strip_accents(lower(coalesce(business_name, ''))), chr(160), ' ') as folded from businesses")
def fold_names(spark, sf_dir):
    return read(spark, sf_dir, "businesses").select("id", fold_accents("business_name").alias("folded"))


# --- duplicates --------------------------------------------------------------------------------

_CLUSTERS = (
    f"k as (select *, {D.cluster_key('business_name')} as name_key, {D.address_quality('address')} as aq, {D.website_quality('website')} as wq from businesses), "
    "c as (select *, first_value(id) over (partition by name_key order by aq desc, wq desc, id) as survivor_id from k qualify count(*) over (partition by name_key) > 1)"
)


@query(f"with {_CLUSTERS} select id, name_key, survivor_id from c")
def live_clusters(spark, sf_dir):
    return merge.clusters(read(spark, sf_dir, "businesses")).select("id", "name_key", "survivor_id")


@query()
def live_conflicts(spark, sf_dir):
    return merge.conflicts(merge.clusters(read(spark, sf_dir, "businesses")))


@query()
def live_dedupe_plan(spark, sf_dir):
    return merge.merge_plan(read(spark, sf_dir, "businesses"))


@query()
def live_dedupe_apply(spark, sf_dir):
    b = read(spark, sf_dir, "businesses")
    return merge.apply_plan(b, merge.merge_plan(b)).select(*COLUMNS)


@query(
    f"with {_CLUSTERS}, f as (select name_key, survivor_id, min_by(phone, id) filter (id <> survivor_id and not ({D.is_blank('phone')})) as v, max(phone) filter (id = survivor_id) as own from c group by all) select name_key, v as set_phone from f where {D.is_blank('own')} and v is not null"
)
def live_backfill_phone(spark, sf_dir):
    c = merge.clusters(read(spark, sf_dir, "businesses"))
    loser = F.col("id") != F.col("survivor_id")
    g = c.groupBy("name_key", "survivor_id").agg(F.min(F.when(loser & ~T.is_blank("phone"), F.struct("id", "phone")))["phone"].alias("set_phone"), F.max(F.when(~loser, F.col("phone"))).alias("own"))
    return g.where(T.is_blank("own") & F.col("set_phone").isNotNull()).select("name_key", "set_phone")


@query()
def cluster_rows(spark, sf_dir):
    return merge.cluster_rows(read(spark, sf_dir, "businesses_prepared"))


@query()
def cluster_merge(spark, sf_dir):
    p = read(spark, sf_dir, "businesses_prepared").where("disposition <> 'Dropped'")
    return merge.merge_rows(p, merge.cluster_rows(p))


_CERT = f"cc as (select *, {D.match_key('company_name')} as k, case list_name when 'HRC' then 0 when 'KYTC' then 1 when 'KYFIN' then 2 else 3 end as r from certifications), "
_COLLAPSED = _CERT + (
    "cl as (select k, " + ", ".join(f"coalesce(arg_min({f}, (r, cert_row_id)) filter (not ({D.is_blank(f)})), '') as {f}" for f in ("company_name", "city", "phone", "website"))
    + f", coalesce(array_to_string(list_sort(list_distinct(flatten(list(list_transform({D.items('certification_type')}, lambda x: upper(x)))))), ', '), '') as labels from cc where k <> '' group by k)"
)


@query(f"with {_COLLAPSED} select * from cl")
def certifier_collapse(spark, sf_dir):
    return merge.collapse_certified(read(spark, sf_dir, "certifications"), LISTS)


@query(
    f"with {_COLLAPSED}, l as (select id, {D.match_key('business_name')} as k, {D.site('website')} as w from businesses) select cl.k, coalesce((select min(id) from l where l.k = cl.k and l.k <> ''), (select max(id) from l where l.w = {D.site('cl.website')} and l.w <> '')) as id from cl"
)
def reconcile_exact(spark, sf_dir):
    return merge.match_exact(merge.collapse_certified(read(spark, sf_dir, "certifications"), LISTS), read(spark, sf_dir, "businesses"))


@query()
def reconcile_outcomes(spark, sf_dir):
    return merge.reconcile(read(spark, sf_dir, "certifications"), read(spark, sf_dir, "businesses"), LISTS)


@query(
    "with m as (select map {" + ", ".join(f"'{k}': '{v}'" for k, v in BY_LABEL.items()) + "} as m, map {" + ", ".join(f"'{k}': '{v}'" for k, v in BY_ETHNICITY.items()) + "} as e), "
    f"x as (select cert_row_id, list_filter(list_concat([e[lower({D.certifier_clean('ethnicity')})]], flatten(list_transform({D.items('certification_type')}, lambda c: {D.items('m[c]')}))), lambda v: v is not null) as l from certifications, m), "
    "y as (select cert_row_id, unnest(l) as v, generate_subscripts(l, 1) as i from x), z as (select cert_row_id, v, min(i) as i from y group by all) "
    "select c.cert_row_id, (select string_agg(v, ', ' order by i) from z where z.cert_row_id = c.cert_row_id) as ownership from certifications c"
)
def derived_ownership(spark, sf_dir):
    return read(spark, sf_dir, "certifications").select("cert_row_id", T.ownership_of("ethnicity", T.items("certification_type"), BY_ETHNICITY, BY_LABEL).alias("ownership"))


# --- incremental work --------------------------------------------------------------------------


@query(f"select id, submission_type, status from submissions where submitted_at > timestamp '{DAY}' and status = 'approved'")
def watermark_batch(spark, sf_dir):
    return incremental.past_mark(read(spark, sf_dir, "submissions"), DAY).where("status = 'approved'").select("id", "submission_type", "status")


@query("select max(submitted_at) as mark from submissions")
def watermark_next(spark, sf_dir):
    return incremental.next_mark(read(spark, sf_dir, "submissions"))


@query(
    "with m as (select id, submitted_at, max(submitted_at) over (order by id rows between unbounded preceding and 1 preceding) as seen from submissions) "
    "select id, (epoch_us(seen) - epoch_us(submitted_at)) // 1000000 as late_seconds from m where submitted_at < seen"
)
def late_rows(spark, sf_dir):
    return incremental.late_rows(read(spark, sf_dir, "submissions"), "id", "submitted_at")


@query(f"select id, website from businesses where website is not null and not (updated_at > timestamp '{DAY}' - interval 25 days)")
def ttl_recheck(spark, sf_dir):
    b = read(spark, sf_dir, "businesses")
    state = b.select("id", F.col("updated_at").alias("checked_at"))
    return incremental.due(b.where("website is not null"), state, "id", DAY, 25).select("id", "website")


@query("select r_name, n_name from region, nation where (r_regionkey, n_nationkey) not in (select n_regionkey, n_nationkey from nation)")
def units_pending(spark, sf_dir):
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    units = F.broadcast(r).join(n, F.lit(True))  # the plan of units: two fixed lists
    done = n.select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey")
    return incremental.pending(units, done, ["r_regionkey", "n_nationkey"]).select("r_name", "n_name")


@query()
def submissions_approved(spark, sf_dir):
    return incremental.approve(read(spark, sf_dir, "businesses"), read(spark, sf_dir, "submissions")).select(*COLUMNS)


@query("select id, case when website is null then 'No Website' else status end as status from businesses")
def link_status(spark, sf_dir):
    return read(spark, sf_dir, "businesses").select("id", F.when(F.col("website").isNull(), "No Website").otherwise(F.col("status")).alias("status"))


@query("select id, submission_type, business_name, status, submitted_at from submissions")
def public_submissions(spark, sf_dir):
    return incremental.public_view(read(spark, sf_dir, "submissions")).select("id", "submission_type", "business_name", "status", "submitted_at")


# --- publishing --------------------------------------------------------------------------------


@query()
def slugs(spark, sf_dir):
    return publish.assign_slugs(read(spark, sf_dir, "businesses"))


@query()
def page_records(spark, sf_dir):
    b = read(spark, sf_dir, "businesses")
    return publish.changed_pages(publish.page_records(b, publish.assign_slugs(b)), None)


@query()
def sitemap(spark, sf_dir):
    """Every page is in it; slugs are handed out one after the other, which SQL cannot say (tests replay them)."""
    return publish.sitemap_entries(publish.assign_slugs(read(spark, sf_dir, "businesses")).select("slug"), "https://directory.example", DAY)


@query(
    f"select id, case when length({D.digits('phone')}) = 10 then '(' || left({D.digits('phone')}, 3) || ') ' || substr({D.digits('phone')}, 4, 3) || '-' || substr({D.digits('phone')}, 7, 4) else phone end as phone, "
    f"regexp_replace(regexp_replace(website, '^https?://', ''), '/$', '') as site_shown, case when website like 'http%' then website when website is not null then 'https://' || website end as site_link, "
    f"coalesce(array_to_string(list_filter({D.items('certification_type')}, lambda c: c not in ('Unknown', 'Not Certified')), ', '), '') as certifications from businesses"
)
def display_fields(spark, sf_dir):
    certs = F.filter(T.items("certification_type"), lambda c: ~c.isin("Unknown", "Not Certified"))
    return read(spark, sf_dir, "businesses").select("id", T.show_phone("phone").alias("phone"), T.show_url("website").alias("site_shown"), T.full_url("website").alias("site_link"), F.array_join(certs, ", ").alias("certifications"))


# --- tables ------------------------------------------------------------------------------------


@query("select disposition, reason, count(*) as n from businesses_prepared group by all")
def outcome_counts(spark, sf_dir):
    return read(spark, sf_dir, "businesses_prepared").groupBy("disposition", "reason").agg(F.count("*").alias("n"))


@query("select business_name, website, row_id from businesses_prepared qualify row_number() over (partition by business_name, website order by row_id) = 1")
def keep_first(spark, sf_dir):
    p = read(spark, sf_dir, "businesses_prepared")
    return p.groupBy("business_name", "website").agg(F.min("row_id").alias("row_id"))


@query("select o_orderkey, case when o_orderkey % 7 = 0 then 'PATCHED' else o_orderpriority end as o_orderpriority from orders")
def patch_apply(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    patch = o.where("o_orderkey % 7 = 0").select("o_orderkey", F.lit("PATCHED").alias("o_orderpriority"))
    return merge.patch_rows(o, patch, "o_orderkey", ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)")
def delete_ids(spark, sf_dir):
    gone = read(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return read(spark, sf_dir, "orders").join(gone, "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


@query("select 'businesses' as name, count(*) as n from businesses union all select 'submissions', count(*) from submissions union all select 'certifications', count(*) from certifications")
def backup_manifest(spark, sf_dir):
    parts = [read(spark, sf_dir, t).agg(F.lit(t).alias("name"), F.count("*").alias("n")) for t in ("businesses", "submissions", "certifications")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query("select l_returnflag, l_linestatus, sum(l_quantity) as sum_qty, count(*) as n from lineitem group by all")
def lineitem_summary(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"))


@query("select event_type, date_trunc('hour', ts) as hour, count(*) as n from events group by all")
def event_windows(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"))


# --- evidence ----------------------------------------------------------------------------------

SOCIAL = ["facebook.com", "instagram.com"]


@query(
    f"with p as (select website, max(case when id % 5 = 0 then 404 else 200 end) as c from businesses where website is not null group by website) "
    "select b.id, case when b.website is null then 'No Website' when trim(b.website) = '' then b.status when coalesce(p.c < 400, false) then 'Active' else 'Inactive' end as status from businesses b left join p using (website)"
)
def link_check(spark, sf_dir):
    b = read(spark, sf_dir, "businesses")
    probes = b.where("website is not null").select("website", F.when(F.col("id") % 5 == 0, 404).otherwise(200).alias("http_code"))
    return discovery.link_state(b, probes, SOCIAL)


@query(
    "with w as (select id, services_products as old, case when lower(coalesce(industry, '')) like '%food%' then 'Meals and groceries' when lower(coalesce(industry, '')) like '%legal%' then 'Legal help' else 'SKIP' end as new from businesses where length(trim(coalesce(services_products, ''))) < 25) "
    "select * from w where new <> 'SKIP' and old is distinct from new"
)
def enrich_services(spark, sf_dir):
    rules = discovery.Rules([("Meals and groceries", ["food"]), ("Legal help", ["legal"])], "SKIP")
    return discovery.enrichment(read(spark, sf_dir, "businesses"), "services_products", discovery.services_need_work(), rules, T.text("industry"))


@query(
    f"with l as (select id, website as link, id as position from businesses) select id, arg_min(link, position) as link from l where lower(coalesce(link, '')) like 'http%' and {D.host('link')} <> '' and len(list_filter({D.listed(HOSTS)}, lambda d: {D.host('link')} = d or ends_with({D.host('link')}, '.' || d))) = 0 group by id"
)
def first_links(spark, sf_dir):
    links = read(spark, sf_dir, "businesses").select("id", F.col("website").alias("link"), F.col("id").alias("position"))
    return discovery.first_acceptable(links, HOSTS)


@query(f"select row_id, case when batch_no % 4 = 0 then 'A' when {D.site('website')} <> '' and row_id % 3 > 0 then 'B' else 'C' end as tier from businesses_prepared")
def discovery_tiers(spark, sf_dir):
    labels = F.when(F.col("batch_no") % 4 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    found = read(spark, sf_dir, "businesses_prepared").select("row_id", "website", labels.alias("labels"), (F.col("row_id") % 3).alias("n_signals"))
    return discovery.tiers(found, SOCIAL)
