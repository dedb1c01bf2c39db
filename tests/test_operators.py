import random

from pyspark.sql import functions as F

from rowsmith.operators import curate, merge, publish
from rowsmith.operators.components import connected_components
from rowsmith.operators.packed import CERTIFICATIONS, Segmenter, known_values, several_values, split_packed
from rowsmith.operators.search import Search, search


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1, 1), (None, 3)] + [(500, i) for i in range(501, 700)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


PACKED = [
    ("DBE MBE", ["DBE", "MBE"]), ("1) SBE 2. VOSB 3. wbe", ["SBE", "VOSB", "wbe"]), ("['MBE']", ["MBE"]), ('["MBE", "WBE"]', ["MBE", "WBE"]),
    ('{MBE,"Veteran Owned Small Business"}', ["MBE", "Veteran Owned Small Business"]), ("MWBE;;VOSB", ["MWBE", "VOSB"]),
    ('"Asian-Owned (Korean, first generation)",Black-wOned', ["Asian-Owned (Korean, first generation)", "Black-wOned"]),
    ("halal, Muslim owner, LGBTQ+-Owned", ["halal, Muslim owner", "LGBTQ+-Owned"]), ("Minority-Owned (gener, Women-Owned", ["Minority-Owned (gener", "Women-Owned"]),
    ("Women-Owned!, and LGBTQ+-Owned ;", ["Women-Owned!", "LGBTQ+-Owned"]), ('"He said ""hi"", ok", MBE', ['He said "hi", ok', "MBE"]), (" , ;", []), ("", []), (None, []),
    ("1) Asina-Owned\n2. see notes", ["Asina-Owned", "see notes"]), ("MBE, MBE", ["MBE", "MBE"]), ("n/a", []), ("'SBE'; 'MWBE'", ["SBE", "MWBE"]), ("Est. 1998, X", ["Est. 1998", "X"]),
]


def test_segments():
    seg = Segmenter([*CERTIFICATIONS, "Women-Owned", "LGBTQ+-Owned", "halal, Muslim owner"])
    assert [(t, list(seg.split(t))) for t, _ in PACKED] == PACKED
    long = ", ".join(["MBE"] * 5_000)
    assert len(seg.split(long)) == 5_000


def test_segments_round_trip():
    """Values joined by any delimiter come apart again."""
    rng = random.Random(3)
    values = ["MBE", "Women-Owned", "Small Business Enterprise", "LGBTQ+-Owned", "Locally Owned"]
    seg = Segmenter(values)
    for d in (", ", ",", "; ", ";;", " | ", "/", "\n", "\t", " & ", " and ", " + ", " • "):
        for n in (2, 3, 4):
            picked = [rng.choice(values) for _ in range(n)]
            assert list(seg.split(d.join(picked))) == picked


def test_packed_table(spark):
    rows = [(1, "MBE, WBE", "x"), (2, None, "y"), (3, "MBE", "z"), (1, "MBE, WBE", "x")]
    df = spark.createDataFrame(rows, "id long, certification_type string, pos string")
    out = several_values(split_packed(df.where("id > 0").limit(3), "id", "certification_type", known_values(df, "certification_type", CERTIFICATIONS), "certification_type"), "id")
    assert sorted((r.id, r.pos, r.item) for r in out.collect()) == [(1, 1, "MBE"), (1, 2, "WBE")]
    empty = df.where("false")
    assert split_packed(empty, "id", "certification_type", known_values(empty, "certification_type", []), "f").count() == 0


BIZ = "id long, business_name string, address string, phone string, services_products string, website string, minority_type string, industry string, status string, kentucky_based string, certification_type string, source string"


def biz(spark, *rows):
    names = [c.split()[0] for c in BIZ.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], BIZ)


def test_search_vectors(spark):
    df = biz(spark, {"id": 1, "business_name": "Choi's Market"}, {"id": 2, "business_name": "Vet Co", "certification_type": "SDVOSB"},
             {"id": 3, "business_name": "Vets LLC", "certification_type": "VOSB, MBE"}, {"id": 4, "certification_type": "Unknown"})
    ids = lambda **p: [r.id for r in search(df, Search(**p)).collect()]
    assert ids(certification="VOSB") == [3]
    assert sorted(ids(certification="Any")) == [2, 3]
    assert ids(text="chois") == [1]
    assert sorted(ids(text="!!!")) == [1, 2, 3, 4]
    assert ids(offset=10) == []
    assert ids() == [1, 2, 3, 4]
    assert search(df, Search(limit=2)).first().total_count == 4


def test_search_plan_has_no_python(spark, data):
    plan = search(spark.read.parquet(f"{data}/businesses.parquet"), Search(text="travel"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Window" not in plan


def test_merge_plan_and_apply(spark):
    df = biz(
        spark,
        {"id": 1, "business_name": "A Co", "address": "Louisville, KY", "minority_type": "Black-Owned", "website": "facebook.com/a"},
        {"id": 2, "business_name": "a co ", "address": "5 Oak St, Louisville", "minority_type": "women-owned, Black-Owned"},
        {"id": 3, "business_name": "A CO", "phone": "502-111-2222", "website": "https://a.example"},
        {"id": 4, "business_name": "B", "address": "1 Elm St, Paris, KY"}, {"id": 5, "business_name": "b", "address": "900 Far Rd, Troy, OH"},
    )
    plan = merge.merge_plan(df)
    r = plan.collect()
    assert len(r) == 1 and r[0].survivor_id == 2 and r[0].delete_ids == "1 3"
    assert r[0].set_phone == "502-111-2222" and r[0].set_website == "https://a.example" and r[0].set_minority_type is None
    once = merge.apply_plan(df, plan)
    assert sorted(x.id for x in once.collect()) == [2, 4, 5]
    assert merge.apply_plan(once, plan).exceptAll(once).count() == 0
    assert {x.name_key for x in merge.conflicts(merge.clusters(df)).collect()} == {"b"}
    assert merge.merge_plan(df.where("false")).count() == 0


def test_cluster_rows_ignore_order(spark, data):
    p = spark.read.parquet(f"{data}/businesses_prepared.parquet")
    a = {r.row_id: r.cluster for r in merge.cluster_rows(p).collect()}
    b = {r.row_id: r.cluster for r in merge.cluster_rows(p.orderBy(F.rand(1))).collect()}
    assert a == b and len(a) == p.count()
    assert all(a[c] == c for c in a.values())
    assert merge.merge_rows(p, merge.cluster_rows(p)).count() == len(set(a.values()))


def test_dispositions_partition_the_input(spark, data):
    p = spark.read.parquet(f"{data}/businesses_prepared.parquet")
    out = curate.prepare(p, spark.read.parquet(f"{data}/businesses.parquet"), spark.read.parquet(f"{data}/submissions.parquet"))
    assert out.count() == p.count()
    assert {r.disposition for r in out.select("disposition").distinct().collect()} <= {"Good to go", "Needs review", "Dropped"}


def sequential_slugs(rows):
    import re

    slugify = lambda s: re.sub("^-+|-+$", "", re.sub("[^a-z0-9]+", "-", (s or "").lower()))
    used, out = set(), {}
    for key, name, city in sorted(rows, key=lambda r: (slugify(r[1]), r[0])):
        base = slugify(name)
        if not base:
            out[key] = ""
            continue
        pick = base
        if pick in used:
            pick = f"{base}-{slugify(city)}" if city else f"{base}-{key}"
            if pick in used:
                pick = f"{base}-{key}"
        used.add(pick)
        out[key] = pick
    return out


def test_slugs(spark):
    rows = [(1, "Ann's", ""), (2, "Anns", "Berea"), (3, "anns", "Berea"), (4, "anns", "Berea"), (5, "", ""), (6, "Anns Berea", ""), (7, "anns", "")]
    df = biz(spark, *({"id": i, "business_name": n, "address": f"1 A St, {c}, KY" if c else None} for i, n, c in rows))
    got = {r.id: r.slug for r in publish.assign_slugs(df).collect()}
    assert got == sequential_slugs(rows)
    named = [s for s in got.values() if s]
    assert len(named) == len(set(named))


def test_unchanged_pages_are_not_written(spark, data):
    b = spark.read.parquet(f"{data}/businesses.parquet")
    pages = publish.page_records(b, publish.assign_slugs(b))
    first = publish.changed_pages(pages, None)
    again = publish.changed_pages(pages, first.select("slug", "content_hash"))
    assert {r.state for r in again.select("state").distinct().collect()} == {"unchanged"}


def test_reconcile_covers_every_company(spark, data):
    c, b = spark.read.parquet(f"{data}/certifications.parquet"), spark.read.parquet(f"{data}/businesses.parquet")
    out = merge.reconcile(c, b, ["HRC", "KYTC", "KYFIN"])
    assert out.count() == merge.collapse_certified(c, ["HRC", "KYTC", "KYFIN"]).count()
    assert {r.outcome for r in out.select("outcome").distinct().collect()} <= {"fill", "review", "insert"}
