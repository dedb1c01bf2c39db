import random

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import addresses, collective, names, records, segments, suffixes, survivors
from rowsmith.llm.canonical import levenshtein


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(0, 30))) for _ in range(2))
        assert names.lcs(a, b) == brute_lcs(a, b)


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("The Verribury & Egremcutt Ttoring", "Egremcutt and Verribury Tutoring, Ltd", True), ("Tutoring by A. Welk", "Adam Welk Tutoring LLC", True),
        ("Larry Verrimere Technology", "LawrenceVerrimere Tech", True), ("Old Holdings LLC dba: Joldby Market", "JOLDBY MARKET - LOUISVILLE", True),
        ("Frithholt &amp; Corvfield Translations", "Frithholt + Corvfield Translations (Covington)", True),
        ("Penelope Selvoside Tax Services", "Harnfield Juniper Enterprises Inc", False), ("Boskford Hearthside Temp Services", "Gravoford Hearthside Temp Services", False),
    ],
)
def test_names(a, b, same):
    x, y = names.read_name(a), names.read_name(b)
    share, lcs = names.name_match(x.words, y.words, lambda w: 0.3 if w in ("services", "temp", "market", "tutoring") else 1.0)
    assert (share >= 0.75 and lcs >= 0.7) == same


def test_odd_names():
    for raw in (None, "", "   ", "LLC", "&", "\x00", "The", "a" * 100_000):
        names.read_name(raw)
    assert names.name_match((), ("a",), lambda _: 1.0) == (0.0, 0.0)


ADDRESSES = [
    ("KY, 40511-5940 Lexington - 2388 E. Harnwiod Boul", ("2388", "e", "harnwiod", "boulevard", "", "lexington", "40511")),
    ("suite 29b, 7918 n needlepoint parkway, lexington, kentucky 40507-9969, united states", ("7918", "n", "needlepoint", "parkway", "29b", "lexington", "40507")),
    ("947 Copper S, Bardstown", ("947", "s", "copper", "", "", "bardstown", "")), ("14420 NINTH DR E., LOUISVILLE, KY 40211", ("14420", "e", "9th", "drive", "", "louisville", "40211")),
    ("13408 dellphwood #13 louisville ky 40203", ("13408", "", "dellphwood", "", "13", "louisville", "40203")), ("17203 East Amberjack Rd, Unit 203, 40220", ("17203", "e", "amberjack", "road", "203", "", "40220")),
    ("PO Box 2062, Nicholasville, KY 40356", ("", "", "", "", "", "nicholasville", "40356")), ("N/A, Lou, KY", ("", "", "", "", "", "louisville", "")),
]


def test_parse_address():
    for raw, want in ADDRESSES:
        p = addresses.parse_address(raw)[0]
        assert (p.number, p.side, p.street, p.kind, p.unit, p.town, p.zip) == want
    assert addresses.parse_address(None) == () and addresses.parse_address(" n/a ") == ()
    assert addresses.parse_address("5 Elm St", "Cov.", "KY")[0].town == "covington"
    addresses.parse_address("1 " + "x" * 50_000)


def test_parse_routes_ranges_and_unlisted_towns():
    read = lambda raw: (lambda p: (p.number, p.street, p.kind, p.town))(addresses.parse_address(raw)[0])
    assert read("1200 US Highway 60, Versailles, KY") == ("1200", "route60", "us", "versailles")
    assert read("1200 US-31, Versailles, KY") == ("1200", "route31", "us", "versailles") and read("1200 Hwy 60")[:3] == ("1200", "route60", "")
    assert read("12-14 Elm Street, Berea")[:3] == ("12", "elm", "street") and read("Calle 9 #120, Berea")[:2] == ("120", "calle9")
    assert read("Granite Square, 120 Main St, Versailles, KY") == ("120", "main", "street", "versailles") and read("120 Main St")[3] == ""


def test_no_row_is_lost_for_its_town(spark):
    rows = [(1, "120 Main St, Versailles, KY"), (2, "120 Main Street, Versailes KY"), (3, "120 Main St, Versailles"), (4, "77 Gristmill Ln"), (5, "77 Gristmill Lane, Berea, KY"), (6, "120 Main Street, Paris, KY"), (7, "120 Main"),
            (8, "1200 US Highway 60, Berea"), (9, "1200 US Hwy 31, Berea"), (10, "1200 Highway 60, Berea KY")]
    df = spark.createDataFrame(rows, "id long, address string")
    res = addresses.resolve_addresses(df, ["id"], "address")
    assert {r.id for r in res.collect()} == set(range(1, 11)) and {r.id for r in res.where("place = ''").collect()} == {7}
    got = {(r.id_a, r.id_b) for r in addresses.same_place_pairs(res, df.select("id", F.col("address").alias("text"))).collect()}
    assert got == {(1, 3), (4, 5), (8, 10)} | ({(1, 2), (2, 3)} & got)


def test_same_places(spark):
    rows = [
        (1, "100 N Elmwood St, Berea, KY 40403"), (2, "100 north elmwod street, Beria"), (3, "100 Elmwood, 40403"), (4, "100 S Elmwood St, Berea, KY 40403"), (5, "100 N Elmwood Ave, Berea"),
        (6, "100 N Elmwood St Suite 2, Berea"), (7, "Unit 3, 100 N Elmwood St, Berea"), (8, "102 N Elmwood St, Berea"), (9, "PO Box 7, Berea"), (10, "Berea, KY"), (11, None), (12, "100 N Elmwood St, Berea, KY 40403"),
        (13, "100 N Elmwood St, Corbin, KY"),
    ]
    df = spark.createDataFrame(rows, "id long, address string").withColumn("place", F.lit("clash"))
    res = addresses.resolve_addresses(df, ["id"], "address")
    assert {r.id for r in res.collect()} == {1, 2, 3, 4, 5, 6, 7, 8, 12, 13}
    got = {(r.id_a, r.id_b) for r in addresses.same_place_pairs(res, df.select("id", F.col("address").alias("text"))).collect()}
    assert {(1, 2), (1, 3), (2, 3), (1, 6), (1, 7), (2, 12), (3, 12)} <= got
    assert not {(1, 4), (1, 5), (6, 7), (1, 8), (1, 12), (1, 13), (4, 12), (2, 4)} & got
    assert addresses.resolve_addresses(df.where("false"), ["id"], "address").count() == 0


COLS = "id long, name string, phone string, website string, address string, extra string"
SAMPLE = [
    (1, "Joldby & Norbcutt Tutoring LLC", "(270) 111-2222", "https://www.joldbynorbcutt.example/", "12 Elm St, Berea, KY 40403"),
    (2, "The Norbcut & Joldby Tutoring", "270.111.2222 x9", None, "Berea, KY"), (3, "JOLDBY & NORBCUTT TUTORING", None, "joldbynorbcutt.example/contact", None),
    (4, "Joldby & Norbcutt Tutoring", "(606) 333-4444", "joldbynorbcuttcorbin.example", "9 Oak Rd, Corbin, KY 40701"), (5, "Welkwood Holdings Inc", "270-111-2222", None, None),
    (6, "Zantiquist Orchard Bakery", None, "N/A", "77 Pine Ln, Berea"), (7, "Zantiquist Orchrad Bakery, Inc", "none", None, "77 Pine Lane #4, Beria, KY 40403"),
    (8, None, None, None, None), (9, "", "", "", ""), (10, "Joldby & Norbcutt Tutoring LLC", "(270) 111-2222", "https://www.joldbynorbcutt.example/", "12 Elm St, Berea, KY 40403"),
]
WANT = {1: 1, 2: 1, 3: 1, 10: 1, 4: 4, 6: 6, 7: 6, 8: 8}


@pytest.fixture(scope="module")
def sample(spark):
    df = spark.createDataFrame([(*r, "x") for r in SAMPLE], COLS)
    return records.prepare([(df, "id", {c: c for c in ("name", "phone", "website", "address")})])


def test_suffix_links(spark, sample):
    got = {r.id: r.entity for r in suffixes.link_names(sample).collect()}
    assert {k: v for k, v in got.items()} == {k: v for k, v in WANT.items() if k < 8 or k == 10}
    pairs = suffixes.spelling_pairs(suffixes.link_names(sample), spark.createDataFrame([r[:2] for r in SAMPLE], "id long, name string"))
    assert {(r.id_a, r.id_b) for r in pairs.collect()} == {(1, 2), (1, 3), (2, 3), (2, 10), (3, 10), (6, 7)}
    assert suffixes.link_names(sample.where("false")).count() == 0


def test_collective_links(spark, sample):
    entity, edges = collective.link_records(sample)
    got = {r.id: r.entity for r in entity.collect()}
    assert got[5] == 1 and {k: got[k] for k in WANT if k < 8 or k == 10} == {k: v for k, v in WANT.items() if k < 8 or k == 10}
    assert len(got) == len(SAMPLE)
    kinds = sample.select("id", (F.col("id") % 2).cast("int").alias("kind"))
    found = collective.cross_matches(entity, edges, kinds).collect()
    assert {(r.left, r.right) for r in found} == {(2, 1), (2, 3), (2, 5), (10, 1), (10, 3), (10, 5), (6, 7)}
    assert all(0.5 <= r.confidence <= 1 for r in found)
    none, links = collective.link_records(sample.where("false"))
    assert none.count() == 0 and links.count() == 0


def test_copies_of_a_third_of_all_rows_meet(spark):
    """A hot group of copies is one record while it is compared, and whole in the result."""
    rows = [(i, "Hulmford Gingham Electric", "(270) 999-0000", None, "5 Elm St, Berea") for i in range(1, 401)] + [(1_000 + i, f"Name{i:04d} Other{i:04d}", None, None, None) for i in range(800)]
    df = spark.createDataFrame([(*r, "x") for r in rows], COLS)
    rec = records.prepare([(df, "id", {c: c for c in ("name", "phone", "website", "address")})])
    assert suffixes.link_names(rec).where("entity = 1").count() == 400
    assert collective.link_records(rec)[0].where("entity = 1").count() == 400


def test_survivors(spark):
    cols = "id long, address string, website string, phone string, services_products string, source string, updated_at timestamp"
    rows = [
        (1, "1 Elm St, Berea, KY 40403", "a.example", "270-111-2222", "Lawn care, snow removal in Berea.", "lo", "2024-01-01"), (2, "1 Elm St, Berea", "a.example", "111-2222", "lawn care", "hi", "2025-01-01"),
        (3, "Berea", None, "606-111-2222", "Lawn care and more in Berea.", "lo", "2024-06-01"), (4, None, "N/A", "none", "N/A", None, None), (5, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame([(*r[:6], None) for r in rows], cols).drop("updated_at").join(spark.createDataFrame([(r[0], r[6]) for r in rows], "id long, t string").select("id", F.col("t").cast("timestamp").alias("updated_at")), "id")
    rec = records.prepare([(df.withColumn("business_name", F.lit("A B")), "id", {"name": "business_name", "phone": "phone", "website": "website", "address": "address"})])
    values = survivors.field_values(df, rec, spark.createDataFrame([("lo", 1), ("hi", 5)], "source string, trust int"))
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)], "id long, entity long")
    got = {r.field_name: r.id for r in survivors.survivors(values, groups).collect()}
    assert got == {"address": 1, "website": 2, "phone": 3, "services_products": 3}
    assert survivors.survivors(values, groups.where("false")).count() == 0


def test_precedence_orders_undated_values(spark):
    """Where the old area code was always given up for the new one, an undated row with the new one is later."""
    vals, groups = [], []
    for g in range(20):
        vals += [(10 * g, "phone", "219", "219", 2, "2024-01-01", 1), (10 * g + 1, "phone", "270", "270", 2, "2025-01-01", 1)]
        groups += [(10 * g, g), (10 * g + 1, g)]
    vals += [(900, "phone", "old", "219", 2, "2025-06-01", 1), (901, "phone", "new", "270", 2, None, 1), (902, "phone", "x", "219", 2, None, 1), (903, "phone", "y", "270", 2, None, 1)]
    groups += [(900, 90), (901, 90), (902, 91), (903, 91)]
    v = spark.createDataFrame(vals, "id long, field_name string, value string, kind string, full int, t string, trust int").withColumn("at", F.col("t").cast("timestamp")).drop("t")
    got = {r.entity: r.value for r in survivors.survivors(v, spark.createDataFrame(groups, "id long, entity long")).collect()}
    assert got[90] == "new" and got[91] == "y" and got[3] == "270"


def test_topologically_latest(spark):
    """219 gave way to 270, 270 to 859: an undated 859 follows 219 though the two were never seen together; a circle gives in at its weakest link."""
    vals, groups, n = [], [], 0

    def seen(times, *kinds):
        nonlocal n
        for g in range(times):
            for t, k in enumerate(kinds):
                vals.append((n, "phone", f"{k}-{n}", k, 2, f"202{t}-01-01", 1))
                groups.append((n, f"{'-'.join(kinds)}{g}"))
                n += 1

    seen(30, "219", "270")
    seen(20, "270", "859")
    seen(3, "859", "219")  # the circle's weakest link
    seen(5, "606", "502")
    seen(5, "502", "606")  # no telling
    for g, rows in {
        "chain": [("219", None), ("859", None), ("270", None)], "dated": [("219", "2029-01-01"), ("859", None)], "stale": [("859", "2021-01-01"), ("219", None)],
        "open": [("606", None), ("502", None)], "apart": [("606", "2020-01-01"), ("859", None)],
    }.items():
        for k, at in rows:
            vals.append((n, "phone", f"{g}-{k}", k, 2, at, 1))
            groups.append((n, g))
            n += 1
    v = spark.createDataFrame(vals, "id long, field_name string, value string, kind string, full int, t string, trust int").withColumn("at", F.col("t").cast("timestamp")).drop("t")
    got = {r.entity: r.value for r in survivors.survivors(v, spark.createDataFrame(groups, "id long, entity string")).collect()}
    assert {g: got[g] for g in ("chain", "dated", "stale", "open", "apart")} == {"chain": "chain-859", "dated": "dated-859", "stale": "stale-859", "open": "open-606", "apart": "apart-606"}


def test_segments_find_every_key_in_reach(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdef") for _ in range(rng.randrange(8, 20))) for _ in range(60)]
    keys = set(base)
    for k in base:
        for _ in range(3):
            s = list(k)
            for _ in range(rng.randrange(1, 4)):
                i = rng.randrange(len(s))
                s[i : i + 1] = rng.choice([[], [rng.choice("abcdef")], [s[i], rng.choice("abcdef")]])
            keys.add("".join(s))
    keys |= {"aaaaaaaabbbb" + x for x in ("cccc", "cccd", "ccdd")}
    df = spark.createDataFrame([("f", k) for k in keys if len(k) > 5], "form string, key string")
    want = {(a, b) for a in keys for b in keys if len(a) > 5 and len(b) > 5 and levenshtein(a, b) <= (1 if min(len(a), len(b)) < 12 else 2)}
    for block in (60, 2):
        segments.BLOCK = block  # 2: nearly every segment is split by its letters
        assert {(r.new, r.old) for r in segments.near_keys(df, df).collect()} == want
    segments.BLOCK = 60


def test_a_batch_meets_the_stored_keys_and_itself(spark):
    """Every two keys of a batch are compared once and told both ways, those stored too; no key meets itself."""
    rng = random.Random(7)
    keys = {"".join(rng.choice("abc") for _ in range(rng.randrange(6, 15))) for _ in range(60)}
    keys |= {k[:i] + rng.choice("abc") + k[i + rng.randrange(2) :] for k in list(keys) for i in (2, 5)}
    stored, fresh = sorted(keys)[::2], sorted(keys)[::3]  # some are both
    table = lambda ks: segments._ids(spark.createDataFrame([("f", k) for k in ks], "form string, key string"))
    old, new = table(stored), table(fresh)
    index = segments.segments(old).withColumn("stored", F.lit(True)).unionByName(segments.segments(new).withColumn("stored", F.lit(False)))
    name = {r.kid: r.key for r in old.unionAll(new).collect()}
    want = sorted((a, b) for a in fresh for b in {*stored, *fresh} if a != b and levenshtein(a, b) <= (1 if min(len(a), len(b)) < 12 else 2))
    for block in (60, 2):
        segments.BLOCK = block
        assert sorted((name[r.new], name[r.old]) for r in segments.meet(segments.probes(new), index, own=False).collect()) == want
    segments.BLOCK = 60


def test_backlog_is_taken_in_growing_steps(spark, data):
    """Twelve waiting batches are three steps, which give what twelve batches give."""
    rec = _prepared(spark, data).withColumn("batch", F.pmod("id", F.lit(12)).cast("int"))
    index = segments.load_batches(rec, [])
    assert index.batches == [0, 3, 11]
    whole = segments.SegmentIndex(spark, [])
    whole.add(rec, 1)
    assert {(r.id, r["first"]) for r in index.firsts().collect()} == {(r.id, r["first"]) for r in whole.firsts().collect()} != set()


def _prepared(spark, data):
    p = spark.read.parquet(f"{data}/businesses_prepared.parquet")
    return records.prepare([(p, "row_id", {"name": "business_name", "phone": "phone", "website": "website", "address": "address"})], {"batch": "batch_no"})


def test_batch_by_batch_is_all_at_once(spark, data):
    """Three batches give what one batch of all rows gives; a reopened index goes on where it was left; a failed batch is added again."""
    rec = _prepared(spark, data)
    whole = segments.SegmentIndex(spark, [])
    whole.add(rec, 1)
    want = {(r.id, r["first"]) for r in whole.firsts().collect()}
    index = segments.SegmentIndex(spark, [], parts=4)
    parts = [rec.where(f"id > {low} and id <= {high}") for low, high in ((0, 60), (60, 110), (110, 10_000))]
    index.add(parts[0], 1)
    spark.range(1).selectExpr("id as junk").write.parquet(f"{index.path}/links/batch=2")  # what a lost batch leaves
    index = segments.SegmentIndex(spark, [], index.path, parts=4)
    assert index.batches == [1]
    index.add(parts[1], 2)
    told = {r.id: r["first"] for r in index.answers(parts[1]).collect()}
    index.add(parts[2], 3)
    assert {(r.id, r["first"]) for r in index.firsts().collect()} == want
    assert all(v <= k for k, v in told.items()) and len(told) == parts[1].count()
    with pytest.raises(ValueError):
        index.add(parts[2], 3)
    assert segments.repeats(segments.load_batches(rec.withColumn("batch", F.lit(None).cast("int")), []).firsts()).count() == sum(f < i for i, f in want)
    empty = segments.SegmentIndex(spark, [])
    empty.add(rec.where("false"), 1)
    assert empty.firsts().count() == 0


def test_small_batch_reads_and_writes_little(spark):
    """With many folders a batch of two rows opens a small part of the history, and stores only its own keys."""
    cols = "id long, name string, phone string, website string, address string"
    rows = [(i, f"{a}{b} Hollow{c} {d}works", None, f"{a}{b}{c}{d}.example", "Berea, KY") for i, (a, b, c, d) in enumerate((a, b, c, d) for a in ("Quar", "Welk", "Zan", "Plo") for b in ("ford", "mere", "tiq") for c in ("by", "dale", "ton", "ick") for d in ("Iron", "Wood", "Glass"))]
    rec = records.prepare([(spark.createDataFrame(rows, cols), "id", {c: c for c in ("name", "phone", "website", "address")})])
    index = segments.SegmentIndex(spark, [], parts=512)
    index.add(rec, 1)
    before, size = index.stored("segments").count(), index.stored("signs").count()
    late = records.prepare([(spark.createDataFrame([(900, "Quarford Hollowby Ironworks", None, None, "Berea"), (901, "Welkmere Hollowdal Woodworks", None, None, None)], cols), "id", {c: c for c in ("name", "phone", "website", "address")})])
    opened = index.stored("segments", index._folders(segments.probes(segments._ids(segments.keys(late, []).where("form in ('whole', 'rare')"))), "h", 2)).count()
    assert opened < before / 2
    index.add(late, 2)
    assert {r.id: r["first"] for r in index.answers(late).collect()} == {900: 0, 901: [r[0] for r in rows if r[1] == "Welkmere Hollowdale Woodworks"][0]}
    # two rows with three fuzzy keys that were not there, of three segments each, at most
    assert index.stored("segments").where("batch = 2").count() <= 12 and index.stored("signs").where("batch = 2").count() <= 12 < size


def test_each_attribute_of_a_record_counts_once(spark):
    """Words with one ending make the same keys again; nothing has to be moved to leave those out."""
    rows = [(1, "Quarford Ironyworks Cherryworks Berryworks", "Berea, KY"), (2, "Quarford", "Berea, KY")]
    rec = records.prepare([(spark.createDataFrame(rows, "id long, name string, address string"), "id", {"name": "name", "address": "address"})])
    made = [tuple(r) for r in collective.attributes(rec, []).collect()]
    assert {r for _, _, r in made} == {1, 2} and len(made) == len(set(made))


def test_large_blocks_lose_no_spelling(spark):
    """A phone under many spellings of one name, in rows that differ in their facts, is one class; others of that phone stay apart."""
    rng = random.Random(9)
    rows = []
    for i in range(150):
        name = list("Zelda Kelmbridge Photography")
        for _ in range(rng.randrange(0, 3)):
            name[rng.randrange(6, 28)] = rng.choice("aeiklmnr")
        rows.append((i, "".join(name), "(270) 111-2222", None, f"{i % 60 + 1} Elm St, Berea"))
    rows += [(200 + i, f"{a}{b} Roofing", "(270) 111-2222", None, None) for i, (a, b) in enumerate((a, b) for a in ("Quor", "Vand", "Hylt") for b in ("imsby", "etholt"))]
    df = spark.createDataFrame([(*r, "x") for r in rows], COLS)
    rec = records.prepare([(df, "id", {c: c for c in ("name", "phone", "website", "address")})])
    got = {r.id: r.entity for r in suffixes.link_names(rec).collect()}
    assert {got[i] for i in range(150)} == {0} and all(v >= 200 for k, v in got.items() if k >= 200)


def test_the_filter_spares_what_the_rules_accept(spark):
    """An abbreviated common word and an extra word don't hide a pair that the rules would accept."""
    rows = [(1, "Zelda Kelmbridge Photography", None, None, "Berea"), (2, "Zelda Kelmbridge Photo", None, None, "Berea")]
    rows += [(10 + i, f"Name{chr(97 + i % 26)}{chr(97 + i // 26)}xx Photography", None, None, "Corbin") for i in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], COLS)
    rec = records.prepare([(df, "id", {c: c for c in ("name", "phone", "website", "address")})])
    got = {r.id: r.entity for r in suffixes.link_names(rec).collect()}
    assert got[1] == got[2] == 1 and len({got[10 + i] for i in range(60)}) > 30


def test_large_blocks_are_searched_whatever_the_order_of_words(spark):
    """A typo in a first letter moves the word; where all the two share is common, they still meet."""
    rows = [(1, "Zeldamont Kelmbridge Photography", None, None, "Berea"), (2, "Aeldamont Kelmbridge Photography", None, None, "Berea")]
    rows += [(10 + i, f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 4} Kelmbridge Photography", None, None, "Berea") for i in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], COLS)
    rec = records.prepare([(df, "id", {c: c for c in ("name", "phone", "website", "address")})])
    for found in (suffixes.link_names(rec), collective.link_records(rec)[0]):
        got = {r.id: r.entity for r in found.collect()}
        assert got[1] == got[2] == 1 and 1 not in {got[10 + i] for i in range(60)}


def test_common_suffixes_are_searched(spark):
    """Two names that share only suffixes which many names share, of one place or none."""
    rows = [(1, "Zantiquistolkelmbridge", None, None, None), (2, "Zantiquistolkelnbridge", None, None, "Berea")]
    rows += [(10 + i, f"{chr(97 + i % 26) * 5}{chr(97 + i // 26) * 5}bridge", None, None, "Berea" if i % 2 else "Corbin") for i in range(60)]
    df = spark.createDataFrame([(*r, "x") for r in rows], COLS)
    rec = records.prepare([(df, "id", {c: c for c in ("name", "phone", "website", "address")})])
    got = {r.id: r.entity for r in suffixes.link_names(rec).collect()}
    assert got[1] == got[2] == 1


def test_tiles_and_cells_lose_no_pair(spark, monkeypatch):
    """Blocks dealt to many tiles and cells give the pairs of one."""
    from rowsmith.operators import alike as near

    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abcdefg") for _ in range(rng.randint(4, 9))), rng.choice((2, 3))) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, t string, role int").select(F.lit(1).alias("g"), "id", near.letter_masks(F.col("t")).alias("m"), F.length("t").alias("n"), "role", F.array((F.col("id") % 3).cast("long"), F.lit(0).cast("long")).alias("f"))
    apart = lambda x, y: sum(abs(min(x.count(c), 3) - min(y.count(c), 3)) for c in "abcdefg")
    want = {(i, j) for i, x, r in rows for j, y, q in rows if i < j and 3 in (r, q) and (i % 3 * (j % 3) == 0 or i % 3 == j % 3) and apart(x, y) <= 0.2 * (len(x) + len(y)) + 1e-4}
    for cell in (4_000, 17):
        monkeypatch.setattr(near, "CELL", cell)
        got = [(r.a, r.b) for r in near.near_letters(df, 0.2).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    rows = [(i, f"Zelda Kelmbridge {chr(97 + i % 26)}{chr(97 + i // 26)}", "(270) 111-2222", None, f"{i} Elm St, Berea") for i in range(70)]
    rec = records.prepare([(spark.createDataFrame([(*r, "x") for r in rows], COLS), "id", {c: c for c in ("name", "phone", "website", "address")})])
    blocks = rec.select(F.lit(1).cast("long").alias("k"), F.lit(suffixes.SEVEN).alias("bit"), F.col("id").alias("rep"))
    for tile in (2_000, 9):
        monkeypatch.setattr(suffixes, "TILE", tile)
        got = [(r.a, r.b) for r in suffixes.crowded(blocks, rec, []).collect()]
        assert len(got) == len(set(got)) == 70 * 69 // 2


def test_the_size_of_a_block_changes_no_edge(spark, monkeypatch):
    """The candidate graph is that of all pairs which share an attribute and fit, however many records share it."""
    rows = [(i, f"Zelda Kelmbridge {chr(97 + i % 26)}{chr(97 + i // 26) * 5}", f"(270) 111-22{i % 9:02d}", None, f"{i % 4 + 1} Elm St, Berea") for i in range(60)]
    rows += [(100 + i, f"{chr(97 + i) * 6} Photography Kelmbridge", None, None, f"7 {s}, Berea") for i, s in enumerate(("Martin Luther King Junior Boulevard", "Martin Luther King Boulevard", "Elm St", "Elm St") * 3)]
    rec = records.prepare([(spark.createDataFrame([(*r, "x") for r in rows], COLS), "id", {c: c for c in ("name", "phone", "website", "address")})])
    reps = rec.where("core <> ''")
    got = []
    for block in (2, 1_000_000):
        monkeypatch.setattr(collective, "BLOCK", block)
        got.append({(r.a, r.b, r.bits) for r in collective.candidate_graph(reps, {}).select("a", "b", "bits").collect()})
    assert got[0] == got[1]
    share = collective.attributes(reps, []).distinct()
    pairs = share.join(share.select("k", F.col("rep").alias("other")), "k").where("rep < other").select(F.col("rep").alias("a"), F.col("other").alias("b"), F.col("bit").alias("bits"))
    want = {(r.a, r.b) for r in suffixes.plausible(pairs, reps, [], contained=True).union(suffixes.heads(reps)).collect()}
    # no pair that is a match by itself is lost
    every = pairs.groupBy("a", "b").agg(F.bit_or("bits").alias("bits"))
    assert want >= {(r.a, r.b) for r in collective.score(every, reps, {}).where("o >= 0").collect()}
    assert {(a, b) for a, b, _ in got[0]} == want and (100, 101) in want and len(want) < pairs.select("a", "b").distinct().count()


def test_names_compared_at_once_as_one_by_one():
    """Shares and ratios of whole batches are those of single pairs to the last bit, for odd names too."""
    from rowsmith.llm import matching

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 7)))
    a = ["", "a", "x" * 70, "é ü", "mc donald", "a b c d e f g h i j", "x" * 40 + " " + "y" * 24, "ab"] + [" ".join(word() for _ in range(rng.randint(0, 5))) for _ in range(4_000)]
    b = ["", "ab", "x" * 69 + "y", "e ü", "mcdonald", "a c b d e f g i", "y" * 24 + " " + "x" * 39, "ab"] + [" ".join(word() for _ in range(rng.randint(0, 5))) for _ in range(4_000)]
    weight = lambda w: {0: 0.3, 1: 0.6}.get(len(w) % 4, 1.0)
    share, lcs = matching.name_matches(a, b, weight)
    assert list(zip(share, lcs)) == [names.name_match(tuple(x.split()), tuple(y.split()), weight) for x, y in zip(a, b)]
    assert list(matching.ratios(a, b)) == [names.ratio(x, y) for x, y in zip(a, b)]
    assert [len(x) for x in matching.name_matches([], [], weight)] == [0, 0] and len(matching.ratios([], [])) == 0


def test_cells_are_the_filter(spark, monkeypatch):
    """Cells that run over many batches, dealt to tiles or not, give the pairs that the filter keeps one by one."""
    rng = random.Random(5)
    pick = lambda *x: rng.choice(x)
    rows = [
        (i, f"{pick('Zelda', 'Zelma', 'Quorimsby')} {pick('Kelmbridge', 'Kelnbridge', 'Vandholt', 'Hyltmere Brook')} {pick('Photography', 'Photos', 'Roofing', '')}",
         pick("(270) 111-2222", "(270) 111-2223", "111-2222", None), pick("kelm.com", "vand.org", None, None), f"{pick(1, 2)} {pick('Elm St', 'Elms St', 'Martin Luther King Boulevard', 'Oak Ridge Rd')}, {pick('Berea', 'Corbin')}")
        for i in range(150)
    ]
    rec = records.prepare([(spark.createDataFrame([(*r, "x") for r in rows], COLS), "id", {c: c for c in ("name", "phone", "website", "address")})])
    index = collective.attributes(rec, []).distinct().localCheckpoint()
    pairs = index.join(index.select("k", F.col("rep").alias("other")), "k").where("rep < other").select(F.col("rep").alias("a"), F.col("other").alias("b"), F.col("bit").alias("bits"))
    want = sorted((r.a, r.b, r.bits) for r in suffixes.plausible(pairs, rec, [], contained=True).collect())
    monkeypatch.setattr(suffixes, "PAIRS", 50)
    for tile, batch in ((2_000, 10_000), (2_000, 7), (9, 7)):
        monkeypatch.setattr(suffixes, "TILE", tile)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        try:
            got = sorted((r.a, r.b, r.bits) for r in suffixes.crowded(index, rec, [], contained=True).collect())
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == want and 100 < len(want) < pairs.count()
