import pytest
from pyspark.sql import functions as F

from rowsmith.functions import geo
from rowsmith.functions import text as T
from rowsmith.functions.html import jsonld_address, links_of, text_of
from rowsmith.functions.similarity import token_sort, word_similarity


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column.alias("r")).first().r


VERDICTS = [
    ("18 Birch Row, Pikeville, KY 41501", "keep_ky"), ("7 Ferry Ct, Paducah, Kentucky 42001", "keep_ky"), ("Berea, Ky", "keep_ky"), ("Somerset, Kentucky", "keep_ky"),
    ("40 Quarry Ln, Evansville, IN 47708", "delete"), ("Evansville, IN 47708.0", "delete"), ("Evansville, IN", "delete"), ("9 Kelp Way, Fresno, CA 93650-1234", "delete"),
    ("60 Kentucky Blvd, Toledo, OH 43604", "delete"), ("", "keep_blank"), (None, "keep_blank"), ("   ", "keep_blank"), ("Georgetown", "review"), ("P.O. Box 77", "review"), ("Memphis, Tennessee", "review"),
    ("31 Fern Rd 41011", "keep_ky"), ("31 Fern Rd 48201", "delete"), ("KY, USA", "keep_ky"), ("KY, United States of America, USA, U.S.A.", "keep_ky"), ("Salem, MA, 1970", "delete"),
    ("Delaware Heights, OH", "delete"), ("Vermont", "review"), ("Taos, New Mexico", "review"), ("5 Pine Rd, Beckley, West Virginia", "review"), ("La Center", "delete"), ("2 B St 42850", "review"), ("8 Calle 00901", "delete"),
]


def test_verdicts(spark):
    df = spark.createDataFrame(VERDICTS, "a string, want string").withColumn("f", geo.detect_state("a"))
    wrong = [r for r in df.select("a", "want", geo.verdict("a", F.col("f")).alias("got")).collect() if r.want != r.got]
    assert not wrong


def test_intake_state_reads_a_last_name_as_a_place(spark):
    rows = [("Dayton, Ohio", "other-state"), ("88 Ohio Ave, Murray", "unclear"), ("Santa Rosa", "unclear"), ("", "blank"), ("Berea, KY", "in-state")]
    df = geo.with_state(spark.createDataFrame(rows, "address string, want string"))
    assert all(r.want == r._place for r in df.collect())


CLEAN = [
    ("Berea, KY, N/A", "Berea, KY"), ("n/a, Corbin, KY 40701", "Corbin, KY 40701"), ("6 Elm St, Corbin, KY 40701 N/A", "6 Elm St, Corbin, KY 40701"), ("N/A", None), ("n / a", None),
    ("N / A, Murray, Kentucky 42071", "Murray, Kentucky 42071"), ("Murray, KY, N/A, N/A", "Murray, KY"), ("", None), (None, None), ("Nina's Attic, Ashland, KY", "Nina's Attic, Ashland, KY"), ("x,y", "x, y"),
]


def test_clean_address(spark):
    df = spark.createDataFrame(CLEAN, "a string, want string").select("want", geo.clean_address("a").alias("got"))
    assert all(r.want == r.got for r in df.collect())


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.dedup_name, "Plo & Quist Design Studio, Ltd.", "plo and quist design studio"), (T.dedup_name, "Half-Moon", "half moon"), (T.dedup_name, "Señal Dos LLC", "señal dos"),
        (T.match_key, "Señal Dos LLC", "seal dos"), (T.match_key, "WELK PLUMBING,INC", "welk plumbing"), (T.match_key, "Co Corner", "corner"), (T.search_key, "Welk's", "welks"),
        (T.site, "HTTP://www.Welk.example/b/", "welk.example/b"), (T.slug, "Nan's Roofing Inc", "nan-s-roofing-inc"), (T.city_of, "14 N Elm St, Winchester, KY 40391", "Winchester"),
        (T.live_phone, "555-0199", "5550199"), (T.intake_phone, "555-0199", ""), (T.live_phone, "(270) 555-0143 Fax: (270) 555-0144", "2705550143"), (T.live_phone, "+1 606-555-0171", "6065550171"),
        (T.address_quality, "P. O. Box 3", 2), (T.address_quality, "8 Fern Ln", 3), (T.address_quality, "Corbin KY 40701", 1), (T.cluster_key, None, "none"), (T.encode_uri, "a b", "a%20b"),
    ],
)
def test_keys(spark, f, value, want):
    assert one(spark, f("x"), x=value) == want


CONFLICTS = [
    ("61 Larch Avenue, Berea, KY, 40403", "N/A, Berea, KY, N/A", False), ("418 Old Mill Road, Vevay, IN, 47043", "418 Old Mill Road, Vevay, IN, 47043.0", False),
    ("15 Heron Road West, Madison, IN, 47250", "15 W Heron Rd, Madison, IN, 47250", False), ("980 Thistle Court, Suite 12, Ashland, KY, 41101", "2077 Cedar Glen Drive, Corbin, KY, 40701", True),
    ("PO Box 411, Joliet, IL, 60431", "1300 S. 9th Street, Peoria, IL, 61602", True), ("Murray, KY", "Murray, Kentucky", False), (None, "2 B St", False),
]


def test_conflicts(spark):
    from rowsmith.functions.similarity import token_sort_ratio

    df = spark.createDataFrame(CONFLICTS, "a string, b string, want boolean").withColumn("r", token_sort_ratio(T.norm_address("a"), T.norm_address("b")))
    assert all(r.want == r.got for r in df.select("want", geo.conflict(F.col("a"), F.col("b"), F.col("r")).alias("got")).collect())


def test_similarities(spark):
    assert round(token_sort("grean pekoe", "green pekoe"), 3) == 90.909
    assert round(one(spark, word_similarity("word", F.col("x")), x="two words"), 3) == 0.8
    assert round(one(spark, word_similarity("chois", F.col("x")), x="Choi's Noodle Bar"), 3) == 0.667
    assert one(spark, word_similarity("zzz", F.col("x")), x="abc") == 0.0
    assert one(spark, word_similarity("zzz", F.col("x")), x=None) is None


def test_pages():
    page = '<html><head><meta name="description" content="D"><script type="application/ld+json">{"@graph":[{"address":{"streetAddress":"1 A St","addressRegion":"KY"}}]}</script></head><body><nav>no</nav><p>Hi <b>you</b></p><a href="/about">About us</a><a href="http://x.y/">x</a></body></html>'
    assert text_of(page) == "D Hi you About us x"
    assert links_of(page, "http://h.t/i", ["about"], 3) == ["http://h.t/about"]
    assert jsonld_address(page) == "1 A St, KY"
    assert text_of(None) == "" and jsonld_address("<p>") is None


def test_chunks(spark):
    got = one(spark, T.chunks("x", 8000, 400, 6), x="a" * 20_000)
    assert [len(c) for c in got] == [8000, 8000, 4800]
    assert one(spark, T.chunks("x", 10, 2, 0), x="") == []
