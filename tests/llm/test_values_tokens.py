import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowsmith.llm import canonical, mixing, tokens


def test_bk_tree_finds_every_entry_in_reach():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(3, 9))) for _ in range(400)})
    tree = canonical.BKTree([(w, 0, i) for i, w in enumerate(words)])
    for q in words[::37] + ["abca", "zz", "dddddd"]:
        for t in (0, 1, 2, 3):
            want = sorted((canonical.levenshtein(q, w), 0, i) for i, w in enumerate(words) if canonical.levenshtein(q, w) <= t)
            assert tree.search(q, t) == want


ENTRIES = [
    (1, "minority_type", "Black-Owned", ""), (5, "minority_type", "LGBTQ+-Owned", ""), (7, "minority_type", "Native American-Owned", ""),
    (10, "minority_type", "Minority-Owned (general)", ""), (107, "industry", "Food and Beverage", "Restaurants, caterers"), (111, "industry", "Information Technology", "Software, networks"),
]
ASKED = [
    ("minority_type", "Black-Owned", 1), ("minority_type", "Bkack-Owned*", 1), ("minority_type", "LGBQT+-Owned", 5), ("minority_type", "American Indian owned", 7),
    ("minority_type", "ask owner", 0), ("minority_type", "Minority-Owned (gene", 10), ("minority_type", "??", 0), ("minority_type", None, 0), ("minority_type", "", 0),
    ("industry", "Beverage & Food", 107), ("industry", "Food and Beve", 107), ("industry", "Medai\xa0and Publishing", 0), ("industry", "I.T. services", 111),
    ("industry", "call for info", 0), ("industry", "x" * 50_000, 0), ("other", "Black-Owned", 0),
]


@pytest.mark.parametrize("shard", [5_000, 2])
def test_match_canonical(spark, shard):
    entries = spark.createDataFrame(ENTRIES, "value_id long, field_name string, label string, about string")
    items = spark.createDataFrame([(i, f, v, w) for i, (f, v, w) in enumerate(ASKED)] * 2, "id long, field_name string, item string, want long")
    got = canonical.match_canonical(items, entries, shard_size=shard)
    assert [r for r in got.collect() if r.want != r.value_id] == []
    assert got.count() == 2 * len(ASKED)
    assert canonical.match_canonical(items.where("false"), entries, shard_size=shard).count() == 0
    assert {r.value_id for r in canonical.match_canonical(items, entries.where("false")).collect()} == {0}
    with pytest.raises(ValueError):
        canonical.match_canonical(items.withColumn("value_id", F.lit(1)), entries)
    assert "Black-Owned" not in {r.item for r in canonical.not_exact(got, entries).where("field_name = 'minority_type'").collect()}


def test_the_cut_of_a_list_changes_nothing(spark):
    """Words shared by entries of different shards point at none; a word near entries of several shards votes for the nearest."""
    rows = [(1, "industry", "Harbor Dredging", "boats, gravel"), (2, "industry", "Harbor Lighting", "lamps, boats"), (3, "industry", "Garden Lightening", "lawns"), (4, "industry", "Gravel Haulage", "trucks")]
    entries = spark.createDataFrame(rows, "value_id long, field_name string, label string, about string")
    asked = ["harbor", "boats for hire", "gravel pit lawns", "lightning rods", "lightening things", "haulages of lamps", "trucks dredgin", "Harbor Lightning", "garden haulage", "none of it"]
    items = spark.createDataFrame([("industry", a) for a in asked], "field_name string, item string")
    want = {(r.item, r.value_id) for r in canonical.match_canonical(items, entries, {}).collect()}
    assert {v for _, v in want} == {0, 2, 3, 4}
    for size in (1, 2, 3):
        assert {(r.item, r.value_id) for r in canonical.match_canonical(items, entries, {}, shard_size=size).collect()} == want


TEXTS = ["Hello, world! It's 2024.", "", None, "   ", "<|endoftext|> is text", "naïve café 日本語 \U0001f600", "a" * 20_000, "x\n\n\n y\t z", "ÿ\x00", "don't DON'T"]


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    if not Path(tokens.default_vocabulary()).exists():
        pytest.skip("no vocabulary")
    return tiktoken.Encoding("own", pat_str=tokens.word_pattern(), mergeable_ranks=tokens.load_ranks(tokens.default_vocabulary()), special_tokens={})


def test_encode_equals_the_public_tokenizer(spark, data, reference):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in tokens.encode(docs).collect()}
    assert got == {i: reference.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    corpus = spark.read.parquet(f"{data}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in corpus.select("doc_id", "text").collect()}
    got = {r.doc_id: list(r.ids) for r in tokens.encode(corpus).collect()}
    assert got == {k: reference.encode_ordinary(t) for k, t in texts.items()}
    assert all(reference.decode(got[k]) == t for k, t in texts.items())
    assert {r.doc_id: r.tokens for r in tokens.count_tokens(corpus, ["doc_id"]).collect()} == {k: len(v) for k, v in got.items()}
    assert tokens.encode(docs.where("false")).count() == 0


def test_transducer_is_exact_and_shares_suffixes(tmp_path, reference):
    ranks = tokens.load_ranks(tokens.default_vocabulary())
    words = [w.encode() for w in ("walking", "talking", "walk", "talk", "stalking", "é", "w")]
    data = tokens.Transducer.compile((w, tokens.merge_word(w, ranks)) for w in words)
    (tmp_path / "t").write_bytes(data)
    t = tokens.Transducer.open(str(tmp_path / "t"))
    assert all(t.ids_of(w) == tokens.merge_word(w, ranks) for w in words)
    assert t.ids_of(b"walki") is None and t.ids_of(b"") is None and t.ids_of(b"xyz") is None
    assert len(t.final) < sum(map(len, words))
    for w in ("supercalifragilistic" * 40, "ΔΩ" * 50, "ababab" * 99):
        assert sum((tokens.merge_word(x.encode(), ranks) for x in __import__("regex").findall(tokens.word_pattern(), w)), []) == reference.encode_ordinary(w)


def test_route_prefers_what_is_unused():
    flow = mixing.route([(("a",), 10), (("a", "b"), 10), (("b",), 2)], {"a": 15, "b": 10, "c": 5}, {"a": 3, "b": 2, "c": 1})
    assert flow.lacking == {"a": 0, "b": 0, "c": 5}
    assert sum(f for (p, s), f in flow.routed.items() if s == "a") == 15
    # 22 tokens exist, 25 are asked for: only 3 are repeated
    first = sum(min(10 if p < 2 else 2, sum(f for (q, s), f in flow.routed.items() if q == p)) for p in range(3))
    assert first == 22


def test_mix(spark):
    docs = [(i, ["a"], 10) for i in range(100)] + [(i, ["b"], 10) for i in range(100, 110)] + [(110, None, 5), (111, ["z"], 5), (112, ["a"], None), (113, [], 0)]
    sized = spark.createDataFrame(docs, "doc_id long, sources array<string>, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3), ("b", 0.4, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    mix, report = mixing.mix_sources(sized, targets)
    got = {r.source: r for r in report.collect()}
    total = 1_110
    assert got["a"].target_tokens == total // 2 and got["a"].lacking_tokens == 0 and total // 2 <= got["a"].mixed_tokens < total // 2 + 10
    assert got["b"].own_tokens == 100 and got["b"].mixed_tokens == 300 and got["b"].lacking_tokens == total // 2 - 300
    assert {r.repeats for r in mix.where("source = 'b'").collect()} == {3}
    assert mix.where("source = 'a' and repeats > 1").count() == 0
    assert sorted(mixing.mix_sources(sized, targets)[0].collect()) == sorted(mix.collect())
    none, empty = mixing.mix_sources(sized.where("false"), targets)
    assert none.count() == 0 and {r.mixed_tokens for r in empty.collect()} == {0}
    assert mixing.mix_sources(sized, targets.where("false"))[1].count() == 0


def test_sources_of_one_pattern_share_its_documents(spark):
    sized = spark.range(1000).selectExpr("id doc_id", "array('a', 'b', 'c') sources", "id % 3 + 1 tokens")
    total = sized.agg({"tokens": "sum"}).first()[0]

    def uses(*shares):
        targets = spark.createDataFrame([(s, x, 3) for s, x in zip("abc", shares)], "source string, target_share double, max_repeats int")
        mix, report = mixing.mix_sources(sized, targets)
        assert all(r.target_tokens <= r.mixed_tokens < r.target_tokens + 4 for r in report.where("target_tokens > 0").collect())
        return [r.n for r in mix.groupBy("doc_id").agg({"repeats": "sum"}).toDF("doc_id", "n").collect()]

    for shares in ((0.5, 0.5, 0.0), (0.3, 0.3, 0.4)):
        got = uses(*shares)
        assert len(got) == 1000 and sum(got) <= 1004
    got = uses(0.7, 0.7, 0.6)  # two uses of every document, a few of three where parts end
    assert len(got) == 1000 and min(got) >= 2 and sum(got) <= 2004
    assert total > 1900
