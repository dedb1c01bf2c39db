import json

from pyspark.sql import functions as F

from rowsmith.operators import discovery


def test_facts_and_resolution(spark):
    raw = [(1, json.dumps({"knowledge_graph": {"address": "1 A St, KY"}, "local_results": [{"address": "no"}]})), (2, json.dumps({"local_results": {"places": [{"address": "2 B St", "phone": "5"}]}})), (3, "not json"), (4, None)]
    got = {r.id: r.address for r in discovery.facts(spark.createDataFrame(raw, "id long, raw string")).collect()}
    assert got == {1: "1 A St, KY", 2: "2 B St", 3: None, 4: None}
    review = spark.createDataFrame([(i,) for i in (1, 2, 3)], "id long")
    a, b = (spark.createDataFrame(x, "id long, address string") for x in ([(1, "x"), (2, "N/A")], [(1, "y"), (2, "z")]))
    assert {r.id: (r.address, r.phase) for r in discovery.resolve(review, a, b).collect()} == {1: ("x", 1), 2: ("z", 2), 3: (None, 0)}


def test_promotion_and_halts(spark):
    q = spark.createDataFrame([(1, "A", "Yes", "t", "Black-Owned"), (2, "a ", "y", "t", "Black-Owned"), (3, "B", "", "t", "x"), (4, "C", "1", "t", ""), (5, "D", "1", "u", "x"), (6, "E", "1", "t", "x")], "row_id long, business_name string, keep string, bucket string, minority_type string")
    go, stay = discovery.promote(q, q.where("row_id = 6"), "t")
    assert [r.row_id for r in go.collect()] == [1] and sorted(r.row_id for r in stay.collect()) == [3, 4]
    m = spark.createDataFrame([("Invalid API key", "fatal"), ("Too many requests", "rate"), ("No results", "benign"), ("odd", "other"), (None, "other")], "m string, want string")
    assert all(r.want == r.got for r in m.select("want", discovery.halt_kind("m").alias("got")).collect())
    one = spark.range(3)
    assert tuple(discovery.budget(one, one, one.limit(2), 2, 10).first()) == (18, 2, 16, 10)


def test_model_answers_every_row(spark):
    df = spark.createDataFrame([(1, "food"), (2, None), (3, "food"), (4, "x")], "id long, t string")
    got = {r.id: r.answer for r in discovery.answer(df, "id", "t", discovery.Rules([("F", ["food"])], "SKIP")).collect()}
    assert got == {1: "F", 2: "SKIP", 3: "F", 4: "SKIP"}
    changed = discovery.enrichment(df, "t", F.lit(True), discovery.Rules([("F", ["food"])], "SKIP"), F.col("t"))
    assert sorted((r.id, r.new) for r in changed.collect()) == [(1, "F"), (3, "F")]
