import random

from rowsmith.llm import subjects

PHRASES = {
    "food": "smoked brisket,pastry counter,lunch menu,sourdough starter,spice rub,dessert tray".split(","), "law": "custody hearing,appeal brief,eviction notice,lien release,jury instructions,probate filing".split(","),
    "health": "blood pressure reading,sleep study,flu vaccination,patient chart,wound dressing,glucose check".split(","),
    "arts": "mural sketch,jazz quartet,violin recital,short film,costume rack,stage lighting".split(","), "travel": "hotel lobby,tour guide,river cruise,cabin rental,souvenir stand,trail maps".split(","),
    "software": "error log,search index,login screen,memory leak,pull request,network switch".split(","),
}
PHRASES = {s: ps + [f"{s}{a} {s}{b}" for a, b in ("ab", "cd", "ef", "gh", "ij", "kl")] for s, ps in PHRASES.items()}
FRAMES = ["What people remember is the {0}.", "Nobody on staff treats the {0} lightly.", "The {0} and the {1} are dealt with on the same day.", "Photos show the {0} next to the {1}."]


def corpus(n=800, seed=1):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        subs = rng.sample(sorted(PHRASES), rng.choice([1, 1, 2]))
        text = ["Welcome to Acme Law!"]
        for s in subs:
            text += [rng.choice(FRAMES).format(*rng.sample(PHRASES[s], 2)) for _ in range(4)]
        other = rng.choice(sorted(set(PHRASES) - set(subs)))
        text.append(f"(Someone mentioned the {rng.choice(PHRASES[other])}, but that is another story.)")
        docs.append((i, " ".join(text), "clash"))
        truth[i] = set(subs)
    return docs, truth


def test_held_out_subjects(spark):
    docs, truth = corpus()
    docs += [(1_000, None, ""), (1_001, "", ""), (1_002, "  \n ", ""), (1_003, "Loading...", ""), (1_004, "日本語", "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, subject string")
    labels = spark.createDataFrame([(i, s) for i in range(60) for s in truth[i]] + [(0, None), (1, "unheard of")], "doc_id long, subject string")
    subs = spark.createDataFrame([(s, "") for s in PHRASES], "subject string, about string")
    parsed = subjects.parse(df)
    models = subjects.train(parsed, subs, labels)
    got = {}
    for r in subjects.assign(parsed, models).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    held = [i for i in truth if i >= 60]
    right = sum(len(truth[i] & got.get(i, set())) for i in held)
    assert right / sum(len(truth[i]) for i in held) > 0.95
    assert right / sum(len(got.get(i, ())) for i in held) > 0.95
    assert not set(got) & {1_000, 1_001, 1_002, 1_003, 1_004}
    none = subjects.parse(df.where("false"))
    assert subjects.assign(none, models).count() == 0
    assert subjects.assign(parsed, subjects.train(none, subs, labels)).count() == 0


def test_mend_and_split():
    assert subjects.mend("demandÃ© lâ€™audience &amp; cafÃ©") == "demandé l'audience & café"
    assert subjects.sentences("One two. (An aside here.) One two.\nThree <b>four</b> five") == [["one", "two"], ["three"], ["four"], ["five"]]
    assert subjects.sentences(None) == []
    assert subjects.language_of(subjects.sentences("La gente recuerda los planos de obra y el andamio.")) == "es"


def test_sums_reach_the_driver_as_arrays(spark, monkeypatch):
    """Rows of Python objects for every term and component would take the driver's memory."""
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(*_):
        raise AssertionError("rows of objects")

    rows = spark.createDataFrame([(1, "en", [0, 1], [1.0, 1.0], [0]), (2, "en", [1, 2], [1.0, 2.0], None)], subjects._row("long"))
    for name in ("toPandas", "collect"):
        monkeypatch.setattr(DataFrame, name, refuse)
    got = subjects.fit(rows, {"en": ["aaaa", "bbbb", "cccc"]}, ["s"], {})
    assert got["en"].shape == (2, 3) and abs(got["en"].sum() - 1) < 1e-6
