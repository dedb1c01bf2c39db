"""Subject areas of documents.

The document-term matrix of the whole corpus is factored into non-negative
parts by alternating multiplicative updates.  Each subject anchors one
component: it is seeded with the words of its description and with the labelled
documents, whose mixtures are held to their labels; further components take up
what belongs to no subject.  Each language has a factor of its own, since words
of one language never stand beside those of another.  The term factor then gives every sentence a
mixture of subjects, and a document is about the subjects that several of its
sentences deal with.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, slots
from .names import fold

RARE = 5e-5  # terms on a smaller share of a language's documents (or on one) are left out of the matrix
TERMS = 500_000  # terms of a language that a worker can hold; more are refused, not cut
LABELS = 100_000  # labelled rows used at most, by the order of a hash
FREE = 1  # components that belong to no subject; it starts as the corpus' average and takes up what all subjects share
UPDATES = 200  # at most; the factors settle long before
TOLERANCE = 0.02  # of the mass of all components that an update still moves when they have settled
STEPS = 3  # of the mixture of a sentence
SHARE = 0.6  # of what a sentence gives to subjects that its subject must hold
SEVERAL = 2.0  # sentences that make a subject
WIDE = 0.2  # terms on a larger share of a language's documents say nothing of a subject
# Frequent short words of a language; texts with none of them are read as "other".
LANGUAGES = {
    "en": "the and of is are to with was for on that this".split(),
    "es": "el la los las de del y con por para se una desde este más nos".split(),
    "fr": "le la les des du et avec pour est une depuis nous ce puis sur au aux".split(),
}
_SPLIT = re.compile(r"(?<=[.!?。！？])[\s)]+|\n+|<[^<>]{1,40}>")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_URL = re.compile(r"\S+://\S+|\S+@\S+|#\w+")
_ACCENTS = re.compile("[ÃÂâ€]")


def mend(text: str) -> str:
    """Undoes UTF-8 read as another code page, and character references."""
    if "&" in text:
        text = html.unescape(text)
    if _ACCENTS.search(text):
        def redo(m: re.Match) -> str:
            raw = bytearray()
            for ch in m.group():
                try:
                    raw += ch.encode("cp1252")
                except UnicodeEncodeError:
                    if ord(ch) > 255:
                        return m.group()
                    raw.append(ord(ch))
            try:
                return raw.decode("utf-8")
            except UnicodeDecodeError:
                return m.group()

        text = re.sub(r"[Â-ô][\u0080-¿Œ-žˆ˜–-›€™]{1,3}", redo, text)
    return text.replace("’", "'").replace("\xa0", " ").replace("\\n", "\n")


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence, folded; asides (sentences in parentheses), repeated sentences and links are left out.

    So are words with a capital inside a sentence: what a business is called says nothing of the subject.
    """
    out, seen = [], set()
    for raw in _SPLIT.split(mend(text or "")):
        raw = raw.strip()
        if len(raw) < 4 or raw.startswith("("):
            continue
        typed = _WORD.findall(_URL.sub(" ", raw))
        words = [fold(w) for i, w in enumerate(typed) if i == 0 or not (w[0].isupper() and w[1:].islower())]
        key = " ".join(words)
        if words and key not in seen:
            seen.add(key)
            out.append(words)
    return out


def language_of(found: list[list[str]]) -> str:
    """The language whose frequent words a text uses most; "other" without any."""
    words = Counter(w for s in found for w in s)
    best = max(LANGUAGES, key=lambda c: (sum(words[fold(x)] for x in LANGUAGES[c]), c))
    return best if any(words[fold(x)] for x in LANGUAGES[best]) else "other"


def terms_of(words: list[str]) -> list[str]:
    """Words and pairs of neighbours."""
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def _row(kind: str) -> str:
    return f"k {kind}, l string, t array<int>, n array<float>, y array<int>"


class Model:
    """The term factor and what is read from it.  Small: terms x (subjects + FREE)."""

    def __init__(self, vocabulary: list[str], subjects: list[str], factor: np.ndarray, frames: dict[int, float] | None = None):
        self.vocabulary, self.subjects, self.factor = vocabulary, subjects, factor
        self.index = {t: i for i, t in enumerate(vocabulary)}
        k = len(subjects)
        total = factor.sum(axis=0) + 1e-12
        self.share = (factor / total).T  # of a term: its components
        top = self.share[:, :k].max(axis=1) if k else np.zeros(len(vocabulary))
        # a term points at a subject if most of it belongs there
        self.points = np.where(top >= 0.5, top, 0.0)
        self.frames = frames or {}

    def mixtures(self, rows: list[list[int]]) -> np.ndarray:
        """The mass of each component in each row of term numbers: the row's mixture under the term factor, times its terms."""
        size = [len(r) for r in rows]
        at = np.repeat(np.arange(len(rows)), size)
        h = self.factor[:, np.fromiter((t for r in rows for t in r), np.int64, sum(size))].T + 1e-15
        w = np.full((len(rows), self.factor.shape[0]), 1.0 / self.factor.shape[0])
        mass = np.zeros_like(w)
        for _ in range(STEPS):
            r = w[at] * h
            r /= r.sum(axis=1, keepdims=True)
            mass = np.stack([np.bincount(at, weights=r[:, c], minlength=len(rows)) for c in range(w.shape[1])], axis=1)
            w = mass / np.maximum(mass.sum(axis=1, keepdims=True), 1e-12)
        return mass

    def sentences(self, rows: list[list[int]]) -> list[int]:
        """The subject each sentence deals with, or -1: it holds ``SHARE`` of what the sentence gives to subjects, and a term at least."""
        k = len(self.subjects)
        if k == 0 or not rows:
            return [-1] * len(rows)
        mass = self.mixtures(rows)[:, :k]
        best = mass.argmax(axis=1)
        top = mass[np.arange(len(rows)), best]
        return np.where((top >= 1.0) & (top >= SHARE * mass.sum(axis=1)), best, -1).tolist()

    def ids(self, words: list[str]) -> list[int]:
        return [self.index[t] for t in terms_of(words) if t in self.index]

    def weight(self, ids: list[int]) -> float:
        """How much a sentence counts: less where its frame usually mentions things in passing."""
        return min((self.frames[i] for i in ids if i in self.frames), default=1.0)

    def subjects_of(self, texts: list[list[list[str]]], several: float = SEVERAL) -> list[list[str]]:
        """The subjects of each text (the words of its sentences), from the mixtures of all their sentences at once."""
        rows = [self.ids(words) for found in texts for words in found]
        said = iter(zip(self.sentences(rows), rows))
        out = []
        for found in texts:
            counts: dict[int, float] = {}
            for _ in found:
                s, ids = next(said)
                if s >= 0:
                    counts[s] = counts.get(s, 0.0) + self.weight(ids)
            out.append([self.subjects[s] for s in sorted(counts) if counts[s] >= several])
        return out


def parse(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``k``, ``l``, ``x``: key, language, and the words of the sentences, a line each; every text is read this once.

    Null and empty texts, and texts without words, have no row.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [sentences(t) for t in pdf["x"]]
            texts = pd.Series(["\n".join(" ".join(w) for w in f) for f in found], dtype="object")
            yield pd.DataFrame({"k": pdf["k"], "l": pd.Series([language_of(f) for f in found], dtype="object"), "x": texts})

    src = docs.select(F.col(key).alias("k"), F.col(text).alias("x")).where("length(x) > 0")
    return cut(src.repartition(slots(docs.sparkSession)).mapInPandas(run, f"k {kind}, l string, x string").where("x <> ''"), "sentences")


def _counts(seen: Counter) -> pd.DataFrame:
    return pd.DataFrame({"l": pd.Series([x for x, _ in seen], dtype="object"), "w": pd.Series([x for _, x in seen], dtype="object"), "n": pd.Series(list(seen.values()), dtype="int64")})


def _lines(x: str) -> list[list[str]]:
    return [line.split(" ") for line in x.split("\n")]


def vocabularies(parsed: DataFrame) -> dict[str, list[str]]:
    """By language, the terms on at least ``RARE`` of its documents, counted over all documents, and on no more than ``WIDE`` of them.

    So a language has at most the terms of an average document / ``RARE``; more than ``TERMS`` are refused.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[tuple[str, str]] = Counter()
        for pdf in batches:
            for lang, x in zip(pdf["l"], pdf["x"]):
                seen.update({(lang, term) for words in _lines(x) for term in terms_of(words)} | {(lang, "")})
            if len(seen) > 300_000:
                yield _counts(seen)
                seen = Counter()
        yield _counts(seen)

    found = cut(parsed.select("l", "x").mapInPandas(count, "l string, w string, n long").groupBy("l", "w").agg(F.sum("n").alias("n")), "terms")
    totals = {r.l: r.n for r in found.where("w = ''").collect()}  # one row per language
    out = {}
    for lang, total in sorted(totals.items()):
        least, most = max(2, int(total * RARE)), max(2, int(total * WIDE))
        rows = found.where((F.col("l") == lang) & F.col("n").between(least, most) & (F.length("w") >= 3))
        if (many := rows.count()) > TERMS:
            raise ValueError(f"{many} terms of language {lang}; at most {TERMS} fit a worker")
        out[lang] = rows.orderBy(F.desc("n"), "w").select("w").toArrow()["w"].to_pylist()
    return out


def matrix(parsed: DataFrame, vocabs: dict[str, list[str]], labels: DataFrame, subjects: list[str]) -> DataFrame:
    """Sparse rows: key, language, term numbers, counts of sentences, and the subjects of labelled documents."""
    kind = parsed.schema["k"].dataType.simpleString()
    given = F.create_map(*(F.lit(v) for i, s in enumerate(subjects) for v in (s, i))) if subjects else F.lit(None).cast("map<string,int>")
    y = labels.select("k", given[F.col("subject")].alias("s")).where("s is not null").groupBy("k").agg(F.collect_set("s").alias("y"))
    src = parsed.join(y, "k", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes = {lang: {t: i for i, t in enumerate(v)} for lang, v in vocabs.items()}
        for pdf in batches:
            t, n = [], []
            for lang, x in zip(pdf["l"], pdf["x"]):
                index = indexes.get(lang, {})
                c = Counter(index[term] for words in _lines(x) for term in set(terms_of(words)) if term in index)
                t.append(list(c))
                n.append([float(v) for v in c.values()])
            yield pd.DataFrame({"k": pdf["k"], "l": pdf["l"].astype("object"), "t": t, "n": n, "y": pdf["y"]})

    return src.repartition(slots(parsed.sparkSession)).mapInPandas(run, _row(kind))


def _solve(t: list, n: list, y: list, factor: np.ndarray, k: int, steps: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mixtures of a block of rows, its numerator for the term factor, sums of the mixtures).

    Multiplicative updates for the divergence; the mixture of a labelled row stays within its labels.
    """
    size = [len(x) for x in t]
    rows = np.repeat(np.arange(len(t)), size)
    cols = np.concatenate([np.asarray(x, dtype=np.int64) for x in t]) if rows.size else np.zeros(0, np.int64)
    vals = np.concatenate([np.asarray(x, dtype=np.float64) for x in n]) if rows.size else np.zeros(0)
    comps = factor.shape[0]
    w = np.full((len(t), comps), 1.0 / comps)
    for i, labels in enumerate(y):
        if labels is not None and len(labels):
            w[i, :k] = 0.0
            w[i, list(labels)] = 1.0 / len(labels)
    h = factor[:, cols].T  # nonzeros x components
    starts = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else np.zeros(0, np.int64)
    some = np.asarray(size) > 0
    norm = factor.sum(axis=1) + 1e-12
    for _ in range(steps):
        q = vals / ((w[rows] * h).sum(axis=1) + 1e-12)
        up = np.zeros_like(w)
        if rows.size:
            up[some] = np.add.reduceat(q[:, None] * h, starts[some], axis=0)
        w *= up / norm
    if rows.size:
        q = vals / ((w[rows] * h).sum(axis=1) + 1e-12)
        contrib = q[:, None] * w[rows]
        num = np.stack([np.bincount(cols, weights=contrib[:, c], minlength=factor.shape[1]) for c in range(comps)])
    else:
        num = np.zeros_like(factor)
    return w, num, w.sum(axis=0)


def fit(rows: DataFrame, vocabs: dict[str, list[str]], subjects: list[str], about: dict[str, list[str]], seed: int = 7) -> dict[str, np.ndarray]:
    """The term factor of each language, (subjects + FREE) x terms, of all rows.

    Each update is one pass over the languages that have not settled: every task solves the
    mixtures of its rows with the factors of the last update and returns one sum per language,
    component and term, whatever the number of rows.  It ends when no component moves more than
    ``TOLERANCE`` of its mass.
    """
    k = len(subjects)
    spark = rows.sparkSession
    factors: dict[str, np.ndarray] = {}
    for lang, vocab in vocabs.items():
        factor = 0.05 + 0.05 * np.random.default_rng(seed).random((k + FREE, len(vocab)))
        index = {t: i for i, t in enumerate(vocab)}
        for s, words in enumerate(about.get(lang, [])):
            for w in terms_of(_WORD.findall(fold(words or ""))):
                for form in {w, w.rstrip("s"), w + "s"}:
                    if form in index and len(form) > 3:
                        factor[s, index[form]] += 1.0
        factors[lang] = factor

    def sums(some: DataFrame, current: dict[str, np.ndarray]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        shared = spark.sparkContext.broadcast(current)  # (subjects + FREE) x TERMS numbers a language at most

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            num = {lang: np.zeros_like(h) for lang, h in shared.value.items()}
            tot = {lang: np.zeros(h.shape[0]) for lang, h in shared.value.items()}
            for pdf in batches:
                for lang, own in pdf.groupby("l"):
                    for a in range(0, len(own), 2_000):
                        part = own.iloc[a : a + 2_000]
                        _, x, y = _solve(list(part["t"]), list(part["n"]), list(part["y"]), shared.value[lang], k)
                        num[lang] += x
                        tot[lang] += y
            for lang, n in num.items():
                if tot[lang].any():
                    yield pd.DataFrame({"l": pd.Series([lang] * n.shape[0], dtype="object"), "c": range(n.shape[0]), "num": list(n), "tot": tot[lang]})

        parts = some.where(F.col("l").isin(*current)).select("l", "t", "n", "y").mapInPandas(run, "l string, c int, num array<double>, tot double")
        # one row per component and task; summed by position before anything reaches the driver
        spread = parts.select("l", "c", "tot", F.posexplode("num").alias("p", "x")).where("x > 0 or p = 0")
        total = spread.groupBy("l", "c", "p").agg(F.sum("x").alias("x"), F.sum(F.when(F.col("p") == 0, F.col("tot")).otherwise(0.0)).alias("tot")).toArrow()  # as arrays: rows of objects would take the driver's memory
        shared.destroy()
        out = {lang: (np.zeros_like(h), np.zeros(h.shape[0])) for lang, h in current.items()}
        said = total["l"].to_numpy()
        c, p, x, mass = (total[n].to_numpy() for n in ("c", "p", "x", "tot"))
        for lang, (num, tot) in out.items():
            own = said == lang
            num[c[own], p[own]] = x[own]
            np.add.at(tot, c[own], mass[own])
        return out

    factors = {lang: f for lang, f in factors.items() if f.shape[1]}
    average = {lang: np.zeros(f.shape[1]) for lang, f in factors.items()}
    sizes = rows.select("l", F.explode(F.arrays_zip("t", "n")).alias("x")).groupBy("l", "x.t").agg(F.sum("x.n").alias("n")).toArrow()  # TERMS rows a language at most
    for lang, whole in average.items():
        own = sizes["l"].to_numpy() == lang
        whole[sizes["t"].to_numpy()[own]] = sizes["n"].to_numpy()[own]
    # the labelled rows alone seed the anchored components
    labelled = rows.where("size(y) > 0").orderBy(F.xxhash64("k")).limit(LABELS)
    for _ in range(2):
        for lang, (num, tot) in sums(labelled, factors).items():
            if tot.sum() > 0:
                seeded = factors[lang] * num / (tot[:, None] + 1e-9)
                factors[lang] = 0.02 * factors[lang] + np.where(tot[:, None] > 0, seeded, factors[lang])
    for lang, factor in factors.items():
        factor += 1e-4
        # the free part starts as the average of all rows: a random start could grow into a subject of its own
        factor[k:] = average[lang][None, :] / max(average[lang].mean(), 1e-9) + 1e-4
        factor /= factor.sum(axis=1, keepdims=True)
    moving, mass = dict(factors), {}
    for _ in range(UPDATES):
        for lang, (num, tot) in sums(rows, moving).items():
            factor = factors[lang] * num / (tot[:, None] + 1e-9) + 1e-9
            # rows have the same mass, so that a component's factor is a distribution over terms
            factor /= factor.sum(axis=1, keepdims=True)
            moved = np.abs(factor - factors[lang]).sum(axis=1) * tot / max(tot.sum(), 1e-9)
            factors[lang], mass[lang] = factor, tot
            moving[lang] = factor
            if moved.sum() < TOLERANCE:
                del moving[lang]
        if not moving:
            break
    else:
        raise RuntimeError("the factors did not settle")
    return {lang: f * (mass[lang][:, None] / max(mass[lang].sum(), 1e-9)) for lang, f in factors.items()}


def learn_frames(parsed: DataFrame, labels: DataFrame, models: dict[str, Model], least: int = 8) -> dict[str, dict[int, float]]:
    """By language, terms whose sentences name a subject in passing: the share in which the labels confirm it.

    Only terms that belong to no subject, are seen ``least`` times and confirmed in less than 0.6 are kept.
    """
    given = labels.groupBy("k").agg(F.collect_set("subject").alias("y")).orderBy(F.xxhash64("k")).limit(LABELS)
    src = parsed.join(given, "k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hit: Counter[tuple[str, int]] = Counter()
        seen: Counter[tuple[str, int]] = Counter()
        for pdf in batches:
            for lang, x, y in zip(pdf["l"], pdf["x"], pdf["y"]):
                if m := models.get(lang):
                    rows = [m.ids(words) for words in _lines(x)]
                    for s, ids in zip(m.sentences(rows), rows):
                        for i in set(ids) if s >= 0 else ():
                            if m.points[i] == 0:
                                seen[lang, i] += 1
                                hit[lang, i] += m.subjects[s] in set(y)
        rows = [(lang, i, n, hit[lang, i]) for (lang, i), n in seen.items()]
        yield pd.DataFrame(rows, columns=["l", "i", "n", "h"])

    total = src.select("l", "x", "y").mapInPandas(run, "l string, i int, n long, h long").groupBy("l", "i").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    out: dict[str, dict[int, float]] = {}
    for r in total.where(f"n >= {least} and h < 0.6 * n").collect():
        out.setdefault(r.l, {})[r.i] = r.h / r.n
    return out


def train(parsed: DataFrame, subjects: DataFrame, labels: DataFrame, key: str = "doc_id") -> dict[str, Model]:
    """A model by language of documents read by :func:`parse`.  ``subjects``: subject, about (small); ``labels``: key, subject (a few may be wrong or repeated).

    Empty tables give models without subjects.
    """
    listed = sorted({(r.subject, r.about or "") for r in subjects.select("subject", "about").collect() if r.subject})
    names, about = [s for s, _ in listed], [a for _, a in listed]
    vocabs = vocabularies(parsed)
    marks = labels.select(F.col(key).alias("k"), "subject").where("subject is not null").distinct()
    rows = cut(matrix(parsed, vocabs, marks, names), "terms")
    models = {lang: Model(vocabs[lang], names, f) for lang, f in fit(rows, vocabs, names, {"en": about}).items()}
    frames = learn_frames(parsed, marks, models)
    return {lang: Model(m.vocabulary, names, m.factor, frames.get(lang)) for lang, m in models.items()}


def assign(parsed: DataFrame, models: dict[str, Model], key: str = "doc_id", several: float = SEVERAL) -> DataFrame:
    """``key``, ``subject``: one row per document and subject that ``several`` sentences deal with.

    Null, empty and white-space texts and texts without a subject have no row; whole texts are
    read; repeated keys are answered each; extra columns are left out.
    """
    kind = parsed.schema["k"].dataType.simpleString()
    shared = parsed.sparkSession.sparkContext.broadcast(models)  # at most TERMS x (subjects + FREE) by language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_language = shared.value
        for whole in batches:
            for a in range(0, len(whole), 500):
                for lang, pdf in whole.iloc[a : a + 500].groupby("l"):
                    if m := by_language.get(lang):
                        got = m.subjects_of([_lines(x) for x in pdf["x"]], several)
                        sizes = [len(g) for g in got]
                        yield pd.DataFrame({"k": pdf["k"].repeat(sizes).to_numpy(), "subject": pd.Series([s for g in got for s in g], dtype="object")})

    return parsed.mapInPandas(run, f"k {kind}, subject string").select(F.col("k").alias(key), "subject")
