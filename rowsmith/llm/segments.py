"""Deduplication of new batches against all history.

A stored segment index for edit distance.  Every accepted key is stored as a
fixed number of segments, each with the key's length and the segment's place.
A new key within ``EDITS`` edits must contain one of the segments of the old one
unchanged and near its place, so it probes only the substrings that can be
one; what meets is verified with the bounded edit distance.  The batch's own
segments are stored after it has been probed.  The index lies in folders by
hash; a batch opens only those its probes fall into, and what is stored is never
written again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import clear, cut, shared_path

EDITS = 2
PARTS = EDITS + 1  # of which one is left whole by any EDITS edits
BLOCK = 60  # keys a segment may hold; longer lists are split by the rest of the key, which is exact
FUZZY = ("whole", "rare")  # forms compared under the edit distance; the others must be equal
NAMES = (*FUZZY, "typed", "initial", "exact")
FACTS = ("site", "phone7", "number", "place", "short")


def keys(records: DataFrame, common: list[str]) -> DataFrame:
    """``id``, ``form``, ``key`` and ``FACTS``: the texts under which a record is stored and looked up.

    The whole name in the order of its words, the name as typed, the name with its first word
    cut to a letter (people shorten given names), the name without common words, and the own site
    and phone.  Names of fewer than six letters and names of holdings are compared as they are.
    ``short``: the name has such a letter itself.  A name shared by very many rows is one key.
    """
    words = F.array_sort("words")
    joined = lambda a: F.array_join(a, "")
    rare = F.filter(words, lambda w: ~w.isin(common))
    first_cut = F.array_sort(F.transform("words", lambda w, i: F.when(i == 0, F.left(w, F.lit(1))).otherwise(w)))
    name = ~F.col("legal") & (F.length(joined(words)) >= 6)
    form = lambda what, key, there: F.struct(F.lit(what).alias("form"), F.when(there & (key != ""), key).alias("key"))
    forms = F.array(
        form("whole", joined(words), name), form("typed", joined(F.col("words")), name), form("rare", joined(rare), name & (F.size(rare) > 1) & (F.length(joined(rare)) >= 6)),
        form("initial", joined(first_cut), name & (F.size(rare) > 1) & (F.length(joined(first_cut)) >= 6)), form("exact", joined(words), ~name),
        form("site", F.col("site"), F.lit(True)), form("phone", F.col("phone"), F.lit(True)),
    )
    facts = records.select("id", "site", "phone7", "number", "place", F.exists("words", lambda w: F.length(w) == 1).alias("short"), F.explode(F.filter(forms, lambda x: x["key"].isNotNull())).alias("x"))
    of_name = ~F.col("x.form").isin("site", "phone")  # a site or phone says enough by itself
    return facts.select("id", "x.form", "x.key", *(F.when(of_name, F.col(c)).otherwise(F.lit(False) if c == "short" else F.lit("")).alias(c) for c in FACTS))


def _mask(key: Column) -> Column:
    """Parity of the count of each letter: an edit changes two at most."""
    return F.aggregate(F.split(key, ""), F.lit(0), lambda m, c: m.bitwiseXOR(F.when(c == "", 0).otherwise(F.call_function("shiftleft", F.lit(1), F.ascii(c) % 31))))


def _ids(keyed: DataFrame) -> DataFrame:
    """Distinct ``form``, ``key`` with ``kid`` (hash) and ``mask``."""
    return keyed.select("form", "key").distinct().withColumn("kid", F.xxhash64("form", "key")).withColumn("mask", _mask(F.col("key")))


def _place(l: Column, i: Column) -> tuple[Column, Column]:
    """Start and size of segment ``i`` of a key of length ``l``; the last ``l % PARTS`` segments are one letter longer."""
    base, whole = F.floor(l / PARTS).cast("int"), PARTS - l % PARTS
    return (base * i + F.greatest(F.lit(0), i - whole) + 1).cast("int"), (base + (i >= whole).cast("int")).cast("int")


def segments(keyed: DataFrame) -> DataFrame:
    """The index rows of the keys: ``h`` (hash of form, length, place and segment), ``kid``, ``mask``, ``key``."""
    length = F.length("key")
    cuts = F.array(*(F.xxhash64("form", length, F.lit(i), F.col("key").substr(*_place(length, F.lit(i)))) for i in range(PARTS)))
    return keyed.select(F.explode(cuts).alias("h"), "kid", "mask", "key")


def _spots(lengths: DataFrame) -> DataFrame:
    """``n``, ``l``, ``i``, ``p``, ``size``: where in a key of length ``n`` segment ``i`` of one of length ``l`` can stand.

    For an old key of length l, segment i at place p can only stand at p - i ... p + i or, from the
    other end, at p + d - (PARTS - 1 - i) ... p + d + (PARTS - 1 - i), d the difference of lengths.
    """
    n, l, i = F.col("n"), F.col("l"), F.col("i")
    each = lengths.select("n", F.explode(F.sequence(F.greatest(F.lit(1), n - EDITS), n + EDITS)).alias("l"))
    each = each.select("n", "l", F.explode(F.array(*map(F.lit, range(PARTS)))).alias("i"))
    (start, size), d, rest = _place(l, i), n - l, PARTS - 1 - i
    low = F.greatest(F.lit(1), start - i, start + d - rest).cast("int")
    high = F.least(n - size + 1, start + i, start + d + rest).cast("int")
    there = F.when((high >= low) & (size > 0), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    return each.select("n", "l", "i", F.explode(there).alias("p"), size.alias("size"))


def probes(keyed: DataFrame) -> DataFrame:
    """The substrings of each key that can be a segment of a key within reach: ``h``, ``kid``, ``mask``, ``key``.

    Their places depend on the length alone and are worked out once for each length there is.
    """
    sized = keyed.withColumn("n", F.length("key"))
    spots = F.broadcast(_spots(sized.select("n").distinct()))  # some 25 rows for each length
    return sized.join(spots, "n").select(F.xxhash64("form", "l", "i", F.col("key").substr(F.col("p"), F.col("size"))).alias("h"), "kid", "mask", "key")


def _quarters(key: Column) -> list[Column]:
    """The letters of six groups in their order: an edit changes at most two groups, so two edits leave two of six unchanged."""
    groups = ("abcd", "efgh", "ijklm", "nopq", "rst", "uvwxyz0123456789")
    return [F.concat(F.lit(str(i)), F.regexp_replace(key, f"[^{g}]", "")) for i, g in enumerate(groups)]


def meet(probe: DataFrame, index: DataFrame, own: bool = True) -> DataFrame:
    """``new``, ``old`` (key ids): keys within ``EDITS`` edits (with ``own`` equal ones too); keys under twelve letters may differ by one edit only.

    ``index``: segments with a flag ``stored``; keys that aren't stored are those of ``probe``, so that each two of them are
    compared once.  A segment held by more than ``BLOCK`` keys would
    meet too often; index and probe then also carry the key's letters by groups, of which EDITS
    edits leave some unchanged, so nothing within reach is lost.  The parity of the letters rules
    most pairs out before keys are compared.
    """
    hot = cut(index.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("h", F.lit(True).alias("hot")), "hot")
    hot = F.broadcast(hot) if hot.count() <= 100_000 else hot
    part = F.explode(F.when(F.col("hot"), F.array(*(F.xxhash64("h", q) for q in _quarters(F.col("key"))))).otherwise(F.array("h"))).alias("g")
    a = probe.join(hot, "h", "left").select(part, F.col("kid").alias("new"), F.col("mask").alias("ma"), F.col("key").alias("ka"))
    b = index.join(hot, "h", "left").select(part, F.col("kid").alias("old"), F.col("mask").alias("mb"), F.col("key").alias("kb"), "stored")
    once = F.col("stored") | (F.col("old") < F.col("new"))
    if own:
        once |= F.col("old") == F.col("new")
    else:
        once &= F.col("old") != F.col("new")
    apart = F.bit_count(F.col("ma").bitwiseXOR(F.col("mb"))) <= 2 * EDITS
    far = F.levenshtein("ka", "kb", EDITS)  # -1 beyond
    near = F.when(F.least(F.length("ka"), F.length("kb")) < 12, far.isin(0, 1)).otherwise(far >= 0)
    to = lambda side: F.max(~F.col("stored") | (F.col("new") == F.col(side))).alias(f"by_{side}")
    both = a.join(b, "g").where(once & apart).where(near).withColumn("low", F.least("new", "old")).withColumn("high", F.greatest("new", "old"))
    both = both.groupBy("low", "high").agg(to("low"), to("high"))
    way = lambda new, old: F.when(F.col(f"by_{new}"), F.struct(F.col(new).alias("new"), F.col(old).alias("old")))
    ways = F.array(way("low", "high"), F.when(F.col("low") != F.col("high"), way("high", "low")))
    return both.select(F.explode(F.array_compact(ways)).alias("x")).select("x.new", "x.old")


def near_keys(new: DataFrame, old: DataFrame) -> DataFrame:
    """``form``, ``new``, ``old``: distinct keys (``form``, ``key``) of ``new`` with those of ``old`` within reach."""
    a, b = _ids(new), _ids(old)
    met = meet(probes(a), segments(b).withColumn("stored", F.lit(True)))
    named = met.join(a.select(F.col("kid").alias("new"), "form", F.col("key").alias("k")), "new").select("form", F.col("k").alias("new"), "old")
    return named.join(b.select(F.col("kid").alias("old"), F.col("key").alias("k")), "old").select("form", "new", F.col("k").alias("old"))


class SegmentIndex:
    """All accepted rows, as stored below ``path``: ``segments`` of their keys, ``signs`` (keys with what is known of the row) and ``links`` between rows.

    ``common``: words that tell little, fixed when the index is made.  ``parts``: folders by hash in
    each table; a probe opens one, so with more folders a small batch reads less of the history.
    A batch is accepted when all it stores is written; one that failed before that is added again.
    """

    def __init__(self, spark: SparkSession, common: list[str], path: str | None = None, parts: int = 16):
        self.spark, self.common, self.parts = spark, common, parts
        self.path = path or shared_path(spark, "segment-index")
        top = self._place("accepted")
        fs = self._files(top)
        self.batches = sorted(int(x.getPath().getName()) for x in fs.listStatus(top)) if fs.exists(top) else []

    def _place(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self, place):
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def stored(self, table: str, folders: list[int] | None = None) -> DataFrame | None:
        """A table of the accepted batches; with ``folders`` only those, which is all that is opened."""
        if not self.batches:
            return None
        df = self.spark.read.option("basePath", f"{self.path}/{table}").parquet(*(f"{self.path}/{table}/batch={n}" for n in self.batches))
        return df if folders is None else df.where(F.col("part").isin(folders))

    def _append(self, df: DataFrame, table: str, batch: int, by: str) -> None:
        out = df.withColumn("part", F.pmod(by, F.lit(self.parts)).cast("int")).repartition("part")
        out.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/{table}/batch={batch}")

    def _folders(self, hashes: DataFrame, by: str, at_least: int) -> list[int] | None:
        """The folders that so many hashes fall into (``parts`` numbers at most); None for all, which is what many hashes hit."""
        if at_least > 8 * self.parts:
            return None
        return [r.part for r in hashes.select(F.pmod(by, F.lit(self.parts)).cast("int").alias("part")).distinct().collect()]

    def add(self, records: DataFrame, batch: int) -> None:
        """Probes the rows of one batch, stores their links to earlier rows and to one another, and their keys.

        Rows of a batch that agree in key and facts are one signature, held by the first of them.
        """
        if batch in self.batches:
            raise ValueError(f"batch {batch} has been added")
        keyed = cut(_signed(keys(records, self.common)), "keys")
        counted = cut(keyed.groupBy("kid", "sid", "form", "key", *FACTS).agg(F.min("id").alias("id"), F.count("*").alias("n")), "signs")
        sign, many = counted.drop("n"), counted.count()
        fresh = cut(sign.where(F.col("form").isin(*FUZZY)).select("kid", "form", "key").distinct().withColumn("mask", _mask(F.col("key"))), "fresh")
        asked = probes(fresh)
        held = segments(fresh).withColumn("stored", F.lit(False))
        if self.batches:
            folders = self._folders(asked, "h", many)
            old = self.stored("segments", folders).select("h", "kid", "mask", "key", F.lit(True).alias("stored"))
            # what a small batch doesn't ask for is left behind at once; one that asks for most of the history moves it once
            held = held.unionByName(old.join(asked.select("h").distinct(), "h", "left_semi") if folders or 8 * many < old.count() else old)
        near = cut(meet(asked, held, own=False), "near")
        theirs = sign.withColumn("stored", F.lit(False))
        if self.batches:
            wanted = near.select(F.col("old").alias("kid")).unionAll(sign.select("kid")).distinct()
            theirs = theirs.unionByName(self.stored("signs", self._folders(wanted, "kid", many)).join(wanted, "kid", "left_semi").select(*sign.columns, F.lit(True).alias("stored")))
        given = lambda c: F.when(F.col(c) != "", F.col(c))
        several = lambda c: F.coalesce(F.min(given(c)) != F.max(given(c)), F.lit(False))
        theirs = cut(theirs, "asked")
        stat = theirs.groupBy("kid").agg((several("place") | several("site")).alias("many"), F.min("id").alias("lead"), (F.count("*") > 1).alias("shared"))
        paired = near.select(F.col("new").alias("kid")).unionAll(near.select("old")).distinct().withColumn("paired", F.lit(True))
        # a signature alone under its key, which is near no other, has no link
        met = cut(theirs.join(stat, "kid").join(paired, "kid", "left").where("shared or paired").drop("paired"), "met")
        pairs = near.unionAll(met.where("shared and not stored").select(F.col("kid").alias("new"), F.col("kid").alias("old")).distinct())

        known = theirs.where("stored").select("kid")
        again = theirs.where("stored").select("sid")
        links = _links(pairs, met).unionByName(self._twins(keyed, counted.where("n > 1")))
        with ThreadPoolExecutor(3) as pool:  # three independent writes
            jobs = [
                pool.submit(self._append, segments(fresh.join(known, "kid", "left_anti")), "segments", batch, "h"),
                pool.submit(self._append, sign.join(again, "sid", "left_anti"), "signs", batch, "kid"),
                pool.submit(links.write.mode("overwrite").parquet, f"{self.path}/links/batch={batch}"),
            ]
            for job in jobs:
                job.result()
        clear(keyed, counted, fresh, near, theirs, met)
        mark = self._place(f"accepted/{batch}")
        self._files(mark).create(mark, True).close()
        self.batches.append(batch)

    def _twins(self, keyed: DataFrame, sign: DataFrame) -> DataFrame:
        """Links of a signature's other rows to its first one; of the lesser forms only where a fact stands beside them."""
        lesser = F.col("form").isin("rare", "initial")
        told = ((F.col("phone7") != "") | (F.col("place") != "")) & ((F.col("form") != "initial") | F.col("short"))
        mine = keyed.where(~lesser | told).select("sid", F.col("id").alias("b"))
        twins = mine.join(sign.select("sid", F.col("id").alias("a")), "sid").where("a < b").select("a", "b").distinct()
        return twins.select("a", "b", F.lit(False).alias("weak"), F.lit(False).alias("torn"), *(F.lit("").alias(c) for c in _SIDES))

    def firsts(self) -> DataFrame:
        """``id``, ``first``: the first row of the business of every row that is linked to another, as far as batches have been added.

        Only the links are read, two ids each; no text of the history is.
        """
        links = self.stored("links")
        if links is None:
            raise ValueError("no batch has been added")
        from .suffixes import settled

        torn = links.where("torn").select(F.col("a").alias("n"))
        calm = links.where("not torn").join(torn.select(F.col("n").alias("a"), F.lit(True).alias("ta")).distinct(), "a", "left").join(torn.select(F.col("n").alias("b"), F.lit(True).alias("tb")).distinct(), "b", "left")
        blank_torn = (F.col("ta").isNotNull() & (F.col("place_a") == "")) | (F.col("tb").isNotNull() & (F.col("place_b") == ""))
        calm = cut(calm.where(~F.col("weak") | ~blank_torn).drop("ta", "tb", "torn", "batch"), "links")
        found = connected_components(settled(calm))
        return found.select(F.col("node").alias("id"), F.col("component").alias("first"))

    def answers(self, batch: DataFrame) -> DataFrame:
        """``id``, ``first`` of the rows of a batch just added; a row that joins two businesses takes the first row of both."""
        return batch.select("id").join(self.firsts(), "id", "left").select("id", F.coalesce("first", "id").alias("first"))


_SIDES = ("place_a", "site_a", "place_b", "site_b")


def _signed(keyed: DataFrame) -> DataFrame:
    return keyed.withColumn("kid", F.xxhash64("form", "key")).withColumn("sid", F.xxhash64("kid", *FACTS))


def _links(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """Signatures under near keys that are one business: nothing own may differ, and the less the name says the more must agree.

    What must agree (seven digits, street number and place, place, or a side that says nothing)
    is part of the join, so that a name of many businesses does not meet itself everywhere.  A row
    of unknown place whose name is borne in several places, or beside several own sites, is
    ``torn``: it would be a guess, and none of its weak links counts; to find that it meets only
    the first row of the name.
    """
    place, number = F.col("place"), F.col("number")
    named = F.col("form").isin(*NAMES)
    when = lambda test, *parts: F.when(test, F.concat(*(F.lit(p) if len(p) == 1 else F.col(p) for p in parts)))
    equal = [when(F.col("phone7") != "", "p", "phone7"), when((place != "") & (number != ""), "n", "number", "@", "place"), when(~named, "*")]
    some, none, led = (place != ""), named & (place == ""), named & (~F.col("many") | (F.col("id") == F.col("lead")))
    ask = [when(some & (number == ""), "a", "place"), when(some, "b", "place"), when(none, "c"), when(led, "d")]
    tell = [when(some, "a", "place"), when(some & (number == ""), "b", "place"), when(led, "c"), when(none, "d")]
    token = lambda more: F.explode(F.array_compact(F.array(*equal, *more))).alias("t")
    fields = ["id", "many", *FACTS]
    x = pairs.join(signs.where("not stored"), F.col("new") == F.col("kid")).select(F.col("old").alias("kid"), "form", token(ask), *(F.col(f).alias(f"{f}_b") for f in fields))
    y = signs.select("kid", token(tell), *(F.col(f).alias(f"{f}_a") for f in fields))
    both = x.join(y, ["kid", "t"])
    torn = F.when(F.col("t") == "c", F.col("many_a")).when(F.col("t") == "d", F.col("many_b")).otherwise(F.lit(False))
    both = both.withColumn("torn", torn)
    differ = lambda f: (F.col(f"{f}_a") != "") & (F.col(f"{f}_b") != "") & (F.col(f"{f}_a") != F.col(f"{f}_b"))
    same = lambda f: (F.col(f"{f}_a") != "") & (F.col(f"{f}_a") == F.col(f"{f}_b"))
    spot = same("number") & same("place")
    lesser = F.col("form").isin("rare", "initial")  # such keys need a fact beside them
    fact = same("phone7") | spot | (same("place") & ~differ("number"))
    cut_short = (F.col("form") != "initial") | F.col("short_a") | F.col("short_b")
    fit = ~differ("site") & (spot | same("phone7") | (~differ("place") & ~differ("number"))) & (~lesser | fact) & cut_short & (F.col("id_a") != F.col("id_b"))
    weak = F.col("form").isin(*NAMES) & ((F.col("place_a") == "") | (F.col("place_b") == "")) & ~same("phone7")
    left = F.col("torn") | (F.col("id_a") < F.col("id_b"))
    blank = F.when(F.col("t") == "c", F.col("id_b")).otherwise(F.col("id_a"))  # the side a torn row is on
    side = lambda c, s: F.when(left, F.col(f"{c}_{s}")).otherwise(F.col(f"{c}_{'b' if s == 'a' else 'a'}"))
    found = both.where(F.col("torn") & ~lesser | ~F.col("torn") & fit).select(
        *(F.when(F.col("torn"), blank).otherwise(side("id", s)).alias(s) for s in "ab"), "torn", (weak & ~F.col("torn")).alias("weak"),
        *(F.when(F.col("torn"), F.lit("")).otherwise(side(c[:-2], c[-1])).alias(c) for c in _SIDES),
    )
    return found.groupBy("a", "b", "torn").agg(F.min("weak").alias("weak"), *(F.max(c).alias(c) for c in _SIDES)).select("a", "b", "weak", "torn", *_SIDES)


def load_batches(records: DataFrame, common: list[str], by: str = "batch", parts: int = 16, path: str | None = None) -> SegmentIndex:
    """The index after all batches of ``records``, in the order of ``by``; rows without one come last.

    A backlog is taken in steps that grow, so that n waiting batches cost log n steps: the first
    alone, then three times what is stored.  The answers are those of single batches, since
    the rows of a step are also compared with one another.
    """
    index = SegmentIndex(records.sparkSession, common, path, parts)
    last = 2**31 - 1
    numbered = records.withColumn(by, F.coalesce(F.col(by), F.lit(last)))
    waiting = sorted(r[0] for r in numbered.select(by).distinct().collect())  # one number per batch
    done = 0
    while done < len(waiting):
        step = waiting[done : max(1, 4 * done)]
        index.add(numbered.where(F.col(by).between(step[0], step[-1])), step[-1])
        done += len(step)
    return index


def repeats(firsts: DataFrame) -> DataFrame:
    """``first_row_id``, ``row_id``: the rows whose business came earlier."""
    return firsts.where("first < id").select(F.col("first").alias("first_row_id"), F.col("id").alias("row_id"))
