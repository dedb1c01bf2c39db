"""Encoding of texts with a public byte-level BPE vocabulary.

A minimal acyclic transducer holds the frequent words of the corpus: its states
are shared by words with equal endings, its arcs carry outputs that add up to
the word's number, and the number leads to the word's ids.  Executors map the
compiled file into memory.  Words it doesn't hold are merged exactly.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

_MAGIC = 0x46535431
LEXICON_SIZE = 65_536  # words in the transducer at most
LEXICON_BYTES = 48  # bytes of such a word at most
_CACHE = 300_000  # words a worker remembers at most


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def word_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Exact BPE of one word: again and again the leftmost pair of lowest rank merges.

    Linked list and heap, so that a word of n bytes takes n log n steps.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop or end[i] == stop:
            continue
        j = end[i]
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Transducer:
    """Minimal acyclic automaton over bytes with added-up outputs, as flat arrays."""

    def __init__(self, buffer: np.ndarray):
        head = buffer[:24].view("<u4")
        if head[0] != _MAGIC:
            raise ValueError("not a transducer")
        self.words, states, arcs, ids = (int(x) for x in head[1:5])
        self.root = int(head[5])
        at = 24
        self.first = buffer[at : (at := at + 4 * (states + 1))].view("<u4")
        self.target = buffer[at : (at := at + 4 * arcs)].view("<u4")
        self.output = buffer[at : (at := at + 4 * arcs)].view("<u4")
        self.offset = buffer[at : (at := at + 4 * (self.words + 1))].view("<u4")
        self.ids = buffer[at : (at := at + 4 * ids)].view("<u4")
        self.label = buffer[at : (at := at + arcs)]
        self.final = buffer[at : (at := at + states)]

    @classmethod
    def open(cls, path: str) -> Transducer:
        return cls(np.memmap(path, dtype=np.uint8, mode="r"))

    @staticmethod
    def compile(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
        """Bytes of the transducer of ``entries`` (distinct words; any order)."""
        entries = sorted(entries)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        # path of unfrozen nodes: [final, [(label, state)...], label that leads on]
        path: list[list] = [[False, [], 0]]
        last = b""
        for word, _ in entries:
            k = 0
            while k < min(len(word), len(last)) and word[k] == last[k]:
                k += 1
            while len(path) > k + 1:
                node = path.pop()
                path[-1][1].append((path[-1][2], freeze(node)))
            for b in word[k:]:
                path[-1][2] = b
                path.append([False, [], 0])
            path[-1][0] = True
            last = word
        while len(path) > 1:
            node = path.pop()
            path[-1][1].append((path[-1][2], freeze(node)))
        root = freeze(path[0])
        below = [0] * len(states)  # words that end at or behind a state; targets are frozen first
        for s, (final, arcs) in enumerate(states):
            below[s] = final + sum(below[t] for _, t in arcs)
        first, target, output, label = [0], [], [], bytearray()
        for final, arcs in states:
            before = int(final)
            for b, t in arcs:
                label.append(b)
                target.append(t)
                output.append(before)
                before += below[t]
            first.append(len(target))
        offset, flat = [0], []
        for _, ids in entries:
            flat += ids
            offset.append(len(flat))
        u4 = lambda x: np.asarray(x, dtype="<u4").tobytes()
        head = struct.pack("<6I", _MAGIC, len(entries), len(states), len(target), len(flat), root)
        return head + u4(first) + u4(target) + u4(output) + u4(offset) + u4(flat) + bytes(label) + bytes(int(f) for f, _ in states)

    def ids_of(self, word: bytes) -> list[int] | None:
        state, number = self.root, 0
        first, label = self.first, self.label
        for b in word:
            lo, hi = int(first[state]), int(first[state + 1])
            while lo < hi:  # arcs are in order of their labels
                mid = (lo + hi) // 2
                if label[mid] < b:
                    lo = mid + 1
                else:
                    hi = mid
            if lo >= int(first[state + 1]) or label[lo] != b:
                return None
            number += int(self.output[lo])
            state = int(self.target[lo])
        if not self.final[state]:
            return None
        return self.ids[int(self.offset[number]) : int(self.offset[number + 1])].tolist()


def frequent_words(docs: DataFrame, text: str, pattern: str, size: int = LEXICON_SIZE) -> list[str]:
    """The ``size`` most frequent words of all texts (bounded by ``size``; ties in order of the word)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        find = regex.compile(pattern).findall
        seen: Counter[str] = Counter()
        for pdf in batches:
            for t in pdf["t"]:
                seen.update(find(t))
            if len(seen) > 200_000:
                yield pd.DataFrame({"w": list(seen), "n": list(seen.values())})
                seen = Counter()
        yield pd.DataFrame({"w": list(seen), "n": list(seen.values())}, columns=["w", "n"])

    words = (
        docs.select(F.col(text).alias("t")).where("length(t) > 0").mapInPandas(count, "w string, n long")
        .where(F.octet_length("w") <= LEXICON_BYTES).groupBy("w").agg(F.sum("n").alias("n"))
        .where("n > 1").orderBy(F.desc("n"), "w").limit(size)
    )
    return [r.w for r in words.select("w").collect()]


class Lexicon:
    """The compiled transducer where every executor finds it."""

    def __init__(self, spark: SparkSession, words: list[str], vocabulary: str, pattern: str):
        ranks = load_ranks(vocabulary)
        data = Transducer.compile((w, merge_word(w, ranks)) for w in {x.encode() for x in words})
        path = shared_path(spark, "lexicon")
        jvm, sc = spark.sparkContext._jvm, spark.sparkContext
        target = jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        sc.addFile(path)
        self.name, self.pattern = path.rpartition("/")[2], pattern
        self.ranks = sc.broadcast(ranks)  # the vocabulary: of fixed size

    def encoder(self) -> Encoder:
        return Encoder(Transducer.open(SparkFiles.get(self.name)), self.ranks.value, self.pattern)


class Encoder:
    """Encodes texts; strings that look like special tokens are ordinary text."""

    def __init__(self, transducer: Transducer, ranks: dict[bytes, int], pattern: str):
        import regex

        self.transducer, self.ranks = transducer, ranks
        self.find = regex.compile(pattern).findall
        self.seen: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        got = self.seen.get(w)
        if got is None:
            raw = w.encode()
            got = self.transducer.ids_of(raw) if len(raw) <= LEXICON_BYTES else None
            if got is None:
                got = merge_word(raw, self.ranks)
            if len(self.seen) >= _CACHE:
                self.seen.clear()
            if len(raw) <= 4 * LEXICON_BYTES:
                self.seen[w] = got
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        seen, word, out = self.seen, self.word, []
        for w in self.find(text):
            out += seen.get(w) or word(w)
        return out


def compile_lexicon(docs: DataFrame, text: str = "text", vocabulary: str | None = None, size: int = LEXICON_SIZE) -> Lexicon:
    """A lexicon of the corpus' frequent words for the vocabulary file at ``vocabulary``."""
    pattern = word_pattern()
    return Lexicon(docs.sparkSession, frequent_words(docs, text, pattern, size), vocabulary or default_vocabulary(), pattern)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", lexicon: Lexicon | None = None, vocabulary: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (list of int) of every row.

    A null or empty text has an empty list; white space is text; very long texts
    are encoded whole; repeated rows stay; extra columns are left out.
    """
    lexicon = lexicon or compile_lexicon(docs, text, vocabulary)
    make = lexicon.encoder

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = make()
        for pdf in batches:
            yield pd.DataFrame({"k": pdf["k"], "ids": [enc.encode(t) for t in pdf["t"]]})

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, ids array<int>")
    return out.select(F.col("k").alias(key), "ids")


def count_tokens(docs: DataFrame, keys: list[str], text: str = "text", lexicon: Lexicon | None = None, vocabulary: str | None = None) -> DataFrame:
    """``keys`` and ``tokens`` (long; 0 for null and empty texts) of every row."""
    lexicon = lexicon or compile_lexicon(docs, text, vocabulary)
    make = lexicon.encoder

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = make()
        for pdf in batches:
            yield pdf.drop(columns="_t").assign(tokens=[len(enc.encode(t)) for t in pdf["_t"]])

    kinds = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, F.col(text).alias("_t")).mapInPandas(run, f"{kinds}, tokens long")
