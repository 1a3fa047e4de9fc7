"""Phrase collocations: phrases are counted level by level in tries whose full subtrees Spark merges by prefix.

A phrase is an edge of a trie of word ids: a prefix (all words but the last) and its last word. Every task counts edges
in :class:`PhraseTrie`, sends whole subtrees on as sorted runs when its budget is used up, and Spark adds the runs up by
prefix and last word, so that a prefix that holds much of the corpus is dealt by its last words. A phrase can only be
frequent if both its parts of one word less are, so each level is counted where a bit table of the level before allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantweave.llm.common import MIX, materialise, mixed, runs, scratch

#: What ends a piece (and, with blanks and tabs, a word). A byte that UTF-8 never uses marks the place.
PIECE_END, MARK = b".,;:!?\x0a\x0b\x0c\x0d", 0xFF
FOLD = bytes(MARK if one in PIECE_END else one + 32 if 65 <= one <= 90 else one for one in range(256))
#: Bit tables have 32 bits a frequent phrase, and at most this many, which is the most that is ever broadcast (32 MB).
TABLE_BITS = 28
WORD_ROWS = 300_000
EDGE = "prefix long, last long, n long"


def pieces(text: str | None) -> list[bytes]:
    """Words of the whole text, A-Z in lower case, with a mark wherever a piece ends."""
    return (text or "").encode().translate(FOLD).replace(b"\xff", b" \xff ").split()


class WordIds:
    """Word ids within each language: 64 bits, never 0 but for the mark. Ids of the words last seen are remembered."""

    KEPT = 300_000

    def __init__(self):
        self.known: dict[str, dict[bytes, int]] = {}
        self.size = 0

    @staticmethod
    def one(word: bytes, seed: int) -> int:
        return 0 if word == b"\xff" else xxhash.xxh3_64_intdigest(word, seed) | 1

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        if self.size > self.KEPT:
            self.known.clear()
            self.size = 0
        known, seed = self.known.setdefault(lang, {}), xxhash.xxh3_64_intdigest(lang.encode())
        for word in words:
            if word not in known:
                known[word] = self.one(word, seed)
                self.size += 1
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple]:
    """(text, lang) of all rows, a few made at a time, as texts may be long."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield from zip(part.column("text").to_pylist(), part.column("lang").to_pylist())


class BitTable:
    """Which ids may be frequent: never wrong about one that is, and the larger the rarer wrong about the others."""

    def __init__(self, slots: np.ndarray, words: np.ndarray, bits: int):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[slots] = words

    def has(self, ids: np.ndarray) -> np.ndarray:
        place = ids >> np.uint64(64 - self.bits)
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bit_table(frequent: DataFrame, id_column: str) -> BitTable:
    """Bits of all ids, set by Spark: at most 2 ** (TABLE_BITS - 6) rows reach the driver, however many ids there are."""
    bits = min(TABLE_BITS, max(10, (32 * frequent.count()).bit_length()))
    place = F.shiftrightunsigned(id_column, 64 - bits)
    slots = frequent.select(F.shiftright(place, 6).alias("slot"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    found = slots.groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")).toArrow()
    words = found.column("word").to_numpy().view(np.uint64)
    return BitTable(found.column("slot").to_numpy(), words, bits)


class Container:
    """Array hash of one node: entries (prefix, last) with counts in contiguous arrays, made unique when it is full."""

    def __init__(self, depth: int):
        self.depth, self.parts, self.size, self.unique = depth, [], 0, 0

    def add(self, entries: np.ndarray) -> None:
        self.parts.append(entries)
        self.size += len(entries)

    def compact(self) -> np.ndarray:
        """The entries in order, each once with its count added up."""
        rows = np.concatenate(self.parts)
        rows = rows[np.lexsort((rows["last"], rows["prefix"]))]
        starts, _ = runs(rows["prefix"])
        new = np.zeros(len(rows), bool)
        new[starts] = True
        new[1:] |= rows["last"][1:] != rows["last"][:-1]
        first = np.flatnonzero(new)
        once = rows[first]
        once["n"] = np.add.reduceat(rows["n"], first)
        self.parts, self.size, self.unique = [once], len(once), len(once)
        return once


ENTRY = np.dtype([("prefix", np.uint64), ("last", np.uint64), ("n", np.int64)])


class PhraseTrie:
    """Counts of phrases under a shallow trie over the bytes of prefix ids, within a budget of entries.

    A node is a container until it holds more than ``burst`` unique entries; then it bursts into up to 256 children by
    the next byte of the prefix id. When all containers together hold more than ``budget`` entries, the largest subtrees
    of the root go out whole, as sorted runs, until half of the budget is free.
    """

    def __init__(self, burst: int = 1 << 16, budget: int = 1 << 21):
        self.burst, self.budget, self.size = burst, budget, 0
        self.root: dict[int, Container | dict] = {}

    def add(self, prefix: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
        rows = np.empty(len(prefix), ENTRY)
        rows["prefix"], rows["last"], rows["n"] = prefix, last, 1
        self._deal(self.root, 0, rows)
        if self.size > self.budget:
            yield from self._spill()

    def _deal(self, node: dict, depth: int, rows: np.ndarray) -> None:
        digit = (rows["prefix"] >> np.uint64(56 - 8 * depth)).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        rows, digit = rows[order], digit[order]
        for start, end in zip(*(edge.tolist() for edge in runs(digit))):
            key, part = int(digit[start]), rows[start:end]
            child = node.setdefault(key, Container(depth + 1))
            if isinstance(child, dict):
                self._deal(child, depth + 1, part)
                continue
            child.add(part)
            self.size += len(part)
            if child.size > max(self.burst, 2 * child.unique):
                self.size -= child.size
                once = child.compact()
                if len(once) > self.burst and child.depth < 8:
                    node[key] = {}
                    self._deal(node[key], depth + 1, once)
                else:
                    self.size += child.size

    def _runs(self, node: Container | dict) -> Iterator[np.ndarray]:
        """A subtree in order."""
        if isinstance(node, dict):
            for key in sorted(node):
                yield from self._runs(node[key])
        else:
            yield node.compact()

    @staticmethod
    def _held(node: Container | dict) -> int:
        return sum(map(PhraseTrie._held, node.values())) if isinstance(node, dict) else node.size

    def _spill(self) -> Iterator[np.ndarray]:
        held = {key: self._held(node) for key, node in self.root.items()}
        for key in sorted(held, key=held.get, reverse=True):
            if self.size <= self.budget // 2:
                break
            self.size -= held[key]
            yield from self._runs(self.root.pop(key))

    def close(self) -> Iterator[np.ndarray]:
        for key in sorted(self.root):
            yield from self._runs(self.root[key])
        self.root, self.size = {}, 0


def count_words(docs: DataFrame) -> DataFrame:
    """``lang``, ``word``, its ``id`` and the number ``n`` of its occurrences in all texts of the language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}
        size = 0

        def release() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                counts.pop(b"\xff", None)
                words, seed = list(counts), xxhash.xxh3_64_intdigest(lang.encode())
                key = np.fromiter((WordIds.one(word, seed) for word in words), np.uint64, len(words)).view(np.int64)
                for at in range(0, len(words), 50_000):
                    part = slice(at, at + 50_000)
                    texts = [word.decode() for word in words[part]]
                    columns = [[lang] * len(texts), texts, key[part], [counts[word] for word in words[part]]]
                    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(*one) for one in zip(columns, kinds)], names=["lang", "word", "id", "n"])
            held.clear()

        for text, lang in small(batches):
            counts = held.setdefault(lang, {})
            before = len(counts)
            for word in pieces(text):
                counts[word] = counts.get(word, 0) + 1
            size += len(counts) - before
            if size > WORD_ROWS:
                yield from release()
                size = 0
        yield from release()

    counted = docs.mapInArrow(count, "lang string, word string, id long, n long")
    return counted.groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def coded(docs: DataFrame, table) -> DataFrame:
    """The ids of each text's words in order, as one binary; 0 for words that are not frequent, ends of pieces and the end."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rows, size = WordIds(), [], 0
        for text, lang in small(batches):
            ids = known.of(lang, pieces(text) + [b"\xff"])
            ids[~table.value.has(ids)] = 0
            inside = ids != 0
            if (inside[1:] & inside[:-1]).any():
                # Neighbouring zeros say no more than one.
                rows.append(ids[inside | np.r_[True, inside[:-1]]].tobytes())
                size += len(rows[-1])
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])
                rows, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    return docs.mapInArrow(code, "ids binary")


def longer(codes: DataFrame, size: int, table, least: int, burst: int, budget: int) -> DataFrame:
    """Phrases of ``size`` words in at least ``least`` places: ``prefix``, ``last``, ``id`` and ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PhraseTrie(burst, budget)

        def sent(run: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(run), 1 << 16):
                part = run[at : at + (1 << 16)]
                columns = [pa.array(np.ascontiguousarray(part[name]).view(np.int64)) for name in ("prefix", "last", "n")]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "last", "n"])

        for batch in batches:
            for words in _stretches(batch.column("ids"), size - 1):
                prefix, inside = words, words != 0
                for length in range(2, size):
                    prefix, inside = phrase_id(prefix[:-1], words[length - 1 :]), inside[:-1] & (words[length - 1 :] != 0)
                good = np.zeros(len(inside), bool)
                good[inside] = table.value.has(prefix[inside])
                at = np.flatnonzero(good[:-1] & good[1:])
                for run in trie.add(prefix[at], words[at + size - 1]):
                    yield from sent(run)
        for run in trie.close():
            yield from sent(run)

    # Rows of one prefix lie side by side and so take little room; a prefix is dealt over salts, by ranges of last words.
    salts = max(4, int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 32)
    salt = F.shiftright(F.shiftrightunsigned("last", 48) * salts, 16)
    edges = codes.mapInArrow(count, EDGE).withColumn("salt", salt).repartition("prefix", "salt")
    merged = edges.groupBy("prefix", "salt", "last").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return merged.select("prefix", "last", "n").mapInArrow(_named, EDGE + ", id long")


def _stretches(ids: pa.BinaryArray, overlap: int, length: int = 1 << 18) -> Iterator[np.ndarray]:
    """The ids of all texts, which end with 0 each, in stretches that share ``overlap`` ids, without copying them."""
    if not len(ids):
        return
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(ids.type) else np.int32)[ids.offset : ids.offset + len(ids) + 1]
    words = np.frombuffer(data, np.uint64, (int(ends[-1]) - int(ends[0])) // 8, int(ends[0])) if ends[-1] > ends[0] else np.empty(0, np.uint64)
    for at in range(0, len(words), length):
        yield words[at : at + length + overlap]


def phrase_id(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Id of the phrase that adds a word to a prefix."""
    return mixed(prefix * MIX + last)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prefix, last = (batch.column(name).to_numpy().view(np.uint64) for name in ("prefix", "last"))
        yield batch.append_column("id", pa.array(phrase_id(prefix, last).view(np.int64)))


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 5,
    least: int = 100,
    burst: int = 1 << 16,
    budget: int = 1 << 21,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that stand in at least ``least`` places of their language, and word totals.

    The first table has ``lang``, ``words`` (array) and ``f``, the second ``lang`` and ``n``. A null text is empty, a
    null language is ``und``; rows count as often as they are there, and other columns play no part. Ids of words and
    phrases are 64-bit hashes; a phrase is told apart by two of them (prefix and last word).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    # Words that are not frequent only matter in the totals, so they are written as one row a language.
    often = lambda name: F.when(F.col("n") >= least, F.col(name)).alias(name)
    words = materialise(count_words(rows).groupBy("lang", often("word"), often("id")).agg(F.sum("n").alias("n")), "words")
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    level = words.filter(F.col("id").isNotNull())
    table = spark.sparkContext.broadcast(bit_table(level, "id"))
    path = scratch(spark, "codes")
    coded(rows, table).write.option("compression", "zstd").parquet(path)
    codes = spark.read.schema("ids binary").parquet(path)
    known = level.select("id", "lang", F.array("word").alias("words"), F.col("n").alias("f"))
    last = level.select(F.col("id").alias("last"), "word")
    found = [known]
    for size in range(2, longest + 1):
        edges = materialise(longer(codes, size, table, least, burst, budget), "edges")
        table = spark.sparkContext.broadcast(bit_table(edges, "id"))
        before = found[-1].select(F.col("id").alias("prefix"), "lang", "words")
        named = edges.join(before, "prefix").join(last, "last")
        named = named.select("id", "lang", F.concat("words", F.array("word")).alias("words"), F.col("n").alias("f"))
        found.append(materialise(named, "phrases"))
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every.select("lang", "words", "f"), totals


def collocations(docs: DataFrame, top: int | None = 2000, **options) -> DataFrame:
    """Phrases of two and more words that stand together more often than their parts suggest.

    ``lang``, ``rank``, ``phrase``, ``words``, ``a`` (its places), ``l`` and ``r`` (places of the two parts at the
    weakest cut), ``n`` (words of the language) and ``score`` = floor(1000 a n / (l r)). A phrase that only ever stands
    within one longer phrase is left out. ``top`` is how many each language reports, by score, places and phrase; None
    reports all. Options and special cases are those of :func:`frequent_phrases`; without texts there are no rows.
    """
    every, totals = frequent_phrases(docs, **options)
    joined = lambda words: F.array_join(words, " ")
    counted = materialise(every.select("lang", joined("words").alias("part"), "f"), "counted")
    long = every.filter(F.size("words") > 1)
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("words") - 1),
        lambda k: F.struct(k.alias("k"), joined(F.slice("words", F.lit(1), k)).alias("first"), joined(F.slice("words", k + 1, F.size("words"))).alias("rest")),
    )
    cut = long.select("lang", "words", joined("words").alias("phrase"), F.col("f").alias("a"), F.inline(cuts))
    cut = cut.join(counted.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(counted.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cut = cut.join(totals, "lang").withColumn("score", _score())
    weakest = cut.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A phrase within any longer one with as many places is also within one that is a single word longer.
    inner = F.array(joined(F.slice("words", F.lit(1), F.size("words") - 1)), joined(F.slice("words", F.lit(2), F.size("words"))))
    within = long.select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("a")).distinct()
    free = weakest.join(within, ["lang", "phrase", "a"], "left_anti")
    rows = free.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked if top is None else ranked.filter(F.col("rank") <= top)


def _score() -> Column:
    """floor(1000 a n / (l r)) in decimals: exact up to 10 ** 17 words a language."""
    a, n, left, right = (F.col(name).cast("decimal(17,0)") for name in ("a", "n", "l", "r"))
    above = (a * n).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), (left * right).cast("decimal(34,0)")).cast("long")
