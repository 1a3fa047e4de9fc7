"""Benchmark decontamination: n-gram seeds join training texts to test items, a bound rules pairs out, Smith-Waterman scores the rest."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import WordHashes, materialise, ngram_hashes, runs, texts

STRIPPED = string.punctuation.encode()
FOUND = "doc_id long, item_id long, score double, first_word int, last_word int"
MATCH, MISMATCH, GAP = 2, -1, 1
#: Items of so few words have single words as seeds.
SHORT = 8


class PlainHashes(WordHashes):
    """Hash of a word without punctuation at its ends, remembered by the word as it stands; 0 if nothing is left."""

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(STRIPPED)
        if plain == word:
            return super().__missing__(word)
        value = self[plain] if plain else 0
        self[word] = value
        return value

    def plain(self, body: bytes) -> np.ndarray:
        """Hashes of the words of a text in lower case; words of punctuation only are left out."""
        found = self.of(body.lower().split())
        return found[found != 0]


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and the range of ``text`` it covers.

    A row is one step: of the gaps inside ``text``, a running maximum gives the best.
    """
    width = len(text)
    slope = GAP * np.arange(width + 1)
    row, begin = np.zeros(width + 1, np.int64), np.arange(width + 1)
    best = (0, 0, 0)
    for word in item:
        cross = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        above = row[1:] - GAP
        value = np.r_[0, np.maximum(np.maximum(cross, above), 0)]
        origin = np.r_[0, np.where(cross >= above, begin[:-1], begin[1:])]
        origin[value == 0] = np.flatnonzero(value == 0)
        lifted = value + slope
        peak = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == peak, np.arange(width + 1), 0))
        row = peak - slope
        begin = np.where(row > 0, origin[source], np.arange(width + 1))
        row = np.maximum(row, 0)
        place = int(row.argmax())
        if row[place] > best[0]:
            best = (int(row[place]), int(begin[place]), place)
    return best


class Seeds:
    """Seed n-grams of a block of items, ordered by hash, with the items they come from."""

    def __init__(self, items: list[tuple[int, np.ndarray]], size: int) -> None:
        self.items = items
        width = [1 if len(words) <= SHORT else size for _, words in items]
        grams = [np.unique(ngram_hashes(words, n)) for (_, words), n in zip(items, width)]
        item = np.repeat(np.arange(len(items)), [len(one) for one in grams])
        value = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(value, kind="stable")
        value, self.item = value[order], item[order]
        starts, ends = runs(value)
        self.value, self.start, self.count = value[starts], starts, ends - starts
        self.sizes = sorted({n for (_, words), n in zip(items, width) if len(words)})
        self.length = np.array([len(words) for _, words in items], np.int64)
        self.first = np.r_[0, np.cumsum(self.length)]
        every = np.concatenate([words for _, words in items]) if items else np.empty(0, np.uint64)
        self.words, self.own = np.unique(every, return_inverse=True)

    def numbered(self, words: np.ndarray) -> np.ndarray:
        """The place of each word among the words of the items, or one past them."""
        at = np.searchsorted(self.words, words)
        at[at < len(self.words)] += (self.words[at[at < len(self.words)]] != words[at < len(self.words)]) * len(self.words)
        return np.minimum(at, len(self.words))

    def matched(self, numbers: np.ndarray, there: np.ndarray) -> np.ndarray:
        """How many words of each item are there."""
        size = self.length[numbers]
        begin = np.r_[0, np.cumsum(size)[:-1]]
        slot = np.repeat(self.first[numbers] - begin, size) + np.arange(size.sum())
        return np.add.reduceat(there[self.own[slot]].astype(np.int64), begin)

    def items_in(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the items with a seed in the text, in order."""
        if not len(self.value):
            return np.empty(0, np.int64)
        there = np.zeros(len(self.value), bool)
        for size in self.sizes:
            grams = ngram_hashes(words, size)
            low = np.minimum(np.searchsorted(self.value, grams), len(self.value) - 1)
            there[low[self.value[low] == grams]] = True
        at = np.flatnonzero(there)
        count = self.count[at]
        slot = np.repeat(self.start[at] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        return np.unique(self.item[slot])


def align(seeds: Seeds, words: np.ndarray, least: float) -> list[tuple[int, float, int, int]]:
    """(item number, score, first and last word) of the best alignment of each item with a seed that reaches ``least``.

    A text word that the item lacks costs one wherever an alignment covers it, so the largest sum of a stretch, with
    two for each word that the item has, bounds the score of what ends there. Where the bound stays below, no alignment
    can reach ``least``; an alignment that does covers at most three times the item's words.
    """
    found = []
    numbers = seeds.items_in(words)
    if not len(numbers):
        return found
    own = seeds.numbered(words)
    worth = np.full(len(seeds.words) + 1, -GAP, np.int64)
    there = np.zeros(len(seeds.words) + 1, bool)
    there[own] = True
    numbers = numbers[MATCH * seeds.matched(numbers, there) >= least * MATCH * seeds.length[numbers]]
    for number in numbers.tolist():
        item = seeds.items[number][1]
        need = least * MATCH * len(item)
        held = seeds.own[seeds.first[number] : seeds.first[number + 1]]
        worth[held] = MATCH
        value = worth[own]
        worth[held] = -GAP
        total = np.r_[0, np.cumsum(value)]
        ends = np.flatnonzero((total - np.minimum.accumulate(total))[1:] >= need)
        if not len(ends):
            continue
        reach, best = 3 * len(item), (0.0, 0, 0)
        for part in np.split(ends, np.flatnonzero(np.diff(ends) > reach) + 1):
            low, high = max(0, int(part[0]) + 1 - reach), int(part[-1]) + 1
            for start in range(low, high, 2048):  # a long stretch is aligned in overlapping pieces
                score, first, last = smith_waterman(item, words[start : min(high, start + 2048 + reach)])
                if score / (MATCH * len(item)) > best[0]:
                    best = (score / (MATCH * len(item)), start + first, start + last)
        if best[0] >= least:
            found.append((number, *best))
    return found


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 2, least: float = 0.5, block: int = 50_000
) -> DataFrame:
    """Documents that hold a benchmark item or an edited copy: ``doc_id``, ``item_id``, ``score``, ``first_word``, ``last_word``.

    ``score`` is the Smith-Waterman score over that of a perfect copy; rows reach ``least``. Words are compared in lower
    case without outer punctuation. Seeds are all of an item's n-grams of ``size`` words, however frequent, or its single
    words if it has at most ``SHORT``; every text with one is scored unless a bound shows that it can't reach ``least``.
    So with ``size`` 2 only copies are missed in which no two neighbouring words of a longer item are left side by side.
    Items are broadcast in blocks of at most about ``block`` items; documents never move. Items without words, null texts and empty texts match nothing;
    rows with a null key are left out; equal rows give equal rows; other columns are left out.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    items = items.filter("item_id is not null")
    blocks = max(1, -(-items.count() // block))
    rows = texts(docs).filter("doc_id is not null")
    found = None
    for number in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).orderBy("item_id").collect()
        hashes = PlainHashes()
        seeds = Seeds([(row["item_id"], hashes.plain(row["body"])) for row in part], size)
        one = _aligned(rows, spark.sparkContext.broadcast(seeds), least)
        found = one if found is None else found.unionByName(one)
    return found


def _aligned(rows: DataFrame, seeds, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PlainHashes()
        for batch in batches:
            held = []
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body")):
                words = hashes.plain(body.as_py())
                for number, score, first, last in align(seeds.value, words, least):
                    held.append((doc, seeds.value.items[number][0], score, first, last))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
            columns = list(zip(*held)) or [()] * 5
            names = [one.split()[0] for one in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return rows.mapInArrow(run, FOUND)


def without_contamination(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents, with all their columns, whose text holds no item (see :func:`find_contamination`).

    Every row is judged by its own text (a 64-bit hash of it stands for it), so rows with null or repeated keys are too.
    """
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    found = find_contamination(docs.select(mark.alias("doc_id"), "text"), benchmark, **settings)
    bad = materialise(found.select(F.col("doc_id").alias("_mark")).distinct(), "contaminated")
    return docs.withColumn("_mark", mark).join(bad, on="_mark", how="left_anti").drop("_mark")
