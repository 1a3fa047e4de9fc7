"""What several text operators share: words, word hashes, n-gram hashes, and postings dealt by hash range."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantweave.shared import materialise, shared_folder

#: Rows that may be sent to every task: a key of 8 bytes and a few small values each.
BROADCAST_ROWS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key as ``doc_id`` and the UTF-8 bytes of the whole text as ``body``; a null text is empty."""
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    )


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS, sized: str | None = None, size: int = 32 << 20) -> DataFrame:
    """A written table, marked for broadcast only if it is small; otherwise Spark shuffles it.

    Small is at most ``rows`` rows and, where ``sized`` names a binary column, at most ``size`` bytes in it.
    """
    if sized is None:
        return F.broadcast(df) if df.count() <= rows else df
    there = df.agg(F.count("*").alias("n"), F.sum(F.octet_length(sized)).alias("size")).first()
    return F.broadcast(df) if there["n"] <= rows and (there["size"] or 0) <= size else df


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class WordHashes(dict):
    """64-bit hash of a word, remembered for the most recent words."""

    KEPT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _weights(count: int) -> np.ndarray:
    """Odd 64-bit weights of the first ``count`` places of a word."""
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * MIX) | np.uint64(1)


BYTE_VALUES = mixed(np.arange(257, 513, dtype=np.uint64) * MIX)
FOLDED_VALUES = np.r_[BYTE_VALUES[:65], BYTE_VALUES[97:123], BYTE_VALUES[91:]]
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
PLACES = _weights(1 << 12)


def word_hashes(body: bytes, fold: bool = False, block: int = 1 << 18) -> np.ndarray:
    """64-bit hash of each word of a text, in order; with ``fold``, A-Z count as a-z.

    A word is a run of bytes other than 0x20 and 0x09 to 0x0D. Its hash adds up the value of each byte times the weight
    of its place. Long texts are read in blocks of whole words, so memory stays near a block or the longest word.
    """
    every = np.frombuffer(body, np.uint8)
    values = FOLDED_VALUES if fold else BYTE_VALUES
    found, begin = [], 0
    while begin < len(every):
        end = begin + block
        while end < len(every):
            gap = np.flatnonzero(SPACE[every[end : end + block]])
            if len(gap):
                end += int(gap[0])
                break
            end += block
        part = every[begin:end]
        begin = end
        inside = ~SPACE[part]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            continue
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        longest = int(sizes.max())
        weights = PLACES if longest <= len(PLACES) else _weights(longest)
        total = np.add.reduceat(values[part[inside]] * weights[place], ends - sizes)
        found.append(mixed(total + sizes.astype(np.uint64) * MIX))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def ngram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; empty if there are fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total = total * MIX + words[place : place + count]
    return mixed(total)


def in_range(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Number of the hash range, of ``parts`` equal ones, that each hash lies in."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def word_count(docs: DataFrame, text: str = "text") -> int:
    """Number of words, estimated at six bytes each."""
    return -(-int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // 6)


def part_count(docs: DataFrame, text: str = "text", words_per_part: int = 1_500_000) -> int:
    """Number of hash ranges so that one holds about ``words_per_part`` words, however large the corpus."""
    return max(2, -(-word_count(docs, text) // words_per_part))


POSTINGS = "part int, docs binary, counts binary, hashes binary"


def postings(
    docs: DataFrame,
    hashes: Callable[[], Callable[[int, bytes], tuple[tuple[int, ...], np.ndarray]]],
    parts: int,
    flush: int = 2_000_000,
) -> DataFrame:
    """Hashes of every document, packed by hash range: a row holds what one task saw of one range.

    ``hashes`` makes, once a task, the function from (document, body) to a name of one or more longs and the hashes.
    Packed rows cost 8 bytes a hash and a little a document, and a task holds at most ``flush`` hashes and a document.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = hashes()
        ids: list[tuple[int, ...]] = []
        held: list[np.ndarray] = []

        def release() -> pa.RecordBatch:
            every = np.concatenate(held)
            owner = np.repeat(np.arange(len(ids)), [len(one) for one in held])
            part = in_range(every, parts)
            order = np.argsort(part, kind="stable")
            every, owner, part = every[order], owner[order], part[order]
            edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist() + [len(part)]
            rows = []
            names = np.array(ids, np.int64)
            for start, end in zip(edges, edges[1:]):
                mine = owner[start:end]
                first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                counts = np.diff(np.r_[first, end - start]).astype(np.uint32)
                rows.append((int(part[start]), names[mine[first]].tobytes(), counts.tobytes(), every[start:end].tobytes()))
            ids.clear()
            held.clear()
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                names=["part", "docs", "counts", "hashes"],
            )

        size = 0
        for batch in batches:
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist()):
                if doc is None:
                    continue
                name, found = of(doc, body)
                if len(found):
                    ids.append(name)
                    held.append(found)
                    size += len(found)
                if size >= flush:
                    yield release()
                    size = 0
        if size:
            yield release()

    return docs.mapInArrow(pack, POSTINGS)


def packed(part: np.ndarray, name: np.ndarray, values: np.ndarray, more: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    """One row for each ``part``, laid out as in ``postings``, with further columns along the values.

    Values of one part and name have to be neighbours.
    """
    order = np.argsort(part, kind="stable")
    part, name, values = part[order], name[order], values[order]
    starts, ends = runs(part)
    change = np.r_[True, (name[1:] != name[:-1]).any(axis=1) | (part[1:] != part[:-1])] if len(part) else np.empty(0, bool)
    first = np.flatnonzero(change)
    counts = np.diff(np.r_[first, len(part)]).astype(np.uint32)
    low, high = np.searchsorted(first, starts), np.searchsorted(first, ends)

    def cut(rows: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> pa.Array:
        return pa.array([rows[x:y].tobytes() for x, y in zip(lows, highs)], pa.binary())

    columns = {
        "part": pa.array(part[starts], pa.int32()),
        "docs": cut(name[first], low, high),
        "counts": cut(counts, low, high),
        "hashes": cut(values, starts, ends),
    }
    return columns | {key: cut(one[order], starts, ends) for key, one in more.items()}


def unpacked(group: pa.Table, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(hash, name) of all packed rows of one range, ordered by hash and then name (of ``width`` longs)."""
    docs, hashes = [], []
    for names, counts, values in zip(*(group.column(name).to_pylist() for name in ("docs", "counts", "hashes"))):
        name = np.frombuffer(names, np.int64).reshape(-1, width)
        docs.append(np.repeat(name, np.frombuffer(counts, np.uint32), axis=0))
        hashes.append(np.frombuffer(values, np.uint64))
    doc, value = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((doc[:, 0], value))
    return value[order], doc[order]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal neighbours."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return starts, np.r_[starts[1:], len(values)]


__all__ = [
    "BROADCAST_ROWS",
    "WordHashes",
    "bounded",
    "in_range",
    "materialise",
    "mixed",
    "ngram_hashes",
    "packed",
    "part_count",
    "postings",
    "runs",
    "scratch",
    "table",
    "texts",
    "unpacked",
    "word_count",
    "word_hashes",
]
