"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the others."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from quantweave.llm.common import texts

#: Pre-tokens whose ids a task remembers.
KEPT = 300_000
WORD = (1 << 64) - 1
STEP = 0x9E3779B97F4A7C15


def _slot(value: int, shift: int, size: int) -> int:
    value = ((value ^ (shift * STEP & WORD)) * 0xBF58476D1CE4E5B9) & WORD
    return ((value >> 32) * size) >> 32


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by rank and a minimal perfect hash over them: one shift a bucket sends each token to a slot of its own."""

    tokens: tuple[bytes, ...]
    shifts: tuple[int, ...]
    slots: tuple[int, ...]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a rank file: a base64 token and its rank a line, the ranks 0, 1, 2, ..."""
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranked = {int(rank): base64.b64decode(token) for token, rank in pairs}
        return cls.of([ranked[rank] for rank in range(len(ranked))])

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        """Hash and displace: buckets in falling size take the first shift that meets only free slots."""
        size = len(tokens)
        count = max(1, size // 4)
        buckets: list[list[tuple[int, int]]] = [[] for _ in range(count)]
        for rank, token in enumerate(tokens):
            value = xxhash.xxh3_64_intdigest(token)
            buckets[value % count].append((value, rank))
        shifts, slots = [0] * count, [-1] * size
        for place in sorted(range(count), key=lambda one: -len(buckets[one])):
            shift = 0
            while buckets[place]:
                goals = [_slot(value, shift, size) for value, _ in buckets[place]]
                if len(set(goals)) == len(goals) and all(slots[goal] < 0 for goal in goals):
                    for goal, (_, rank) in zip(goals, buckets[place]):
                        slots[goal] = rank
                    shifts[place] = shift
                    break
                shift += 1
        return cls(tuple(tokens), tuple(shifts), tuple(slots))

    def rank(self, token: bytes) -> int:
        """Rank of a token, or -1: two array reads and one comparison."""
        value = xxhash.xxh3_64_intdigest(token)
        rank = self.slots[_slot(value, self.shifts[value % len(self.shifts)], len(self.slots))]
        return rank if self.tokens[rank] == token else -1

    @cached_property
    def merges(self) -> dict[bytes, int]:
        """Rank of what two neighbours merge to. A task makes it when it first misses; it is not sent."""
        return {token: rank for rank, token in enumerate(self.tokens)}

    def pieces(self, token: bytes) -> list[int]:
        """Ids of one pre-token. A miss merges its bytes, always the pair of lowest rank and of those the leftmost.

        The bytes form a linked list and the mergeable pairs a heap, so a pre-token of n bytes takes n log n steps. A
        heap entry is one number: rank, left end and right end of a pair. A byte that is merged away ends at 0.
        """
        whole = self.rank(token)
        if whole >= 0:
            return [whole]
        merges, size = self.merges, len(token)
        width = size + 1
        square = width * width
        ends = [*range(1, width), 0]
        before = list(range(-1, size))
        heap = []
        for left in range(size - 1):
            rank = merges.get(token[left : left + 2])
            if rank is not None:
                heap.append(rank * square + left * width + left + 2)
        heapq.heapify(heap)
        while heap:
            left, end = divmod(heapq.heappop(heap) % square, width)
            middle = ends[left]
            if not middle or ends[middle] != end:
                continue
            ends[middle] = 0
            ends[left] = end
            if end < size:
                before[end] = left
                rank = merges.get(token[left : ends[end]])
                if rank is not None:
                    heapq.heappush(heap, rank * square + left * width + ends[end])
            other = before[left]
            if other >= 0:
                rank = merges.get(token[other:end])
                if rank is not None:
                    heapq.heappush(heap, rank * square + other * width + end)
        found, left = [], 0
        while left < size:
            found.append(merges[token[left : ends[left]]])
            left = ends[left]
        return found


class _Memo(dict):
    """Ids of pre-tokens as the bytes of 32-bit numbers, which join faster than lists."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, token: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        found = self[token] = np.array(self.vocabulary.pieces(token.encode()), np.int32).tobytes()
        return found


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text, each match of ``pattern`` encoded separately.

    A null or empty text has no ids; a null key stays null; repeated rows stay; other columns are left out. Bytes that
    are not UTF-8 are read as U+FFFD. No special tokens. The vocabulary has a fixed size and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, split = _Memo(shared.value), regex.compile(pattern)
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                lengths, chunks = [0], []
                for body in part.column("body"):
                    found = split.findall(body.as_py().decode("utf-8", "replace"))
                    chunks.append(b"".join(map(memo.__getitem__, found)))
                    lengths.append(lengths[-1] + len(chunks[-1]) // 4)
                ids = np.frombuffer(b"".join(chunks), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return texts(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of :func:`encode` with ``decoded``, the bytes that the ids stand for; null ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            for start in range(0, len(batch), 512):
                part = batch.slice(start, 512)
                ids = part.column("ids")
                values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
                lows, highs = offsets[:-1], np.where(ids.is_valid().to_numpy(zero_copy_only=False), offsets[1:], offsets[:-1])
                decoded = [b"".join(map(token, values[low:high].tolist())) for low, high in zip(lows, highs)]
                columns = [part.column("doc_id"), ids, pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
