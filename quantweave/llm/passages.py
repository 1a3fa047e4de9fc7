"""Removal of repeated passages: confirmed recurrences become sharded Aho-Corasick automata that find every occurrence."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import POSTINGS, bounded, in_range, materialise, mixed, ngram_hashes, packed, part_count, postings, runs, texts, unpacked, word_hashes

#: Kinds of packed rows that leave a hash range.
WINDOWS, ROUTES = 0, 1
KEPT = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"


def with_first(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``body``, ``same`` (a hash of the body) and ``first``, the smallest key with this text if rows share it.

    A text that a smaller document holds too repeats it whole, so only the first of equal texts has to be searched.
    """
    rows = texts(docs).withColumn("same", F.unhex(F.md5("body")))
    classes = rows.filter("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = materialise(classes.filter("first <> last").drop("last"), "copied")
    return rows.join(bounded(copied), on="same", how="left")


def first_texts(rows: DataFrame) -> DataFrame:
    """``doc_id`` and ``body`` of the rows of ``with_first`` that no smaller document repeats whole."""
    return rows.filter("doc_id is not null and (first is null or first = doc_id)").select("doc_id", "body")


def _dealt(keys: np.ndarray, parts: int) -> np.ndarray:
    return in_range(mixed(np.ascontiguousarray(keys).view(np.uint64)), parts)


def recurring_windows(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """Windows of ``width`` words that start in several documents; the smallest of these owns the window.

    ``rows`` are distinct texts with their keys. Packed rows of two kinds leave a hash range: the windows of each owner,
    dealt by owner, and the distinct owners of each other document's windows, dealt by document. There they are merged
    (``owned_windows``, ``routes_of``), so that however many ranges a pair meets in, one row of it is left.
    """

    def hashes():
        return lambda doc, body: ((doc,), np.unique(ngram_hashes(word_hashes(body), width)))

    def confirm(group: pa.Table) -> pa.Table:
        value, doc = unpacked(group)
        doc = doc[:, 0]
        starts, ends = runs(value)
        # Documents are in order within a window, so the first is the owner and the last tells whether it recurs.
        again = doc[starts] != doc[ends - 1]
        starts, ends = starts[again], ends[again]
        size = ends - starts
        owner = np.repeat(doc[starts], size)
        held = np.repeat(starts - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        pairs = np.unique(np.c_[doc[held], owner], axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        order = np.argsort(doc[starts], kind="stable")
        owner, window = doc[starts][order], value[starts][order]
        both = [
            packed(_dealt(owner, parts), owner[:, None], window, {}) | {"kind": WINDOWS},
            packed(_dealt(pairs[:, 0], parts), pairs[:, :1], pairs[:, 1].view(np.uint64), {}) | {"kind": ROUTES},
        ]
        for one in both:
            one["kind"] = pa.array([one["kind"]] * len(one["part"]), pa.int8())
        return pa.concat_tables([pa.table(one) for one in both])

    found = postings(rows, hashes, parts).groupBy("part").applyInArrow(confirm, f"{POSTINGS}, kind byte")
    return materialise(found, "recurring")


def owned_windows(recurring: DataFrame) -> DataFrame:
    """``doc_id`` of each owner and ``windows``, the hashes of the windows that it owns."""

    def gather(group: pa.Table) -> pa.Table:
        names, counts, values = (b"".join(group.column(one).to_pylist()) for one in ("docs", "counts", "hashes"))
        owner = np.repeat(np.frombuffer(names, np.int64), np.frombuffer(counts, np.uint32))
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], np.frombuffer(values, np.uint64)[order]
        starts, ends = runs(owner)
        return pa.table({"doc_id": owner[starts], "windows": pa.array([value[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})

    rows = recurring.filter(F.col("kind") == WINDOWS).drop("kind")
    return materialise(rows.groupBy("part").applyInArrow(gather, "doc_id long, windows binary"), "marks")


def routes_of(recurring: DataFrame) -> DataFrame:
    """``doc_id`` and ``owner``, once for each owner of a window of another document."""

    def merge(group: pa.Table) -> pa.Table:
        owner, doc = unpacked(group)
        new = np.r_[True, (owner[1:] != owner[:-1]) | (doc[1:, 0] != doc[:-1, 0])]
        return pa.table({"doc_id": doc[new, 0], "owner": owner[new].view(np.int64)})

    rows = recurring.filter(F.col("kind") == ROUTES).drop("kind")
    return rows.groupBy("part").applyInArrow(merge, "doc_id long, owner long")


def confirmed_passages(rows: DataFrame, recurring: DataFrame, width: int = 13) -> DataFrame:
    """Passages of the owners: ``owner`` and ``passage`` (words joined by a space), maximal runs of windows they own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, found = [], []
            for owner, body, blob in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "body", "windows"))):
                own = np.unique(np.frombuffer(blob, np.uint64))
                text = body.split()
                value, first = np.unique(ngram_hashes(word_hashes(body), width), return_index=True)
                place = np.sort(first[np.isin(value, own, assume_unique=True)])
                starts, ends = runs(place - np.arange(len(place)))
                for start, end in zip(place[starts].tolist(), (place[ends - 1] + width).tolist() if len(place) else ()):
                    owners.append(owner)
                    found.append(b" ".join(text[start:end]))
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(found, pa.binary())], names=["owner", "passage"])

    marks = owned_windows(recurring)
    owners = rows.join(bounded(marks.select("doc_id")), on="doc_id", how="left_semi")
    rows = owners.join(marks, on="doc_id").select("doc_id", "body", "windows")
    return materialise(rows.mapInArrow(run, "owner long, passage binary").distinct(), "passages")


class Matcher:
    """Automaton over words. Of each passage every block of (width + 1) // 2 words is a pattern.

    A word is written as a few characters of 64 values each, a value's place in the word showing in the character, so
    that patterns match at word bounds only and a node has at most 64 children (a node's children are searched in turn).

    Any window of ``width`` words of a passage holds a whole block, so each window's occurrences show up as hits, which
    are then extended word by word in both directions. A block at more than ``places`` places, as in a phrase that
    many passages quote, is replaced by the whole windows that hold it: a window has one owner, so that it has few
    places however common its block is.
    """

    def __init__(self, passages: list[tuple[int, bytes]], width: int, places: int = 6) -> None:
        self.width = width
        block = (width + 1) // 2
        self.numbers: dict[bytes, int] = {}
        self.owners = [owner for owner, _ in passages]
        self.words = []
        blocks: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        kept = []
        for number, (_, passage) in enumerate(passages):
            own = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in passage.split()]
            kept.append(own)
            self.words.append(np.array(own, np.int32))
            for start in range(0, len(own) - block + 1, block):
                blocks.setdefault(tuple(own[start : start + block]), []).append((number, start))
        patterns: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for pattern, found in blocks.items():
            if len(found) <= places:
                patterns[pattern] = found
                continue
            for number, start in found:
                own = kept[number]
                for first in range(max(0, start + block - width), min(start, len(own) - width) + 1):
                    patterns.setdefault(tuple(own[first : first + width]), []).append((number, first))
        self.digits = 1
        while 64**self.digits <= len(self.numbers):
            self.digits += 1
        codes = [self._code(number) for number in range(len(self.numbers) + 1)]
        self.codes = {word: codes[number] for word, number in self.numbers.items()}
        self.unknown = codes[0]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for pattern, found in patterns.items():
            # The longest passage first: what it covers need not be looked at again.
            found.sort(key=lambda place: -len(kept[place[0]]))
            self.automaton.add_word("".join([codes[number] for number in pattern]), (len(pattern), found))
        self.automaton.make_automaton()

    def _code(self, number: int) -> str:
        return "".join(chr(48 + 64 * place + (number >> 6 * place) % 64) for place in range(self.digits))

    def spans(self, doc: int, text: list[bytes]) -> list[tuple[int, int]]:
        """Word ranges of ``width`` words or more that a passage of a smaller document holds too."""
        zeros = [0] * len(text)
        here = np.fromiter(map(self.numbers.get, text, zeros), np.int32, len(text))
        coded = "".join(map(self.codes.get, text, [self.unknown] * len(text)))
        done: dict[tuple[int, int], int] = {}
        found = []
        low_end, high_end = 0, 0
        for at, (length, places) in self.automaton.iter(coded):
            last = at // self.digits
            first = last - length + 1
            # All windows that hold this pattern, which lie in this range, may have been found already.
            margin = self.width - length
            if max(0, first - margin) >= low_end and min(len(here), last + 1 + margin) <= high_end:
                continue
            for number, offset in places:
                shift = first - offset
                if self.owners[number] >= doc or done.get((number, shift), -1) > first:
                    continue
                passage = self.words[number]
                low, high = max(0, -shift), min(len(passage), len(here) - shift)
                differ = np.flatnonzero(passage[low:high] != here[low + shift : high + shift]) + low
                side = int(differ.searchsorted(offset))
                left = differ[side - 1] + 1 if side else low
                right = differ[side] if side < len(differ) else high
                done[number, shift] = int(right + shift)
                if right - left >= self.width:
                    start, end = int(left + shift), int(right + shift)
                    found.append((start, end))
                    if start > high_end or end < low_end:
                        low_end, high_end = start, end
                    else:
                        low_end, high_end = min(low_end, start), max(high_end, end)
                    if max(0, first - margin) >= low_end and min(len(here), last + 1 + margin) <= high_end:
                        break
        return found


def occurrences(rows: DataFrame, recurring: DataFrame, passages: DataFrame, width: int, shard_bytes: int, shard_docs: int) -> DataFrame:
    """``doc_id``, ``same`` (a hash of the body) and ``spans`` (word ranges to remove) of every document with repeats.

    Passages are dealt into shards of about ``shard_bytes`` by their owner; a document is streamed through the
    automata of exactly the shards that hold a window of it. A shard with more than ``shard_docs`` documents is
    split, its automaton being built in each part.
    """
    total = passages.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    shards = max(2, -(-int(total) // shard_bytes))
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int").alias("shard")
    routes = materialise(routes_of(recurring).select("doc_id", shard).distinct(), "routes")
    salts = routes.groupBy("shard").agg(F.ceil(F.count("*") / shard_docs).cast("int").alias("salts"))
    salts = bounded(materialise(salts, "salts"))
    salted = routes.join(salts, on="shard").select("doc_id", "shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), "salts").cast("int").alias("salt"))
    salted = bounded(materialise(salted, "salted"))
    sent = rows.join(salted, on="doc_id").select("shard", "salt", "doc_id", "body")
    built = passages.withColumn("shard", shard).join(salts, on="shard")
    built = built.select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "owner", "passage")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        matcher = Matcher(list(zip(left.column("owner").to_pylist(), left.column("passage").to_pylist())), width)
        ids, sames, spans = [], [], []
        for doc, body in zip(right.column("doc_id").to_pylist(), right.column("body")):
            body = body.as_py()
            found = matcher.spans(doc, body.split())
            if found:
                ids.append(doc)
                sames.append(hashlib.md5(body).digest())
                spans.append(np.array(_merged(found), np.int32).tobytes())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "same": pa.array(sames, pa.binary()), "spans": pa.array(spans, pa.binary())})

    found = built.groupBy("shard", "salt").cogroup(sent.groupBy("shard", "salt")).applyInArrow(search, "doc_id long, same binary, spans binary")
    gathered = found.distinct().groupBy("doc_id", "same").agg(F.array_join(F.collect_list(F.hex("spans")), "").alias("spans"))
    return materialise(gathered.withColumn("spans", F.unhex("spans")), "spans")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return [tuple(one) for one in joined]


def remove_repeats(docs: DataFrame, width: int = 13, shard_bytes: int = 4 << 20, shard_docs: int = 4000, parts: int | None = None) -> DataFrame:
    """Each document without the words that a window of a smaller document covers.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words joined by a space) and its ``kept_sha256``. Windows
    are judged on the input. A null text has no words; texts under ``width`` words are kept whole; rows with a null
    key take no part and are returned whole; rows with equal keys are one document, of which each text is judged by
    itself against smaller keys. Other columns are left out.
    """
    rows = with_first(docs)
    first = first_texts(rows)
    recurring = recurring_windows(first, width, parts or part_count(docs))
    passages = confirmed_passages(first, recurring, width)
    spans = occurrences(first, recurring, passages, width, shard_bytes, shard_docs)
    rows = rows.join(bounded(spans, sized="spans"), on=["doc_id", "same"], how="left")
    rows = rows.select("doc_id", "body", "spans", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).alias("copy"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 512):
                part = batch.slice(begin, 512)
                counts, removed, kept, digests = [], [], [], []
                for body, blob, copy in zip(*(part.column(name) for name in ("body", "spans", "copy"))):
                    words, blob = body.as_py().split(), blob.as_py()
                    counts.append(len(words))
                    if copy.as_py() and len(words) >= width:
                        words = []
                    elif blob:
                        place, left = 0, []
                        for start, end in _merged(np.frombuffer(blob, np.int32).reshape(-1, 2).tolist()):
                            left += words[place:start]
                            place = end
                        words = left + words[place:]
                    removed.append(counts[-1] - len(words))
                    kept.append(b" ".join(words))
                    digests.append(hashlib.sha256(kept[-1]).hexdigest())
                arrays = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
                arrays += [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digests)]
                yield pa.RecordBatch.from_arrays(arrays, names=[one.split()[0] for one in KEPT.split(", ")])

    return rows.mapInArrow(cut, KEPT)
