"""Language-model scoring by an Elias-Fano n-gram trie in memory-mapped shards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import WordHashes, in_range, materialise, runs, scratch, texts
from quantweave.llm.elias_fano import EliasFano
from quantweave.llm.warc import store

PACKED = "part int, keys binary, counts binary"
SHARD = "level int, part int, path string, entries long, tokens long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
#: Log probabilities are kept in 255 steps of 0.04, from 0 down to -10.2.
STEP = 0.04
#: Tokens that a chunk of texts holds, or those of one longer text; and bytes of text split at a time.
TOKENS_AT_ONCE = 1_000_000
BYTES_AT_ONCE = 4 << 20
#: Chunks that a task takes where there are many, so that it opens the shards once for all of them.
CHUNKS_A_TASK = 16
#: Training tokens whose n-grams a shard holds.
TOKENS_PER_PART = 1_500_000
CHUNKS = "path string, tokens long, trained long"


def held_out(key: Column) -> Column:
    """The documents that training leaves out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def quantised(value: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-value / STEP), 0, 255).astype(np.uint8)


def save_shard(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write named arrays one after the other, each at a multiple of 8 bytes, behind a list of names, types and sizes."""
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    path = f"{folder}/{uuid.uuid4().hex}.trie"
    head = ";".join(f"{name},{array.dtype.str},{len(array)}" for name, array in arrays.items()).encode()
    head = len(head).to_bytes(8, "little") + head
    with files.open_output_stream(store(path)[1], compression=None) as out:
        out.write(head + b"\0" * (-len(head) % 8))
        for array in arrays.values():
            raw = np.ascontiguousarray(array).tobytes()
            out.write(raw + b"\0" * (-len(raw) % 8))
    return path


def load_shard(path: str) -> dict[str, np.ndarray]:
    """The arrays of a shard: memory-mapped where the shared folder is a mounted one, read otherwise."""
    files, name = store(path)
    if isinstance(files, pa.fs.LocalFileSystem):
        raw = np.memmap(name, np.uint8, "r")
    else:
        with files.open_input_file(name) as source:
            raw = np.frombuffer(source.read_buffer(), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    at = 8 + size + (-(8 + size) % 8)
    arrays = {}
    for one in raw[8 : 8 + size].tobytes().decode().split(";"):
        label, kind, count = one.split(",")
        length = int(count) * np.dtype(kind).itemsize
        arrays[label] = raw[at : at + length].view(kind)
        at += length + (-length % 8)
    return arrays


def narrow(count: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs, up to four."""
    return count.astype(np.min_scalar_type(int(np.minimum(count.max(initial=0), 0xFFFFFFFF))))


def coded(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{name}{place}": array for place, array in enumerate(EliasFano.arrays(values))}


def sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano(*(arrays[f"{name}{place}"] for place in range(5)))


class Level:
    """One level in shards; entries have global numbers, shard by shard. Shards are opened when first used."""

    def __init__(self, shards: list[tuple[int, str, int]], parents: int, parts: int) -> None:
        self.paths = {part: path for part, path, _ in shards}
        sizes = np.zeros(parts, np.int64)
        for part, _, entries in shards:
            sizes[part] = entries
        self.offsets = np.r_[0, np.cumsum(sizes)]
        self.parents, self.parts = parents, parts
        self.open: dict[int, dict] = {}

    @property
    def size(self) -> int:
        return int(self.offsets[-1])

    def shard(self, part: int) -> dict:
        if part not in self.open:
            arrays = load_shard(self.paths[part])
            self.open[part] = arrays | {"ids": sequence(arrays, "ids")} | ({"ptr": sequence(arrays, "ptr")} if "ptr0" in arrays else {})
        return self.open[part]

    def part_of(self, parent: np.ndarray) -> np.ndarray:
        return parent * self.parts // max(1, self.parents)

    def split(self, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(part, kind="stable")
        for start, end in zip(*runs(part[order])):
            if int(part[order[start]]) in self.paths:
                yield int(part[order[start]]), order[start:end]

    def take(self, at: np.ndarray, name: str, kind: type) -> np.ndarray:
        """A value of each entry by its global number."""
        out = np.zeros(len(at), kind)
        for part, some in self.split(np.searchsorted(self.offsets, at, "right") - 1):
            out[some] = self.shard(part)[name][at[some] - self.offsets[part]]
        return out


class Vocabulary(Level):
    """First level: word hashes in order, with their training counts."""

    def find(self, words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), -1, np.int64)
        for part, some in self.split(in_range(words, self.parts).astype(np.int64)):
            local = self.shard(part)["ids"].find(words[some])
            out[some] = np.where(local >= 0, local + self.offsets[part], -1)
        return out


class Successors(Level):
    """Further level: for each entry of the level above, its successors' numbers, monotone within a shard."""

    def low(self, parent: int) -> int:
        return -(-parent * self.parents // self.parts)

    def bounds(self, part: int, parent: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        held = self.shard(part)
        local = parent - self.low(part)
        start, end = np.split(held["ptr"].get(np.r_[local, local + 1]).astype(np.int64), 2)
        return held, start, end

    def _base(self, held: dict, start: np.ndarray) -> np.ndarray:
        base = np.zeros(len(start), np.uint64)
        later = start > 0
        base[later] = held["ids"].get(start[later] - 1) + np.uint64(1)
        return base

    def find(self, parent: np.ndarray, relative: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each parent and relative number (or -1): the successor's global number and its place among the parent's
        successors (or -1), its probability and the parent's back-off weight, both in log10 steps.

        Equal parents should be neighbours: each run of them is looked up once.
        """
        out, place = np.full(len(parent), -1, np.int64), np.full(len(parent), -1, np.int64)
        prob, weight = np.zeros(len(parent), np.uint8), np.zeros(len(parent), np.uint8)
        for part, some in self.split(self.part_of(parent)):
            mine, asked = parent[some], relative[some]
            first, last = runs(mine)
            size = last - first
            held, start, end = self.bounds(part, mine[first])
            weight[some] = np.repeat(held["back"][mine[first] - self.low(part)], size)
            base = np.repeat(self._base(held, start), size)
            start, end = np.repeat(start, size), np.repeat(end, size)
            local = held["ids"].find(base + np.maximum(asked, 0).astype(np.uint64))
            hit = np.flatnonzero((asked >= 0) & (local >= start) & (local < end))
            there, local = some[hit], local[hit]
            out[there], place[there], prob[there] = local + self.offsets[part], local - start[hit], held["prob"][local]
        return out, place, prob, weight

    def first(self, parent: np.ndarray) -> np.ndarray:
        """Global number of each parent's first successor."""
        out = np.zeros(len(parent), np.int64)
        for part, some in self.split(self.part_of(parent)):
            out[some] = self.bounds(part, parent[some])[1] + self.offsets[part]
        return out


class Model:
    """The levels found so far, the number of training tokens, and the least count of a word in an n-gram."""

    def __init__(self, levels: list[Level], tokens: int, least: int) -> None:
        self.levels, self.tokens, self.least = levels, tokens, least

    def look_up(self, words: np.ndarray, tokens: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """Counts of distinct words; per level and token the entry ending at it, its relative number, and the log10 steps
        of its probability and of its context's back-off.

        ``tokens`` are places in ``words``; ``follows`` tells which tokens have their predecessor in the same text.
        """
        at = self.levels[0].find(words)
        count = np.where(at >= 0, self.levels[0].take(np.maximum(at, 0), "count", np.int64), 0)
        entry = np.where(count >= self.least, at, -1)[tokens]
        none = np.zeros(len(tokens), np.uint8)
        found = [(entry, entry, none, none)]
        for level in self.levels[1:]:
            parent, relative = self.keys(found, follows)
            known = np.flatnonzero(parent >= 0)
            key, back = np.unique((parent[known] << 32) | (relative[known] + 1), return_inverse=True)
            columns = []
            for value, default in zip(level.find(key >> 32, (key & 0xFFFFFFFF) - 1), (-1, -1, 0, 0)):
                column = np.full(len(tokens), default, value.dtype)
                column[known] = value[back]
                columns.append(column)
            found.append(tuple(columns))
        return count, found

    @staticmethod
    def keys(found: list[tuple[np.ndarray, ...]], follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parent entry, relative number) of every token for the level after those found; -1 where there is none.

        The parent is the entry that ends one token earlier. From the third level on, the number is relative: the
        place of the suffix's entry among the successors of the suffix's own context.
        """
        entry, relative, _, _ = found[-1]
        return np.where(follows, np.r_[-1, entry[:-1]], -1), relative

    def log_probability(self, words: np.ndarray, tokens: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, log10 of the base probability and log10 of the model's probability of every token."""
        count, found = self.look_up(words, tokens, follows)
        base = np.log10((count + 1) / (self.tokens + self.levels[0].size + 1))[tokens]
        value = base.copy()
        for entry, _, prob, weight in found[1:]:
            value = np.where(entry >= 0, -STEP * prob, value - STEP * weight)
        return count[tokens], base, value


def _split(bodies: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, A-Z lower-cased, with an empty one as the end of each, and the number of them per text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(bodies.view(pa.string())))
    words = lists.flatten().view(pa.binary())
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    inside = pc.greater(pc.binary_length(words), 0)
    sizes = np.bincount(owner[inside.to_numpy(zero_copy_only=False)], minlength=len(lists))
    # White space at either end leaves an empty word there; the ends follow as words of their own, put in place below.
    words = pa.concat_arrays([words.filter(inside), pa.array([b""], pa.binary())])
    place = np.full(int(sizes.sum()) + len(sizes), len(words) - 1)
    inner = np.ones(len(place), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    place[inner] = np.arange(len(words) - 1)
    return words.take(pa.array(place)), sizes + 1


def tokenised(rows: DataFrame) -> DataFrame:
    """Read every text (``doc_id``, ``held_out``, ``body``) once and write its tokens, in chunks, to the shared folder.

    A chunk holds the hashes of its distinct words in order, its tokens as places among them, and its texts. What
    returns is the written list of chunks: path, tokens, and tokens of texts that are not held out.
    """
    folder = scratch(rows.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = WordHashes()
        held: list[tuple[pa.Array, np.ndarray, pa.Array, pa.Array]] = []

        def release() -> pa.RecordBatch:
            words, sizes, docs, out = zip(*held)
            coded_ = pa.chunked_array(words).combine_chunks().dictionary_encode()
            distinct, back = np.unique(read.of(coded_.dictionary.to_pylist()), return_inverse=True)
            tokens = back[coded_.indices.to_numpy()]
            docs, out = pa.concat_arrays(docs), pa.concat_arrays(out).to_numpy(zero_copy_only=False)
            sizes = np.concatenate(sizes)
            arrays = {"words": distinct, "low": (tokens & 0xFFFF).astype(np.uint16), "sizes": sizes, "held": out.astype(np.uint8)}
            if len(distinct) > 1 << 16:
                arrays["high"] = (tokens >> 16).astype(np.min_scalar_type((len(distinct) - 1) >> 16))
            arrays |= {"docs": docs.fill_null(0).to_numpy(), "keyed": docs.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)}
            row = [pa.array([save_shard(folder, arrays)]), pa.array([len(tokens)], pa.int64()), pa.array([int(sizes[~out].sum())], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(row, names=["path", "tokens", "trained"])

        size = 0
        for batch in batches:
            docs, out, bodies = batch.columns
            before = np.cumsum(pc.binary_length(bodies).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < len(bodies):
                done = int(before[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(before, done + BYTES_AT_ONCE, "right")))
                words, sizes = _split(bodies[begin:end])
                held.append((words, sizes, docs[begin:end], out[begin:end]))
                begin, size = end, size + len(words)
                if size >= TOKENS_AT_ONCE:
                    yield release()
                    size = 0
        if held:
            yield release()

    return materialise(rows.select("doc_id", "held_out", "body").mapInArrow(run, CHUNKS), "chunks")


class Chunk:
    """A chunk read back: distinct word hashes, tokens as places among them, and texts; with ``training``, no held-out ones."""

    def __init__(self, path: str, training: bool) -> None:
        held = load_shard(path)
        self.words, self.sizes = np.asarray(held["words"]), np.asarray(held["sizes"])
        self.docs, self.keyed, self.held = held["docs"], held["keyed"].astype(bool), held["held"].astype(bool)
        self.tokens = held["low"].astype(np.int64)
        if "high" in held:
            self.tokens |= held["high"].astype(np.int64) << 16
        if training:
            self.tokens, self.sizes = self.tokens[np.repeat(~self.held, self.sizes)], self.sizes[~self.held]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.follows = np.ones(len(self.tokens), bool)
        self.follows[self.starts] = False


def _dealt(chunks: DataFrame) -> DataFrame:
    """The chunks, dealt to tasks evenly: their list is small, and its file would be read by one task."""
    there, least = chunks.count(), 4 * chunks.sparkSession.sparkContext.defaultParallelism
    return chunks.select("path").repartition(max(1, min(there, max(least, -(-there // CHUNKS_A_TASK)))))


def _wrapped(key: np.ndarray) -> bytes:
    """Keys in order, their upper halves as steps, byte by byte of all, which compresses better."""
    low = np.uint64(0xFFFFFFFF)
    step = (np.diff(key >> np.uint64(32), prepend=np.uint64(0)) << np.uint64(32)) | (key & low)
    return step.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unwrapped(blob: bytes) -> np.ndarray:
    step = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return (np.cumsum(step >> np.uint64(32), dtype=np.uint64) << np.uint64(32)) | (step & np.uint64(0xFFFFFFFF))


def _packed(chunks: DataFrame, keys) -> DataFrame:
    """Counted keys by part: ``keys`` makes the function from a chunk to its (distinct keys in order, their parts, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = None
        for batch in batches:
            for path in batch.column("path").to_pylist():
                of = of or keys()
                key, part, count = of(Chunk(path, True))
                if not len(key):
                    continue
                # The part is a function of the key's order, so equal keys share it.
                first, last = runs(part)
                blobs = lambda own: pa.array([own(a, b) for a, b in zip(first, last)], pa.binary())
                arrays = [pa.array(part[first], pa.int32()), blobs(lambda a, b: _wrapped(key[a:b]))]  # noqa: B023
                arrays.append(blobs(lambda a, b: narrow(count[a:b]).tobytes()))  # noqa: B023
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "keys", "counts"])

    return _dealt(chunks).mapInArrow(run, PACKED)


def _counted(group: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    keys = [_unwrapped(blob) for blob in group.column("keys").to_pylist()]
    counts = [np.frombuffer(blob, f"<u{len(blob) // len(own)}") for blob, own in zip(group.column("counts").to_pylist(), keys)]
    key, count = np.concatenate(keys), np.concatenate([one.astype(np.int64) for one in counts])
    order = np.argsort(key)
    key, count = key[order], count[order]
    starts, _ = runs(key)
    return group.column("part")[0].as_py(), key[starts], np.add.reduceat(count, starts)


def _shard_row(level: int, part: int, path: str, entries: int, tokens: int) -> pa.Table:
    return pa.table({
        "level": pa.array([level], pa.int32()), "part": pa.array([part], pa.int32()), "path": pa.array([path]),
        "entries": pa.array([entries], pa.int64()), "tokens": pa.array([tokens], pa.int64()),
    })


def build(docs: DataFrame, order: int = 3, least: int = 1, discount: float = 0.75, parts: int | None = None) -> Model:
    """Train on ``docs`` (``body``): a level a pass, each written in shards by the tasks that count it.

    The first level holds every training word; a further level holds every n-gram, or with ``least`` above 1 those of at
    least so many counts whose words have as many. Probabilities are interpolated with absolute discounting, so what is discounted or left out goes to the
    shorter context and each context's probabilities sum to one (up to quantisation). A shard is a range of parents;
    only the list of shards reaches the driver.
    """
    rows = docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "body")
    return train(tokenised(rows), order, least, discount, parts)


def train(chunks: DataFrame, order: int = 3, least: int = 1, discount: float = 0.75, parts: int | None = None) -> Model:
    """The model of ``build``, of the texts in ``chunks`` that are not held out."""
    spark = chunks.sparkSession
    parts = parts or max(2, -(-int(chunks.agg(F.sum("trained")).first()[0] or 0) // TOKENS_PER_PART))
    folder = scratch(spark, "trie")

    def collect(rows: DataFrame) -> list:
        return materialise(rows, "shards").collect()

    def first_keys():
        def of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            count = np.bincount(chunk.tokens, minlength=len(chunk.words))
            seen = np.flatnonzero(count)
            return chunk.words[seen], in_range(chunk.words[seen], parts).astype(np.int64), count[seen]

        return of

    def first_level(group: pa.Table) -> pa.Table:
        part, key, count = _counted(group)
        path = save_shard(folder, coded("ids", key) | {"count": narrow(count)})
        return _shard_row(1, part, path, len(key), int(count.sum()))

    shards = collect(_packed(chunks, first_keys).groupBy("part").applyInArrow(first_level, SHARD))
    listed = [(row["part"], row["path"], row["entries"]) for row in shards]
    made = [(listed, 0)]
    tokens = sum(row["tokens"] for row in shards)

    def next_level(known: list, level: int, parents: int) -> list:
        def keys():
            model = assemble(known, parts, tokens, least)

            def of(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                _, found = model.look_up(chunk.words, chunk.tokens, chunk.follows)
                parent, relative = model.keys(found, chunk.follows)
                both = (parent >= 0) & (relative >= 0)
                key = np.sort((parent[both].astype(np.uint64) << np.uint64(32)) | relative[both].astype(np.uint64))
                starts, ends = runs(key)
                key = key[starts]
                return key, (key >> np.uint64(32)).astype(np.int64) * parts // parents, ends - starts

            return of

        def write(group: pa.Table) -> pa.Table:
            model = assemble(known, parts, tokens, least)
            part, key, count = _counted(group)
            kept = count >= least
            key, count = key[kept], count[kept]
            parent, relative = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
            above = model.levels[-1]
            low, high = -(-part * parents // parts), -(-(part + 1) * parents // parts)
            starts, ends = runs(parent)
            total = above.take(parent[starts], "count", np.int64)
            size = ends - starts
            share = (count - discount) / np.repeat(total, size)
            rest = np.maximum(1 - np.add.reduceat(share, starts), 1e-9) if len(starts) else np.empty(0)
            if level == 1:
                lower = (above.take(relative, "count", np.int64) + 1) / (tokens + above.size + 1)
            else:
                # The suffix: successor number ``relative`` of the parent's last word.
                suffix = np.repeat(above.first(_last_words(above, parent[starts])), size) + relative
                lower = 10.0 ** (-STEP * above.take(suffix, "prob", np.uint8))
            chance = share + np.repeat(rest, size) * lower
            pointers = np.zeros(high - low + 1, np.int64)
            pointers[parent[starts] - low + 1] = size
            back = np.zeros(high - low, np.uint8)
            back[parent[starts] - low] = quantised(np.log10(rest))
            base = np.r_[0, np.cumsum(relative[ends - 1] + 1)[:-1]] if len(starts) else np.empty(0, np.int64)
            ids = relative + np.repeat(base, size)
            arrays = coded("ids", ids) | coded("ptr", np.cumsum(pointers))
            arrays |= {"prob": quantised(np.log10(chance)), "back": back}
            if level + 1 < order:  # only a further level reads them
                arrays["count"] = narrow(count)
            return _shard_row(level + 1, part, save_shard(folder, arrays), len(key), int(count.sum()))

        rows = _packed(chunks, keys).groupBy("part").applyInArrow(write, SHARD)
        return [(row["part"], row["path"], row["entries"]) for row in collect(rows)]

    for level in range(1, order):
        parents = assemble(made, parts, tokens, least).levels[-1].size
        if not parents:
            break
        made.append((next_level(list(made), level, parents), parents))
    return assemble(made, parts, tokens, least)


def _last_words(level: Successors, entry: np.ndarray) -> np.ndarray:
    """For entries of the second level, the number of their last word."""
    out = np.zeros(len(entry), np.int64)
    for part, some in level.split(np.searchsorted(level.offsets, entry, "right") - 1):
        held = level.shard(part)
        local = entry[some] - level.offsets[part]
        pointers = held["ptr"].get(np.arange(held["ptr"].n)).astype(np.int64)
        start = pointers[np.searchsorted(pointers, local, "right") - 1]
        out[some] = (held["ids"].get(local) - level._base(held, start)).astype(np.int64)
    return out


def assemble(made: list[tuple[list[tuple[int, str, int]], int]], parts: int, tokens: int, least: int) -> Model:
    (shards, _), *more = made
    levels: list[Level] = [Vocabulary(shards, 0, parts)]
    levels += [Successors(further, parents, parts) for further, parents in more]
    return Model(levels, tokens, least)


def score_texts(docs: DataFrame, order: int = 3, least: int = 1, parts: int | None = None) -> DataFrame:
    """Score every whole text by a model of the documents that are not held out.

    Tokens are words without white space, A-Z lower-cased, and one end a text. Returns ``doc_id``, ``held_out``,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams with one added) and ``score`` (the trie's
    log10 probability). A null text is empty: one end. A null key counts as not held out; repeated rows are texts of
    their own; other columns are left out. Every training n-gram is stored and scored unless ``least`` is above 1. Without training tokens every token has the base probability 1.
    """
    if order > 3:
        raise ValueError("order is at most 3")
    chunks = tokenised(texts(docs).withColumn("held_out", held_out(F.col("doc_id"))))
    model = train(chunks, order, least, parts=parts)
    made = [([(part, path, int(np.diff(one.offsets)[part])) for part, path in one.paths.items()], one.parents) for one in model.levels]
    parts, tokens = model.levels[0].parts, model.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = assemble(made, parts, tokens, least)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                chunk = Chunk(path, False)
                count, base, value = model.log_probability(chunk.words, chunk.tokens, chunk.follows)
                arrays = [pa.array(chunk.docs, pa.int64(), mask=~chunk.keyed), pa.array(chunk.held, pa.bool_())]
                arrays += [pa.array(chunk.sizes), pa.array(np.add.reduceat((count > 0).astype(np.int64), chunk.starts))]
                arrays += [pa.array(np.add.reduceat(one, chunk.starts)) for one in (base, value)]
                yield pa.RecordBatch.from_arrays(arrays, names=[one.split()[0] for one in SCORES.split(", ")])

    scored = _dealt(chunks).mapInArrow(run, SCORES)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
