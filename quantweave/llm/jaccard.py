"""N-gram Jaccard join by vertical partitioning: the global n-gram order is cut into fragments, overlaps are counted
fragment by fragment, and the counts are summed per pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import POSTINGS, bounded, in_range, materialise, mixed, ngram_hashes, packed, part_count, postings, runs, texts, unpacked, word_hashes
from quantweave.operators.components import connected_components

#: Document frequencies above this count as this one in the global order, and the frequency from which an n-gram lies in
#: the frequent half of the fragments.
MOST = (1 << 16) - 1
OFTEN = 32
#: Most rounds that compare each node with one partner before all pairs that are left are compared, and the share of
#: its pairs that a round must link to be followed by another.
STAR_ROUNDS = 4
STAR_SHARE = 0.05
#: Bits, 64 to a number, of the map that bounds from below how much two sets differ.
MAP_WORDS = 16
EMPTY = np.empty(0, np.uint64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct n-grams, ordered; a shorter text is one n-gram of all its words, a text without words has none."""
    if not len(words):
        return EMPTY
    if len(words) < size:
        return ngram_hashes(words, len(words)) ^ np.uint64(len(words))
    return np.unique(ngram_hashes(words, size))


def _identity(grams: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(grams.tobytes()), np.uint64).view(np.int64))


def _map(grams: np.ndarray) -> np.ndarray:
    """Parity of the number of n-grams in each of ``64 * MAP_WORDS`` classes, as ``MAP_WORDS`` longs.

    Each n-gram that only one of two sets holds flips one bit, so the sets differ in at least as many n-grams as their
    maps do in bits.
    """
    counts = np.bincount((grams >> np.uint64(8)).astype(np.int64) & (64 * MAP_WORDS - 1), minlength=64 * MAP_WORDS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _reader(size: int):
    return lambda body: shingles(word_hashes(body, fold=True), size)


def required(size, percent: int):
    """Least overlap that a set of this size (or of each of these sizes) needs with any partner."""
    return -(-percent * size // 100)


def sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node``, which is equal for documents with equal sets and null for empty ones, and ``map``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = _reader(size)
        for batch in batches:
            grams = [read(body.as_py()) for body in batch.column("body")]
            nodes = [_identity(one) if len(one) else None for one in grams]
            maps = np.concatenate([_map(one) for one in grams]) if grams else np.empty(0, np.int64)
            maps = pa.ListArray.from_arrays(pa.array(np.arange(len(grams) + 1) * MAP_WORDS, pa.int32()), pa.array(maps))
            arrays = [batch.column("doc_id"), pa.array([len(one) for one in grams], pa.int64()), pa.array(nodes, pa.int64()), maps]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "node", "map"])

    return materialise(texts(docs).mapInArrow(run, "doc_id long, n_shingles long, node long, map array<long>"), "sets")


def recurring_grams(docs: DataFrame, size: int, parts: int) -> DataFrame:
    """The n-grams that several distinct sets hold, with the exact number of these sets, dealt by set.

    Every n-gram of the corpus goes to its hash range once for each set that a task sees, and is counted there over
    distinct sets. Those that recur leave, packed, for the part that their set belongs to; ``often`` holds the counts.
    """

    def hashes():
        read, seen = _reader(size), set()

        def of(doc: int, body: bytes):
            grams = read(body)
            node = _identity(grams)
            if node in seen:
                return (node, 0), EMPTY
            if len(seen) > 1_000_000:
                seen.clear()
            seen.add(node)
            return (node, len(grams)), grams

        return of

    def count(group: pa.Table) -> pa.Table:
        value, name = unpacked(group, 2)
        # The same set can come from several tasks.
        new = np.r_[True, (value[1:] != value[:-1]) | (name[1:, 0] != name[:-1, 0])]
        value, name = value[new], name[new]
        starts, ends = runs(value)
        often = np.repeat(ends - starts, ends - starts)
        value, name, often = value[often > 1], name[often > 1], often[often > 1]
        order = np.argsort(name[:, 0], kind="stable")
        value, name, often = value[order], name[order], np.minimum(often[order], MOST).astype(np.uint16)
        part = in_range(mixed(np.ascontiguousarray(name[:, 0]).view(np.uint64)), parts)
        return pa.table(packed(part, name, value, {"often": often}))

    found = postings(texts(docs), hashes, parts).groupBy("part").applyInArrow(count, f"{POSTINGS}, often binary")
    return materialise(found, "recurring")


def ordered_sets(recurring: DataFrame, percent: int, fragments: int, parts: int) -> DataFrame:
    """Prefixes and fragments of the sets, in the global order: by number of sets that hold an n-gram, then by hash.

    An n-gram of one set alone comes before all others and meets nothing, so only the number of those in a set counts:
    its prefix of n - required(n) + 1 goes on with the first recurring ones. Rows of two kinds: packed postings of
    these by hash range, with names (node, n, end), and (``node``, ``fragment``, ``grams``) of each set that has any,
    one row for a frequency class (rare, frequent) and hash range. ``end`` is the place of the prefix's last n-gram.
    """
    half = max(1, fragments // 2)

    def order(group: pa.Table) -> pa.Table:
        names, counts, values, often = (b"".join(group.column(one).to_pylist()) for one in ("docs", "counts", "hashes", "often"))
        name = np.repeat(np.frombuffer(names, np.int64).reshape(-1, 2), np.frombuffer(counts, np.uint32), axis=0)
        value, often = np.frombuffer(values, np.uint64), np.frombuffer(often, np.uint16)
        place = np.lexsort((value, often, name[:, 0]))
        name, value, often = name[place], value[place], often[place]
        starts, ends = runs(name[:, 0])
        size = ends - starts
        n = name[starts, 1]
        # Recurring n-grams in the prefix: its length less the n-grams that no other set holds.
        inside = size + 1 - required(n, percent)
        meets = np.repeat(inside > 0, size)
        prefix = np.arange(len(value)) - np.repeat(starts, size) < np.repeat(inside, size)
        last = np.repeat(np.where(inside > 0, starts + inside - 1, starts), size)
        end = (often[last].astype(np.int64) << 47) | (value[last] >> np.uint64(17)).astype(np.int64)
        named = np.c_[name, end][prefix]
        rows = packed(in_range(value[prefix], parts), named, value[prefix], {})

        value, often, node = value[meets], often[meets], name[meets, 0]
        number = (often >= OFTEN) * half + ((value >> np.uint64(40)) * np.uint64(half) >> np.uint64(24)).astype(np.int64)
        place = np.lexsort((number, node))
        value, number, node = value[place], number[place], node[place]
        first = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (number[1:] != number[:-1])]) if len(node) else np.empty(0, np.int64)
        grams = pa.ListArray.from_arrays(pa.array(np.r_[first, len(node)], pa.int32()), pa.array(value.view(np.int64)))
        before, after = len(rows["part"]), len(first)
        kept = {key: pa.concat_arrays([one, pa.nulls(after, one.type)]) for key, one in rows.items()}
        pieces = {"node": pa.array(node[first], pa.int64()), "fragment": pa.array(number[first], pa.int32()), "grams": grams}
        return pa.table(kept | {key: pa.concat_arrays([pa.nulls(before, one.type), one]) for key, one in pieces.items()})

    found = recurring.groupBy("part").applyInArrow(order, f"{POSTINGS}, node long, fragment int, grams array<long>")
    return materialise(found, "ordered")


def shared_prefixes(ordered: DataFrame, percent: int) -> DataFrame:
    """``gram``, ``node``, ``n``, ``end``, ``most``: n-grams that are in the prefixes of several sets.

    Two sets with the needed overlap share an n-gram among the first n - required(n) + 1 of each in the global order.
    ``most`` is the number of all n-grams but for those of the prefix that no other prefix holds. Of two sets, that
    whose prefix ends first shares ``most`` at most: what it shares of its prefix lies in the other's prefix too.
    """

    def shared(group: pa.Table) -> pa.Table:
        value, name = unpacked(group, 3)
        starts, ends = runs(value)
        keep = np.repeat(ends - starts > 1, ends - starts)
        node, n, end = (pa.array(name[keep, place], pa.int64()) for place in range(3))
        return pa.table({"gram": value[keep].view(np.int64), "node": node, "n": n, "end": end})

    packed_rows = ordered.filter("part is not null").select("part", "docs", "counts", "hashes")
    rows = materialise(packed_rows.groupBy("part").applyInArrow(shared, "gram long, node long, n long, end long"), "shared")
    held = materialise(rows.groupBy("node").agg((F.count("*") + F.ceil(F.first("n") * percent / 100) - 1).alias("most")), "held")
    return materialise(rows.join(held, on="node"), "prefixes")


def linked(pairs: DataFrame, fragments: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``, ``na``, ``nb``) whose overlaps, counted per fragment and summed, reach the similarity."""
    left = fragments.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("ga"))
    right = fragments.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("gb"))
    partial = pairs.join(left, on="a").join(right, on=["b", "fragment"]).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("part")
    )
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap"))
    return total.filter(F.col("overlap") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("overlap")))


def jaccard_groups(
    docs: DataFrame, size: int = 5, percent: int = 80, fragments: int = 8, parts: int | None = None
) -> DataFrame:
    """Groups of documents that are linked, directly or through others, by n-gram sets of the given similarity.

    Words are runs without white space, A-Z lower-cased. Two documents link when 100 * intersection >= percent *
    union. Returns a row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (smallest ``doc_id`` that
    links reach) and ``node`` (class of equal sets). Empty sets link to nothing, nor do rows with a null key; rows
    with equal keys are texts of their own. Other columns are left out.

    Equal sets are one node, so copies make no pairs. A few rounds compare each node with one partner in another
    group, the one that shares most of its prefix out of one hub for each n-gram, a different one each round; that
    joins nearly all groups with a comparison a node and round. Even rounds take as hub the node with the smallest part
    of unshared n-grams, which in a family of edited copies is its origin, odd rounds any node. Then all pairs are
    compared that share a prefix n-gram, are still in different groups (pairs within a group cannot change it) and that
    no bound rules out: what both prefixes leave, and the bits in which maps of both sets differ. No link is lost.
    """
    rows = sets(docs, size)
    real = rows.filter("doc_id is not null and node is not null")
    kept = (F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("map").alias("map"))
    nodes = materialise(real.groupBy("node").agg(*kept), "nodes")
    parts = parts or part_count(docs)
    own = docs.filter(F.col("doc_id").isNotNull())
    ordered = ordered_sets(recurring_grams(own, size, parts), percent, fragments, parts)
    prefixes = shared_prefixes(ordered, percent)
    fits = F.greatest("na", "nb") * percent <= F.least("na", "nb") * 100

    meeting = materialise(prefixes.select("node").distinct(), "meeting")
    pieces = ordered.filter("part is null").select("node", "fragment", "grams")
    pieces = materialise(pieces.join(bounded(meeting), on="node", how="left_semi"), "fragments")

    def compared(pairs: DataFrame) -> DataFrame:
        return materialise(linked(pairs, pieces, percent).select("a", "b"), "links")

    placed = prefixes.withColumn("group", F.col("node"))
    links = groups = tried = None
    for turn in range(STAR_ROUNDS):
        order = F.xxhash64(F.lit(turn), "node")
        if turn % 2 == 0:
            alone = F.when(F.col("group") == F.col("node"), 0).otherwise(1) if turn else F.lit(0)
            order = F.struct(alone.alias("joined"), ((F.col("n") - F.col("most")) / F.col("n")).alias("unshared"), order.alias("any"))
        hubs = placed.groupBy("gram").agg(
            F.min_by(F.struct("node", "n", "group"), order).alias("hub"), F.min("group").alias("low"), F.max("group").alias("high")
        ).filter("low <> high")
        near = placed.join(hubs, on="gram").select(
            F.col("node").alias("a"), F.col("n").alias("na"), F.col("hub.node").alias("b"), F.col("hub.n").alias("nb"),
            (F.col("group") != F.col("hub.group")).alias("apart"),
        )
        shares = near.filter(F.col("apart") & fits).groupBy("a", "na", "b", "nb").count()
        best = shares.groupBy("a", "na").agg(F.max(F.struct("count", "b", "nb")).alias("most"))
        pairs = materialise(best.select("a", F.col("most.b").alias("b"), "na", F.col("most.nb").alias("nb")), "pairs")
        found = compared(pairs)
        seen = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        tried = seen if tried is None else tried.unionByName(seen)
        new = found.count()
        if not new:
            break
        links = found if links is None else links.unionByName(found)
        groups = node_groups(links)
        placed = materialise(with_groups(prefixes, groups), "placed")
        if new < STAR_SHARE * pairs.count():
            break

    mixed = placed.groupBy("gram").agg(F.min("group").alias("low"), F.max("group").alias("high")).filter("low <> high")
    live = placed.join(mixed.select("gram"), on="gram", how="left_semi").join(nodes.select("node", "map"), on="node")
    fields = {"node": "", "n": "n", "group": "g", "end": "e", "most": "m", "map": "map_"}
    one = live.select("gram", *[F.col(name).alias(f"{short}a") for name, short in fields.items()])
    two = live.select("gram", *[F.col(name).alias(f"{short}b") for name, short in fields.items()])
    # Overlap that the pair needs, in whole numbers: percent * (na + nb) / (100 + percent), rounded up.
    needed = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    most = F.when(F.col("ea") < F.col("eb"), F.col("ma")).when(F.col("ea") > F.col("eb"), F.col("mb")).otherwise(F.greatest("ma", "mb"))
    bits = [F.bit_count(F.col("map_a")[place].bitwiseXOR(F.col("map_b")[place])) for place in range(MAP_WORDS)]
    near = F.col("na") + F.col("nb") - sum(bits[1:], bits[0]) >= 2 * needed
    rest = one.join(two, on="gram").filter((F.col("ga") != F.col("gb")) & (F.col("a") < F.col("b")) & fits & (most >= needed) & near)
    # Grams up to the nearer end of both prefixes are counted here; of the rest, the set that ends there first has
    # required(n) - 1 at most. Pairs that this bound rules out need no comparison.
    most = F.col("count") + F.ceil(F.greatest("na", "nb") * percent / 100) - 1
    rest = rest.groupBy("a", "b", "na", "nb").count().filter(most >= needed).drop("count")
    if tried is not None:
        rest = rest.join(tried.distinct(), on=["a", "b"], how="left_anti")
    more = compared(materialise(rest, "pairs"))
    if not more.isEmpty():
        groups = node_groups(more if links is None else links.unionByName(more))

    member = materialise(with_groups(nodes.select("node", "doc_id"), groups), "members")
    smallest = materialise(member.groupBy("group").agg(F.min("doc_id").alias("component_id")), "smallest")
    named = materialise(member.join(smallest, on="group").select("node", "component_id"), "named")
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.drop("map").join(named, on="node", how="left").select("doc_id", "n_shingles", known.alias("component_id"), "node")


def with_groups(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Rows with the ``group`` of their ``node``: the node itself where it has no links."""
    if groups is None:
        return rows.withColumn("group", F.col("node"))
    return rows.join(groups, on="node", how="left").withColumn("group", F.coalesce("group", "node"))


def node_groups(links: DataFrame) -> DataFrame:
    """``node`` and ``group`` (its smallest node) of the nodes with links."""
    ends = links.select(F.struct("a", "b").alias("link"), F.explode(F.array("a", "b")).alias("node"))
    return materialise(connected_components(ends, "link", "node").withColumnRenamed("component", "group"), "groups")
