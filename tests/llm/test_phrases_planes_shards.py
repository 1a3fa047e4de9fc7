"""Collocations, bit-plane clustering and shards against brute force, on small tables with the awkward cases."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantweave.llm import collocations as phrases
from quantweave.llm.collocations import PhraseTrie, collocations
from quantweave.llm.popcount import cluster, component_sums, digest, dots, planes_of
from quantweave.llm.sharding import group_hash, shard_records, write_shards

RNG = np.random.default_rng(11)


def prose(size, words=14):
    ends = RNG.choice(["", "", "", "", ",", ".", ";", "\n", "\t", "  "], size)
    return " ".join(f"W{n}{end}" for n, end in zip(RNG.zipf(1.6, size) % words, ends))


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text, lang): repeated phrases and rows, nulls, empty and long texts, other spaces, a third in one language."""
    texts = [(n, prose(int(RNG.integers(1, 90))), ["a", "b", None, "a"][n % 4]) for n in range(60)]
    texts += [(n, "new york city, the new york city hall! New York\vcity", "b") for n in range(60, 100)]
    texts += [(n, "ü é x ü é x. 漢 字 漢 字", "c") for n in range(100, 120)]
    return texts + [(120, None, "a"), (121, "", None), (122, "... ,\n", "d"), (123, "x " * 4000, "a"), (60, "new york", "b"), (None, "new york", "b"), (60, "new york", "b")]


@pytest.fixture(scope="module")
def documents(spark, rows):
    made = [(doc, text, lang, 1, 2) for doc, text, lang in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, n int, word int").repartition(3)


def expected_phrases(rows, least, top):
    n, f = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\v\f\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [word for word in re.split("[ \t]", piece) if word]
            n[lang] += len(words)
            f.update((lang, tuple(words[at : at + k])) for k in range(1, 6) for at in range(len(words) - k + 1))
    long = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    found = collections.defaultdict(list)
    for (lang, words), a in long.items():
        around = (
            other[0] == lang and len(other[1]) > len(words) and 100 * b >= 100 * a
            and any(other[1][at : at + len(words)] == words for at in range(len(other[1])))
            for other, b in long.items()
        )
        if any(around):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    return {
        (lang, rank, phrase.decode(), -a, left, right, total, -score)
        for lang, ones in found.items()
        for rank, (score, a, phrase, left, right, total) in enumerate(sorted(ones)[:top], 1)
    }


@pytest.mark.parametrize("burst, budget", [(1 << 16, 1 << 22), (4, 32)])
def test_collocations(documents, rows, burst, budget):
    got = collocations(documents, least=12, top=9, burst=burst, budget=budget).collect()
    fields = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert {tuple(row[name] for name in fields) for row in got} == expected_phrases(rows, 12, 9)
    assert len(got) == len(expected_phrases(rows, 12, 9))


def test_collocations_without_texts(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert collocations(docs).count() == 0
    assert collocations(spark.createDataFrame([(None, None), ("", "x")], docs.schema)).count() == 0


def test_trie_spills_sorted_subtrees():
    trie, prefix, last = PhraseTrie(8, 64), RNG.integers(0, 1 << 63, 40).astype(np.uint64), RNG.integers(1, 5, 3000).astype(np.uint64)
    owner, runs = prefix[RNG.integers(0, 40, 3000)], []
    for at in range(0, 3000, 100):
        runs += trie.add(owner[at : at + 100], last[at : at + 100])
        assert trie.size == sum(map(trie._held, trie.root.values())) <= 164
    spilled = len(runs)
    runs += trie.close()
    counts = collections.Counter()
    for run in runs:
        keys = list(zip(run["prefix"].tolist(), run["last"].tolist()))
        assert keys == sorted(set(keys))
        counts.update(dict(zip(keys, run["n"].tolist())))
    assert spilled and counts == collections.Counter(zip(owner.tolist(), last.tolist()))


def test_bit_table_knows_all_frequent_ids(spark):
    ids = RNG.integers(-(1 << 63), (1 << 63) - 1, 5000)
    table = phrases.bit_table(spark.createDataFrame([(int(one),) for one in ids], "id long"), "id")
    assert table.has(ids.view(np.uint64)).all()
    assert table.has(RNG.integers(0, 1 << 63, 100_000).astype(np.uint64)).mean() < 0.1


def test_planes_give_exact_dots():
    rows = RNG.integers(0, 1 << 27, (50, 64))
    planes = planes_of(rows, 27)
    assert (dots(planes, planes[7]) == rows @ rows[7]).all()
    assert (component_sums(planes) == rows.sum(axis=0)).all()


def expected_clusters(vectors, clusters, rounds):
    kept = [(key, [int(np.floor(1024 * float(x))) for x in v]) for key, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda one: (one[0] is None, hashlib.sha256(f"3:{one[0]}".encode()).hexdigest(), one[1]))
    centers = [v for _, v in first[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))
    for _ in range(rounds):
        held = collections.defaultdict(list)
        for _, v in kept:
            held[near(v)[1]].append(v)
        centers = [[sum(x) // len(held[n]) for x in zip(*held[n])] if held[n] else c for n, c in enumerate(centers)]
    ends = [(key, *near(v)[::-1]) for key, v in kept]
    total = collections.Counter()
    for _, n, far in ends:
        total[n] += far
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return collections.Counter((key, n, far, total[n], sum(total.values()), hashes[n]) for key, n, far in ends)


@pytest.mark.parametrize("count", [0, 5, 120])
def test_clusters(spark, count):
    base = RNG.normal(0, 0.4, (6, 64))
    vectors = [(n, [float(np.float32(x)) for x in base[n % 6] + RNG.normal(0, 0.2, 64)]) for n in range(count)]
    if count:
        vectors += [vectors[0], vectors[0], (vectors[1][0], vectors[2][1]), (None, vectors[3][1]), (900, [0.0] * 64)]
    vectors += [(901, None), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [float("nan")] * 64),
                (906, [float("inf")] + [0.0] * 63), (907, [])]
    made = [(key, v, "x", 5, 6) for key, v in vectors]
    df = spark.createDataFrame(made, "vec_id long, embedding array<float>, planes string, cluster int, distance int").repartition(3)
    for clusters, rounds in ((8, 3), (3, 10)):
        out = cluster(df, clusters=clusters, rounds=rounds)
        got = out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest(F.col("centroid")))
        assert collections.Counter(map(tuple, got.collect())) == expected_clusters(vectors, clusters, rounds)


def test_clusters_refuse_components_beyond_exact_distances(spark):
    df = spark.createDataFrame([(1, [3e38] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        cluster(df).count()


def sharded(docs, **options):
    whole = F.coalesce(F.col("text"), F.lit(""))
    return shard_records(docs, F.octet_length(whole) + 1, group_hash(whole), **options)


def test_shards(documents, rows):
    docs = documents.unionByName(documents.select((F.col("doc_id") + 1000).alias("doc_id"), F.lit("hot").alias("text"), "lang", "n", "word"))
    docs = docs.withColumn("shard", F.lit("other"))
    out = sharded(docs, shards=5, tolerance=0.2)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
    got = out.collect()
    assert collections.Counter((row["doc_id"], row["text"], row["lang"]) for row in got) == collections.Counter(
        rows + [(None if doc is None else doc + 1000, "hot", lang) for doc, _, lang in rows]
    )
    size = lambda row: len((row["text"] or "").encode()) + 1
    code = lambda row: int(hashlib.sha256((row["text"] or "").encode()).hexdigest()[:15], 16)
    order = sorted(got, key=lambda row: (code(row), row["doc_id"] is not None, row["doc_id"] or 0))
    total, at = sum(map(size, got)), 0
    whole, shard = collections.Counter(), []
    for row in got:
        whole[code(row)] += size(row)
    begins = {}
    for row in order:
        begins.setdefault(code(row), at)
        one = whole[code(row)]
        twice = 2 * begins[code(row)] + one if one <= 0.2 * total / 5 else 2 * at + size(row)
        shard.append((row["doc_id"], row["text"], twice * 5 // (2 * total)))
        at += size(row)
    assert collections.Counter(shard) == collections.Counter((row["doc_id"], row["text"], row["shard"]) for row in got)
    for number in range(5):
        own = [row for row in got if row["shard"] == number]
        assert sorted(row["slot"] for row in own) == list(range(len(own)))


def test_overfull_ranges_are_cut_again(spark, monkeypatch):
    """One text, one key and one row again and again: work stays dealt, and the result does not depend on the samples."""
    from quantweave.llm import sharding

    text = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("w"), F.col("id"))).otherwise(F.lit("twin"))
    docs = spark.range(30_000).select(F.when(F.col("id") % 3 == 2, 7).otherwise(F.col("id")).alias("doc_id"), text.alias("text"))
    rows = docs.select("*", group_hash(F.col("text")).alias("_group"), F.col("doc_id").alias("_key"), F.lit(1).cast("long").alias("_size"),
                       F.monotonically_increasing_id().alias("_row"))
    dealt, sizes = sharding._dealt(sharding.materialise(rows, "rows"), 30_000 / 64)
    held = sizes.collect()
    assert sum(row["_rows"] for row in held) == 30_000 and max(row["_rows"] for row in held) <= 4 * 30_000 / 64
    ordered = dealt.orderBy("_path", *sharding.ORDER).select(*sharding.ORDER).collect()
    assert [tuple(row) for row in ordered] == sorted(map(tuple, ordered))
    counts = [row["count"] for row in sharded(docs.withColumn("text", F.lit("same")), shards=7).groupBy("shard").count().collect()]
    assert len(counts) == 7 and max(counts) - min(counts) <= 1


def test_shards_of_nothing_and_written_shards(spark, documents, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharded(empty).count() == 0 and {"shard", "slot"} <= set(sharded(empty).columns)
    whole = F.coalesce(F.col("text"), F.lit(""))
    back = write_shards(documents, str(tmp_path / "shards"), F.octet_length(whole) + 1, group_hash(whole), shards=3)
    assert back.select("doc_id", "text").exceptAll(documents.select("doc_id", "text")).isEmpty()
    assert back.count() == documents.count() and back.select("shard").distinct().count() == 3
    assert zlib.crc32(b"") == 0 == spark.range(1).select(F.crc32(F.lit("").cast("binary"))).first()[0]
