"""Nearest neighbours by multi-index hashing: learned binary codes, substring indexes, pigeonhole probing, reranking."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantweave.llm.common import materialise

FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Codes:
    """Rotations whose signs are the code bits, and the Hamming radius to search."""

    rotations: np.ndarray
    radius: int

    def of(self, unit: np.ndarray) -> np.ndarray:
        """Codes as rows of 64-bit substrings."""
        signs = np.concatenate([unit @ rotation for rotation in self.rotations], axis=1) > 0
        spare = -signs.shape[1] % 64
        signs = np.pad(signs, ((0, 0), (0, spare)))
        return np.packbits(signs, axis=1).view(np.uint64)


def learn(sample: np.ndarray, bits: int = 256, steps: int = 20, recall: float = 0.97, k: int = 5, seed: int = 7) -> Codes:
    """Fit rotations by iterative quantisation, and take the radius that holds ``recall`` of the sample's neighbours.

    Neighbours within a sample are farther than in the whole table, so the radius errs towards more candidates.
    """
    rng = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    rotations = []
    for _ in range(max(1, -(-bits // unit.shape[1]))):
        rotation = np.linalg.qr(rng.normal(size=(unit.shape[1],) * 2))[0]
        for _ in range(steps):
            u, _, v = np.linalg.svd(unit.T @ np.where(unit @ rotation > 0, 1.0, -1.0))
            rotation = u @ v
        rotations.append(rotation)
    codes = Codes(np.array(rotations), 0)
    own = codes.of(unit)
    some = np.arange(0, len(unit), max(1, len(unit) // 256))
    near = unit[some] @ unit.T
    near[np.arange(len(some)), some] = -2
    top = np.argsort(-near, axis=1)[:, : min(k, len(unit) - 1)]
    apart = np.bitwise_count(own[some][:, None, :] ^ own[top]).sum(2)
    return Codes(codes.rotations, int(np.quantile(apart, recall)) if apart.size else 64 * own.shape[1])


def search_block(query: np.ndarray, ids: np.ndarray, base: np.ndarray, names: np.ndarray, codes: Codes, k: int) -> list[tuple]:
    """The k best rows of a block for each query, out of every row whose code lies within the radius.

    By the pigeonhole principle such a code has a substring within radius // substrings of the query's. Each substring
    has an index of its distinct values; the values within reach are probed, and their rows' whole codes compared.
    """
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    mine = query / np.linalg.norm(query, axis=1, keepdims=True)
    held, asked = codes.of(unit), codes.of(mine)
    parts = held.shape[1]
    reach = codes.radius // parts
    index = []
    for part in range(parts):
        order = np.argsort(held[:, part], kind="stable")
        value, first = np.unique(held[order, part], return_index=True)
        index.append((value, order, np.r_[first, len(order)]))
    found = []
    for row in range(len(mine)):
        live = np.zeros(len(held), bool)
        for part, (value, order, bounds) in enumerate(index):
            probes = np.flatnonzero(np.bitwise_count(value ^ asked[row, part]) <= reach)
            size = bounds[probes + 1] - bounds[probes]
            slot = np.repeat(bounds[probes] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            live[order[slot]] = True
        near = np.flatnonzero(live)
        near = near[np.bitwise_count(held[near] ^ asked[row]).sum(1) <= codes.radius]
        near = near[names[near] != ids[row]]
        # The score in double precision on the original vectors.
        score = base[near] @ query[row] / (np.linalg.norm(base[near], axis=1) * np.linalg.norm(query[row]))
        best = np.lexsort((names[near], -score))[:k]
        found += [(int(ids[row]), int(names[near[one]]), float(score[one])) for one in best]
    return found


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` (array of double) of the rows that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


def nearest(
    vectors: DataFrame, queries: Column, k: int = 5, bits: int = 256, sample: int = 4096,
    block: int = 16_384, query_block: int = 1024, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """The k nearest other rows, by cosine, of every row for which ``queries`` (over ``vec_id``) holds.

    Returns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller ``vec_id``. Vectors that are
    null, zero, or hold a null or non-finite component take no part, nor do those of another
    length than most; equal rows are one; other columns are left out.

    Rotations and radius are fitted on at most about ``sample`` rows; every row is indexed. Rows and queries are dealt
    into blocks by hash, and each pair of blocks is one task that returns k rows a query. A query with fewer than k
    codes within the radius is searched again without a radius, so isolated queries get their k as well.
    """
    spark = vectors.sparkSession
    fit = usable(vectors, key, vector)
    lengths = fit.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = materialise(fit.filter(F.size("v") == (lengths["length"] if lengths else 0)).distinct(), "vectors")
    count = rows.count()
    share = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, sample / max(1, count)) * (1 << 30)))
    drawn = share.toArrow().column("v").to_pylist()
    if len(drawn) < 2:
        drawn = [row["v"] for row in rows.limit(2).collect()]
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = learn(np.array(drawn), bits, k=k)
    asked = rows.filter(queries)
    first = materialise(_blocks(asked, rows, codes, k, block, query_block, count), "near")
    served = first.groupBy("query_id").count().filter(F.col("count") >= min(k, count - 1)).select(F.col("query_id").alias("vec_id"))
    short = materialise(asked.join(served, on="vec_id", how="left_anti"), "short")
    if not short.isEmpty():
        again = _blocks(short, rows, Codes(codes.rotations, 1 << 20), k, block, query_block, count)
        kept = first.join(short.select(F.col("vec_id").alias("query_id")), on="query_id", how="left_anti")
        first = kept.unionByName(again)
    best = first.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("all"))
    ranked = best.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("place", "one"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.far")).alias("score"))


def _blocks(asked: DataFrame, rows: DataFrame, codes: Codes, k: int, block: int, query_block: int, count: int) -> DataFrame:
    across = max(1, -(-count // block))
    down = max(1, -(-asked.count() // query_block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = rows.withColumn("column", F.pmod(F.xxhash64("vec_id"), F.lit(across)).cast("int")).withColumn("row", every(down))
    query = asked.withColumn("row", F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int")).withColumn("column", every(across))
    shared = rows.sparkSession.sparkContext.broadcast(codes)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            matrix = lambda t: np.array(t.column("v").to_pylist(), float)
            names = lambda t: t.column("vec_id").to_numpy()
            found = search_block(matrix(left), names(left), matrix(right), names(right), shared.value, k)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()))})

    return query.groupBy("row", "column").cogroup(base.groupBy("row", "column")).applyInArrow(search, FOUND)
