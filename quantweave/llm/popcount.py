"""Centroid clustering on bit planes: exact dot products by AND and popcount.

A vector's 64 integer components, moved to start at 0, are cut into planes: plane j packs bit j of all components into
one 64-bit word. The dot product of two vectors is the sum over pairs of planes of 2 ** (i + j) times the bits that both
have, so that distances are exact. Spark deals the packed vectors; a round sends back 64 sums a centroid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantweave.llm.common import materialise

WIDTH = 64
#: Components of the integer vectors lie within this, so that 64 squares of differences fit into 63 bits.
LARGEST = 1 << 27
BLOCK = 1 << 14


def integers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, as longs; null unless there are 64 components, none null or not finite."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    fits = lambda x: F.abs(x) * scale < LARGEST
    usable = (F.size(vector) == WIDTH) & F.forall(whole, sound)
    large = F.raise_error(F.lit("a component is too large for exact distances in 64 bits"))
    return F.when(usable, F.when(F.forall(whole, fits), F.transform(whole, lambda x: F.floor(x * scale))).otherwise(large))


def planes_of(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows of 64 values from 0 to 2 ** count - 1 as ``count`` words each; bit c of word j is bit j of component c."""
    bits = (rows[:, None, :] >> np.arange(count)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def dots(planes: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Dot product of each packed vector with a packed centroid."""
    total = np.zeros(len(planes), np.int64)
    for i in range(planes.shape[1]):
        for j in range(len(centroid)):
            total += np.bitwise_count(planes[:, i] & centroid[j]).astype(np.int64) << (i + j)
    return total


def nearest(planes: np.ndarray, squares: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of equally near ones) and the squared distance to it."""
    packed = planes_of(centroids, planes.shape[1])
    own = (centroids * centroids).sum(axis=1)
    far = np.stack([squares + norm - 2 * dots(planes, one) for norm, one in zip(own, packed)])
    best = far.argmin(axis=0)
    return best, far[best, np.arange(len(planes))]


def component_sums(planes: np.ndarray) -> np.ndarray:
    """Sum of each component over packed vectors, from how many of them have each bit."""
    bits = np.unpackbits(np.ascontiguousarray(planes).astype("<u8", copy=False).view(np.uint8).reshape(*planes.shape, 8), axis=2, bitorder="little")
    return (bits.sum(axis=0, dtype=np.int64) << np.arange(planes.shape[1])[:, None]).sum(axis=0)


def _blocks(batch: pa.RecordBatch, count: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        planes = np.frombuffer(b"".join(part.column("planes").to_pylist()), "<u8").reshape(-1, count)
        yield part, planes, part.column("square").to_numpy()


def _packed(kept: DataFrame, base: int, count: int) -> DataFrame:
    schema = T.StructType([*kept.drop("_v").schema, T.StructField("planes", T.BinaryType()), T.StructField("square", T.LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                rows = part.column("_v").flatten().to_numpy().reshape(-1, WIDTH) - base
                words = planes_of(rows, count)
                packed = pa.array([one.tobytes() for one in words], pa.binary())
                part = part.drop_columns(["_v"]).append_column("planes", packed)
                yield part.append_column("square", pa.array((rows * rows).sum(axis=1)))

    return kept.mapInArrow(pack, schema)


def _moved(packed: DataFrame, centroids: np.ndarray, base: int, count: int) -> np.ndarray:
    """The centroids after a round. Tasks send 64 sums and a count for each centroid; Spark adds them up."""
    shifted = centroids - base

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, members = np.zeros(shifted.shape, np.int64), np.zeros(len(shifted), np.int64)
        for batch in batches:
            for _, planes, squares in _blocks(batch, count):
                best, _ = nearest(planes, squares, shifted)
                for one in range(len(shifted)):
                    mine = planes[best == one]
                    members[one] += len(mine)
                    sums[one] += component_sums(mine)
        number, place = np.divmod(np.arange(sums.size, dtype=np.int64), WIDTH)
        columns = [number, place, sums.ravel(), np.repeat(members, WIDTH)]
        yield pa.RecordBatch.from_arrays([pa.array(one) for one in columns], names=["cluster", "place", "total", "members"])

    parts = packed.select("planes", "square").mapInArrow(add, "cluster long, place long, total long, members long")
    added = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members"))
    moved = centroids.copy()
    for row in added.filter("members > 0").collect():  # 64 rows a centroid
        moved[row["cluster"], row["place"]] = int(row["total"]) // row["members"] + base
    return moved


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    salt: str = "3:",
) -> DataFrame:
    """The columns of ``vectors`` but for the vector, and ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia`` and ``centroid`` of every row whose vector has exactly 64 components, none null or not finite.

    Centroids start at the kept vectors with the smallest sha256 of ``salt`` and key (a null key comes last, ties by the
    vector); with fewer vectors there are fewer clusters, and without any no rows. Rows count as often as they are
    there. Components must be under 2 ** 27 / ``scale`` in size, or the job fails, as distances would not fit into 64
    bits. Columns of ``vectors`` with the names of added ones are replaced.
    """
    added = ["cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    rows = vectors.withColumn("_v", integers(F.col(vector), scale)).filter(F.col("_v").isNotNull())
    kept = materialise(rows.drop(*({vector, *added, "planes", "square"} - {key})), "integers")
    order = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    first = kept.select("_v", order.alias("order")).orderBy(F.asc_nulls_last("order"), "_v").limit(clusters).collect()
    ends = kept.agg(F.min(F.array_min("_v")).alias("low"), F.max(F.array_max("_v")).alias("high")).first()
    base = ends["low"] or 0
    count = max(1, int((ends["high"] or 0) - base).bit_length())
    centroids = np.array([row["_v"] for row in first], np.int64).reshape(-1, WIDTH)
    packed = materialise(_packed(kept, base, count), "planes")
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(packed, centroids, base, count)
    schema = T.StructType([*packed.drop("planes", "square").schema, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, planes, squares in _blocks(batch, count):
                best, far = nearest(planes, squares, centroids - base)
                part = part.drop_columns(["planes", "square"]).append_column("cluster", pa.array(best.astype(np.int32)))
                yield part.append_column("distance", pa.array(far))

    assigned = materialise(packed.mapInArrow(assign, schema), "assigned")
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = inertia.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    values = [(number, [int(one) for one in row]) for number, row in enumerate(centroids)]
    final = vectors.sparkSession.createDataFrame(values, "cluster int, centroid array<long>")
    return assigned.join(F.broadcast(inertia.join(final, "cluster")), "cluster").select(*assigned.columns, *added[2:])


def digest(centroid: Column) -> Column:
    """sha256 of the components, as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)
