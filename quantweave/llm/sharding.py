"""Shards by sampled splitters, in DataFrame operations only.

Records lie in the order of a hash of their group, then key, then row. Size-weighted samples of that order give
quantile boundaries; records are dealt to the ranges between them; ranges that came out overfull, such as one that a
large group fills, are sampled and cut again. Exact sizes of all ranges then place every record, so samples decide how
evenly the work is spread but not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantweave.llm.common import bounded, materialise

#: Samples for each range, ranges for each shard, records for each range, and how many times over a range may be.
SAMPLES, FINENESS, RANGE_ROWS, OVERFULL = 16, 32, 2_000_000, 2
#: The order of records: by group, within a group by key, for repeated keys by row.
ORDER = ("_group", "_key", "_row")
ROUNDS = ("_group", "_group", "_key", "_row")


def group_hash(value: Column) -> Column:
    """60 bits of a cryptographic hash; equal values share it, and null counts as empty."""
    return F.conv(F.substring(F.sha2(F.coalesce(value.cast("binary"), F.lit(b"")), 256), 1, 15), 16, 10).cast("long")


def _ranges(records: DataFrame) -> DataFrame:
    """Records, total and largest size of every range."""
    return records.groupBy("_path").agg(
        F.count("*").alias("_rows"),
        F.sum("_size").alias("_bytes"),
        F.max("_size").alias("_largest"),
        (F.min("_group") < F.max("_group")).alias("_mixed"),
        F.first("_of").alias("_of"),
    )


def _splitters(records: DataFrame, column: str, target: Column, seed: int) -> DataFrame:
    """Boundaries of each range by ``column``: about one every ``target`` bytes, from samples weighted by size.

    A value that fills as many samples as a range should have gets a boundary on either side.
    """
    chance = F.col("_size") * SAMPLES / target
    value = F.coalesce(F.col(column), F.lit(-(1 << 63)))
    sample = records.filter(F.rand(seed) < chance).select("_path", value.alias("_value"))
    order = Window.partitionBy("_path").orderBy("_value")
    placed = sample.groupBy("_path", "_value").agg(F.count("*").alias("_times"))
    placed = placed.withColumn("_upto", F.sum("_times").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    step = lambda seen: F.floor(seen / SAMPLES)
    crossing = step(F.col("_upto")) > step(F.col("_upto") - F.col("_times"))
    heavy = (F.col("_times") >= SAMPLES) & (F.col("_value") < (1 << 63) - 1)
    ends = F.when(heavy, F.array(F.col("_value"), F.col("_value") + 1)).otherwise(F.array("_value"))
    chosen = placed.filter(crossing).select("_path", F.explode(ends).alias("_cut"))
    return chosen.groupBy("_path").agg(F.array_sort(F.collect_set("_cut")).alias("_cuts"))


def _at(value: Column, cuts: Column, most: int) -> Column:
    """How many of at most ``most`` sorted cuts are at or under the value."""
    steps = F.array(*[F.lit(1 << power) for power in reversed(range(max(1, most).bit_length()))])
    step = lambda at, size: F.when(F.get(cuts, at + size - 1) <= value, at + size).otherwise(at)
    return F.when(cuts.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), step))


def _dealt(records: DataFrame, target: float) -> tuple[DataFrame, DataFrame]:
    """Records with the ``_path`` of their range, and the ranges' sizes; paths and records share their order.

    Only a range of one whole group is cut by key or row; ``_of`` then holds its path, as it was before.
    """
    records = records.withColumns({"_path": F.array().cast("array<int>"), "_of": F.lit(None).cast("array<int>")})
    sizes = materialise(_ranges(records), "ranges")
    for place, column in enumerate(ROUNDS):
        over = sizes.filter((F.col("_bytes") - F.col("_largest") > OVERFULL * target) | (F.col("_rows") > OVERFULL * RANGE_ROWS))
        if column != "_group":
            over = over.filter(~F.col("_mixed"))
        over = over.select("_path", F.least(F.lit(target), F.col("_bytes") * RANGE_ROWS / F.col("_rows")).alias("_target"))
        if over.isEmpty():
            continue
        within = records.join(bounded(over), "_path")
        cuts = materialise(_splitters(within, column, F.col("_target"), place), "splitters")
        most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
        value = F.coalesce(F.col(column), F.lit(-(1 << 63)))
        joined = records.join(bounded(cuts), "_path", "left")
        if column != "_group":
            joined = joined.withColumn("_of", F.coalesce("_of", F.when(F.col("_cuts").isNotNull(), F.col("_path"))))
        records = joined.withColumn("_path", F.concat("_path", F.array(_at(value, F.col("_cuts"), most)))).drop("_cuts")
        sizes = materialise(_ranges(records), "ranges")
    return records, sizes


def shard_records(
    records: DataFrame, size: Column, group: Column, key: str = "doc_id", shards: int = 16, tolerance: float = 0.01
) -> DataFrame:
    """The columns of ``records`` with ``shard`` (from 0) and ``slot`` (place in the shard, without gaps, from 0).

    Shards have nearly equal total ``size`` (a positive long): each ends where its share of the order is full, which is
    within half a record of it. A group of at most ``tolerance`` shards stays together, so that a boundary may also be
    off by half of that; larger groups are cut. Null groups are one group, null keys come first; repeated rows are
    records of their own, in a fixed but arbitrary order; no records give no rows. Columns of ``records`` named
    ``shard`` or ``slot`` are replaced, and names that begin with an underscore are kept for the work.
    """
    kept = records.drop("shard", "slot")
    columns = kept.columns
    rows = kept.select(
        "*",
        F.coalesce(group, F.lit(0)).cast("long").alias("_group"),
        F.col(key).cast("long").alias("_key"),
        size.cast("long").alias("_size"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = materialise(rows, "records")
    whole = rows.agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows")).first()
    total, ranges = whole["bytes"] or 1, max(FINENESS * shards, -(-whole["rows"] // RANGE_ROWS))
    dealt, sizes = _dealt(rows, total / ranges)
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select(
        "_path",
        "_of",
        "_bytes",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_ahead"),
    )
    of = Window.partitionBy("_of")
    held = F.when(F.col("_of").isNotNull(), F.sum("_bytes").over(of))
    ends = F.when(F.col("_of").isNotNull(), F.max(F.col("_before") + F.col("_bytes")).over(of))
    starts = starts.select("_path", "_before", "_ahead", held.alias("_held"), ends.alias("_held_end"))
    order = Window.partitionBy("_path").orderBy(*ORDER)
    same = Window.partitionBy("_path", "_group")
    placed = (
        dealt.withColumn("_upto", F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_rank", F.row_number().over(order))
        .withColumn("_whole", F.sum("_size").over(same))
        .withColumn("_end", F.max("_upto").over(same))
        .join(bounded(materialise(starts, "starts")), "_path")
    )
    whole = F.coalesce("_held", "_whole")
    end = F.coalesce(F.col("_held_end"), F.col("_before") + F.col("_end"))
    # Twice the middle of the record, or of its group, in the order of all bytes.
    own = 2 * (F.col("_before") + F.col("_upto")) - F.col("_size")
    middle = F.when(whole <= F.lit(tolerance * total / shards), 2 * end - whole).otherwise(own)
    shard = F.call_function("div", middle.cast("decimal(25,0)") * shards, F.lit(2 * total).cast("decimal(25,0)"))
    rank = F.col("_ahead") + F.col("_rank") - 1
    placed = placed.select(*columns, shard.cast("int").alias("shard"), rank.alias("_rank"))
    placed = materialise(placed, "shards")
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(*columns, "shard", (F.col("_rank") - F.col("_first")).alias("slot"))


def write_shards(records: DataFrame, path: str, size: Column, group: Column, **options) -> DataFrame:
    """Write whole records as Parquet, one folder a shard, in the order of their slots; returns them as read back."""
    dealt = shard_records(records, size, group, **options)
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return records.sparkSession.read.parquet(path)
