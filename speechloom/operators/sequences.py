"""Operators on ordered rows: sessions, pairs, first appearances, batches, cuts, positions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint
from .stretches import MOST, before_misses, following, gaps, reset_batches, split


def indexed(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """A gapless position from 0 in a total order, without moving all rows to one task.

    Rows are range-partitioned and sorted; a partition's rows are numbered within it, and the number of rows before it is
    joined from a table of one row for each partition. The numbered rows are written once, to the checkpoint folder: planned
    twice, the ranges would be sampled twice, and rows of one plan wouldn't meet the counts of the other.
    """
    from pyspark.sql.functions import monotonically_increasing_id as local

    placed = checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", local()))
    # the upper bits of the local number are the partition
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    # one row for each shuffle partition, a number that a setting bounds, so one task can sum them and all can have them
    before = sizes.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def gap_sessions(df: DataFrame, keys: list[str], begin: str, end: str, tie: str, tolerance: float = 0.2, most: int = MOST) -> DataFrame:
    """Adds segment_index from 0: a new segment begins where |begin - previous end| exceeds the tolerance, overlaps too.

    The comparison is in doubles. Ties on `begin` are ordered by `tie`. Keys of more than `most` rows are scanned in stretches.
    """

    def apart(b: Column, e: Column) -> Column:
        return F.coalesce((F.abs(b - e) > tolerance).cast("int"), F.lit(0))

    few, large = split(df, keys, [begin, tie], most)
    w = Window.partitionBy(*keys).orderBy(begin, tie)
    out = few.withColumn("_new", apart(F.col(begin), F.lag(end).over(w)))
    out = out.withColumn("segment_index", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")
    return out if large is None else out.unionByName(gaps(large, keys, begin, end, tie, apart))


def segment_documents(df: DataFrame, keys: list[str], begin: str, tie: str, chunk: Column) -> DataFrame:
    """(keys, segment_index, entry, n_segments, num_segments, chunks): a row for each segment, its chunks in order.

    num_segments is the number of entries of the segment; n_segments the number of segments of the key.
    """
    rows = df.groupBy(*keys, "segment_index").agg(F.array_sort(F.collect_list(F.struct(F.col(begin).alias("_b"), F.col(tie).alias("_t"), chunk.alias("_c")))).alias("rows"))
    rows = rows.select(*keys, "segment_index", F.col("rows")[0]["_t"].alias("entry"), F.size("rows").alias("num_segments"), F.transform("rows", lambda r: r["_c"]).alias("chunks"))
    return rows.withColumn("n_segments", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def segment_id(entry: Column, index: Column, n_segments: Column, kind: int) -> Column:
    """`_seg{i}` only where a key has several segments."""
    return F.concat(entry, F.when(n_segments > 1, F.concat(F.lit("_seg"), index.cast("string"))).otherwise(""), F.lit(f"_type{kind}"))


def consecutive_pairs(df: DataFrame, keys: list[str], order: list[str], columns: list[str], prefix: str = "next_", most: int = MOST) -> DataFrame:
    """Each row with the next one of its group; the last of a group has none. Groups of more than `most` rows are scanned in
    stretches."""
    few, large = split(df, keys, order, most)
    out = few.withColumn("_next", F.lead(F.struct(*columns)).over(Window.partitionBy(*keys).orderBy(*order)))
    if large is not None:
        out = out.unionByName(following(large, keys, order, columns, "_next"))
    return out.filter("_next is not null").select(*df.columns, *[F.col(f"_next.{c}").alias(prefix + c) for c in columns])


def first_appearance(values: Column) -> Column:
    """0, 1, 2 ... for the values of an array, by where each is first seen."""
    seen = F.array_distinct(values)
    return F.transform(values, lambda v: (F.array_position(seen, v) - 1).cast("int"))


def group_batches(df: DataFrame, key: str, per_batch: int) -> DataFrame:
    """Adds `batch`: the sorted distinct keys in tiles of `per_batch`; all rows of a key stay together."""
    tiles = indexed(df.select(key).distinct(), [key], "_rank").select(key, F.floor(F.col("_rank") / per_batch).cast("int").alias("batch"))
    return df.join(tiles, key)


def first_per_group(df: DataFrame, key: str, order: list[str], quota: Column, most: int | None = None) -> DataFrame:
    """The first rows of each group, up to the quota in the row.

    most: no quota is larger, if that is known. Then the first `most` rows of each group within each of the input's
    partitions are found first, a limit that Spark applies while it sorts, so a large group never meets whole in one task.
    """
    if most is not None:
        apart = Window.partitionBy(key, "_part").orderBy(*order)
        df = df.withColumn("_part", F.spark_partition_id()).withColumn("_rn", F.row_number().over(apart)).filter(F.col("_rn") <= most).drop("_part", "_rn")
        df = df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_rn") <= most)
        return df.filter(F.col("_rn") <= quota).drop("_rn")
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_rn") <= quota).drop("_rn")


def proportional_quota(count: Column, total: Column | float, sample: int) -> Column:
    """At least one, else the truncated share of the sample; the division comes first."""
    return F.greatest(F.lit(1), (F.lit(sample) * (count / total)).cast("int"))


def until_misses(df: DataFrame, key: str, order: str, ok: Column, limit: int = 5, most: int = MOST) -> DataFrame:
    """Of each group the successful rows before the first run of `limit` failures. Groups of more than `most` rows are scanned
    in stretches."""
    few, large = split(df, [key], [order], most)
    w = Window.partitionBy(key).orderBy(order)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = few.withColumn("_ok", ok.cast("int")).withColumn("_island", F.sum("_ok").over(run))
    rows = rows.withColumn("_fails", F.sum(1 - F.col("_ok")).over(Window.partitionBy(key, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_stopped", F.max((F.col("_fails") >= limit).cast("int")).over(run))
    out = rows.filter("_ok = 1 and _stopped = 0").drop("_ok", "_island", "_fails", "_stopped")
    return out if large is None else out.unionByName(before_misses(large, key, order, ok, limit))


def threshold_batches(df: DataFrame, key: str, order: str, size: str, threshold: int, most: int = MOST) -> DataFrame:
    """(key, order, size, batch): units in order; a batch is closed when it has reached the threshold, units stay whole.

    A running total with resets is no window function, and a fold over a list copies what it has gathered at each step: rows
    sorted by key and order pass through a task in Arrow batches, with one number carried over. No group is held whole. Groups
    of more than `most` rows are scanned in stretches, each of which tells what it makes of any total that it is handed.
    """
    rows, large = split(df.select(key, order, F.col(size).cast("long").alias(size)), [key], [order, size], most)
    kinds = rows.schema

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, batch = object(), 0, 0
        for b in batches:
            out = []
            for k, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != last:
                    last, total, batch = k, 0, 0
                out.append(batch)
                total += s or 0
                if total >= threshold:
                    total, batch = 0, batch + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], [*b.schema.names, "batch"])

    placed = rows.repartition(key).sortWithinPartitions(key, order, size)
    out = placed.mapInArrow(fold, T.StructType([*kinds, T.StructField("batch", T.IntegerType())]))
    return out if large is None else out.unionByName(reset_batches(large, key, order, size, threshold))


def sample_per_group(df: DataFrame, key: str, identity: list[str], k: int, seed: int = 42) -> DataFrame:
    """k rows of each group without replacement, fixed by the seed: those of the smallest hash."""
    parts = [F.col(key).cast("string"), *(F.col(c).cast("string") for c in identity), F.lit(str(seed))]
    draw = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return first_per_group(df.withColumn("_draw", draw), key, ["_draw", *identity], F.lit(k), k).drop("_draw")


def resume_from(df: DataFrame, order: str, value) -> DataFrame:
    """The rows from the given one on; all rows if there is none."""
    found = df.filter(F.col(order) == value).agg(F.count(F.lit(1)).alias("_found"))
    return df.join(F.broadcast(found), how="left").filter((F.col("_found") == 0) | (F.col(order) >= value)).drop("_found")


def shuffled(df: DataFrame, seed: int | None = None) -> DataFrame:
    return df.orderBy(F.rand(seed))
