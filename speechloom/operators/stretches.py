"""Scans in the order of a key's rows that no key's size holds up.

A window by key sorts all rows of the key in one task. Here keys with more than `most` rows are counted first; their rows,
and only theirs, are cut into stretches by a range sort on key and order, written once. A scan then runs in three steps:
each stretch by itself; what a stretch hands on (its last row, its open run, its sums) as one row, composed over the
stretches of its key; and each stretch again with what the ones before it hand on. A stretch has about `most` rows, as
Spark's range exchange deals them, so a key of any share of the rows is dealt over all tasks. Without such keys the plan is
the plain window's.

Rows of one key and equal order values are in any order, as in a window; null orders come first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint

#: Rows of a key that one task may sort.
MOST = 1_000_000
STRETCH = "_stretch"


def same(keys: list[str], names: list[str]) -> Column:
    out = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        out = out & F.col(k).eqNullSafe(F.col(n))
    return out


def split(df: DataFrame, keys: list[str], order: list[str], most: int = MOST) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys with at most `most` rows, and those of all others with `_stretch`; None if there are no others."""
    if df.count() <= most:  # no key can have more; this count needs no exchange
        return df, None
    names = [f"_large{k}" for k in range(len(keys))]
    large = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    large = checkpoint(large)  # a row for `most` rows at least
    total = large.agg(F.sum("_n")).first()[0]
    if not total:
        return df, None
    large = large.drop("_n")
    rest = df.join(large, same(keys, names), "left_anti")
    rows = df.join(large, same(keys, names), "left_semi")
    placed = checkpoint(rows.repartitionByRange(-(-total // most), *keys, *order).sortWithinPartitions(*keys, *order).withColumn(STRETCH, F.spark_partition_id()))
    return rest, placed


def inside(keys: list[str], order: list[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys, STRETCH).orderBy(*order)


def handed(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with what their stretch is handed: (keys, _stretch, ...), a row for each stretch of each key."""
    names = [f"_of{k}" for k in range(len(keys))]
    renamed = carry.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(STRETCH).alias("_at_stretch"), *[c for c in carry.columns if c not in (*keys, STRETCH)])
    return rows.join(renamed, same(keys, names) & (F.col(STRETCH) == F.col("_at_stretch"))).drop(*names, "_at_stretch")


def gaps(rows: DataFrame, keys: list[str], begin: str, end: str, tie: str, apart: Callable[[Column, Column], Column]) -> DataFrame:
    """segment_index of stretched rows: how many rows of the key up to this one are apart from the row before them."""
    w, order = inside(keys, [begin, tie]), F.struct(begin, tie)
    marked = rows.withColumn("_new", apart(F.col(begin), F.lag(end).over(w)))
    of = marked.groupBy(*keys, STRETCH).agg(F.min_by(begin, order).alias("_first"), F.max_by(end, order).alias("_last"), F.sum("_new").alias("_news"))
    along = Window.partitionBy(*keys).orderBy(STRETCH)
    of = of.withColumn("_bound", apart(F.col("_first"), F.lag("_last").over(along)))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = of.select(*keys, STRETCH, (F.coalesce(F.sum(F.col("_news") + F.col("_bound")).over(before), F.lit(0)) + F.col("_bound")).alias("_carry"))
    out = handed(marked, carry, keys)
    inner = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("segment_index", (F.col("_carry") + inner).cast("int")).drop("_carry", "_new", STRETCH)


def following(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], name: str) -> DataFrame:
    """`name`: the columns of the row that follows in the key's order, null for its last one."""
    of = rows.groupBy(*keys, STRETCH).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_head"))
    carry = of.select(*keys, STRETCH, F.lead("_head").over(Window.partitionBy(*keys).orderBy(STRETCH)).alias("_head"))
    lead = F.lead(F.struct(*columns)).over(inside(keys, order))
    return handed(rows.withColumn(name, lead), carry, keys).withColumn(name, F.coalesce(F.col(name), F.col("_head"))).drop("_head", STRETCH)


def before_misses(rows: DataFrame, key: str, order: str, ok: Column, limit: int) -> DataFrame:
    """The successful stretched rows before their key's first run of `limit` failures."""
    w = inside([key], [order])
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_ok", ok.cast("int")).withColumn("_island", F.sum("_ok").over(run))
    fails = F.sum(1 - F.col("_ok")).over(Window.partitionBy(key, STRETCH, "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_island", F.coalesce("_island", F.lit(0))).withColumn("_fails", F.coalesce(fails, F.lit(0)))
    # the open run at a stretch's end goes on through stretches without a success
    of = rows.groupBy(key, STRETCH).agg(F.max("_island").alias("_islands"), F.max_by("_fails", F.struct("_island", "_fails")).alias("_tail"))
    along = Window.partitionBy(key).orderBy(STRETCH)
    of = of.withColumn("_group", F.sum((F.col("_islands") > 0).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    of = of.withColumn("_open", F.sum("_tail").over(Window.partitionBy(key, "_group").orderBy(STRETCH).rowsBetween(Window.unboundedPreceding, 0)))
    rows = handed(rows, of.select(key, STRETCH, F.coalesce(F.lag("_open").over(along), F.lit(0)).alias("_carry")), [key])
    long = (F.col("_fails") + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(0)) >= limit
    rows = rows.withColumn("_long", F.coalesce(long, F.lit(False)).cast("int"))
    ended = rows.groupBy(key, STRETCH).agg(F.max("_long").alias("_ended"))
    ended = ended.select(key, STRETCH, F.coalesce(F.max("_ended").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_over"))
    rows = handed(rows, ended, [key]).withColumn("_stopped", F.max("_long").over(run))
    return rows.filter("_ok = 1 and _stopped = 0 and _over = 0").drop("_ok", "_island", "_fails", "_carry", "_long", "_over", "_stopped", STRETCH)


# running totals with resets


class Resets:
    """Units of a stretch in order, and what it makes of a total that it is handed: batches are closed at `threshold`."""

    def __init__(self, sizes: np.ndarray, threshold: int):
        self.threshold, self.n = threshold, len(sizes)
        self.sums = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])

    def closes(self, at: int, total: int) -> int:
        """The unit that closes the batch which has `total` before unit `at`; n if none does."""
        return max(int(np.searchsorted(self.sums, self.sums[at] + self.threshold - total, "left")) - 1, at)

    def fresh(self) -> tuple[np.ndarray, np.ndarray]:
        """For each place, with nothing in the batch there: (total, batches closed) at the end."""
        total, closed = np.zeros(self.n + 1, np.int64), np.zeros(self.n + 1, np.int64)
        ends = np.maximum(np.searchsorted(self.sums, self.sums + self.threshold, "left") - 1, np.arange(self.n + 1))
        for k in range(self.n - 1, -1, -1):
            e = ends[k]
            if e >= self.n:
                total[k] = self.sums[self.n] - self.sums[k]
            else:
                total[k], closed[k] = total[e + 1], closed[e + 1] + 1
        return total, closed

    def pieces(self) -> list[tuple[int, int, int, bool]]:
        """What becomes of a total: (from this total on, total at the end, batches closed, whether the total adds to that).

        A piece for each unit that can be the first to close a batch, so as many as a batch has units at most, and one for
        totals that don't close any.
        """
        total, closed = self.fresh()
        out, whole = [], int(self.sums[self.n])
        if whole < self.threshold:
            out.append((0, whole, 0, True))
        first = self.closes(0, 0)
        for k in range(min(first, self.n - 1), -1, -1):
            low = max(self.threshold - int(self.sums[k + 1]), 0)
            if low >= max(self.threshold, 1):
                continue  # no total is closed by units of size 0
            if out and out[-1][0] == low and not out[-1][3]:
                out.pop()  # the earlier unit comes first
            out.append((low, int(total[k + 1]), int(closed[k + 1]) + 1, False))
        return out

    def batches(self, total: int) -> np.ndarray:
        """The batch of each unit, from 0, when `total` is handed."""
        out, at, batch = np.zeros(self.n, np.int64), 0, 0
        while at < self.n:
            e = self.closes(at, total)
            out[at : e + 1] = batch
            at, batch, total = e + 1, batch + 1, 0
        return out


def by_key(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Sorted rows as one table for each value of the first columns."""
    held, last = [], None
    for b in batches:
        values = list(zip(*(b.column(k).to_pylist() for k in range(keys)), strict=True))
        low = 0
        for k in range(1, len(values) + 1):
            if k == len(values) or values[k] != values[low]:
                if held and last != values[low]:
                    yield last, pa.Table.from_batches(held)
                    held = []
                held.append(b.slice(low, k - low))
                last, low = values[low], k
    if held:
        yield last, pa.Table.from_batches(held)


def reset_batches(rows: DataFrame, key: str, order: str, size: str, threshold: int) -> DataFrame:
    """`batch` of stretched rows (key, order, size, _stretch): as if each key's units were added up one after another."""
    kind = rows.schema[key].dataType
    sizes = lambda t: t.column(size).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    dealt = rows.select(key, STRETCH, order, size).repartition(key, STRETCH).sortWithinPartitions(key, STRETCH, order, size)

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (k, s), t in by_key(batches, 2):
            found = Resets(sizes(t), threshold).pieces()
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(found), t.schema.field(0).type), pa.array([s] * len(found), pa.int32()), *(pa.array([p[i] for p in found], x) for i, x in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_())))], [key, STRETCH, "low", "total", "closed", "adds"])

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, batch = object(), 0, 0
        for (k, s), t in by_key(batches, 2):
            if k != last:
                last, total, batch = k, 0, 0
            yield pa.RecordBatch.from_arrays([pa.array([k], t.schema.field(0).type), pa.array([s], pa.int32()), pa.array([total], pa.int64()), pa.array([batch], pa.int64())], [key, STRETCH, "_total", "_batch"])
            at = int(np.searchsorted(np.array(t.column("low").to_pylist()), total, "right")) - 1
            got, closed, adds = (t.column(c)[at].as_py() for c in ("total", "closed", "adds"))
            total, batch = got + (total if adds else 0), batch + closed

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in by_key(batches, 2):
            batch = Resets(sizes(t), threshold).batches(t.column("_total")[0].as_py()) + t.column("_batch")[0].as_py()
            cols = [t.column(c).combine_chunks() for c in (key, order, size)]
            yield from pa.Table.from_arrays([*cols, pa.array(batch.astype(np.int32))], names=[key, order, size, "batch"]).to_batches(10_000)

    field = T.StructField
    piece = T.StructType([field(key, kind), field(STRETCH, T.IntegerType()), field("low", T.LongType()), field("total", T.LongType()), field("closed", T.LongType()), field("adds", T.BooleanType())])
    found = dealt.mapInArrow(tables, piece).repartition(key).sortWithinPartitions(key, STRETCH, "low")
    carry = checkpoint(found.mapInArrow(chain, T.StructType([field(key, kind), field(STRETCH, T.IntegerType()), field("_total", T.LongType()), field("_batch", T.LongType())])))
    full = handed(rows.select(key, STRETCH, order, size), carry, [key]).select(key, STRETCH, order, size, "_total", "_batch")
    full = full.repartition(key, STRETCH).sortWithinPartitions(key, STRETCH, order, size)
    return full.mapInArrow(fold, T.StructType([*rows.select(key, order, size).schema, field("batch", T.IntegerType())]))
