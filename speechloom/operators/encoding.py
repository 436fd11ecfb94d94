"""Recordings to codes: long ones in parts, parts in batches of like length, codes joined along time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plugins import PER_SECOND, Encoder, frames_of

CODES = T.ArrayType(T.ArrayType(T.IntegerType()))


def batches_of(lengths: list[int], budget: int, slack: float) -> Iterator[tuple[int, int]]:
    """(first, end) of batches of ascending lengths: of at most `budget` samples with their silence, if more than one member,
    and none longer than the shortest by more than `slack` of it. So silence is at most slack / (1 + slack) of a batch."""
    first = 0
    for k, n in enumerate(lengths):
        if k > first and (n > lengths[first] * (1 + slack) or n * (k + 1 - first) > budget):
            yield first, k
            first = k
    if first < len(lengths):
        yield first, len(lengths)


def encoded(df: DataFrame, samples: str, make: Callable[[], Encoder], budget: int = 16 * 60 * 24_000, slack: float = 0.1, per_second: float = PER_SECOND) -> DataFrame:
    """The other columns with `codes`, array<array<int>>, and `silence`, the samples a batch added to the row's own.

    Rows are range-partitioned and sorted by length, equal lengths by a hash of the other columns, so neither a length nor
    copies under many keys make a large partition, and neighbours make the batches. A model that gives a recording the same codes in any batch gives those of
    recordings encoded one by one. Null or empty samples have no codes. An Arrow batch is the unit of memory: recordings
    of minutes want a small spark.sql.execution.arrow.maxRecordsPerBatch.
    """
    kept = [f for f in df.schema if f.name != samples]
    place = df.columns.index(samples)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            column = b.column(place)
            ends = [0 if x is None else x for x in column.value_lengths().to_pylist()]
            order = sorted(range(len(ends)), key=ends.__getitem__)
            order = order[sum(n == 0 for n in ends) :]
            codes: list = [[] for _ in ends]
            silence = [0] * len(ends)
            for first, end in batches_of([ends[k] for k in order], budget, slack):
                members = order[first:end]
                padded = np.zeros((len(members), ends[members[-1]]), np.float32)
                for row, k in zip(padded, members, strict=True):
                    row[: ends[k]] = column[k].values.to_numpy(zero_copy_only=False)
                for k, book in zip(members, model.encode(list(padded)), strict=True):
                    frames = frames_of(ends[k], model.rate, per_second)
                    codes[k] = [list(row[:frames]) for row in book]
                    silence[k] = padded.shape[1] - ends[k]
            rest = [c for k, c in enumerate(b.columns) if k != place]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(codes, pa.list_(pa.list_(pa.int32()))), pa.array(silence, pa.int64())], [*[f.name for f in kept], "codes", "silence"])

    length = F.coalesce(F.size(samples), F.lit(0))
    told = [F.col("`" + f.name.replace("`", "``") + "`") for f in kept if "map<" not in f.dataType.simpleString()] or [F.col(samples)]
    near = df.repartitionByRange(length, F.xxhash64(*told)).sortWithinPartitions(length)
    return near.mapInArrow(run, T.StructType([*kept, T.StructField("codes", CODES), T.StructField("silence", T.LongType())]))


def parts_of(df: DataFrame, key: str, samples: str, rate: int = 24_000, limit: float = 60.0) -> DataFrame:
    """(key, part, samples): recordings longer than `limit` seconds in pieces of that, others whole, null ones too."""
    step = int(limit * rate)
    firsts = F.sequence(F.lit(0), F.greatest(F.coalesce(F.size(samples), F.lit(0)) - 1, F.lit(0)), F.lit(step))
    return df.select(key, samples, F.posexplode(firsts).alias("part", "first")).select(key, "part", F.slice(samples, F.col("first") + 1, F.lit(step)).alias(samples))


def encoded_audio(df: DataFrame, key: str, samples: str, make: Callable[[], Encoder], rate: int = 24_000, limit: float = 60.0, **batching) -> DataFrame:
    """(key, codes, parts, silence): each recording's codes, its parts encoded apart and joined along time in their order.

    `key` has to tell recordings apart. Recordings without samples have empty codes.
    """
    done = encoded(parts_of(df, key, samples, rate, limit), samples, make, **batching)
    whole = done.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("part", "codes"))).alias("all"), F.sum("silence").alias("silence"))
    first = F.col("all")[0]["codes"]
    joined = F.transform(first, lambda _, k: F.flatten(F.transform("all", lambda p: F.get(p["codes"], k))))
    return whole.select(key, joined.alias("codes"), F.size("all").alias("parts"), "silence")
