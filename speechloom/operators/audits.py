"""What is done, what is missing: semi and anti joins of lists, state ladders, progress and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States that count as completion — fixed values
COMPLETED = ("completed", "completed_already_uploaded")


def pending(wanted: DataFrame, published: DataFrame, on: str | list[str]) -> DataFrame:
    """Wanted rows that are not published; duplicates stay."""
    return wanted.join(published, on, "left_anti")


def restricted(rows: DataFrame, listed: DataFrame, on: str | list[str]) -> DataFrame:
    return rows.join(listed, on, "left_semi")


def missing_extra(expected: DataFrame, published: DataFrame, on: str) -> DataFrame:
    """(on, side): `missing` for what is expected only, `extra` for what is published only."""
    a = expected.select(on).distinct().withColumn("_e", F.lit(1))
    b = published.select(on).distinct().withColumn("_p", F.lit(1))
    both = a.join(b, on, "full_outer").filter("_e is null or _p is null")
    return both.select(on, F.when(F.col("_p").isNull(), "missing").otherwise("extra").alias("side"))


def completeness(expected: DataFrame, published: DataFrame, on: str, by: list[str]) -> DataFrame:
    """(by, total, existing, missing, pct)."""
    flags = expected.join(published.select(on).distinct().withColumn("_p", F.lit(1)), on, "left")
    agg = flags.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count("_p").alias("existing"))
    return agg.select(*by, "total", "existing", (F.col("total") - F.col("existing")).alias("missing"), (F.col("existing") * 100.0 / F.col("total")).alias("pct"))


def progress(units: DataFrame, totals: DataFrame, key: str, completed: Column, failed: Column, default: int = 1000) -> DataFrame:
    """(key, completed, failed, total, remaining, pct); totals (key, n) default where a key has none."""
    done = units.groupBy(key).agg(F.count_if(completed).alias("completed"), F.count_if(failed).alias("failed"))
    out = done.join(totals.select(key, F.col("n").alias("_n")), key, "left").withColumn("total", F.coalesce("_n", F.lit(default)).cast("long")).drop("_n")
    out = out.withColumn("remaining", F.greatest(F.lit(0).cast("long"), F.col("total") - F.col("completed") - F.col("failed")))
    return out.withColumn("pct", percent(F.col("completed"), F.col("total")))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def rolled_up(shards: DataFrame, by: str) -> DataFrame:
    """Sums by group and over all (null group); the percentage is a ratio of sums."""
    sums = shards.rollup(by).agg(F.count(F.lit(1)).alias("shards"), *[F.sum(c).alias(c) for c in ("completed", "failed", "total", "remaining")])
    return sums.withColumn("pct", percent(F.col("completed"), F.col("total")))


def histogram(df: DataFrame, status: Column) -> DataFrame:
    """(status, n, pct of all)."""
    counts = df.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    return counts.join(F.broadcast(total)).select("status", "n", (F.col("n") * 100.0 / F.col("all")).alias("pct"))  # one row


def where_kept(units: DataFrame, hub: DataFrame, disk: DataFrame, on: list[str]) -> DataFrame:
    """Each completed unit as on_hf, local_only or missing."""
    rows = units.join(hub.select(*on).distinct().withColumn("_h", F.lit(1)), on, "left").join(disk.select(*on).distinct().withColumn("_d", F.lit(1)), on, "left")
    return rows.withColumn("state", F.when(F.col("_h").isNotNull(), "on_hf").when(F.col("_d").isNotNull(), "local_only").otherwise("missing")).drop("_h", "_d")


def shard_state(listed: DataFrame, done: DataFrame, work: DataFrame, on: str) -> DataFrame:
    """The first that holds: the progress file's status, then what the work folder shows.

    done: (on, status). work: (on, cache_exists, cache_files, audio_files, extracted, archived).
    """
    rows = listed.join(done, on, "left").join(work.withColumn("_w", F.lit(1)), on, "left")
    share = F.format_string("processing_audio (%d/%d = %.1f%%)", F.col("cache_files").cast("long"), F.col("audio_files").cast("long"), F.col("cache_files") * 100.0 / F.col("audio_files"))
    state = (
        F.when(F.col("status").isNotNull(), F.col("status"))
        .when(F.col("_w").isNull(), "not_started")
        .when(F.col("cache_exists") & (F.coalesce("audio_files", F.lit(0)) > 0), share)
        .when(F.col("cache_exists"), "processing_audio")
        .when(F.col("extracted"), "extraction_complete")
        .when(F.col("archived"), "tar_downloaded")
        .otherwise("in_progress")
    )
    return rows.select(on, state.alias("state"))


def merged_resume(fresh: DataFrame, existing: DataFrame, on: str, done: Column) -> DataFrame:
    """Rows that are done in the old output come from it (part 0), the others from the new input (part 1)."""
    old = existing.filter(done)
    keep = old.join(fresh.select(on).distinct(), on, "left_semi").withColumn("part", F.lit(0))
    return keep.unionByName(fresh.join(old.select(on), on, "left_anti").withColumn("part", F.lit(1)), allowMissingColumns=True)


def first_by_id(df: DataFrame, key: str, order: list[str], existing: DataFrame | None = None) -> DataFrame:
    """One row for each key, the first in order, and none that exists already."""
    fields = [F.struct(*order).alias("_o"), *[F.col(c) for c in df.columns]]
    out = df.groupBy(key).agg(F.min_by(F.struct(*df.columns), fields[0]).alias("_r")).select("_r.*")
    return out if existing is None else out.join(existing.select(key), key, "left_anti")


def with_counts(units: DataFrame, counts: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Units with their counts, and the units that have none, to warn of."""
    return units.join(counts, on), units.join(counts, on, "left_anti")


def success(rows: DataFrame, state: Column, done: str, total: Column | None = None) -> DataFrame:
    """(processed, succeeded, rate): the share of processed rows in this state; rows that `total` is false for don't count."""
    some = F.lit(True) if total is None else total
    agg = rows.agg(F.count_if(some).alias("processed"), F.count_if(some & (state == done)).alias("succeeded"))
    return agg.withColumn("rate", percent(F.col("succeeded"), F.col("processed")))


def after_row(rows: DataFrame, progress: DataFrame, on: str, position: str = "position") -> DataFrame:
    """Rows behind the last one that a unit's progress has; all rows of a unit without progress."""
    last = progress.groupBy(on).agg(F.max("last_processed_index").alias("_last"))
    return rows.join(last, on, "left").filter(F.col(position) > F.coalesce("_last", F.lit(-1))).drop("_last")


#: How statistics may be ordered — fixed values
ORDERS = ("name", "completion", "remaining")


def ordered_stats(stats: DataFrame, key: str, by: str = "name") -> DataFrame:
    """By name, or by completion or remaining units from the largest, then by name."""
    if by not in ORDERS:
        raise ValueError(f"unknown order {by}")
    return stats.orderBy(key) if by == "name" else stats.orderBy(F.desc("pct" if by == "completion" else "remaining"), key)


def last_rows(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """The last k rows, in order: a top-k from the end."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(k).orderBy(*order)


def all_encoded(entries: DataFrame, key: str, codes: str) -> DataFrame:
    """(key, complete): every entry has codes, which may be empty."""
    return entries.groupBy(key).agg((F.count_if(F.col(codes).isNull()) == 0).alias("complete"))


def three_states(df: DataFrame, done: str, total: str) -> DataFrame:
    """(state, n, pct) of completed, in progress and not started; the percentage is cut to an integer."""
    state = F.when((F.col(total) > 0) & (F.col(done) == F.col(total)), "completed").when(F.col(done) > 0, "in_progress").otherwise("not_started")
    counts = df.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("all")))).select("state", "n", F.expr("n * 100 div all").alias("pct"))
