"""Publishing: folders to their destination in one step, with retries; checked before local copies go; limits on jobs."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import listing

T = TypeVar("T")


class Conflict(RuntimeError):
    """Another writer was at the destination."""


def doubling(attempt: int) -> float:
    """Seconds before a download is tried again."""
    return float(2**attempt)


def conflict_delay(attempt: int, draw: Callable[[float, float], float] = random.uniform) -> float:
    """Seconds before a publication is tried again after a conflict; the numbers are fixed values."""
    return min(5.0 * 2**attempt + draw(0.0, 5.0), 120.0)


def retried(call: Callable[[], T], attempts: int = 3, delay: Callable[[int], float] = doubling, on: tuple[type[BaseException], ...] = (OSError,), otherwise: Callable[[], T] | None = None, sleep: Callable[[float], None] = time.sleep) -> T:
    """The first result of `call`; after the last failed attempt that of `otherwise`, if there is one."""
    for attempt in range(attempts):
        try:
            return call()
        except on:
            if attempt + 1 == attempts:
                if otherwise is not None:
                    return otherwise()
                raise
            sleep(delay(attempt))
    raise ValueError("at least one attempt is needed")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def publish_folder(spark: SparkSession, source: str, target: str, attempts: int = 10, sleep: Callable[[float], None] = time.sleep) -> None:
    """Copy a folder beside its destination and rename it, so that a reader sees all of it or nothing.

    A destination that exists already is left as it is, and Conflict is raised once the attempts are over.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source_fs, from_ = _file_system(spark, source)
    fs, to = _file_system(spark, target)

    def once() -> None:
        if fs.exists(to):
            raise Conflict(target)
        draft = jvm.org.apache.hadoop.fs.Path(to.getParent(), f"_draft-{uuid.uuid4()}")
        try:
            jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, from_, fs, draft, False, conf)
            if fs.exists(to) or not fs.rename(draft, to):
                raise Conflict(target)
        finally:
            fs.delete(draft, True)

    retried(once, attempts, conflict_delay, (Conflict,), sleep=sleep)


def publish_table(df: DataFrame, target: str, by: list[str] | None = None) -> None:
    """Write a table to its destination; the job's commit makes it all or nothing. `by`: a push for each split or shard,
    which replaces itself and leaves the others."""
    writer = df.write.option("compression", "snappy")
    if by:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)
    else:
        writer.mode("errorifexists").parquet(target)


def compared(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(name, size, state) of local files: `published` where the destination has the name with this size, else `missing`
    or `different`."""

    def files(path: str, size: str) -> DataFrame:
        fs, where = _file_system(spark, path)
        root = fs.makeQualified(where).toUri().getPath().rstrip("/") + "/"
        return listing(spark, path).select(F.substring_index("path", root, -1).alias("name"), F.col("size").alias(size))

    both = files(source, "size").join(files(target, "there"), "name", "left")
    return both.select("name", "size", F.when(F.col("there").isNull(), "missing").when(F.col("there") == F.col("size"), "published").otherwise("different").alias("state"))


def delete_published(spark: SparkSession, source: str, target: str) -> int:
    """Delete local files that are published; the rest stays. How many went."""
    fs, _ = _file_system(spark, source)
    gone = 0
    for r in compared(spark, source, target).filter("state = 'published'").select("name").toLocalIterator():
        gone += bool(fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{source.rstrip('/')}/{r['name']}"), False))
    return gone


def reconciled(local: DataFrame, published: DataFrame, on: str) -> DataFrame:
    """(on, action) at a restart: `complete` for local units that are published already, `queue` for the others."""
    there = published.select(on).distinct().withColumn("_p", F.lit(True))
    return local.select(on).distinct().join(there, on, "left").select(on, F.when(F.col("_p"), "complete").otherwise("queue").alias("action"))


def watched(report: Callable[[], DataFrame], seconds: float, rounds: int | None = None, sleep: Callable[[float], None] = time.sleep) -> Iterator[list]:
    """The rows of a report, made anew every so many seconds. A report is as small as a screen."""
    k = 0
    while rounds is None or k < rounds:
        if k:
            sleep(seconds)
        yield report().collect()
        k += 1


def run_limited(jobs: list[Callable[[], T]], limit: int) -> list[T]:
    """The results of all jobs in order, of which at most `limit` run at a time; the next begins when one has ended."""
    results: dict[int, T] = {}
    with ThreadPoolExecutor(limit) as pool:
        running, following = {}, iter(enumerate(jobs))
        while True:
            while len(running) < limit and (job := next(following, None)) is not None:
                running[pool.submit(job[1])] = job[0]
            if not running:
                return [results[k] for k in range(len(jobs))]
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                results[running.pop(done)] = done.result()
