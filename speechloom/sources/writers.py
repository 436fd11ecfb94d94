"""Writers: parquet by size or shard, JSON trees, fixed chunks, lists, tables for people."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audits import first_by_id
from ..operators.sequences import indexed
from ..session import checkpoint
from .readers import footers, tree_files


def batched_parquet(df: DataFrame, path: str, records: int = 20_000, mode: str = "append") -> None:
    """Files of at most so many rows; the committer makes the job all or nothing."""
    df.write.mode(mode).option("maxRecordsPerFile", records).option("compression", "snappy").parquet(path)


def sharded_parquet(df: DataFrame, path: str, shard: str = "shard_id") -> None:
    """A folder for each shard. Written again, a shard replaces itself and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(shard).parquet(path)


def entry_names(spark: SparkSession, path: str) -> DataFrame:
    """(name) of the files that utterance_tree() has written, from a listing; nothing is read."""
    try:
        names = tree_files(spark, path, ".json").select(F.regexp_extract("path", r"([^/]*)\.json$", 1).alias("name"))
        return checkpoint(names)  # as they were before this job's files
    except FileNotFoundError:  # nothing yet
        return spark.createDataFrame([], "name string")


def utterance_tree(df: DataFrame, path: str, skip_existing: bool = True) -> int:
    """A file `speaker/book/entry.json` with all columns for each entry; how many were written.

    Of entries with one id the first in order of their bounds is written, and none whose name is there already: only names are
    looked at. A file is written under another name, which readers pass over, and then renamed, so each one is whole or absent: a
    task that runs again writes the same files, and a job that was stopped goes on where it was. Names are URL-encoded with `~` in
    place of `%`, as are an underscore or a dot at the beginning, which would hide the file; null and empty ids are `~`.
    """
    spark = df.sparkSession
    plain = lambda c: F.replace(F.url_encode(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("%"), F.lit("~"))
    shown = lambda x: F.regexp_replace(F.regexp_replace(x, "^_", "~5F"), r"^\.", "~2E")
    name = lambda c: F.coalesce(F.nullif(shown(plain(c)), F.lit("")), F.lit("~"))
    rows = first_by_id(df, "entry_id", ["begin_time", "end_time"] if "begin_time" in df.columns else ["entry_id"])
    files = rows.select(name("speaker_id").alias("speaker"), name("book_id").alias("book"), name("entry_id").alias("name"), F.to_json(F.struct(*rows.columns)).alias("line"))
    # many small files: as many tasks as there may be, not as few as the bytes ask for
    files = files.repartition(4 * spark.sparkContext.defaultParallelism, "name")
    if skip_existing:
        files = files.join(entry_names(spark, path), "name", "left_anti").select("speaker", "book", "name", "line")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        made: set[str] = set()
        for b in batches:
            for speaker, book, entry, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                folder = f"{base}/{speaker}/{book}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                draft = f"{folder}/.{entry}.{uuid.uuid4()}"
                with store.open_output_stream(draft, compression=None) as out:
                    out.write(line.encode())
                store.move(draft, f"{folder}/{entry}.json")
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return files.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def fixed_chunks(df: DataFrame, path: str, order: list[str], size: int = 10_000, resume: bool = False) -> None:
    """Folders chunk=0, 1, ...: `size` rows each, in order; the last has what is left.

    With `resume` the chunks that are whole stay as they are and all others are written, whichever those are: missing ones, those
    of another number of rows, and those with a file that can't be read. Whole is told from the files' footers.
    """
    rows = indexed(df, order).withColumn("chunk", F.floor(F.col("position") / size).cast("int"))
    if not resume:
        rows.drop("position").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("chunk").parquet(path)
        return
    whole = whole_chunks(df.sparkSession, path, size, rows.agg(F.count(F.lit(1))).first()[0])
    missing = (rows if whole is None else rows.join(whole, "chunk", "left_anti")).drop("position")
    missing.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(path)


def whole_chunks(spark: SparkSession, path: str, size: int, total: int) -> DataFrame | None:
    """(chunk) of the folders whose readable files have the rows that the chunk should have; None without any folder."""
    try:
        files = footers(spark, path).withColumn("chunk", F.regexp_extract("path", r"/chunk=(\d+)/[^/]*$", 1).try_cast("int"))
        found = files.groupBy("chunk").agg(F.sum("rows").alias("rows"), F.count_if(F.col("error").isNotNull()).alias("broken"))
        return checkpoint(found.filter(F.col("rows") == F.least(F.lit(size), F.lit(total) - F.col("chunk") * size)).filter("broken = 0").select("chunk"))
    except AnalysisException:  # nothing yet
        return None


def code_arrays(df: DataFrame, path: str, codes: str = "codes", name: str = "id") -> None:
    """Code matrices of any length as nested arrays, in place of files of pickled objects."""
    df.select(F.col(name).alias("id"), F.col(codes).cast("array<array<int>>").alias("codes")).write.mode("overwrite").parquet(path)


def cached(df: DataFrame, path: str, key: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """compute(rows) for all rows, from a table at `path` where it has the key; what is new is added to it first."""
    spark = df.sparkSession
    try:
        known = spark.read.parquet(path).select(key)
        fresh = df.join(known, key, "left_anti")
    except AnalysisException:  # nothing yet
        fresh = df
    compute(fresh).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(df.select(key).distinct(), key, "left_semi")


def tsv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("sep", "\t").csv(path)


def lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def json_stats(df: DataFrame, path: str, by: str = "language", mode: str = "full_analysis") -> None:
    """A folder for each language; `mode` says how the numbers were found."""
    if mode not in ("full_analysis", "sampling"):
        raise ValueError(f"unknown mode {mode}")
    df.withColumn("mode", F.lit(mode)).write.mode("overwrite").partitionBy(by).json(path)


def report(head: str, rows: DataFrame, path: str) -> None:
    """A report of one row for each language under its head, in one file: rows (ord, lang, line)."""
    spark = rows.sparkSession
    top = spark.createDataFrame([(-1, "", head)], "ord int, lang string, line string")
    top.unionByName(rows).orderBy("ord", "lang").coalesce(1).select(F.col("line").alias("value")).write.mode("overwrite").text(path)
