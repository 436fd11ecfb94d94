"""Incremental, idempotent preparation: each input file counts once, and a broken one is kept in a ledger until it is mended."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.alphabet import Alphabet
from ..operators.documents import chunks_of, pretrain_rows
from ..session import checkpoint as settled
from ..sources.readers import RAW, last_wins, listing

LEDGER = "path string, size long, modified timestamp, failed boolean, documents long, batch long"
STATUS = ("path", "size", "modified")
#: Columns of a file as the reader sees it.
SEEN = {"path": "_metadata.file_path", "size": "_metadata.file_size", "modified": "_metadata.file_modification_time"}
READ = RAW + ", _corrupt_record string"


def pretrain_batch(raw: DataFrame, alphabet: Alphabet = Alphabet()) -> DataFrame:
    raw = raw.withColumn("text", last_wins("text")).withColumn("codes", last_wins("codes"))
    return pretrain_rows(chunks_of(raw, alphabet), "audio_id")


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """(path, size, modified, failed, documents, batch): a row for each time a file was taken. Batches of the stream count from
    0, those that took changed files again from -1 down."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{target}_files")
    except AnalysisException:  # nothing yet
        return spark.createDataFrame([], LEDGER)


def quarantine(spark: SparkSession, target: str) -> DataFrame:
    """(path, size, modified, batch) of the files that failed and were not taken since, each as it was when it failed last."""
    every = ledger(spark, target)
    last = every.groupBy("path").agg(F.bool_and("failed").alias("failed"), F.max(F.struct("modified", "size", "batch")).alias("last"))
    return last.filter("failed").select("path", "last.size", "last.modified", "last.batch")


def prepared(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all batches that are settled: a batch is when its part of the ledger is written, after its rows."""
    batches = ledger(spark, target).select("batch").distinct()
    return spark.read.parquet(target).join(batches, "batch", "left_semi")


def settle(spark: SparkSession, parsed: DataFrame, number: int, target: str, alphabet: Alphabet, asked: DataFrame | None = None) -> None:
    """One batch with two outcomes: the rows of whole files, and an entry of the ledger for each file, broken or not.

    The files are read once, into a checkpoint, so both outcomes tell of the same contents even if a file changes meanwhile. A
    file any of whose records can't be parsed gives no rows. Rows go first, the ledger after them, each to a folder of the
    batch's own that a repeated attempt replaces; a file that another batch took well gives nothing again.
    asked: (path, size, modified) of files that get an entry even if they give no records; such a file failed.
    """
    known = ledger(spark, target).filter((F.col("batch") != number) & ~F.col("failed")).select("path").distinct()
    parsed = settled(parsed.join(known, "path", "left_anti"))
    files = parsed.groupBy(*STATUS).agg(F.bool_or(F.col("_corrupt_record").isNotNull()).alias("failed"), F.count_if(F.col("_corrupt_record").isNull()).alias("documents"))
    if asked is not None:
        found = files.select("path", "failed", "documents")
        files = asked.select(*STATUS).join(found, "path", "left").withColumns({"failed": F.coalesce("failed", F.lit(True)), "documents": F.coalesce("documents", F.lit(0))})
    files = settled(files.withColumn("documents", F.when(F.col("failed"), 0).otherwise(F.col("documents")).cast("long")))
    good = parsed.join(files.filter("failed").select("path"), "path", "left_anti")
    pretrain_batch(good.drop("_corrupt_record", *STATUS), alphabet).write.mode("overwrite").parquet(f"{target}/batch={number}")
    files.write.mode("overwrite").parquet(f"{target}_files/batch={number}")


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_trigger: int = 100, alphabet: Alphabet = Alphabet()) -> StreamingQuery:
    """Prepare all files that haven't been seen yet, then stop. `retake` does the rest, once this has ended.

    The checkpoint's log says which files belong to which batch; a batch is written to its own folders and replaces what
    an interrupted attempt left there. So every file counts once, whenever the job is run again.
    """
    files = spark.readStream.schema(READ).option("multiLine", True).option("mode", "PERMISSIVE").option("maxFilesPerTrigger", files_per_trigger).json(source)
    files = files.select("audio_id", "text", "codes", "_corrupt_record", *[F.col(c).alias(n) for n, c in SEEN.items()])

    def write(batch: DataFrame, number: int) -> None:
        settle(batch.sparkSession, batch, number, target, alphabet)

    return files.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def changed(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(path, size, modified) of listed files that no batch took well, and that didn't fail as they are now."""
    every = ledger(spark, target)
    taken = every.filter(~F.col("failed")).select("path")
    failed = every.filter("failed").select(*STATUS)
    return listing(spark, source).select(*STATUS).join(taken, "path", "left_anti").join(failed, list(STATUS), "left_anti")


def retake(spark: SparkSession, source: str, target: str, files_per_batch: int = 100, alphabet: Alphabet = Alphabet()) -> int:
    """Take files again that failed and have changed since, or that gave no record at all, and return how many were taken.

    A file without a record is entered as failed; one of 0 bytes, which Spark doesn't list, is taken when it has contents.

    At most `files_per_batch` names come to the driver at a time. A batch gets the number below the ledger's lowest, so one
    that was interrupted before its ledger is written is done again under the same number.
    """
    taken = 0
    while True:
        names = changed(spark, source, target).orderBy("path").limit(files_per_batch).collect()
        if not names:
            return taken
        lowest = ledger(spark, target).agg(F.min("batch")).first()[0]
        asked = spark.createDataFrame(names, "path string, size long, modified timestamp")
        parsed = spark.read.schema(READ).option("multiLine", True).option("mode", "PERMISSIVE").json([n.path for n in names])
        settle(spark, parsed.select("audio_id", "text", "codes", "_corrupt_record", F.col(SEEN["path"]).alias("path"), *[F.col(SEEN[c]).alias(c) for c in STATUS[1:]]), min(lowest or 0, 0) - 1, target, alphabet, asked)
        taken += len(names)


def prepare(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_trigger: int = 100, alphabet: Alphabet = Alphabet()) -> DataFrame:
    """Everything new, then everything that was mended; the files that are still broken."""
    ingest(spark, source, target, checkpoint, files_per_trigger, alphabet).awaitTermination()
    retake(spark, source, target, files_per_trigger, alphabet)
    return quarantine(spark, target)


def sessions(spark: SparkSession, stream: DataFrame, key: str, begin: str, end: str, tolerance: float = 0.2, forget: str | None = None) -> DataFrame:
    """Gap sessions of a stream whose rows come in order of `begin` within a key: (key, begin, end, segment_index).

    The state of a key is the last end and its segment; batch and stream give the same segments. A row that comes after
    a later one of its key is compared with that one's end. forget: a key without rows for so long, in processing time, is
    closed and its state dropped; without it, the state has an entry for every key for ever.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(k, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last, segment = state.get if state.exists else (None, 0)
        rows = pd.concat(list(frames)).sort_values([begin, end], kind="stable")
        out = []
        for b, e in zip(rows[begin], rows[end], strict=True):
            if last is not None and abs(b - last) > tolerance:
                segment += 1
            last = e
            out.append(segment)
        state.update((float(last), int(segment)))
        if forget:
            state.setTimeoutDuration(forget)
        yield pd.DataFrame({key: [k[0]] * len(out), begin: rows[begin].to_numpy(), end: rows[end].to_numpy(), "segment_index": out})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {begin} double, {end} double, segment_index int", "last double, segment int", "append", GroupStateTimeout.ProcessingTimeTimeout if forget else GroupStateTimeout.NoTimeout)
