"""Parquet files named by a number that goes on from job to job: a data source whose jobs appear as a whole or not at all."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Bytes of a row group, about; what a task holds.
GROUP = 32 << 20
NAME = re.compile(r"(\d{8,})\.parquet")
#: Journals are named by the first number of a job, the first after it, and the job.
JOURNAL = re.compile(r"(\d+)-(\d+)-([0-9a-f-]{36})\.json")


@dataclass
class Written(WriterCommitMessage):
    """The drafts of one task, in the order of its rows."""

    drafts: list[str]


class Folder:
    """A target folder: numbered files, drafts in `_drafts/job/`, journals in `_journal/`. Readers of Parquet pass over the last two."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.base = fs.FileSystem.from_uri(path)

    def names(self, below: str = "") -> list[str]:
        from pyarrow import fs

        return [f.base_name for f in self.fs.get_file_info(fs.FileSelector(f"{self.base}{below}", allow_not_found=True))]

    def journals(self) -> dict[str, tuple[int, int, str]]:
        found = [JOURNAL.fullmatch(n) for n in self.names("/_journal")]
        return {m[3]: (int(m[1]), int(m[2]), m[0]) for m in found if m}

    def next(self) -> int:
        """One more than any number that a journal or a file tells of; so files that have been moved on leave no number free."""
        files = [int(m[1]) + 1 for m in map(NAME.fullmatch, self.names()) if m]
        return max([0, *files, *(end for _, end, _ in self.journals().values())])

    def drop(self, job: str) -> None:
        if job in self.names("/_drafts"):
            self.fs.delete_dir(f"{self.base}/_drafts/{job}")

    def settle(self, besides: str | None = None) -> None:
        """Ends what other jobs left: a job with a journal was committed, so its drafts get their names; others leave nothing."""
        journals = self.journals()
        for job in self.names("/_drafts"):
            if job == besides:
                continue
            if job in journals:
                first, _, name = journals[job]
                with self.fs.open_input_stream(f"{self.base}/_journal/{name}") as file:
                    self.rename(job, first, json.loads(file.read()))
            self.drop(job)

    def rename(self, job: str, first: int, drafts: list[str]) -> None:
        left = set(self.names(f"/_drafts/{job}"))
        for number, draft in enumerate(drafts, first):
            if draft in left:
                self.fs.move(f"{self.base}/_drafts/{job}/{draft}", f"{self.base}/{number:08d}.parquet")

    def commit(self, job: str, drafts: list[str]) -> None:
        """The journal's rename is the commit: before it nothing counts, after it the names follow, if need be by `settle`."""
        first = self.next()
        if drafts:
            self.fs.create_dir(f"{self.base}/_journal", recursive=True)
            draft = f"{self.base}/_journal/.{job}"
            with self.fs.open_output_stream(draft, compression=None) as out:
                out.write(json.dumps(drafts).encode())
            self.fs.move(draft, f"{self.base}/_journal/{first:08d}-{first + len(drafts):08d}-{job}.json")
            self.rename(job, first, drafts)
        self.drop(job)


class NumberedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, records: int):
        self.path, self.records, self.job = path, records, str(uuid.uuid4())

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyarrow import parquet

        folder, drafts = Folder(self.path), []
        place = f"{folder.base}/_drafts/{self.job}"
        writer, rows, held = None, 0, []

        def flush() -> None:
            if held:
                writer.write_table(pa.Table.from_batches(held))
                held.clear()

        try:
            for batch in iterator:
                while batch.num_rows:
                    if writer is None:
                        if not drafts:
                            folder.fs.create_dir(place, recursive=True)
                        drafts.append(f"{uuid.uuid4()}.parquet")
                        writer, rows = parquet.ParquetWriter(f"{place}/{drafts[-1]}", batch.schema, filesystem=folder.fs, compression="snappy"), 0
                    part = batch.slice(0, self.records - rows)
                    batch = batch.slice(part.num_rows)
                    held.append(part)
                    rows += part.num_rows
                    if rows == self.records or sum(p.nbytes for p in held) > GROUP:
                        flush()
                    if rows == self.records:
                        writer.close()
                        writer = None
            if writer is not None:
                flush()
        finally:
            if writer is not None:
                writer.close()
        return Written(drafts)

    def commit(self, messages: list[Written | None]) -> None:
        folder = Folder(self.path)
        folder.settle(besides=self.job)
        folder.commit(self.job, [d for m in messages if m is not None for d in m.drafts])

    def abort(self, messages: list[Written | None]) -> None:
        Folder(self.path).drop(self.job)


class NumberedParquet(DataSource):
    """`df.write.format("numbered_parquet").option("records", n).mode("append").save(path)`; Parquet readers read it."""

    @classmethod
    def name(cls) -> str:
        return "numbered_parquet"

    def writer(self, schema, overwrite: bool) -> NumberedWriter:
        if overwrite:
            raise ValueError("numbers go on; nothing is overwritten")
        records = int(self.options.get("records", 20_000))
        if records < 1:
            raise ValueError("a file has one row at least")
        return NumberedWriter(self.options["path"], records)


@contextmanager
def as_active(spark: SparkSession) -> Iterator[SparkSession | None]:
    """Within it the session is the active one of this thread; gives the one that was. Spark looks sources up there, whatever
    session the frame has; and after a stream's foreachBatch Python's `getActiveSession` tells of the batch's session."""
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    before = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        yield SparkSession(spark.sparkContext, before.get()) if before.isDefined() else None
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
        else:
            sessions.clearActiveSession()


def numbered_parquet(df: DataFrame, path: str, records: int = 20_000) -> None:
    """Adds the rows as files 00000000.parquet, 00000001.parquet, ... of at most `records` rows, numbered in the order of the
    partitions from the first number that was never drawn.

    Tasks write drafts; the driver, which sees their names only, writes a journal of them, and its rename commits the job. A job that
    fails or is killed before leaves no file and draws no number; one killed after is ended by the next job or by `recovered`.
    Drafts that no journal names, of tasks that ran again or still ran when their job had failed, go with the next job. One job at a time may write to a folder. Without rows no file is
    written.
    """
    with as_active(df.sparkSession) as before:
        df.sparkSession.dataSource.register(NumberedParquet)
        if before is not None:  # for writes by hand
            with as_active(before):
                before.dataSource.register(NumberedParquet)
        df.write.format("numbered_parquet").option("records", records).mode("append").save(path)


def recovered(path: str) -> int:
    """Ends what killed jobs left, while no job runs; the next number."""
    folder = Folder(path)
    folder.settle()
    return folder.next()


def units_of_files(spark: SparkSession, path: str, unit: str) -> DataFrame:
    """(number, unit, rows): which units are in which file, to mark them completed when the file has been published."""
    number = F.regexp_extract("_metadata.file_name", NAME.pattern, 1).cast("long").alias("number")
    return spark.read.parquet(path).groupBy(number, F.col(unit)).agg(F.count(F.lit(1)).alias("rows"))
