"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from pathlib import Path
from sys import getsizeof

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint, checkpoint_folder

__all__ = ["BROADCAST_BYTES", "Bounded", "alone", "checkpoint", "checkpoint_folder", "keyed", "quoted", "ship", "slices", "small_or_plain", "table"]

#: A side of a join is broadcast only when it was measured to hold no more bytes than this.
BROADCAST_BYTES = 64 << 20

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch at most. Spark's default of ten thousand whole documents is held several times over, outside the heap
#: on the way to a Python worker and back, and in the worker.
BATCH = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of every executor, once per application, and bound their batches."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="speechloom-")
    target = os.path.join(folder, "speechloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def small_or_plain(df: DataFrame, rows: int, bytes_per_row: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when the counted rows are known to fit, else leave the choice of the join to the optimizer."""
    return F.broadcast(df) if rows * bytes_per_row <= limit else df


def quoted(name: str) -> str:
    """A column's name as an expression, dots and all."""
    return "`" + name.replace("`", "``") + "`"


FILE, AT, ODD, NUMBER = "file of the row", "place of the row", "id of several rows", "number of the row"
#: Keys of rows without an id of their own begin here, so any id goes before them.
FIRST = 1 << 62


def keyed(docs: DataFrame, id_col: str, key: str) -> tuple[DataFrame, int]:
    """The rows with `key`, a long that no two rows share, and how many ids aren't one row's alone.

    The key is the id if it is a whole number that no other row has, else a number from FIRST on. Rows without an id of
    their own are numbered once, by where they are in their files, so every scan of the result has the same keys. A table
    that isn't read from files is written to the checkpoint folder first, if there are such rows.
    """
    name = quoted(id_col)
    whole = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    own = F.col(name).cast("long") if whole else F.lit(None).cast("long")
    ids = docs.groupBy(F.col(name).alias(ODD)).agg(F.count(F.lit(1)).alias("n"))
    odd = checkpoint((ids.filter(f"n > 1 or `{ODD}` is null") if whole else ids).select(ODD))
    n = odd.count()
    if not n:
        return docs.withColumn(key, own), 0
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT))
    except AnalysisException:  # no files
        placed = checkpoint(docs).select("*", F.lit("").alias(FILE), F.monotonically_increasing_id().alias(AT))
    found = placed.join(small_or_plain(odd, n, 64), F.col(name).eqNullSafe(F.col(ODD)), "left_semi")
    numbers = checkpoint(found.select(FILE, AT).withColumn(NUMBER, F.monotonically_increasing_id() + F.lit(FIRST)))
    rows = placed.join(small_or_plain(numbers, numbers.count(), 200), [FILE, AT], "left")
    return rows.select(*[F.col(quoted(c)) for c in docs.columns], F.coalesce(F.col(NUMBER), own).alias(key)), n


def slices(batches, rows: int = 512):
    """Arrow batches in parts of at most `rows` rows, so that what is made from them stays small too."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


_memos: list[weakref.ref] = []
_at_work = ""


def alone(owner: str) -> None:
    """A Python worker serves one operator after another: when another one begins, the memos of the others are emptied."""
    global _at_work
    if owner != _at_work:
        _at_work = owner
        for r in _memos:
            memo = r()
            if memo is not None and memo.owner != owner:
                memo.clear()
        _give_back()


def _give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the allocator keep it otherwise."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Bounded(dict):
    """A memo that starts afresh when it holds about `mb` megabytes; `fill(key)` computes what is missing.

    Long keys, such as a text without blanks, are computed each time and not kept.
    """

    #: Of an entry besides its key and value, and the longest key that is kept.
    SLOT, LONG = 100, 1024

    def __init__(self, fill, mb: int = 24, owner: str = ""):
        super().__init__()
        self.fill, self.cap, self.owner, self.size = fill, mb << 20, owner, 0
        _memos.append(weakref.ref(self))

    def clear(self) -> None:
        super().clear()
        self.size = 0

    def __missing__(self, key):
        value = self.fill(key)
        if isinstance(key, int) or len(key) <= self.LONG:
            if self.size >= self.cap:
                self.clear()
            self[key] = value
            self.size += getsizeof(key) + getsizeof(value) + self.SLOT
        return value
