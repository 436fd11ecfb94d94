"""The corpus pipeline: five stages, each applied to all that the stage before it kept.

Documents are told apart by row, not by id: a row whose id no other row has goes by its id, rows with repeated or null ids
get a number of their own (`keyed`). So equal rows are copies like any others, one of them stays, and a text is never
dropped because of what another row of its id holds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from speechloom.llm._common import checkpoint, checkpoint_folder, keyed, quoted, small_or_plain, table

KEY = "row key of the stage"


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Each row is judged alone, by its text; the threshold is that of its language, the common one for a null or new
    language. Null and empty texts are judged as the reserved word; null and repeated ids make no difference, repeated rows
    go or stay together; an empty table stays empty; all columns pass through, whatever their names.
    """
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns))
    return found.filter("not rejected").select(*[F.col(quoted(f"kept_{c}")).alias(c) for c in docs.columns])


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts exactly one row stays: the longest as it stands, then the smallest id.

    Rows with a repeated or null id go after those with an id of their own, in the order of the files. Null and empty texts
    are equal. An empty table stays empty; all columns pass through, whatever their names.
    """
    rows, _ = keyed(docs, "doc_id", KEY)
    found = exact_dedup.exact_dedup(rows, KEY)
    return without(rows, found.filter("not kept").select(KEY), docs.columns)


def near_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates exactly one row stays, that with the smallest id.

    Rows with a repeated or null id go after those with an id of their own, and are linked by their texts alone. Texts
    without words are linked with nothing and stay. An empty table stays empty; all columns pass through.
    """
    rows, _ = keyed(docs, "doc_id", KEY)
    found = jaccard_join.near_duplicates(rows, KEY)
    return without(rows, found.filter(F.col(KEY) != F.col("component_id")).select(KEY), docs.columns)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Each row is judged alone, so null and repeated ids make no difference and repeated rows go or stay together. Null and
    empty texts stay. Items with a null id or without words are passed over; without items everything stays. An empty table
    stays empty; all columns pass through, whatever their names.
    """
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns))
    return found.filter("not contaminated").select(*[F.col(quoted(f"kept_{c}")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in sequences, as `op10_pack` returns them.

    Each row gives its pieces, with repeated and null ids too; null and empty texts are the end mark alone; an empty table
    gives no rows; other columns are not returned.
    """
    return packing.pack(docs)


def without(rows: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """The texts stay where they are if the keys to drop are few enough to be sent around."""
    dropped = checkpoint(dropped)
    return rows.join(small_or_plain(dropped, dropped.count(), 16), KEY, "left_anti").select(*map(quoted, columns))


STAGES = [
    ("toxicity", toxic_out),
    ("exact dedup", copies_out),
    ("near duplicates", near_out),
    ("decontamination", leaks_out),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the packing; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage keeps is written as Parquet to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
