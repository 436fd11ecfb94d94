"""Exact deduplication by a tree merge of sorted digest runs, in DataFrame operations only.

Every input partition forms a run: its digests, each once, with the row that stays, the number of rows and the rows
themselves. A run is cut into buckets by ranges of the digest, and each bucket is a sorted array. Runs then exchange in
binomial rounds, by `fan_in` neighbours in each (two bits of the run's number at a time): they meet bucket by bucket, and
their arrays are merged (a merge sort that finds sorted stretches and merges them); of equal neighbours, at
most one for each run, the first, the smallest, stays with the sum of their counts. When one run is left, its entries are
the winners, and a run's digests are joined with them once: a group of any size meets in no task, as a digest comes once
from each run, and the rows of a digest are listed by run.

A digest is the SHA-256 of the normalised text, verified by a second, independent 64-bit hash and the length: groups
are formed on all three, so that a defect of one of them can't join different texts.

Defined results: null text counts as empty, and empty texts are one group; ties on length go to the smallest id, then to
the row that was read first, so exactly one row of a group is kept, also if rows repeat; a null id loses to any other; each
row is returned; an empty table gives no rows; other columns of the input, whatever their names, are neither read nor
returned. Ids may be of any type that has an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import checkpoint, table

#: Deleted before texts are compared.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
KEY = ["digest", "check", "width"]
#: Runs that a round merges into one.
FAN_IN = 4
#: Digests in a bucket when all runs are one, about.
BUCKET = 2048


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, points, digest, check, width, run): the only pass over the texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("points"), normalised(F.col(text_col)).alias("norm"))
        .select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            "points",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.xxhash64("norm").alias("check"),
            F.length("norm").alias("width"),
            F.spark_partition_id().cast("long").alias("run"),
        )
    )


def same(a: Column, b: Column) -> Column:
    return (a["digest"] == b["digest"]) & (a["check"] == b["check"]) & (a["width"] == b["width"])


def merged(runs: Column, most: int) -> Column:
    """Sorted entries of up to `most` runs as one sorted run: the smallest of equal digests, with the sum of the counts."""

    def entry(x: Column, i: Column) -> Column:
        n = F.aggregate(F.slice(runs, i + 1, most), F.lit(0).cast("long"), lambda a, y: a + F.when(same(x, y), y["n"]).otherwise(F.lit(0)))
        first = (i == 0) | ~same(x, F.get(runs, i - 1))
        return F.when(first, F.struct(*[x[k].alias(k) for k in KEY], x["best"].alias("best"), n.alias("n")))

    return F.filter(F.transform(runs, entry), lambda x: x.isNotNull())


def tree_merge(leaves: DataFrame, fan_in: int = FAN_IN, bucket: int = BUCKET) -> DataFrame:
    """(digest, check, width, best, n), one row for each digest, from (run, digest, check, width, best, n)."""
    n, last = leaves.agg(F.count(F.lit(1)), F.max("run")).first()
    buckets, runs = -(-n // bucket) or 1, (last or 0) + 1
    # a range of the digest's first 48 bits
    place = F.floor(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("double") / float(1 << 48) * buckets)
    level = leaves.groupBy("run", place.alias("bucket")).agg(F.array_sort(F.collect_list(F.struct(*KEY, "best", "n"))).alias("entries"))
    while runs > 1:
        level = level.groupBy(F.expr(f"run div {fan_in}").alias("run"), "bucket").agg(F.array_sort(F.flatten(F.collect_list("entries"))).alias("entries"))
        level = level.select("run", "bucket", merged(F.col("entries"), fan_in).alias("entries"))
        runs = -(-runs // fan_in)
    return level.select(F.inline("entries"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN, bucket: int = BUCKET) -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256), one row for each row of `docs`."""
    best = F.struct((-F.col("points")).alias("order"), F.col("id").isNull().alias("nameless"), F.col("id").alias("id"), F.col("row").alias("row"))
    rows = digests(docs, id_col, text_col).groupBy("run", *KEY)
    leaves = checkpoint(rows.agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("id", "row")).alias("rows")))
    winners = tree_merge(leaves.drop("rows"), fan_in, bucket)
    found = leaves.select(*KEY, "rows").join(winners, KEY)
    return found.select("digest", "best", "n", F.explode("rows").alias("one")).select(
        F.col("one.id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("one.row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
