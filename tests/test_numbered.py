"""Numbered Parquet files: jobs as a whole or not at all, numbers that go on."""

import os

import pytest
from pyspark.sql import functions as F

from speechloom.sources import numbered


def files(path):
    return sorted(n for n in os.listdir(path) if n.endswith(".parquet")) if os.path.isdir(path) else []


def values(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_numbers_go_on_from_job_to_job_and_after_files_are_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    numbered.numbered_parquet(spark.range(0, 25, 1, 2), path, 10)  # 13 and 12 rows
    assert files(path) == [f"{k:08d}.parquet" for k in range(4)]
    units = numbered.units_of_files(spark, path, "id").groupBy("number").agg(F.sum("rows").alias("n"), F.min("id").alias("first")).orderBy("number")
    assert [(r.number, r.n, r.first) for r in units.collect()] == [(0, 10, 0), (1, 2, 10), (2, 10, 12), (3, 3, 22)]
    numbered.numbered_parquet(spark.range(25, 30, 1, 1), path, 10)
    assert files(path)[-1] == "00000004.parquet" and values(spark, path) == list(range(30))
    for name in files(path):
        os.remove(f"{path}/{name}")  # published, so not needed here
    numbered.numbered_parquet(spark.range(1).coalesce(1), path, 10)
    assert files(path) == ["00000005.parquet"]
    os.rename(f"{path}/00000005.parquet", f"{path}/00000041.parquet")  # put there by someone else
    numbered.numbered_parquet(spark.range(1).coalesce(1), path, 10)
    assert files(path) == ["00000041.parquet", "00000042.parquet"]
    numbered.numbered_parquet(spark.range(0), path, 10)
    assert len(files(path)) == 2 and numbered.recovered(path) == 43


def test_a_failed_job_leaves_nothing_and_draws_no_number(spark, tmp_path):
    path = str(tmp_path / "t")
    numbered.numbered_parquet(spark.range(0, 4, 1, 1), path, 2)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        numbered.numbered_parquet(broken, path, 2)
    assert values(spark, path) == [0, 1, 2, 3] and numbered.Folder(path).next() == 2  # a task may still write drafts
    with pytest.raises(Exception, match="nothing is overwritten"):
        spark.range(1).write.format("numbered_parquet").mode("overwrite").save(path)
    numbered.numbered_parquet(spark.range(4, 5).coalesce(1), path, 2)
    assert files(path) == [f"{k:08d}.parquet" for k in range(3)] and not os.listdir(f"{path}/_drafts")


def killed(spark, path, ids, step):
    """A job that is killed in its commit: before the journal, after it, or between two renames."""
    writer = numbered.NumberedWriter(path, 2)
    drafts = writer.write(iter(spark.createDataFrame([(k,) for k in ids], "id long").toArrow().to_batches())).drafts
    folder = numbered.Folder(path)

    def rename(job, first, names):
        if step == 2:
            numbered.Folder.rename(folder, job, first, names[:1])
        raise KeyboardInterrupt

    folder.rename = rename
    if step:
        with pytest.raises(KeyboardInterrupt):
            folder.commit(writer.job, drafts)


@pytest.mark.parametrize("step", [0, 1, 2])
@pytest.mark.parametrize("by", ["recovered", "next job"])
def test_a_killed_job_is_whole_or_absent(spark, tmp_path, step, by):
    path = str(tmp_path / "t")
    numbered.numbered_parquet(spark.range(0, 2, 1, 1), path, 2)
    killed(spark, path, [2, 3, 4, 5, 6], step)
    more = []
    if by == "recovered":
        assert numbered.recovered(path) == (4 if step else 1)
    else:
        more = [7]
        numbered.numbered_parquet(spark.range(7, 8).coalesce(1), path, 2)
    assert values(spark, path) == [0, 1] + ([2, 3, 4, 5, 6] if step else []) + more
    assert files(path) == [f"{k:08d}.parquet" for k in range((4 if step else 1) + len(more))]
    assert not os.listdir(f"{path}/_drafts")


def test_sessions_whichever_is_active_and_after_a_stream_with_batches(spark, tmp_path):
    one, other = spark.newSession(), spark.newSession()
    one.createDataFrame([(1,)], "a int")  # makes its session the active one
    numbered.numbered_parquet(one.range(0, 3, 1, 1), str(tmp_path / "t"), 2)
    numbered.numbered_parquet(other.range(3, 5, 1, 1), str(tmp_path / "t"), 2)  # `one`, which is active, has the source
    other.createDataFrame([(1,)], "a int")
    numbered.numbered_parquet(one.range(5, 7, 1, 1), str(tmp_path / "t"), 2)
    third = spark.newSession()
    third.createDataFrame([(1,)], "id long").write.parquet(str(tmp_path / "in"))

    def batch(df, number):
        df.sparkSession.createDataFrame([(1,)], "a int")  # Python's active session, not the JVM's in this thread

    third.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).foreachBatch(batch).start().awaitTermination()
    numbered.numbered_parquet(third.range(7, 9, 1, 1), str(tmp_path / "t"), 2)
    assert values(spark, str(tmp_path / "t")) == list(range(9)) and len(files(str(tmp_path / "t"))) == 5
    spark.createDataFrame([(1,)], "a int")
