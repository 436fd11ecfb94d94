"""Scans in stretches give what windows by key give, and deal one large key over all tasks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechloom.operators import sequences, stretches


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark):
    """One key with nine tenths of the rows, small keys, a null key and null values."""
    r = random.Random(4)
    out, at = [], 0.0
    for n in range(3000):
        key = "hot" if r.random() < 0.9 else r.choice(["a", "b", None])
        at += r.choice([0.1, 0.1, 0.3])
        end = None if r.random() < 0.02 else at + r.choice([0.05, 0.1, 0.4])
        out.append((key, n, round(at, 3), end, int(r.random() < 0.6), r.choice([0, 0, 1, 5, 9, None])))
    df = spark.createDataFrame(out, "k string, id int, b double, e double, ok int, size int").repartition(5)
    return df.cache()


def test_one_key_is_dealt_over_all_tasks(spark, table):
    few, large = stretches.split(table, ["k"], ["b", "id"], 500)
    assert {r.k for r in few.select("k").distinct().collect()} == {"a", "b", None}
    sizes = [r[0] for r in large.groupBy(stretches.STRETCH).count().select("count").collect()]
    assert len(sizes) == 6 and max(sizes) < 0.3 * sum(sizes)
    assert stretches.split(table, ["k"], ["b"], 10_000)[1] is None


def test_gap_sessions(table):
    want = sequences.gap_sessions(table, ["k"], "b", "e", "id")
    got = sequences.gap_sessions(table, ["k"], "b", "e", "id", most=100)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert want.agg(F.max("segment_index")).first()[0] > 100


def test_pairs(table):
    args = (table, ["k"], ["b", "id"], ["id", "e"])
    assert rows(sequences.consecutive_pairs(*args, most=100)) == rows(sequences.consecutive_pairs(*args))


@pytest.mark.parametrize("limit", [1, 3, 5, 8, 60])
def test_misses(table, limit):
    args = (table.select("k", "id", "ok"), "k", "id", F.col("ok") == 1, limit)
    assert rows(sequences.until_misses(*args, most=100)) == rows(sequences.until_misses(*args))


def test_misses_over_stretches_without_a_success(spark):
    df = spark.range(2000).select(F.lit("h").alias("k"), F.col("id"), (~F.col("id").between(300, 1700)).alias("ok"))
    for limit, n in ((1401, 300), (1402, 599)):
        got = sequences.until_misses(df, "k", "id", F.col("ok"), limit, most=100)
        assert got.count() == n and rows(got) == rows(sequences.until_misses(df, "k", "id", F.col("ok"), limit))


@pytest.mark.parametrize("threshold", [1, 7, 40, 3000, 10**9])
def test_batches(table, threshold):
    args = (table, "k", "id", "size", threshold)
    assert rows(sequences.threshold_batches(*args, most=100)) == rows(sequences.threshold_batches(*args))


def test_what_a_stretch_makes_of_a_total():
    r = random.Random(9)
    for _ in range(300):
        threshold = r.randint(1, 30)
        sizes = np.array([r.choice([0, 0, 1, 2, 7, 40]) for _ in range(r.randint(1, 25))])
        pieces = stretches.Resets(sizes, threshold).pieces()
        assert [p[0] for p in pieces] == sorted({p[0] for p in pieces}) and pieces[0][0] == 0
        for given in range(threshold):
            total, batch, want = given, 0, []
            for s in sizes:
                want.append(batch)
                total += s
                if total >= threshold:
                    total, batch = 0, batch + 1
            _, end, closed, adds = [p for p in pieces if p[0] <= given][-1]
            assert (end + (given if adds else 0), closed) == (total, batch), (sizes, threshold, given)
            assert stretches.Resets(sizes, threshold).batches(given).tolist() == want
