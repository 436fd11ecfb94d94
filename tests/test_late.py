"""Sessions of a stream whose rows come late, against the batch."""

import datetime
import random

from pyspark.sql import functions as F

from speechloom.operators import sequences
from speechloom.streaming import late

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "k string, time timestamp, id long, b double, e double"


def row(key, second, tie, length=1.0):
    return (key, START + datetime.timedelta(seconds=second), tie, float(second), second + length)


def run(spark, tmp_path, parts, **options):
    """Each part is written and taken by a run of its own, which goes on from the checkpoint; the rows and the progress."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    progress = []
    for k, part in enumerate(parts):
        own.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{source}/{k}")
        stream = own.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(source)
        out = late.late_sessions(stream, "k", "time", "id", "b", "e", **options)
        q = out.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(target)
        q.awaitTermination()
        progress += q.recentProgress
    return own.read.parquet(target), progress


def same(got, want):
    shown = lambda df: sorted(map(repr, df.select("k", "id", "segment_index").collect()))
    assert shown(got) == shown(want)


def test_rows_shuffled_within_the_delay_give_the_sessions_of_the_batch(spark, tmp_path):
    rng = random.Random(3)
    data = [row(rng.choice("abc"), rng.randrange(400), n, rng.choice([0.5, 1.0, 9.0])) for n in range(120)]  # ties in time too
    arrival = sorted(data, key=lambda r: r[3] + rng.random() * 60)
    parts = [arrival[:40], arrival[40:70], arrival[70:], [row(None, 10_000, -1)]]
    got, progress = run(spark, tmp_path, parts, delay="60 seconds")
    want = sequences.gap_sessions(spark.createDataFrame(data, SCHEMA), ["k"], "b", "e", "id")
    same(got, want)
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) == 0


def test_rows_beyond_the_delay_are_counted_and_rows_without_time_come_at_once(spark, tmp_path):
    timeless = ("a", None, 9, 5.0, 6.0)
    parts = [[row("a", 0, 0), row("a", 100, 1), timeless], [row("a", 1, 2), row("a", 95, 3)], [row(None, 10_000, -1)]]
    got, progress = run(spark, tmp_path, parts, delay="10 seconds")
    assert sorted((r.id, r.segment_index) for r in got.collect()) == [(0, 0), (1, 2), (3, 1), (9, None)]
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) == 1


def test_keys_without_rows_are_forgotten_by_their_timer(spark, tmp_path):
    parts = [[row("a", 0, 0), row("a", 5, 1), row("b", 3, 2)], [row("c", 300, 3)], [row("a", 301, 4), row("c", 1000, 5)], [row(None, 10_000, -1)]]
    got, progress = run(spark, tmp_path, parts, delay="10 seconds", forget_ms=60_000)
    assert sorted((r.id, r.segment_index) for r in got.collect()) == [(0, 0), (1, 1), (2, 0), (3, 0), (4, 0), (5, 0)]
    states = spark.read.format("statestore").option("path", str(tmp_path / "c")).load()
    assert states.select(F.col("key.k")).collect() == [(None,)]  # the row that ended the stream


def test_many_keys_in_few_buckets_give_the_sessions_of_the_batch(spark, tmp_path):
    rng = random.Random(4)
    keys = [None, *(f"u{k}" for k in range(150))]
    data = [row(rng.choice(keys), rng.randrange(400), n, rng.choice([0.5, 1.0, 90.0])) for n in range(900)]
    data = [(*r[:4], None) if r[2] % 50 == 0 else r for r in data]
    arrival = sorted(data, key=lambda r: r[3] + rng.random() * 60)
    got, progress = run(spark, tmp_path, [arrival[:400], arrival[400:], [row(None, 10_000, -1)]], delay="60 seconds", buckets=4)
    same(got, sequences.gap_sessions(spark.createDataFrame(data, SCHEMA), ["k"], "b", "e", "id"))
    # a call and a row of state for each bucket, and one for null, however many keys there are
    assert max(s.numRowsTotal for p in progress for s in p.stateOperators) == 5


def test_a_bucket_forgets_each_key_by_itself_and_is_dropped_with_its_last(spark, tmp_path):
    parts = [[row("a", 0, 0), row("a", 5, None), row("b", 3, 2), ("b", None, 9, 5.0, 6.0)], [row("c", 300, 3)], [row("a", 301, 4), row("c", 1000, 5)], [row(None, 10_000, -1)]]
    got, _ = run(spark, tmp_path, parts, delay="10 seconds", forget_ms=60_000, buckets=1)
    want = [(-9, "a", 1), (0, "a", 0), (2, "b", 0), (3, "c", 0), (4, "a", 0), (5, "c", 0), (9, "b", None)]
    assert sorted((-9 if r.id is None else r.id, r.k, r.segment_index) for r in got.collect()) == want
    states = spark.read.format("statestore").option("path", str(tmp_path / "c")).load()
    assert states.select(F.col("key._bucket")).collect() == [(None,)]  # the row that ended the stream
