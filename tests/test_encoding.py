import math
import random

import pytest
from pyspark.sql import functions as F

from speechloom import plugins
from speechloom.operators import encoding


def small():
    return plugins.Energy(codebooks=3, size=16, per_second=2400)  # frames of 10 samples


def recordings(seed, n, longest=400):
    r = random.Random(seed)
    some = [[r.randrange(-128, 128) / 128 for _ in range(r.randrange(1, longest))] for _ in range(n)]
    return [*some, None, [], [0.5] * 30, [0.5] * 30, [0.25] * 31]


def alone(x):
    return small().encode([x])[0] if x else []


@pytest.mark.parametrize("slack", [0.0, 0.1, 1.0])
def test_batches_cover_all_and_bound_the_silence(slack):
    for seed in range(50):
        r = random.Random(seed)
        lengths = sorted(r.randrange(1, 300) for _ in range(r.randrange(0, 60)))
        cuts = list(encoding.batches_of(lengths, 900, slack))
        assert [k for a, b in cuts for k in range(a, b)] == list(range(len(lengths)))
        for a, b in cuts:
            full = lengths[b - 1] * (b - a)
            assert (full <= 900 or b - a == 1) and full - sum(lengths[a:b]) <= slack / (1 + slack) * full + 1e-9


@pytest.mark.parametrize("partitions", [1, 5])
def test_codes_are_those_of_recordings_one_by_one(spark, partitions):
    """Whatever the order of arrival; other columns stay, those named like the results' sources too."""
    all_ = recordings(partitions, 60)
    df = spark.createDataFrame([(k, x, k % 3) for k, x in enumerate(all_)], "id int, x array<float>, part int").repartition(partitions)
    got = encoding.encoded(df, "x", small, budget=2000, per_second=2400)
    assert got.columns == ["id", "part", "codes", "silence"]
    found = {r.id: r for r in got.collect()}
    assert len(found) == len(all_) and all(found[k].part == k % 3 for k in found)
    for k, x in enumerate(all_):
        assert found[k].codes == alone(x)
    silence, samples = sum(r.silence for r in found.values()), sum(len(x or []) for x in all_)
    assert silence <= 0.1 / 1.1 * (silence + samples)


def test_parts_are_joined_along_time(spark):
    """Exactly the limit is one part, a sample more gives two; a part that ends within a frame has that frame filled up."""
    all_ = [*recordings(9, 20), [0.1] * 100, [0.1] * 101, [0.3] * 1000]
    df = spark.createDataFrame(list(enumerate(all_)), "id int, x array<float>").repartition(3)
    got = {r.id: r for r in encoding.encoded_audio(df, "id", "x", small, rate=1000, limit=0.1, per_second=2400).collect()}
    assert len(got) == len(all_)
    for k, x in enumerate(all_):
        pieces = [alone(x[at : at + 100]) for at in range(0, len(x), 100)] if x else []
        assert got[k].codes == [[v for p in pieces for v in p[book]] for book in range(3 if x else 0)]
        assert got[k].parts == max(1, math.ceil(len(x or []) / 100))


def test_one_length_is_spread_over_tasks(spark):
    df = spark.range(4000).select("id", F.transform(F.sequence(F.lit(0), F.lit(29)), lambda k: ((F.col("id") + k) % 64 / 64).cast("float")).alias("x"))
    df = df.withColumn("x", F.concat("x", F.array(F.col("id").cast("float"))))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # partitions as small as these would be put together
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        rows = encoding.encoded(df, "x", small, per_second=2400).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(setting, before)
    assert sum(r["count"] for r in rows) == 4000 and max(r["count"] for r in rows) < 2500


def test_no_recordings(spark):
    assert encoding.encoded_audio(spark.createDataFrame([], "id int, x array<float>"), "id", "x", small).collect() == []
