import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from speechloom import plugins
from speechloom.functions.alphabet import Alphabet

A = Alphabet()
SMALL = Alphabet(offset=100, codebooks=2, size=4)


def encoded(spark, alphabet, matrix):
    return spark.createDataFrame([(matrix,)], "m array<array<int>>").select(alphabet.encode(F.col("m"))).first()[0]


def chars(*points):
    return "".join(map(chr, points))


def test_encode_vectors(spark):
    assert encoded(spark, Alphabet(codebooks=2), [[0, 1], [2, 3]]) == chars(0xE000, 0xE802, 0xE001, 0xE803)
    wide = [[0, 1], [0, 2], [0, 3], [1791, 4], [0, 5], [0, 6], [0, 7], [2047, 8]]
    got = encoded(spark, A, wide)
    assert got == chars(0xE000, 0xE800, 0xF000, 0xFEFF, 0x10000, 0x10800, 0x11000, 0x11FFF, 0xE001, 0xE802, 0xF003, 0xF804, 0x10005, 0x10806, 0x11007, 0x11808)
    assert encoded(spark, Alphabet(codebooks=2), [[], []]) == ""
    assert encoded(spark, A, wide + [[9, 9]] * 24) == got


def test_offsets():
    Alphabet(0x4E00, 8, 2048)
    with pytest.raises(ValueError):
        Alphabet(0x4E00, 32, 2048)


def test_robust_decode(spark):
    df = spark.createDataFrame([(chars(100, 104, 105, 101, 102, 106),), (chars(105, 100, 104, 104, 101),), ("",)], "s string")
    assert [r[0] for r in df.select(SMALL.consistent(F.col("s"))).collect()] == [chars(100, 104, 101, 106), chars(105, 100, 104, 101), ""]
    fast = plugins.consistent_udf(SMALL.offset, SMALL.codebooks, SMALL.size)
    assert [r[0] for r in df.select(fast(F.col("s"))).collect()] == [chars(100, 104, 101, 106), chars(105, 100, 104, 101), ""]
    t = spark.createDataFrame([(chars(105, 100, 104, 101),)], "s string").select(SMALL.trimmed(F.col("s")).alias("t")).first()["t"]
    assert (t.begin, t.body, t.end) == (chars(105), chars(100, 104), chars(101))
    k = spark.createDataFrame([(99,), (100,), (104,), (108,), (500,)], "c int").select(SMALL.codebook(F.col("c"))).collect()
    assert [r[0] for r in k] == [-1, 0, 1, 1, 1]
    assert df.select(SMALL.robust(F.col("s")).alias("m")).collect()[0].m == [[0, 1], [0, 2]]


def test_ragged_decode_stops(spark):
    with pytest.raises(Exception, match="multiple of the codebooks"):
        spark.createDataFrame([(chars(100, 104, 101),)], "s string").select(SMALL.decode(F.col("s"))).collect()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 5).flatmap(lambda t: st.lists(st.lists(st.integers(0, 2047), min_size=t, max_size=t), min_size=8, max_size=8)))
def test_round_trip(spark, matrix):
    df = spark.createDataFrame([(matrix,)], "m array<array<int>>")
    assert df.select(A.decode(A.encode(F.col("m")))).first()[0] == matrix
