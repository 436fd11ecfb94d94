"""Every query of the catalogue against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from speechloom.plans import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    if name in catalogue.ORACLES:
        out = duck.execute(catalogue.ORACLES[name])
        names = [c[0] for c in out.description]
        want = sorted(repr([plain(r[names.index(c)]) for c in sorted(names)]) for r in out.fetchall())
        assert sorted(names) == sorted(df.columns)
        assert got == want


def test_digests_of_whole_documents_pass_in_small_batches(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    catalogue.QUERIES["compatible_digests"](own, DIR)
    assert own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"
