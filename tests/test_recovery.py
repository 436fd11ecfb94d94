"""What a restart does: broken and mended files, interrupted batches, chunks and archives."""

import io
import json
import os
import random
import shutil
import tarfile
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from speechloom.sources import readers, writers
from speechloom.streaming import ingest


def document(name):
    return {"audio_id": name, "text": {"a": f"said by {name}", "a2": "x"}, "codes": {"a": [[1, 2]] * 8}}


def put(path, names, cut=False):
    text = json.dumps([document(n) for n in names], indent=2)
    path.write_text(text[: len(text) // 2] if cut else text)
    later = time.time() + random.random() * 100 + 5  # another modification time
    os.utime(path, (later, later))


def ids(spark, target):
    return sorted(r.id for r in ingest.prepared(spark, target).collect())


def both(*names):
    return sorted(f"{n}_type{k}" for n in names for k in (1, 2))


def test_a_broken_file_is_counted_mended_and_taken_once(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    put(source / "0.json", ["d0", "d1"])
    put(source / "1.json", ["d2", "d3"], cut=True)
    (source / "2.json").write_text("")
    left = ingest.prepare(spark, str(source), target, check)
    assert sorted(r.path.rsplit("/", 1)[-1] for r in left.collect()) == ["1.json"]  # an empty file isn't listed
    assert ids(spark, target) == both("d0", "d1")
    before = ingest.ledger(spark, target).count()
    assert ingest.retake(spark, str(source), target) == 0  # nothing has changed
    assert ingest.ledger(spark, target).count() == before
    put(source / "1.json", ["d2"], cut=True)  # changed, and still broken
    assert ingest.prepare(spark, str(source), target, check).count() == 1
    (source / "1b.json").write_text("[]")
    put(source / "1.json", ["d2", "d3"])
    put(source / "3.json", ["d4"])
    for _ in range(3):
        left = ingest.prepare(spark, str(source), target, check)
        assert [r.path.rsplit("/", 1)[-1] for r in left.collect()] == ["1b.json"]  # no record in it
        assert ids(spark, target) == both("d0", "d1", "d2", "d3", "d4")
    put(source / "2.json", ["d5"])
    put(source / "1b.json", ["d6"])
    assert ingest.prepare(spark, str(source), target, check).isEmpty()
    assert ids(spark, target) == both(*(f"d{k}" for k in range(7)))
    entries = ingest.ledger(spark, target).filter("not failed").groupBy("path").count()
    assert entries.count() == 5 and entries.filter("count > 1").isEmpty()


class Killed(Exception):
    pass


def killed_once(monkeypatch, at):
    """Writing to a path with `at` in it stops the job, the first time."""
    from pyspark.sql import DataFrameWriter

    own, done = DataFrameWriter.parquet, []

    def parquet(self, path, *a, **k):
        if at in path and not done:
            done.append(path)
            raise Killed(path)
        return own(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return done


@pytest.mark.parametrize("at", ["out_files/batch=0", "out/batch=0"])
def test_a_restart_between_the_two_writes_of_a_batch(spark, tmp_path, monkeypatch, at):
    source, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    put(source / "0.json", ["d0"])
    put(source / "1.json", ["d1"], cut=True)
    done = killed_once(monkeypatch, at)
    with pytest.raises(Exception):  # noqa: B017  the query wraps it
        ingest.ingest(spark, str(source), target, check).awaitTermination()
    assert done
    put(source / "1.json", ["d1"])  # mended between the attempts
    assert ingest.prepare(spark, str(source), target, check).isEmpty()
    assert ids(spark, target) == both("d0", "d1")


def test_a_restart_within_a_batch_of_mended_files(spark, tmp_path, monkeypatch):
    source, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    put(source / "0.json", ["d0"], cut=True)
    put(source / "1.json", ["d1"], cut=True)
    assert ingest.prepare(spark, str(source), target, check).count() == 2
    put(source / "0.json", ["d0"])
    put(source / "1.json", ["d1"])
    killed_once(monkeypatch, "out_files/batch=-1")
    with pytest.raises(Killed):
        ingest.retake(spark, str(source), target)
    assert ids(spark, target) == []  # rows without their ledger don't count
    assert ingest.retake(spark, str(source), target, files_per_batch=1) == 2
    assert ids(spark, target) == both("d0", "d1")


def test_repeated_keys_need_no_setting(spark):
    before = spark.conf.get("spark.sql.mapKeyDedupPolicy")
    df = spark.createDataFrame([('{"b": 1, "a": 2, "b": 3}',), ('{"a": 1}',), (None,), ("{}",)], "v string")
    got = df.select(F.map_entries(readers.last_wins(F.from_json("v", "map<string,int>"))).alias("m")).collect()
    assert [None if r.m is None else [tuple(x) for x in r.m] for r in got] == [[("b", 3), ("a", 2)], [("a", 1)], None, []]
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == before


# -- chunks


@pytest.fixture
def rows(spark):
    return spark.range(1000).select(F.col("id"), F.col("id").cast("string").alias("text"))


def chunk_state(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).groupBy("chunk").agg(F.count("*"), F.min("id"), F.max("id"), F.count_distinct("id")).collect())


WHOLE = [(k, 100, 100 * k, 100 * k + 99, 100) for k in range(9)] + [(9, 95, 900, 994, 95)]


@pytest.mark.parametrize("seed", range(4))
def test_any_chunks_lost_or_cut_are_written_again(spark, rows, tmp_path, seed):
    path, r = str(tmp_path / "c"), random.Random(seed)
    rows = rows.filter("id < 995")
    writers.fixed_chunks(rows, path, ["id"], 100)
    assert chunk_state(spark, path) == WHOLE
    kept = {}
    for k in range(10):
        folder = f"{path}/chunk={k}"
        data = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        what = r.choice(["keep", "keep", "lose", "cut", "empty"]) if seed else ("lose" if k == 2 else "keep")
        if what == "keep":
            kept[k] = data
        elif what == "lose":
            shutil.rmtree(folder)
        elif what == "cut":
            for f in data:
                with open(f"{folder}/{f}", "r+b") as file:
                    file.truncate(os.path.getsize(f"{folder}/{f}") // 2)
        else:
            for f in data:
                os.remove(f"{folder}/{f}")
    writers.fixed_chunks(rows, path, ["id"], 100, resume=True)
    assert chunk_state(spark, path) == WHOLE
    for k, data in kept.items():  # whole chunks weren't written again
        assert [f for f in os.listdir(f"{path}/chunk={k}") if f.endswith(".parquet")] == data


def test_resuming_from_nothing_and_with_a_short_chunk(spark, rows, tmp_path):
    path = str(tmp_path / "c")
    writers.fixed_chunks(rows, path, ["id"], 300, resume=True)
    assert [x[:2] for x in chunk_state(spark, path)] == [(0, 300), (1, 300), (2, 300), (3, 100)]
    part = rows.filter("id between 300 and 350").withColumn("chunk", F.lit(1))
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(path)
    assert chunk_state(spark, path)[1][1] == 51
    writers.fixed_chunks(rows, path, ["id"], 300, resume=True)
    assert [x[:2] for x in chunk_state(spark, path)] == [(0, 300), (1, 300), (2, 300), (3, 100)]


def test_footers_are_read_without_contents(spark, rows, tmp_path):
    rows.repartition(2).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "bad.parquet").write_bytes(b"PAR1 nothing PAR1")
    got = {r.path.rsplit("/", 1)[-1]: r for r in readers.footers(spark, str(tmp_path / "p")).collect()}
    assert len(got) == 3 and got["bad.parquet"].error and got["bad.parquet"].rows is None
    assert sum(r.rows or 0 for r in got.values()) == 1000
    assert [r.path.rsplit("/", 1)[-1] for r in readers.unreadable_parquet(spark, str(tmp_path / "p")).collect()] == ["bad.parquet"]


# -- archives


def archive(path, members, cut=False, odd=False):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz" if str(path).endswith("gz") else "w") as t:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    data = buffer.getvalue()
    path.write_bytes(b"no archive at all" if odd else data[: len(data) * 2 // 3] if cut else data)
    later = time.time() + random.random() * 100 + 5
    os.utime(path, (later, later))


def test_a_broken_archive_stops_no_other(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    big = {f"m{k}.txt": random.Random(k).randbytes(5000) for k in range(6)}
    archive(source / "a.tar.gz", {"x.txt": b"1", "y.txt": b"2", "z.bin": b"3"})
    archive(source / "b.tar.gz", big, cut=True)
    archive(source / "c.tar", {"x.txt": b"4"}, odd=True)
    archive(source / "d.tar", {})
    got = readers.extract(spark, str(source), target, ".txt")
    assert sorted((r.archive.rsplit("/", 1)[-1], r.name, bytes(r.content)) for r in got.collect()) == [("a.tar.gz", "x.txt", b"1"), ("a.tar.gz", "y.txt", b"2")]
    state = {r.archive.rsplit("/", 1)[-1]: r for r in readers.extracted(spark, target).collect()}
    assert {k for k, r in state.items() if r.error} == {"b.tar.gz", "c.tar"}
    assert state["d.tar"].members == 0 and state["a.tar.gz"].members == 2
    stamp = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(target) for f in names}
    readers.extract(spark, str(source), target, ".txt")  # nothing changed: nothing is done
    assert stamp == {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(target) for f in names if f in stamp}
    archive(source / "b.tar.gz", big)
    again = readers.extract(spark, str(source), target, ".txt")
    assert again.filter("archive like '%b.tar.gz'").count() == 6 and again.count() == 8
    assert [r.archive.rsplit("/", 1)[-1] for r in readers.extracted(spark, target).filter("error is not null").collect()] == ["c.tar"]


def test_skipped_files_are_counted_in_the_same_scan(spark, tmp_path):
    folder = tmp_path / "s" / "b"
    folder.mkdir(parents=True)
    for k in range(9):
        (folder / f"{k}.json").write_text("{cut" if k % 4 == 1 else json.dumps({"entry_id": f"e{k}", "speaker_id": "s", "book_id": "b"}))
    seen = Observation()
    got = readers.utterance_tree(spark, str(tmp_path), seen)
    assert sorted(r.entry_id for r in got.collect()) == [f"e{k}" for k in range(9) if k % 4 != 1]
    assert seen.get == {"read": 7, "skipped": 2} and len(readers.unreadable_utterances(spark, str(tmp_path)).collect()) == 2
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
