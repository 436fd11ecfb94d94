import json
import os
import random
import tarfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from speechloom import plugins, session
from speechloom.functions.alphabet import Alphabet
from speechloom.functions import ids
from speechloom.functions.markup import AE, AS, BOS, EOS, TE, TS
from speechloom.operators import audits, documents, merges, sequences, statistics, vocabulary
from speechloom.plans import catalogue, recipes
from speechloom.sources import publish, readers, writers
from speechloom.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(("prev", "begin", "same"), [(20.0, 20.2, True), (5.3, 5.5, False), (0.1, 0.3, True), (20.0, 19.85, True), (20.0, 19.7, False)])
def test_gap(spark, prev, begin, same):
    df = spark.createDataFrame([("k", "a", -100.0, prev), ("k", "b", begin, begin + 1)], "k string, id string, b double, e double")
    got = sequences.gap_sessions(df, ["k"], "b", "e", "id").orderBy("id").collect()
    assert got[1].segment_index == (0 if same else 1)


def test_book_documents(spark):
    base = [("e1", "p", "s", "b", " hi ", 0.0, 1.0, "X"), ("e2", "p", "s", "b", "yo", 1.1, 2.0, "Y"), ("e3", "p", "s", "b", "z", 9.0, 9.5, "Z"), ("e4", "q", "s", "b", "w", 0.0, 1.0, "W")]
    df = spark.createDataFrame(base, "entry_id string, original_path string, speaker_id string, book_id string, transcript string, begin_time double, end_time double, audio_str string")
    got = {r.id: r for r in recipes.book_documents(df).collect()}
    assert set(got) == {f"{e}_type{k}" for e in ("e1_seg0", "e3_seg1", "e4") for k in (1, 2)}
    assert got["e1_seg0_type1"].text == BOS + TS + "hi" + TE + AS + "X" + AE + TS + "yo" + TE + AS + "Y" + AE + EOS
    assert got["e1_seg0_type2"].num_segments == 2


def test_indexed_matches_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"))
    got = sequences.indexed(df, ["x"]).orderBy("x").collect()
    assert [r.position for r in got] == list(range(1000))


def test_indexed_keeps_every_row_with_all_its_columns(spark, tmp_path):
    wide = spark.range(100_000, numPartitions=7).select(F.col("id"), (F.col("id") * 7919 % 100_003).alias("x"), F.repeat(F.col("id").cast("string"), 12).alias("payload"), F.lit("s").alias("source"))
    got = sequences.indexed(wide, ["x"])
    assert got.count() == 100_000
    assert tuple(got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()) == (0, 99_999, 100_000)
    assert got.filter("payload <> repeat(cast(id as string), 12)").isEmpty()
    at = {r.position: r.x for r in got.filter("position % 9973 = 0").collect()}
    assert at == dict(zip(range(0, 100_000, 9973), sorted(k * 7919 % 100_003 for k in range(100_000))[::9973], strict=True))
    writers.fixed_chunks(wide, str(tmp_path / "f"), ["x"], 30_000)
    back = spark.read.parquet(str(tmp_path / "f"))
    assert rows(back.groupBy("chunk").count()) == [(0, 30_000), (1, 30_000), (2, 30_000), (3, 10_000)]
    assert rows(back.groupBy("chunk").agg(F.min("x") < F.max("x")).select("chunk")) == [(0,), (1,), (2,), (3,)]


def test_batches_quota_misses(spark):
    df = spark.createDataFrame([(f"s{k:02d}",) for k in range(25)], "s string")
    got = sequences.group_batches(df, "s", 10).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [10, 10, 5]
    q = spark.createDataFrame([("a", 9), ("b", 1), ("c", 90)], "l string, n long").select("l", sequences.proportional_quota(F.col("n"), F.lit(100), 50))
    assert rows(q) == [("a", 4), ("b", 1), ("c", 45)]
    ok = [1, 0, 0, 1, 0, 0, 0, 0, 0, 1]
    m = spark.createDataFrame([("g", k, bool(v)) for k, v in enumerate(ok)], "g string, p int, ok boolean")
    assert [r.p for r in sequences.until_misses(m, "g", "p", F.col("ok")).orderBy("p").collect()] == [0, 3]
    x = spark.createDataFrame([(1000, 3, 7)], "t long, s long, n long").select(statistics.extrapolated(F.col("t"), F.col("s"), F.col("n"))).first()[0]
    assert x == 2333


def test_speakers_pairs(spark):
    df = spark.createDataFrame([("d", 0, "B", "x", "1"), ("d", 1, "A", "y", "2"), ("d", 2, "B", "z", "3"), ("d", 3, "C", "w", "4")], "d string, o int, s string, text string, audio_str string")
    r = recipes.conversations(df, "d", "o", "s", recipes.Recipe()).first()
    assert (r.speaker_ids, r.speaker_count) == ([0, 1, 0, 2], 3)
    assert r.text.startswith(BOS + TS + "[0]x" + TE + AS + "1" + AE)
    pairs = recipes.tts_pairs(df.withColumn("id", F.concat(F.lit("s"), "o")), ["d"], ["o"], recipes.Recipe())
    assert sorted(r.id for r in pairs.collect()) == ["s0#s1", "s1#s2", "s2#s3"]


def test_long_parts(spark):
    df = spark.createDataFrame([(60.0,), (60.00005,), (150.0,)], "s double").select(documents.long_parts(F.col("s")).alias("p"))
    got = [r.p for r in df.collect()]
    assert [len(p) for p in got] == [1, 2, 3]
    assert [x.length for x in got[2]] == [1_440_000, 1_440_000, 720_000]


def raw_files(folder):
    docs = [
        {"audio_id": "d1", "text": {"b": "one", "a": "two", "x": "no codes"}, "codes": {"b": [[1, 2]] * 8, "a": [[3]] * 8, "y": [[1]] * 8}},
        {"audio_id": "d2", "text": {"a": "t"}, "codes": {"a": []}},
        {"audio_id": "d3", "text": {"a": "t"}},
    ]
    (folder / "00000000.json").write_text(json.dumps(docs, indent=2))
    (folder / "00000001.json").write_text('[{"audio_id": "d4", "text": {"a": "1", "a": "2"}, "codes": {"a": [[5],[5],[5],[5],[5],[5],[5],[5]]}}]')


def test_raw_documents_and_ingest(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    raw_files(source)
    chunks = {r.audio_id: r.chunks for r in documents.chunks_of(readers.raw_documents(spark, str(source))).collect()}
    assert set(chunks) == {"d1", "d4"}
    assert [c.text for c in chunks["d1"]] == ["one", "two"]
    assert [c.text for c in chunks["d4"]] == ["2"]
    target, check = str(tmp_path / "out"), str(tmp_path / "check")
    for _ in range(2):  # nothing new the second time
        ingest.ingest(spark, str(source), target, check).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["d1_type1", "d1_type2", "d4_type1", "d4_type2"]
    (source / "00000002.json").write_text(json.dumps([{"audio_id": "d5", "text": {"a": "t"}, "codes": {"a": [[1]] * 8}}]))
    ingest.ingest(spark, str(source), target, check).awaitTermination()
    assert spark.read.parquet(target).count() == 6


def test_readers(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a\n\n# c\n b \n")
    assert sorted(r.id for r in readers.id_list(spark, str(tmp_path / "l.txt")).collect()) == ["a", "b"]
    assert readers.id_list(spark, str(tmp_path / "l.txt"), comments=False).count() == 3
    (tmp_path / "c.json").write_text('{"en000": 3,\n "de000": 4}')
    assert rows(readers.counts(spark, str(tmp_path / "c.json"))) == [("de000", 4), ("en000", 3)]
    (tmp_path / "p.tsv").write_text("a\tb\nbad\nc\td\te\n")
    assert rows(readers.pairs_tsv(spark, str(tmp_path / "p.tsv"))) == [("a", "b")]
    with tarfile.open(tmp_path / "t.tar.gz", "w:gz") as t:
        t.add(tmp_path / "l.txt", "x/l.txt")
    got = readers.archive_members(spark, str(tmp_path / "t.tar.gz")).first()
    assert (got.name, bytes(got.content).decode()) == ("x/l.txt", "a\n\n# c\n b \n")
    ragged = np.empty(2, dtype=object)
    ragged[:] = [np.ones((2, 3), "uint16"), np.zeros((2, 1), "uint16")]
    np.save(tmp_path / "a.npy", ragged, allow_pickle=True)
    np.save(tmp_path / "b.npy", np.full((1, 1, 2, 2), 7))
    assert [len(r.codes[0]) for r in readers.code_arrays(spark, str(tmp_path / "a.npy")).orderBy("item").collect()] == [3, 1]
    assert readers.code_arrays(spark, str(tmp_path / "b.npy")).first().codes == [[7, 7], [7, 7]]
    assert [r.id for r in readers.numbered_by(spark, "EN", 1).collect()] == ["EN-B000000", "EN-B000001"]
    spark.range(123).write.parquet(str(tmp_path / "n"))
    assert readers.row_count(spark, str(tmp_path / "n")) == 123
    assert readers.listing(spark, str(tmp_path), "*.tsv").count() == 1


def test_utterance_tree(spark, tmp_path):
    d = tmp_path / "s" / "b"
    d.mkdir(parents=True)
    (d / "1.json").write_text(json.dumps({"entry_id": "e", "begin_time": "1.5", "speaker_id": "s"}))
    (d / "2.json").write_text("{broken")
    got = [r for r in readers.utterance_tree(spark, str(tmp_path)).collect() if r.entry_id]
    assert [(r.entry_id, r.begin_time, r.end_time) for r in got] == [("e", 1.5, 0.0)]


def test_writers(spark, tmp_path):
    df = spark.range(25).select(F.col("id"), F.when(F.col("id") < 10, "a").otherwise("b").alias("shard_id"))
    out = str(tmp_path / "w")
    writers.sharded_parquet(df, out)
    writers.sharded_parquet(df.filter("shard_id = 'a'").limit(3), out)
    assert rows(spark.read.parquet(out).groupBy("shard_id").count()) == [("a", 3), ("b", 15)]
    writers.fixed_chunks(df.select("id"), str(tmp_path / "c"), ["id"], 10)
    assert rows(spark.read.parquet(str(tmp_path / "c")).groupBy("chunk").count()) == [(0, 10), (1, 10), (2, 5)]
    writers.batched_parquet(df, str(tmp_path / "b"), 5)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 25
    writers.tsv(df, str(tmp_path / "t"))
    assert readers.pairs_tsv(spark, str(tmp_path / "t")).count() == 25
    files = spark.createDataFrame([("en", "s", "a", 1500), ("de", "s", "b", None)], "lang string, shard string, sub string, n long")
    writers.report(statistics.HEAD, statistics.report_lines(statistics.rows_by_language(files)), str(tmp_path / "r"))
    assert rows(statistics.parsed_report(spark.read.text(str(tmp_path / "r")))) == [("de", 0, 1, 1), ("en", 1500, 1, 1)]


def test_audits(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "s string")
    have = spark.createDataFrame([("c",), ("d",)], "s string")
    assert rows(audits.pending(wanted, have, "s")) == [("a",), ("b",), ("b",)]
    assert rows(audits.missing_extra(wanted, have, "s")) == [("a", "missing"), ("b", "missing"), ("d", "extra")]
    twice = spark.createDataFrame([("k", 2, "second"), ("k", 1, "first")], "k string, o int, v string")
    assert rows(audits.first_by_id(twice, "k", ["o"])) == [("k", 1, "first")]


def test_merges(spark):
    with pytest.raises(ValueError):
        merges.MergePlan(vocab_size=10)
    plan = merges.MergePlan(Alphabet(codebooks=1, size=4, offset=97), vocab_size=10, max_ngrams=3)
    df = spark.createDataFrame([("ababab",), ("abc",), ("abc",)], "s string")
    learned = merges.train(df, "s", plan, rounds=2)
    assert learned[0] == ("a", "b")
    assert merges.apply("abab", learned[:1]) == ["ab", "ab"]
    assert merges.train(df, "s", merges.MergePlan(Alphabet(codebooks=1, size=4, offset=97), vocab_size=10, max_ngrams=0)) == []


def pair_counts(rows, limit):
    n = Counter(p for t in rows for p in zip(t, t[1:]) if len(p[0]) + len(p[1]) <= limit)
    return sorted(((a, b, c) for (a, b), c in n.items() if c > 1), key=lambda r: (-r[2], r[0], r[1]))


def one_at_a_time(texts, limit, most):
    rows, learned = [list(t) for t in texts], []
    while len(learned) < most and (ranked := pair_counts(rows, limit)):
        learned.append(ranked[0][:2])
        rows = [merges.joined(t, {learned[-1]}) for t in rows]
    return learned, rows


def random_texts(seed):
    r = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"[: r.randint(1, 26)]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(r.randint(1, 30))]
    return texts + texts[:5] + ["abcabcabc" * 4, "aaaaaaa"]


def test_merges_of_rounds_are_those_of_one_at_a_time():
    fewer = 0
    for seed in range(150):
        texts, limit, at_once = random_texts(seed), 2 + seed % 8, (2, 7, 1000)[seed % 3]
        want, rows = one_at_a_time(texts, limit, 60)
        state, learned, rounds = [list(t) for t in texts], [], 0
        while len(learned) < 60 and (ranked := pair_counts(state, limit)):
            found = merges.independent(ranked[:at_once], {a + b for a, b in learned}, len(ranked) <= at_once)[: 60 - len(learned)]
            state = [merges.joined(t, set(found)) for t in state]
            learned += found
            rounds += 1
        assert learned == want and state == rows and [merges.apply(t, want) for t in texts] == rows
        fewer += len(want) - rounds
    assert fewer > 0


def test_encoder_gives_what_merges_give_one_after_another():
    for seed in range(200):
        texts = random_texts(seed)
        learned, rows = one_at_a_time(texts, 2 + seed % 8, 60)
        own = merges.Encoder(learned, {})
        assert [own.tokens(t) for t in texts] == rows
    # merges in any order, some of them more than once
    r = random.Random(1)
    for _ in range(300):
        made, learned = list("abc"), []
        for _ in range(r.randint(1, 25)):
            learned.append((r.choice(made), r.choice(made)))
            if len(made[-1]) < 12:
                made.append("".join(learned[-1]))
        text = "".join(r.choice("abcd") for _ in range(r.randint(0, 80)))
        assert merges.Encoder(learned, {}).tokens(text) == merges.apply(text, learned)


def test_merged_tokens_of_every_codec_string(spark):
    """The catalogue's query against merges applied one after another."""
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no tables")
    texts = {r.vec_id: r.audio_str for r in catalogue.QUERIES["codec_encode"](spark, d).collect()}
    plan = merges.MergePlan(Alphabet(), vocab_size=17_000, max_ngrams=2)
    learned = one_at_a_time([texts[k] for k in sorted(texts)], 16, 24)[0]
    ids = merges.vocabulary(plan, learned)
    got = catalogue.QUERIES["merged_tokens"](spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        want = [ids[t] for t in merges.apply(texts[r.vec_id], learned)]
        assert (r.n_tokens, r.ids) == (len(want), ",".join(map(str, want)))


def test_long_texts_are_encoded_in_time():
    learned = [("a", "b"), ("ab", "ab"), ("abab", "abab")]
    assert len(merges.Encoder(learned, {}).tokens("ab" * 100_000)) == 25_000


def test_encoded_column(spark):
    texts = random_texts(7)
    plan = merges.MergePlan(Alphabet(codebooks=1, size=26, offset=97), vocab_size=200, max_ngrams=6)
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate([*texts, None, "A", ""])], "ids2 int, s string, tokens int").repartition(3)
    learned = merges.train(df, "s", plan, rounds=30)
    ids = merges.vocabulary(plan, learned)
    assert list(ids)[:3] == ["<pad>", "<eos>", "a"] and len(ids) == 28 + len({a + b for a, b in learned})
    got = merges.encoded(df, "s", learned, plan)
    assert got.columns == ["ids2", "s", "tokens", "ids"]
    for r in got.collect():
        assert r.ids == (None if r.s is None else [ids.get(t, -1) for t in merges.apply(r.s, learned)])


def test_merges_of_a_table(spark):
    texts = random_texts(5)
    plan = merges.MergePlan(Alphabet(codebooks=1, size=26, offset=97), vocab_size=200, max_ngrams=6)
    got = merges.train(spark.createDataFrame([(t,) for t in [*texts, None]], "s string"), "s", plan, rounds=12)
    assert got == one_at_a_time(texts, 6, 12)[0]


def test_merges_of_buckets(spark):
    """Strings in many buckets: the merges of one string after another, fewer strings read for rarer pairs, nothing left."""
    folder = session.checkpoint_folder(spark).removeprefix("file:")
    plan = merges.MergePlan(Alphabet(codebooks=1, size=26, offset=97), vocab_size=400, max_ngrams=6)
    for seed, at_once in ((5, 2), (13, 1000)):
        texts, work = random_texts(seed) + random_texts(seed + 1), []
        df = spark.createDataFrame([(t,) for t in [*texts, None]], "s string")
        got = merges.train(df, "s", plan, rounds=14, at_once=at_once, bucket=5, report=work.append)
        assert got == one_at_a_time(texts, 6, 14)[0]
        assert max(w.strings for w in work) <= len(set(texts)) and sum(w.merges for w in work) <= 14
    assert not [f for f in os.listdir(folder) if f.startswith("merges-")]


def test_rounds_read_what_holds_their_pairs(spark):
    """The frequent pairs are everywhere, the rare ones in few strings each: rounds read ever less."""
    r = random.Random(3)
    texts = ["ab" * 3 + "".join(r.choice("cd") for _ in range(2)) + f"{chr(0x4E00 + k // 2)}{chr(0x6E00 + k // 2)}" for k in range(200)]
    plan = merges.MergePlan(Alphabet(codebooks=1, size=26, offset=97), vocab_size=400)
    work = []
    got = merges.train(spark.createDataFrame([(t,) for t in texts], "s string"), "s", plan, rounds=16, at_once=8, bucket=4, report=work.append)
    assert work[0].strings == len(set(texts)) and work[-1].strings < work[0].strings / 4
    rows = [list(t) for t in texts]
    for p in got:
        ranked = pair_counts(rows, 1 << 30)
        assert ranked[0][:2] == p
        rows = [merges.joined(t, {p}) for t in rows]


def test_merges_of_no_strings(spark):
    plan = merges.MergePlan(Alphabet(codebooks=1, size=26, offset=97), vocab_size=400)
    assert merges.train(spark.createDataFrame([], "s string"), "s", plan) == []
    assert merges.train(spark.createDataFrame([(None,), ("",)], "s string"), "s", plan) == []


def test_independent_pairs():
    ranked = [("a", "b", 9), ("c", "d", 8), ("e", "f", 5), ("b", "c", 5), ("g", "h", 4)]
    assert merges.independent(ranked, set(), True) == [("a", "b"), ("c", "d")]
    assert merges.independent(ranked[:3], set(), True) == [("a", "b"), ("c", "d"), ("e", "f")]
    assert merges.independent(ranked[:3], set(), False) == [("a", "b"), ("c", "d")]
    assert merges.independent(ranked[:3], {"ab"}, True) == [("a", "b")]
    assert merges.independent([("a", "a", 9), ("c", "d", 8)], set(), True) == [("a", "a")]


def test_resampling_filter():
    t = np.arange(24_000) / 24_000
    low, high = np.sin(2 * np.pi * 440 * t), np.sin(2 * np.pi * 11_000 * t)
    got = plugins.resampled(low + high, 24_000, 16_000)  # 11 kHz is above the new band
    assert len(got) == 16_000
    assert np.abs(got - np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000))[200:-200].max() < 5e-3
    up = plugins.resampled(low, 24_000, 48_000)
    assert np.abs(up - np.sin(2 * np.pi * 440 * np.arange(48_000) / 48_000))[200:-200].max() < 5e-3
    assert np.allclose(plugins.resampled([0.25] * 50_000, 44_100, 24_000), 0.25) and len(plugins.resampled([], 8_000, 24_000)) == 0
    assert plugins.resampled([1.0, 2.0], 8_000, 8_000).tolist() == [1.0, 2.0]


def test_added_tokens(spark):
    base = spark.range(151_669).select(F.format_string("t%d", "id").alias("token"), "id")
    tags = ["<|text_start|>", "<|text_end|>", "<|audio_start|>", "<|audio_end|>"]
    vocab = vocabulary.extended(base, [*merges.initial_alphabet(), *tags, "t5", tags[0], "<bos>", "<eos>"])
    n, last, ids = vocab.agg(F.count("id"), F.max("id"), F.countDistinct("id")).first()
    assert (n, last, ids) == (168_059, 168_058, 168_059)
    assert vocabulary.ids_of(vocab, {"begin": "<bos>", "end": "<eos>", "none": "?"}) == {"begin": 168_057, "end": 168_058, "none": None}
    assert [tuple(r) for r in vocabulary.extended(base.limit(0), ["x", "x", "y"]).collect()] == [("x", 0), ("y", 1)]
    table = spark.createDataFrame([(k, [float(k), -1.0]) for k in range(10)], "id long, vector array<float>")
    big = {r.id: list(r.vector) for r in vocabulary.resized(table, 400, trained=8).collect()}
    assert sorted(big) == list(range(400)) and [big[k] for k in range(8)] == [[float(k), -1.0] for k in range(8)]
    new = np.array([big[k] for k in range(8, 400)])
    assert np.allclose(new.mean(0), [3.5, -1.0], atol=0.01) and np.allclose(new.std(0), 0.02, atol=0.005)
    assert sorted(r.id for r in vocabulary.resized(table, 4).collect()) == [0, 1, 2, 3]


def test_plugins(spark):
    df = spark.createDataFrame([([0.0] * 1921,), ([0.5] * 10,)], "x array<float>")
    codes = df.select(plugins.encoder_udf(plugins.Energy)(F.col("x")).alias("c")).collect()
    assert [(len(r.c), len(r.c[0])) for r in codes] == [(8, 2), (8, 1)]
    words = spark.createDataFrame([("a b c",), (None,)], "t string").select(plugins.token_length_udf(lambda: str.split)(F.col("t")).alias("n"))
    assert [r.n for r in words.collect()] == [3, 0]
    half = df.select(F.size(plugins.resampler_udf(12_000)(F.col("x"), F.lit(24_000)))).collect()
    assert [r[0] for r in half] == [960, 5]


def test_streamed_sessions_match_the_batch(spark, tmp_path):
    data = [(k % 2, float(b), float(b) + 1.0) for k, b in enumerate([0, 0, 1, 9, 2, 10, 30, 11, 31, 40])]
    schema = "k long, b double, e double"
    (tmp_path / "in").mkdir()
    batch = spark.createDataFrame(sorted(data, key=lambda r: r[1]), schema)
    for n, part in enumerate((data[:6], data[6:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = ingest.sessions(spark, stream, "k", "b", "e").writeStream.format("memory").queryName("streamed").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = sequences.gap_sessions(batch, ["k"], "b", "e", "e").select("k", "b", "e", "segment_index")
    assert rows(spark.table("streamed").select("k", "b", "e", "segment_index")) == rows(want)


def test_work_state(spark):
    files = spark.createDataFrame([(f"/w/{p}",) for p in ("s1/a.mp3", "s1/b.wav", "s1/x.cache.json", "s1/.extraction_complete", "s2/s2.tar.gz")], "path string")
    got = rows(readers.work_state(files))
    assert got == [("s1", True, 1, 2, True, False), ("s2", False, 0, 0, False, True)]
    want = spark.createDataFrame([("/w/s2/s2.tar.gz",), ("/w/none",)], "path string")
    assert rows(readers.available(spark, want, files)) == [("/w/none", False), ("/w/s2/s2.tar.gz", True)]


def test_publishing(spark, tmp_path):
    source, target = tmp_path / "local", tmp_path / "hub" / "data"
    (source / "sub").mkdir(parents=True)
    target.parent.mkdir()
    for k in range(5):
        (source / ("sub" if k % 2 else ".") / f"f{k}.txt").write_text("x" * (k + 1))
    waits = []
    publish.publish_folder(spark, str(source), str(target), sleep=waits.append)
    assert sorted(p.name for p in target.rglob("*.txt")) == [f"f{k}.txt" for k in range(5)] and not list(tmp_path.rglob("_draft*")) and not waits
    with pytest.raises(publish.Conflict):  # it is there already
        publish.publish_folder(spark, str(source), str(target), attempts=3, sleep=waits.append)
    assert len(waits) == 2 and 5 <= waits[0] <= 10 and 10 <= waits[1] <= 15 and publish.conflict_delay(9) == 120
    (target / "f2.txt").unlink()
    (target / "f4.txt").write_text("short")
    (target / "f4.txt").write_text("other size")
    assert rows(publish.compared(spark, str(source), str(target)).select("name", "state")) == [("f0.txt", "published"), ("f2.txt", "missing"), ("f4.txt", "different"), ("sub/f1.txt", "published"), ("sub/f3.txt", "published")]
    assert publish.delete_published(spark, str(source), str(target)) == 3
    assert sorted(p.name for p in source.rglob("*.txt")) == ["f2.txt", "f4.txt"]
    publish.publish_table(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)already exists"):
        publish.publish_table(spark.range(3), str(tmp_path / "t"))


def test_retries_and_limits():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("away")
        return "here"

    assert publish.retried(flaky, sleep=waits.append) == "here" and waits == [1.0, 2.0]
    assert publish.retried(lambda: open("/nowhere/x"), otherwise=lambda: "direct", sleep=waits.append) == "direct"
    with pytest.raises(OSError):
        publish.retried(lambda: open("/nowhere/x"), sleep=waits.append)
    import threading
    import time

    now, most, lock = [0], [0], threading.Lock()

    def job(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        return k

    assert publish.run_limited([lambda k=k: job(k) for k in range(12)], 3) == list(range(12)) and most[0] <= 3
    assert publish.run_limited([], 2) == []


def test_monitor_reports_again(spark):
    seen, waits = [], []
    for got in publish.watched(lambda: spark.range(len(seen)), 30, rounds=3, sleep=waits.append):
        seen.append(len(got))
    assert seen == [0, 1, 2] and waits == [30, 30]


def test_archives_are_extracted_once(spark, tmp_path):
    for name, size in (("a", 3), ("b", 2)):
        with tarfile.open(tmp_path / f"{name}.tar", "w") as t:
            for k in range(size):
                (tmp_path / "m.txt").write_text(f"{name}{k}")
                t.add(tmp_path / "m.txt", f"{name}/{k}.txt")
    target = str(tmp_path / "out")
    got = readers.extract(spark, str(tmp_path / "*.tar"), target, ".txt")
    assert sorted(bytes(r.content).decode() for r in got.collect()) == ["a0", "a1", "a2", "b0", "b1"]
    (tmp_path / "a.tar").write_bytes(b"no archive any more")  # it isn't opened again
    assert readers.extract(spark, str(tmp_path / "*.tar"), target, ".txt").count() == 5


def test_skipped_files_are_counted(spark, tmp_path):
    d = tmp_path / "s" / "b"
    d.mkdir(parents=True)
    (d / "1.json").write_text(json.dumps({"entry_id": "e"}))
    (d / "2.json").write_text("{broken")
    assert [r.entry_id for r in readers.utterance_tree(spark, str(tmp_path)).collect()] == ["e"]
    assert [r.path.rsplit("/", 1)[1] for r in readers.unreadable_utterances(spark, str(tmp_path)).collect()] == ["2.json"]
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "bad.parquet").write_bytes(b"PAR1 and nothing")
    assert [r.path.rsplit("/", 1)[1] for r in readers.unreadable_parquet(spark, str(tmp_path / "p")).collect()] == ["bad.parquet"]


def test_arrays_run_no_code(spark, tmp_path):
    import os
    import pickle

    class Evil:
        def __reduce__(self):
            return os.mkdir, (str(tmp_path / "owned"),)

    bad = np.empty(1, dtype=object)
    bad[0] = Evil()
    np.save(tmp_path / "bad.npy", bad, allow_pickle=True)
    with pytest.raises(pickle.UnpicklingError):
        readers.load_array((tmp_path / "bad.npy").read_bytes())
    assert not (tmp_path / "owned").exists()
    one = np.empty((), dtype=object)
    one[()] = np.arange(6, dtype="uint16").reshape(2, 3)
    np.save(tmp_path / "one.npy", one, allow_pickle=True)
    assert readers.load_array((tmp_path / "one.npy").read_bytes()).item().tolist() == [[0, 1, 2], [3, 4, 5]]


def test_counts_and_rows_from_the_first_file_there_is(spark, tmp_path):
    assert readers.first_counts(spark, [str(tmp_path / "no.json")]).count() == 0
    (tmp_path / "c.json").write_text('{"en000": 3}')
    assert rows(readers.first_counts(spark, [str(tmp_path / "no.json"), str(tmp_path / "c.json")])) == [("en000", 3)]
    spark.range(7).write.parquet(str(tmp_path / "n"))
    (tmp_path / "info.json").write_text('{"num_rows": 12}')
    (tmp_path / "card.json").write_text("{}")
    assert readers.total_rows(spark, str(tmp_path / "n"), [str(tmp_path / "no"), str(tmp_path / "card.json")]) == 7
    assert readers.total_rows(spark, str(tmp_path / "n"), [str(tmp_path / "card.json"), str(tmp_path / "info.json")]) == 12


def test_utterance_files_and_resumed_chunks(spark, tmp_path):
    base = [("e1", "s", "b", 2.0, 3.0), ("e1", "s", "b", 1.0, 2.0), ("e2", "s", "c", 0.0, 1.0)]
    df = spark.createDataFrame(base, "entry_id string, speaker_id string, book_id string, begin_time double, end_time double")
    out = str(tmp_path / "tree")
    for n in (2, 0):  # nothing new the second time
        assert writers.utterance_tree(df, out) == n
        files = list((tmp_path / "tree").rglob("*.json"))
        assert sorted(str(f.relative_to(out)) for f in files) == ["s/b/e1.json", "s/c/e2.json"]
        assert sorted(json.loads(f.read_text())["begin_time"] for f in files) == [0.0, 1.0]
    # what is there isn't read, only named; ids with any signs; a lost file is written again
    (tmp_path / "tree" / "s" / "b" / "e1.json").write_text("{not json")
    (tmp_path / "tree" / "s" / "c" / "e2.json").unlink()
    more = df.unionByName(spark.createDataFrame([("x/y z%é", None, "b", 0.0, 1.0), (None, "s", "", 0.0, 1.0), ("_h~", ".s", "_b", 0.0, 1.0)], df.schema))
    assert writers.utterance_tree(more, out) == 4 and writers.utterance_tree(more, out) == 0
    assert (tmp_path / "tree" / "s" / "b" / "e1.json").read_text() == "{not json"
    assert sorted(r.entry_id or "" for r in readers.utterance_tree(spark, out).collect()) == ["", "_h~", "e2", "x/y z%é"]
    chunks = str(tmp_path / "chunks")
    writers.fixed_chunks(spark.range(25), chunks, ["id"], 10, resume=True)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "chunks" / "chunk=0").glob("*.parquet")}
    writers.fixed_chunks(spark.range(40), chunks, ["id"], 10, resume=True)
    assert rows(spark.read.parquet(chunks).groupBy("chunk").count()) == [(k, 10) for k in range(4)]
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "chunks" / "chunk=0").glob("*.parquet")} == before


def test_trees_are_listed_by_tasks_and_read_as_by_spark(spark, tmp_path, monkeypatch):
    odd = [b'{"entry_id": "x", "begin_time": 1.50, "transcript": { "a": 1e5 }}', b'[ {"entry_id":"p"}, {"begin_time":NaN} ]', b'{"entry_id":', b"", b" \n", b"null", b"[]", b'[{"entry_id":"p"},3]', b"[null]", b"7"]
    odd += ['{"entry_id":"ü"}'.encode("utf-16"), b'\xef\xbb\xbf{"entry_id":"bom"}', b'{"entry_id":"\xff"}', b'{"entry_id":"1"} more', b"{'entry_id':'y'}", b'{"entry_id":"1","entry_id":true}']
    for n, content in enumerate(odd):
        (tmp_path / f"s{n % 3}" / "b" / "deep").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"s{n % 3}" / ("b" if n % 2 else "b/deep") / f"é {n}%.json").write_bytes(content)
    for name in ("top.json", "s1/_f.json", "s1/.f.json", "s1/f.txt", "s1/_f=1.json", "s1/f._COPYING_"):
        (tmp_path / name).write_bytes(odd[0])
    schema = readers.UTTERANCE + ", _corrupt_record string"
    want = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(str(tmp_path))
    told = lambda df, path: sorted(map(repr, df.select(path.alias("path"), F.isnull("_corrupt_record"), *(F.when(F.isnull("_corrupt_record"), F.col(c)) for c in readers.UTTERANCE.replace(" string", "").split(", "))).collect()))
    want = told(want, F.col("_metadata.file_path"))
    assert told(readers._tree(spark, str(tmp_path)), F.col("path")) == want and len(want) > 15
    driver = []
    monkeypatch.setattr(readers, "FEW", 3)
    monkeypatch.setattr(readers, "listing", lambda *a: driver.append(a))
    monkeypatch.setattr(type(spark.read), "json", lambda *a, **k: driver.append(a))
    assert told(readers._tree(spark, str(tmp_path)), F.col("path")) == want and len(want) > 15
    assert writers.entry_names(spark, str(tmp_path)).count() == len(odd) + 2 and not driver  # nothing is listed on the driver


def test_cache_computes_what_is_new(spark, tmp_path):
    asked = []

    def compute(df):
        asked.append(sorted(r.id for r in df.collect()))
        return df.select("id", (F.col("id") * 2).alias("twice"))

    path = str(tmp_path / "cache")
    assert rows(writers.cached(spark.range(3), path, "id", compute)) == [(0, 0), (1, 2), (2, 4)]
    assert rows(writers.cached(spark.range(1, 5), path, "id", compute)) == [(1, 2), (2, 4), (3, 6), (4, 8)]
    assert asked == [[0, 1, 2], [3, 4]]


def test_predicates_and_orders(spark):
    df = spark.createDataFrame([("en/a.parquet",), ("en/a.txt",), ("end/a.parquet",), ("x/train-1",)], "p string")
    assert [r.p for r in df.filter(ids.in_shard(F.col("p"), "en")).collect()] == ["en/a.parquet"]
    assert [r.p for r in df.filter(ids.in_split(F.col("p"))).collect()] == ["x/train-1"]
    assert spark.createDataFrame([("SPEAKER_01",)], "s string").select(ids.speaker(F.col("s"))).first()[0] == "SPEAKER_01"
    for bad in ("01", None):
        with pytest.raises(Exception, match="no such speaker"):
            spark.createDataFrame([(bad,)], "s string").select(ids.speaker(F.col("s"))).collect()
    stats = spark.createDataFrame([("b", 50.0, 3), ("a", 50.0, 9), ("c", 90.0, 1)], "shard string, pct double, remaining long")
    order = lambda by: [r.shard for r in audits.ordered_stats(stats, "shard", by).collect()]
    assert (order("name"), order("completion"), order("remaining")) == (list("abc"), list("cab"), list("abc"))
    with pytest.raises(ValueError):
        audits.ordered_stats(stats, "shard", "size")
    with_, without = audits.with_counts(stats, stats.filter("shard = 'a'").select("shard", F.lit(4).alias("n")), "shard")
    assert with_.count() == 1 and sorted(r.shard for r in without.collect()) == ["b", "c"]
    means = spark.createDataFrame([(0, 5.0), (1, -5.0)], "dimension int, mean double")
    fresh = statistics.new_rows(means, 500).groupBy("dimension").agg(F.avg("x").alias("m"), F.stddev("x").alias("s")).orderBy("dimension").collect()
    assert all(abs(r.m - m) < 0.01 and 0.015 < r.s < 0.025 for r, m in zip(fresh, (5.0, -5.0), strict=True))


def test_padded_batches_and_decoding(spark, tmp_path):
    import wave

    model = plugins.Energy(codebooks=2, size=16)
    waves = [[0.5] * 4000, [], None, [0.1] * 1920, [-0.9] * 1921, [0.2] * 10]
    alone = [plugins.encode_padded(model, [w])[0] for w in waves]
    assert plugins.encode_padded(model, waves) == alone
    assert [len(c[0]) if c else 0 for c in alone] == [3, 0, 0, 1, 2, 1]
    df = spark.createDataFrame([(k, w) for k, w in enumerate(waves)], "k int, samples array<float>").repartition(2)
    encode, decode = plugins.encoder_udf(lambda: plugins.Energy(codebooks=2, size=16), batch=4), plugins.decoder_udf(lambda: plugins.Energy(codebooks=2, size=16), batch=2)
    got = {r.k: r for r in df.select("k", encode("samples").alias("codes")).withColumn("back", decode("codes")).collect()}
    assert [[list(row) for row in got[k].codes] for k in range(6)] == alone
    assert [len(got[k].back) for k in range(6)] == [3 * 1920, 0, 0, 1920, 2 * 1920, 1920]
    for name, channels in (("one", 1), ("two", 2)):
        with wave.open(str(tmp_path / f"{name}.wav"), "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(2)
            w.setframerate(8000)
            w.writeframes(np.array([0, 16384, -32768, 0], "<i2").tobytes())
    (tmp_path / "bad.wav").write_bytes(b"RIFFnot")
    files = spark.read.format("binaryFile").load(str(tmp_path / "*.wav")).select(F.substring_index("path", "/", -1).alias("name"), plugins.wave_decode("content").alias("a"))
    got = {r.name: r.a for r in files.collect()}
    assert got["one.wav"].samples == [0.0, 0.5, -1.0, 0.0] and got["two.wav"].samples == [0.25, -0.5] and got["one.wav"].rate == 8000
    assert got["bad.wav"].samples is None


def test_threshold_batches_fold(spark):
    import random

    r = random.Random(1)
    base = [(f"k{r.randrange(4)}", n, r.randint(0, 9)) for n in range(400)]
    df = spark.createDataFrame(base, "k string, o int, s int").repartition(5)
    want = []
    for key in {x[0] for x in base}:
        total = batch = 0
        for _, o, s in sorted(x for x in base if x[0] == key):
            want.append((key, o, s, batch))
            total += s
            if total >= 20:
                total, batch = 0, batch + 1
    assert rows(sequences.threshold_batches(df, "k", "o", "s", 20)) == sorted(want, key=repr)


def test_consistent_in_stretches(spark):
    import random

    a, r = Alphabet(codebooks=3, size=4, offset=0x4E00), random.Random(2)
    texts = ["".join(chr(0x4E00 - 1 + r.randrange(14)) for _ in range(n)) for n in [0, 1, 2, 3, 5, 17, 100, 999] for _ in range(4)]

    def kept(text):
        book = [max(-1, min(2, (ord(c) - 0x4E00) // 4)) for c in text]
        wait, out = max(0, book[0]) if book else 0, []
        for c, k in zip(text, book, strict=True):
            if k == wait:
                out.append(c)
                wait = (wait + 1) % 3
        return "".join(out)

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", a.consistent(F.col("t")).alias("c")).collect()
    assert len(got) == len(texts) and all(g.c == kept(g.t) for g in got)


def test_positions_of_limited_groups(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(300)], "g int, o int").repartition(7)
    got = sequences.first_per_group(df, "g", ["o"], F.col("g") + 1, most=3)
    assert rows(got) == [(0, 0), (1, 1), (1, 4), (2, 2), (2, 5), (2, 8)]
