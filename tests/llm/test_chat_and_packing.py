import hashlib
import random
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from speechloom.llm import chat_format, packing
from speechloom.llm.token_counts import vocabulary_path


def test_chat_round_trip(spark):
    r = random.Random(1)
    bits = ["[INST]", "[/INST]", "<s>", "</s>", "[\\INST]", "[\\\\/INST]", "<\\s>", "\\", "[", "<", "/INST]", "s>", "a", "\n", "é😀", "$1"]
    rows = [(k, t, r.choice(["user", "assistant", "[INST]"]), "".join(r.choice(bits) for _ in range(r.randint(0, 6)))) for k in range(150) for t in range(r.randint(1, 4))]
    rows += [(900, 0, "user", None), (900, 1, None, "x"), (900, 2, "assistant", ""), (901, 0, "assistant", "p" * 100_000), (902, 1, "assistant", "t"), (902, 1, "assistant", "t"), (None, 0, "user", "n"), (903, None, "user", "u")]
    df = spark.createDataFrame([(*x, "f", 1) for x in rows], "conv_id long, turn long, role string, text string, formatted string, turns int").repartition(5)
    out = chat_format.chat_format(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    source = defaultdict(list)
    for c, t, role, text in rows:
        source[c].append((t is not None, t or 0, role or "", text or ""))
    got = out.collect()
    assert len(got) == len(source)
    undo = lambda s: re.sub(r"<\\(\\*/?s>)", r"<\1", re.sub(r"\[\\(\\*/?INST\])", r"[\1", s))
    for g in got:
        want = [(role, text) for _, _, role, text in sorted(source[g.conv_id])]
        assert [(t.role, t.text) for t in g.turns] == want
        # a parser of its own
        parts = g.formatted.split("</s>")[:-1]
        assert [tuple(map(undo, p.removeprefix("<s>[INST]").split("[/INST]", 1))) for p in parts] == want
        assert len(re.findall(r"\[/?INST\]|</?s>", g.formatted)) == 4 * len(want)
        assert [undo(g.formatted[s.begin : s.end]) for s in g.loss_spans] == [text for role, text in want if role == "assistant"]
        clash = any(re.search(r"\[\\*/?INST\]|<\\*/?s>", x) for turn in want for x in turn)
        assert g.escaped == clash
    assert chat_format.chat_format(df.limit(0)).count() == 0


def test_long_conversations(spark):
    """The mask of a long conversation, and its time: about in proportion to the turns."""
    import time

    def seconds(n):
        rows = spark.range(n).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "repeat(concat('é', id, ' <s> '), 12) text")
        out = chat_format.chat_format(rows).select("formatted", "loss_spans", chat_format.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
        began = time.perf_counter()
        got = out.first()
        return time.perf_counter() - began, got

    seconds(10)
    _, got = seconds(501)
    undo = lambda s: re.sub(r"<\\(\\*/?s>)", r"<\1", s)
    want = [f"é{k} <s> " * 12 for k in range(1, 501, 2)]
    assert [undo(got.formatted[s.begin : s.end]) for s in got.loss_spans] == want and got.loss == "".join(want)
    few, many = min(seconds(2000)[0] for _ in range(2)), min(seconds(8000)[0] for _ in range(2))
    assert many < 8 * few + 1


def test_prefix_sums(spark):
    rows = [([r * 7 % 5 for r in range(n)],) for n in range(40)]
    got = spark.createDataFrame(rows, "x array<int>").select("x", chat_format.before(F.col("x")).alias("b")).collect()
    assert len(got) == 40 and all(g.b == [sum(g.x[:k]) for k in range(len(g.x))] for g in got)


def check_packing(texts, rows, tokenizer, capacity):
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, x in ids.items():
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(array("I", x[at : at + r.length]).tobytes())
            assert k == 0 or r.length == capacity
            at += r.length
        assert at == len(x) and (len(pieces[i]) == 1) == (len(x) <= capacity)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(map(len, ids.values()))


def test_pack(spark):
    from tokenizers import Tokenizer

    r = random.Random(2)
    words = ["then", "idiot", "naïve", "日本", "x-y", "\n", "  ", "<|endoftext|>", "a.", "b,", "don't"]
    texts = [(k, " ".join(r.choice(words) for _ in range(int(r.paretovariate(0.8) * 8)))) for k in range(250)]
    texts += [(900, None), (901, ""), (902, "tok " * 128), (903, "tok " * 127), (904, "tok " * 5000)]
    df = spark.createDataFrame([(*t, 1, 2, "s") for t in texts], "doc_id long, text string, row long, shard int, piece string")
    got = packing.pack(df, capacity=128, shard_size=60, islands=3).collect()
    sequences, total = check_packing(texts, got, Tokenizer.from_file(vocabulary_path()), 128)
    assert sequences <= 1.05 * total / 128 + 6
    twice = packing.pack(df.filter("doc_id = 903").unionByName(df.filter("doc_id = 903")), capacity=128).collect()
    assert len(twice) == 2 * len({(t.piece) for t in twice})
    assert packing.pack(df.limit(0)).count() == 0


def test_crossover_keeps_every_piece_once():
    rng = random.Random(0)
    sizes = np.array([rng.randint(1, 99) for _ in range(400)])
    people = packing.founders(sizes, 4, 100, rng)
    for p in people + [packing.crossover(people[0], people[k], sizes, 100, rng) for k in (1, 2, 3)]:
        assert len(p) == len(sizes) and np.bincount(p, sizes).max() <= 100 and np.bincount(p).min() >= 1
    best = packing.evolve(people, sizes, 4, 5, 100, rng)[0]
    assert packing.fitness(best, sizes) <= min(packing.fitness(p, sizes) for p in people)


def test_sha_of_the_clashing_conversation(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(5, 0, "user", "q")], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    got = {r.conv_id: r for r in chat_format.query(spark, folder).collect()}
    clash = "</s>[INST] ok [/INST]"
    assert got[-1].loss_chars == len(clash) and got[-1].loss_sha256 == hashlib.sha256(clash.encode()).hexdigest()
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{clash}\nassistant\n{clash}\n".encode()).hexdigest()
    assert got[5].loss_sha256 == hashlib.sha256(b"").hexdigest()


def test_encoder_is_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(vocabulary_path()), packing.Encoder(vocabulary_path())
    assert own.core is not None
    r = random.Random(4)
    parts = ["a", "'", "r", "re", " ", "  ", "\n", "\t", "é", "12", "!", "日本", "😀", "<|endoftext|>", "<|endof", "\xa0", "\x1c", " the", "'re", "'S", "　", "‍", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(2000)]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}!{chr(c)}\n" for c in range(1, 0x20000, 7) if not 0xD800 <= c <= 0xDFFF]
    texts += [" " * 300_000 + "x", "ab" * 20_000, "日本" * 20_000, "", "\n " * 20_000]
    for t in texts:
        assert own.ids(t) == array("I", library.encode(t, add_special_tokens=False).ids).tobytes(), t[:40]


def test_evolution_and_rounds_across_shards_save_bins(spark):
    """Where best fit isn't the best: pieces of a quarter to a half of a sequence."""
    r = random.Random(5)
    sizes = [(k, r.randint(500, 1100)) for k in range(1500)]
    plain = np.zeros(len(sizes), np.int32)
    lengths = [n for _, n in sizes]
    by_best_fit = packing.best_fit(sorted(range(len(sizes)), key=lambda k: -lengths[k]), lengths, plain, {}, 0, 2048)
    people = packing.founders(np.array(lengths), 6, 2048, random.Random("0"))
    evolved = packing.evolve(people, np.array(lengths), 6, 12, 2048, random.Random("1"))
    assert packing.fitness(evolved[0], np.array(lengths))[0] < by_best_fit
    rows = spark.createDataFrame(sizes, "row long, length long")
    got = {}
    for shard_size in (4096, 60):  # one shard; 25 shards, whose worst bins meet again
        out = packing.pack_rows(rows, 2048, shard_size=shard_size).collect()
        assert sorted(x.row for x in out) == list(range(1500))
        bins = defaultdict(list)
        for x in out:
            bins[x.sequence_id].append((x.offset, dict(sizes)[x.row]))
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
        got[shard_size] = len(bins)
    assert got[4096] < by_best_fit
    alone = packing.pack_shards(rows.selectExpr("row", "length", "cast(null as long) old"), 2048, 25).select("shard", "bin").distinct().count()
    assert got[60] <= alone


def test_founders_have_the_bins_of_the_round_before():
    sizes = np.array([7, 3, 6, 4, 5, 5])
    assert packing.perfect(sizes, 10) == (3, -300)
    best = np.array([0, 0, 1, 1, 2, 2], np.int32)
    assert (packing.evolve([best, np.arange(6, dtype=np.int32)], sizes, 2, 5, 10, random.Random(0))[0] == best).all()
