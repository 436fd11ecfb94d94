import hashlib
import random

import pytest

from speechloom.llm import exact_dedup, token_counts

SCHEMA = "doc_id long, text string, digest string, run int, best int, n int, tokens int"


def docs(spark, rows):
    """With further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], SCHEMA)


def brute(rows):
    """Of equal texts one row is kept; which of those that agree in length and id doesn't show in the result."""
    groups = {}
    for at, (i, t) in enumerate(rows):
        key = "".join(c for c in t or "" if c not in "\x20\x09\x0a\x0b\x0c\x0d")
        groups.setdefault(key, []).append((-len(t or ""), i is None, i or 0, at))
    out = []
    for at, (i, t) in enumerate(rows):
        key = "".join(c for c in t or "" if c not in "\x20\x09\x0a\x0b\x0c\x0d")
        keep = min(groups[key])[3]
        out.append((i, rows[keep][0], len(groups[key]), at == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_dedup_edges(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\tb "), (5, None), (6, ""), (7, " \n"), (8, "é😀"), (9, "é 😀"), (9, "é 😀"), (None, "x"), (11, "x"), (None, "y"), (12, "z" * 200_000), (13, "z" * 200_000), (14, "a b")]
    df = docs(spark, rows).repartition(9)
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(df, fan_in=2).collect()), key=repr)
    assert got == brute(rows)


def test_exact_dedup_hot_group_and_empty(spark):
    rows = [(k, "same" if k % 3 else f"t{k % 50}") for k in range(600)]
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs(spark, rows).repartition(17), fan_in=4).collect()), key=repr)
    assert got == brute(rows)
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


def test_exact_dedup_keeps_one_row_of_repeated_rows(spark):
    rows = [(k % 7, "t" * (k % 3)) for k in range(200)] + [(None, "n")] * 5
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs(spark, rows).repartition(11), bucket=2).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[3] for r in got) == len({r[4] for r in got})


def test_exact_dedup_string_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", "")], "name string, body string")
    got = {(r.name, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df, "name", "body").collect()}
    assert got == {("b", "a", 3, False), ("a", "a", 3, True), (None, "a", 3, False), ("c", "c", 1, True)}


def test_exact_dedup_is_native(spark):
    plan = exact_dedup.exact_dedup(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    path = token_counts.vocabulary_path()
    return Tokenizer.from_file(path), token_counts.counter(path)


def test_every_prefix(library):
    reference, counter = library
    r = random.Random(5)
    parts = ["a", "'", "r", "re", "l", " ", "  ", "\n", "\t", "é", "12", "!", "日本", "😀", "<|endoftext|>", "<|endof", "\xa0", "\x1c", " the", "'re", "'ll", "'s", "　", "‍", ".", ","]
    for _ in range(400):
        s = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        want = [len(reference.encode(s[:i], add_special_tokens=False).ids) for i in range(len(s) + 1)]
        assert counter.vector(s).tolist() == want, s
        fit = max(i for i, n in enumerate(want) if n <= 3)
        assert counter.summary(s, 3) == (want[-1], fit), s


def test_long_runs(library):
    reference, counter = library
    for s in ("x" + " " * 5000 + "y", "ab" * 5000, "\n" * 3000, "日" * 2000):
        assert counter.count(s) == len(reference.encode(s, add_special_tokens=False).ids)


@pytest.mark.parametrize("unit", ["漢字仮名", "한국어", "😀🏽", "a漢"])
def test_runs_of_several_tokens_a_code_point(library, unit):
    reference, counter = library
    for n in (90, 99, 100, 120, 199, 200, 250):
        run = (unit * n)[:n]
        for s in (run, "see " + run, f"see {run}, {run}. end", f"{run}<|endoftext|>{run}"):
            ids = [len(reference.encode(s[:i], add_special_tokens=False).ids) for i in (len(s), n // 2)]
            got = counter.vector(s)
            assert [counter.count(s), got[n // 2]] == ids and got[-1] == ids[0], (n, s[:20])


def test_compatible_pairs_match_the_definition(library):
    counter = library[1]
    r = random.Random(2)
    for _ in range(3000):
        pair = r.randrange(len(counter.tokens)) << 20 | r.randrange(len(counter.tokens))
        two = [counter.tokens[pair >> 20], counter.tokens[pair & 0xFFFFF]]
        assert counter._stay(pair) == (counter._merge(two[0] + two[1]) == two)


def test_token_query_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "Hello there, <|endoftext|> you"), (3, "Hello there, <|endoftext|> you"), (4, "word " * 3000)]
    got = token_counts.token_counts(docs(spark, rows), prefixes=True).collect()
    want = {t: len(library[0].encode(t or "", add_special_tokens=False).ids) for _, t in rows}
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((i, len((t or "").encode()), want[t], want[t] > 1024) for i, t in rows)
    assert all(r.prefix_counts[-1] == r.n_tokens for r in got)
    assert token_counts.token_counts(docs(spark, [])).count() == 0
