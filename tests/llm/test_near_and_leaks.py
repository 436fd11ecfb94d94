import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from speechloom.llm import components, decontaminate, jaccard_join

SCHEMA = "doc_id long, text string, token long, n int, sig string, slice int, root int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "s", 3, 4) for r in rows], SCHEMA)


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if (all_ and 100 * both >= 80 * all_) or rows[i][0] == rows[j][0]:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def mutated(r, words, k):
    out = list(words)
    for _ in range(k):
        out[r.randrange(len(out))] = f"m{r.randrange(10**6)}"
    return out


def test_near_duplicates_against_brute_force(spark):
    r = random.Random(11)
    vocabulary = [f"w{k}" for k in range(300)]
    rows, passage = [], [f"p{k}" for k in range(40)]
    for g in range(12):
        base = [r.choice(vocabulary) for _ in range(r.choice((6, 30, 120, 200)))]
        for _ in range(r.choice((1, 3, 25))):
            rows.append((len(rows), " ".join(mutated(r, base, r.choice((0, 1, 2, 3, 5))))))
    for _ in range(30):  # a passage that many share, in texts that differ otherwise
        rows.append((len(rows), " ".join(passage + [r.choice(vocabulary) for _ in range(r.choice((4, 8, 12, 30)))])))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (len(rows) + 3, "one two"), (len(rows) + 4, "One\x0bTWO"), (len(rows) + 5, "one\xa0two"), (len(rows) + 6, "É a"), (len(rows) + 7, "é a")]
    rows += [(len(rows) + k, rows[3][1]) for k in range(20)]
    rows.append((len(rows) + 50, " ".join(r.choice(vocabulary) for _ in range(20_000))))
    want = brute(rows)
    for bits, hot in ((16, 1000), (20, 2)):  # with 2, nearly every shared list is dealt over tasks
        got = sorted(tuple(x) for x in jaccard_join.near_duplicates(docs(spark, rows).repartition(5), sketch_bits=bits, hot=hot).collect())
        assert got == want


def test_near_duplicates_of_repeated_null_and_string_ids(spark):
    r = random.Random(6)
    base = [[f"w{r.randrange(90)}" for _ in range(40)] for _ in range(6)]
    text = lambda k, extra="": " ".join(base[k]) + extra
    rows = [(1, text(0)), (2, text(0, " x")), (3, text(1)), (3, text(2)), (4, text(2, " y")), (5, text(1, " z")), (6, ""), (6, text(3)), (7, text(3, " q")), (8, None), (9, text(4)), (9, text(4))]
    assert sorted(tuple(x) for x in jaccard_join.near_duplicates(docs(spark, rows), sketch_bits=15).collect()) == brute(rows)
    names = [(f"n{i}", t) for i, t in rows]
    got = jaccard_join.near_duplicates(spark.createDataFrame(names, "name string, text string"), "name", sketch_bits=15).collect()
    assert sorted(tuple(x) for x in got) == brute(names)
    nameless = [(None, text(0)), (None, text(0)), (None, text(5)), (None, None), (1, text(5, " x")), (2, text(1))]
    got = jaccard_join.near_duplicates(spark.createDataFrame(nameless, "doc_id long, text string"), sketch_bits=15).collect()
    assert sorted((x.doc_id or 0, x.component_id or 0) for x in got) == [(0, 0), (0, 0), (0, 0), (0, 1), (1, 1), (2, 2)]


def test_near_duplicates_empty(spark):
    assert jaccard_join.near_duplicates(docs(spark, []), sketch_bits=15).count() == 0


def test_filters_lose_nothing():
    r = np.random.default_rng(3)
    for _ in range(300):
        base = np.unique(r.integers(0, 500, r.integers(1, 60))).astype(np.uint64)
        other = np.unique(np.concatenate([base[r.random(len(base)) < r.choice([0.8, 0.95, 1])], r.integers(0, 500, r.integers(0, 8)).astype(np.uint64)]))
        if not len(other):
            continue
        both, union = len(np.intersect1d(base, other)), len(np.union1d(base, other))
        assert jaccard_join.overlap_bound(base, other) >= both
        assert jaccard_join.linked(base, other) == (100 * both >= 80 * union)
        if 100 * both >= 80 * union:  # some shared prefix token leaves both rows in their list
            x, y = base[: jaccard_join.prefix_size(len(base))], other[: jaccard_join.prefix_size(len(other))]
            ok = alone = False
            for t in np.intersect1d(x, y):
                n = np.array([len(base), len(other)])
                place = np.array([np.flatnonzero(base == t)[0], np.flatnonzero(other == t)[0]])
                ok |= bool(jaccard_join.viable(np.array([t, t]), n, place, place).all())
                alone |= bool(jaccard_join.hopeful(n, place, place).all())
            assert ok and alone


def test_held_lists_across_batches(spark):
    salted = [(t, i, 10, 1, 1 + i % 3) for t in range(1, 40, 6) for i in range(50)]
    rows = [(t, i, 10, 1, 0) for t in range(40) for i in range(t % 4 + 1) if t % 6 != 1] + salted
    df = spark.createDataFrame(rows, "token long, id long, n int, place int, salt int")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert jaccard_join.hopeful(*(np.array([k]) for k in (10, 9, 0))).tolist() == [False]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        want = sorted(x for x in rows if x[0] % 4)
        for most in (200_000, 2):
            got = sorted(tuple(x) for x in jaccard_join.shared_only(df, 80, most).collect())
            assert [x for x in got if x[0] % 4] == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(5, 5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(got[k] == 100 for k in range(100, 140))
    r = random.Random(5)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(95)]
    parent = list(range(150))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {g.node: g.root for g in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for e in edges for k in e if e[0] != e[1]}


def leak_words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def leaks(rows, items):
    out = []
    for i, t in rows:
        w = leak_words(t)
        hit, found = set(), set()
        for item, text in items:
            b = leak_words(text)
            n = min(10, len(b))
            for window in {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else ():
                for k in range(len(w) - n + 1):
                    if tuple(w[k : k + n]) == window:
                        hit.update(range(k, k + n))
                        found.add(str(item))
        names = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_decontaminate_against_brute_force(spark):
    r = random.Random(4)
    v = ["a", "b", "c", "Straße", "x1", "日本"]
    items = [(10 * k, " ".join(r.choice(v) for _ in range(r.choice((0, 1, 2, 9, 10, 14))))) for k in range(25)] + [(9, "A-b! c"), (None, "a"), (7, None)]
    rows = [(k, " ".join(r.choice(v) for _ in range(r.choice((0, 3, 40))))) for k in range(30)]
    rows += [(100 + k, "zz, " + (items[k][1] or "").upper().replace(" ", " - ") + "; zz") for k in range(25)] + [(200, None), (200, None), (201, "a B\nC"), (202, "q " * 30_000 + "a b c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = leaks(rows, [x for x in items if x[0] is not None])
    for block in (200_000, 60):  # in one block, and in several, with items in parts
        got = decontaminate.decontaminate(docs(spark, rows), bench, block_words=block, keep=("sig", "token"))
        assert sorted(tuple(x) for x in got.select(*columns).collect()) == want
        assert {x.kept_sig for x in got.collect()} == {"s"}
    assert decontaminate.decontaminate(docs(spark, []), bench).count() == 0
    clean = decontaminate.decontaminate(docs(spark, rows), bench.limit(0)).filter("contaminated").count()
    assert clean == 0


def test_parts_have_each_window_once():
    r = random.Random(8)
    for n in (0, 1, 9, 10, 11, 47, 200):
        words = [str(r.random()).encode() for _ in range(n)]
        whole = [tuple(w) for w in decontaminate.windows(words, 10)]
        for most in (20, 33, 500):
            parts = decontaminate.parts_of(words, 10, most)
            assert all(len(p) <= most for p in parts)
            assert [tuple(w) for p in parts for w in decontaminate.windows(p, 10)] == whole


def test_spans_are_united(spark):
    r = random.Random(9)
    rows = [([[b, b + r.randint(1, 9)] for b in (r.randrange(60) for _ in range(r.randint(0, 9)))],) for _ in range(80)]
    got = spark.createDataFrame(rows, "s array<array<int>>").select("s", decontaminate.united(F.col("s")).alias("u")).collect()
    for g in got:
        inside = {k for b, e in g.s for k in range(b, e)}
        assert {k for b, e in g.u for k in range(b, e)} == inside
        assert all(x[1] < y[0] for x, y in zip(g.u, g.u[1:], strict=False))
