"""Queries with SQL against it, and the pipeline against brute force, on the smallest tables and a fixture."""

import os
import random
import zlib

import duckdb
import pytest

import corpus_pipeline
from speechloom.llm import queries, url_filter

from .test_chat_and_packing import check_packing
from .test_near_and_leaks import brute, leaks

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    out = con.execute(queries.ORACLES[name])
    names = [c[0] for c in out.description]
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in out.fetchall())
    df = queries.QUERIES[name](spark, DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect()) == want


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_without_sql(spark, name):
    """Queries that SQL can't express run over their whole tables: a row for each row, with the columns of the contract."""
    con = duckdb.connect()
    one = lambda sql: con.execute(sql).fetchall()
    documents = f"'{DIR}/documents.parquet'"
    got = queries.QUERIES[name](spark, DIR)
    rows = got.collect()
    if name == "op4_url_filter":
        # host, path, rule and the ruled verdicts by SQL
        rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
        want = one(f"""WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM '{DIR}/pages.parquet'),
          h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
          m AS (SELECT page_id, arg_max(h2 || p2, length(h2 || p2)) AS rule, arg_max(v, length(h2 || p2)) AS verdict FROM h JOIN (VALUES {rules}) t(v, h2, p2) ON (host = h2 OR ends_with(host, '.' || h2)) AND starts_with(path, p2) GROUP BY page_id)
          SELECT page_id, host, path, rule, verdict FROM h LEFT JOIN m USING (page_id)""")
        assert sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict if r.rule else "") for r in rows) == sorted((*w[:3], w[3] or "", w[4] or "") for w in want)
        assert {r.verdict for r in rows} <= {"allow", "block"}
        return
    ids = sorted(r[0] for r in one(f"SELECT doc_id FROM {documents}"))
    if name == "op10_pack":
        import public_tokenizers
        from tokenizers import Tokenizer

        texts = one(f"SELECT doc_id, text FROM {documents}")
        used, tokens = check_packing(texts, rows, Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), 2048)
        assert used <= 1.02 * tokens / 2048 + 1
        return
    assert sorted(r.doc_id for r in rows) == ids
    fold = {"op8_toxicity": (5, 0), "op9_language": (4, 2)}.get(name)
    if fold:
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) and 0 <= r.score <= 1 for r in rows)
    if name == "op2_token_counts":
        sizes = dict(one(f"SELECT doc_id, octet_length(encode(coalesce(text, ''))) FROM {documents}"))
        assert all(r.n_bytes == sizes[r.doc_id] and r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_pipeline_stages(spark, tmp_path):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    rows, labels = [], []
    for k in range(260):
        text = [word() for _ in range(r.randint(12, 80))]
        bad = k % 3 == 0
        if bad:
            text.insert(r.randrange(len(text)), "vilest")
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(bad)))
    items = [(k, " ".join(word() for _ in range(14))) for k in range(5)]
    clean = [t for k, t in rows if k % 3]
    rows += [(500 + k, clean[k] + " ") for k in range(6)]  # copies
    rows += [(600 + k, clean[k] + " extra") for k in range(10, 16)]  # near copies
    rows += [(700 + k, " ".join([word() for _ in range(20)]) + " " + items[k][1]) for k in range(5)]  # leaks
    rows += [(800, None), (801, ""), (802, "")]
    d = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(k, t, "xx", "s", len(t or "")) for k, t in rows], schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{d}/out{k}")
        docs = spark.read.parquet(f"{d}/out{k}")
        kept.append([(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()] if k < 4 else docs.collect())
    told = {i: t for i, _, t in labels}
    assert sum(told.get(i, 0) for i, _ in kept[0]) <= 4 and sum(1 for i, _ in kept[0] if not told.get(i, 0)) >= 0.97 * len([i for i, _ in rows if not told.get(i, 0)])
    groups = {}
    for i, t in kept[0]:
        groups.setdefault("".join((t or "").split()), []).append((-len(t or ""), i))
    assert sorted(i for i, _ in kept[1]) == sorted(min(g)[1] for g in groups.values())
    assert sorted(i for i, _ in kept[2]) == sorted(i for i, _, c in brute(kept[1]) if i == c)
    assert sorted(i for i, _ in kept[3]) == sorted(x[0] for x in leaks(kept[2], items) if not x[5])
    assert {x.doc_id for x in kept[4]} == {i for i, _ in kept[3]}
    spark.createDataFrame([], schema).write.parquet(f"{d}/empty/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").write.parquet(f"{d}/empty/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{d}/empty").count() == 0


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    """Repeated ids, repeated rows, null ids and columns with odd names."""
    r = random.Random(3)
    fresh = lambda: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(30))
    one, two, three, four = fresh(), fresh(), fresh(), fresh()
    rows = [(1, one), (2, one), (2, two), (3, three), (3, three), (None, three), (None, four), (4, None), (4, ""), (None, fresh()), (5, two + " "), (6, four + " more"), (7, four), (8, four + " less")]
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "xx", "s", 0, k, 7) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, id int").repartition(3).write.parquet(f"{d}/documents.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    same = lambda t: "".join((t or "").split())
    out = corpus_pipeline.copies_out(spark, docs, d)
    assert out.columns == docs.columns
    kept = sorted(x["a.b"] for x in out.collect())
    groups = {}
    for k, (_, t) in enumerate(rows):
        groups.setdefault(same(t), []).append(k)
    assert sorted(next(iter({same(rows[k][1])})) for k in kept) == sorted(groups)
    assert {0, 10, 12} <= set(kept)  # the smallest id of its own; the longest
    out.write.parquet(f"{d}/two")
    near = corpus_pipeline.near_out(spark, spark.read.parquet(f"{d}/two"), d)
    left = [x["a.b"] for x in near.collect()]
    assert near.columns == docs.columns and set(kept) - set(left) == {13} | ({12} if 11 in left else {11})
    assert 11 in left  # id 6 goes before 7 and 8
    # a table that is no file
    again = corpus_pipeline.copies_out(spark, spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (2, "y"), (2, "z")], "doc_id long, text string"), d)
    assert sorted(x.text for x in again.collect()) == ["x", "y", "z"]
    items = spark.createDataFrame([(1, " ".join(two.split()[:12]))], "item_id long, text string")
    items.write.parquet(f"{d}/benchmark.parquet")
    clean = corpus_pipeline.leaks_out(spark, docs, d)
    assert clean.columns == docs.columns and sorted(x["a.b"] for x in clean.collect()) == [k for k in range(len(rows)) if k not in (2, 10)]
    spark.createDataFrame([(k, k % 2) for k in range(9)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    judged = corpus_pipeline.toxic_out(spark, docs, d)
    assert judged.columns == docs.columns and judged.count() <= len(rows)
    assert corpus_pipeline.run(spark, d).count() <= len(rows)
