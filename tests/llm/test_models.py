import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from speechloom.llm import langid, quality, toxicity, url_filter, word_trigrams

from . import plain_url_models

DOCS = "doc_id long, text string, lang string, score double, id int, row int, words string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, 2, "w") for r in rows], DOCS)


def sentences(r, letters, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n))


# toxicity


def toxic_corpus(n=500):
    r = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        lang, letters = r.choice([("aa", "abcdefgh"), ("bb", "ijklmnop")])
        bad = r.random() < 0.4
        text = sentences(r, letters, r.randint(3, 60)).split()
        if bad:
            for _ in range(r.randint(1, 3)):
                text.insert(r.randrange(len(text) + 1), r.choice(["vile", "rotten", "Nasty"]))
        rows.append((k, " ".join(text), lang))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, known = toxic_corpus()
    extra = [(9000, None, "aa"), (9001, "", None), (9002, "x " * 40_000 + "vile", "aa"), (0, rows[0][1], "aa")]
    labels = spark.createDataFrame([*known, (1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs(spark, rows + extra), labels, keep=("words", "score")).collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(known)
    held = [g for g in got if g.held_out and g.doc_id in truth]
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    assert len(held) > 60 and np.mean([g.predicted == truth[g.doc_id] for g in held]) > 0.93
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) and g.kept_words == "w" for g in got)
    at = {g.doc_id: g.score for g in got}
    assert at[9000] == at[9001] and at[9002] > 0.5


def test_toxicity_score_is_of_the_text_alone(spark):
    rows, known = toxic_corpus(200)
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    net = toxicity.fit(docs(spark, rows), labels, "doc_id", "text", "lang")
    a = toxicity.score_with(net, docs(spark, [(1, "some vile text", "aa")]), "doc_id", "text", "lang").first().score
    b = toxicity.score_with(net, docs(spark, [(77, "some vile text", None)]), "doc_id", "text", "lang").first().score
    alone = net.score([toxicity.hashed("some vile text"), toxicity.hashed("other")])[0]
    assert a == b and math.isclose(a, alone, rel_tol=1e-5)


def test_toxicity_thresholds_of_rare_languages(spark):
    """All told rows count, and a language with few toxic rows is shrunk, not switched off."""
    rows = [("big", y, 0.31 + 0.3 * y) for y in (0, 1) for _ in range(4000)] + [("few", y, 0.55 + 0.2 * y) for y in (0, 1) for _ in range(20)] + [(None, 0, 0.1), ("one", 0, 0.5)]
    common, by = toxicity.levels(spark.createDataFrame(rows, "lang string, y int, score double"))
    assert 0.55 < common < 0.61 and set(by) == {"big", "few"}
    assert math.isclose(by["big"], common + 4000 / 4040 * (0.4605 - common), abs_tol=0.01)
    assert math.isclose(by["few"], common + 20 / 60 * (0.6505 - common), abs_tol=0.01)
    assert toxicity.levels(spark.createDataFrame([], "lang string, y int, score double")) == (0.5, {})


def test_toxicity_without_labels(spark):
    for labels in ([], [(0, 0), (1, 0)]):
        known = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert toxicity.toxicity(docs(spark, [(1, "a", "x"), (2, None, None)]), known).filter("predicted = 1").count() == 0
    assert toxicity.toxicity(docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


# language


def test_language(spark):
    r = random.Random(3)
    rows = [(k, sentences(r, "abcde" if k % 3 else "eéèêz", r.randint(3, 40)), "xx" if k % 3 else "yy") for k in range(400)]
    rows += [(500, None, "xx"), (501, "", "xx"), (502, "12 ?!", "yy"), (503, "abc", None), (504, "éèê " * 30_000, "yy"), (0, rows[0][1], "yy")]
    got = langid.language(docs(spark, rows)).collect()
    by = {g.doc_id: g for g in got}
    assert len(got) == len(rows)
    assert [by[k].lang_pred for k in (500, 501, 502)] == ["und"] * 3 and by[504].lang_pred == "yy"
    held = [g for g in got if g.held_out and g.doc_id < 400]
    truth = {k: v for k, _, v in rows}
    assert held and np.mean([g.lang_pred == truth[g.doc_id] for g in held]) > 0.97
    assert all(0 <= g.score <= 1 and g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) for g in got)
    assert langid.language(docs(spark, [])).count() == 0
    none = langid.language(docs(spark, [(1, "abc", None)])).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)


def test_presence_is_a_set():
    once, twice = langid.presence("abcab"), langid.presence("abcabcab")
    assert once.sum() <= twice.sum() <= 12 and (once <= twice).all()
    assert langid.presence("").sum() == 0 and langid.presence("A").tolist() == langid.presence("a").tolist()


def test_forward_pass_word_by_word():
    """The scores of look-ups and sums against the definition: rows added, filters slid over the words, the largest kept."""
    r = np.random.default_rng(2)
    net = toxicity.Net(seed=4)
    net.tables = [r.normal(0, 1, t.shape).astype(np.float32) for t in net.tables]
    net.bias = [r.normal(0, 0.5, b.shape).astype(np.float32) for b in net.bias]
    net.base = np.float32(0.3)
    net.project()
    texts = ["one", "one two", "a b c d e f g", "", None, "the cat " * 40]
    batch = [toxicity.hashed(t) for t in texts]
    got = net.logits(batch)
    for rows, value in zip(batch, got, strict=True):
        x = [net.tables[0][w & 0xFFFFFFFF].astype(float) + net.tables[1][w >> 32] for w in rows.tolist()]
        total = float(net.base)
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                best = -np.inf
                for at in range(len(x)):  # words beyond the end count nothing
                    best = max(best, sum(float(x[at + j] @ net.conv[k][j][:, f]) for j in range(width) if at + j < len(x)))
                total += max(0.0, best + float(net.bias[k][f])) * float(net.out[k * toxicity.FILTERS + f])
        assert math.isclose(total, float(value), rel_tol=1e-3, abs_tol=1e-3)


def test_samples_are_bounded_by_rows_and_bytes(spark):
    """One labelled id in very many rows, and long texts."""
    rows = [(k, f"fine words {k}" if k % 2 else f"vile words {k}", "x") for k in range(60)] + [(61, "same text", "x")] * 3000 + [(63, "vile " * 50_000, "x")]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(62)] + [(63, 1)], "doc_id long, toxic int")
    sizes = []
    train = toxicity.Net.train
    toxicity.Net.train = lambda self, words, y, **how: sizes.append((len(words), sum(map(len, words)))) or train(self, words, y, **how)
    try:
        toxicity.fit(docs(spark, rows), labels, "doc_id", "text", "lang", sample=10)
        toxicity.fit(docs(spark, rows), labels, "doc_id", "text", "lang", sample=1000, sample_bytes=2000)
    finally:
        toxicity.Net.train = train
    assert 0 < sizes[0][0] <= 20
    assert sizes[1][1] <= 2000
    picked = langid.fit(docs(spark, rows), "doc_id", "text", "lang", sample=7)
    assert picked is not None and picked.langs == ["x"]


def test_a_text_that_does_not_fit_is_passed_over(spark):
    """Long texts first in the order of the sample, in each class, and a class of nothing else."""
    rows = [(k, f"fine words {k}" if k % 2 else f"vile words {k}", "x") for k in range(80)]
    labels = [(k, 1 - k % 2) for k in range(80)]
    order = [r.id for r in spark.range(1000, 3000).orderBy(F.xxhash64("id")).limit(4).collect()]
    long = [(i, ("vile " if k % 2 else "fine ") * 400, "x") for k, i in enumerate(order)]
    told = spark.createDataFrame(labels + [(i, k % 2) for k, i in enumerate(order)], "doc_id long, toxic int")
    net = toxicity.fit(docs(spark, rows + long), told, "doc_id", "text", "lang", sample_bytes=2400)
    assert net.score([toxicity.hashed("vile words")])[0] > 0.5 > net.score([toxicity.hashed("fine words")])[0]
    # every toxic text is too long: the shortest one is learned from, and the class isn't empty
    sizes = []
    train = toxicity.Net.train
    toxicity.Net.train = lambda self, words, y, **how: sizes.append(set(y)) or train(self, words, y, **how)
    try:
        only = [(k, "fine " + str(k), "x") for k in range(40)] + [(100 + k, "vile " * (300 + k), "x") for k in range(3)]
        toxicity.fit(docs(spark, only), spark.createDataFrame([(k, 0) for k in range(40)] + [(100 + k, 1) for k in range(3)], "doc_id long, toxic int"), "doc_id", "text", "lang", sample_bytes=2000)
    finally:
        toxicity.Net.train = train
    assert not sizes or sizes[0] <= {0.0, 1.0}
    assert toxicity.LOWEST <= net.common <= toxicity.HIGHEST


def test_ids_of_any_type(spark):
    rows = [(f"n{k}", f"vile stuff {k}" if k % 3 == 0 else f"kind things {k}", "x") for k in range(90)] + [(None, "vile stuff", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    labels = spark.createDataFrame([(f"n{k}", int(k % 3 == 0)) for k in range(90)] + [(None, 1)], "doc_id string, toxic int")
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == len(rows) and sum(g.doc_id is None for g in got) == 2
    assert all(g.held_out == (g.doc_id is not None and zlib.crc32(g.doc_id.encode()) % 5 == 0) for g in got)
    said = langid.language(df).collect()
    assert len(said) == len(rows) and {g.lang_pred for g in said} == {"x", "und"}


def test_kernel_by_sets():
    """The kernel of two texts from sets of hashed n-grams, and the scores from the explicit kernel matrix."""
    texts = ["der hund und die katze", "le chien et le chat", "the dog and the cat", "ein haus am see", "une maison", "a house by the lake", "noch ein hund", "encore un chien", "another dog"]
    langs = ["de", "fr", "en"] * 3

    def places(t):
        out = set()
        for n in langid.ORDERS:
            for i in range(len(t) - n + 1):
                h = 0
                for k, c in enumerate(t.lower()[i : i + n], 1):
                    h = (h * 0x01000193 + ord(c) + k) & 0xFFFFFFFF
                out.add(((h * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - langid.BITS))
        return out

    sets = [places(t) for t in texts]
    x = np.stack([langid.presence(t) for t in texts])
    assert [set(np.flatnonzero(row).tolist()) for row in x] == sets
    kernel = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    assert np.allclose(langid.unit(x) @ langid.unit(x).T, kernel, atol=1e-5)
    model = langid.Kernel(x, langs, per_lang=2)
    marks = sorted(i for v in ("de", "en", "fr") for i in [k for k, y in enumerate(langs) if y == v][:2])
    value, vector = np.linalg.eigh(kernel[np.ix_(marks, marks)])
    phi = np.hstack([kernel[:, marks] @ (vector / np.sqrt(np.maximum(value, 1e-3))), np.ones((len(texts), 1))])
    target = np.array([[1.0 if y == v else -1.0 for v in sorted(set(langs))] for y in langs])
    w = np.linalg.solve(phi.T @ phi + 0.3 * np.eye(phi.shape[1]), phi.T @ target)  # as many texts of each language
    assert np.allclose(langid.unit(x) @ model.map + model.shift, phi @ w, atol=1e-3)
    assert [model.langs[k] for k in model.predict(x)[0]] == langs


# urls


def ruled(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_filter(spark):
    r = random.Random(6)
    urls = [f"http{r.choice(['', 's'])}://{r.choice(['', 'a.', 'M.'])}{r.choice(['good', 'fine', 'Example'])}.{r.choice(['org', 'com', 'net'])}{r.choice(['', '/', '/es/', '/en/1', '/en/2', '/fr/x', '/de/y', '?q=/fr/', '#x'])}{r.randrange(99)}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://org/", "http://xorg/", "http://a.org", "http://example.org/en/12", "http://b.example.org/en/1?x", "x" * 30_000, urls[0]]
    pages = spark.createDataFrame([(k, u, "h", "allow", "p") for k, u in enumerate(urls)], "page_id long, url string, host string, verdict string, path string")
    got = {g.page_id: g for g in url_filter.url_filter(pages).collect()}
    assert len(got) == len(urls)
    told = [ruled(u) for u in urls]
    learn = {v: sorted({u for u, t in zip(urls, told, strict=True) if t[3] == v}) for v in ("allow", "block")}
    model = plain_url_models.Ratio(learn["allow"], learn["block"])
    for k, (host, path, rule, verdict) in enumerate(told):
        g = got[k]
        assert (g.host, g.path, g.rule) == (host, path, rule), urls[k]
        assert g.verdict == (verdict or model.verdict(urls[k] or "")[0])
    assert url_filter.url_filter(pages.limit(0)).count() == 0
    one_kind = url_filter.url_filter(pages.filter("page_id >= 300 and url is null or url = ''")).collect()
    assert {g.verdict for g in one_kind} == {"allow"}


def test_url_models_learn_from_every_ruled_url(spark, monkeypatch):
    """More ruled URLs of a kind than 3000: differences are those of the models of all of them, broadcast and joined."""
    urls = [f"http://a{k % 71}.org/p{k}/{k * 7919 % 1009}" for k in range(4000)] + [f"http://b{k % 53}.com/de/q{k}-{k * 31 % 997}" for k in range(3500)]
    asked = [f"http://a{k}.net/p{k * 13}" for k in range(40)] + [f"http://b{k}.net/q{k}-{k}" for k in range(40)] + [""]
    model = plain_url_models.Ratio(urls[:4000], urls[4000:])
    pages = spark.createDataFrame(list(enumerate(urls + asked)), "page_id long, url string")
    exact = []
    for limit in (64 << 20, 0):
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", limit)
        got = {g.page_id: g for g in url_filter.url_filter(pages).collect()}
        assert len(got) == len(urls) + len(asked)
        for k, u in enumerate(asked, len(urls)):
            assert math.isclose(got[k].difference, model.difference(u), rel_tol=1e-9, abs_tol=1e-9), u
            assert got[k].verdict == model.verdict(u)[0]
        exact.append({k: got[k].difference for k in got})
    assert exact[0] == exact[1]  # the same numbers, bit by bit


def test_url_rules_of_equal_length_and_odd_ids(spark):
    pages = spark.createDataFrame([(None, "http://a.org/x"), (1, "http://a.org/x"), (1, "http://a.org/x"), (2, None)], "page_id long, url string")
    rules = (("allow", "a.org", "/x"), ("block", "org", "/x"), ("block", "a.org", "/x"))
    got = sorted((tuple(g)[:5] for g in url_filter.url_filter(pages, rules=rules).collect()), key=repr)
    assert [g[4] for g in got if g[3]] == ["block"] * 3  # the later of two rules of one length
    assert len(got) == 4


def test_markov_is_a_distribution():
    m = plain_url_models.Markov(["abab", "abba"], order=2, letters=4)
    for before in ("", "a", "ab", "zz"):
        s = "\x02\x02" + before
        total = 0.0
        for c in "ab\x03z":
            p = 1 / 4
            for k in range(3):
                seen = m.after.get(s[len(s) - k :])
                if seen is None:
                    break
                n, kinds = m.total[s[len(s) - k :]], len(seen)
                p = (seen.get(c, 0) + kinds * p) / (n + kinds)
            total += p
        assert math.isclose(total, 1)


# quality


def parts_of(text):
    """Words, one by one: letters, digits and underscores together, Han characters and other signs alone."""
    out, last = [], ""
    for c in text or "":
        plain = (c.isalnum() or c == "_") and not "\u4e00" <= c <= "\u9fff"
        if plain and last:
            out[-1] += c
        elif not c.isspace():
            out.append(c)
        last = c if plain else ""
    return out


def kneser_ney(trusted, texts, order=4, units=list):
    """Perplexities by the textbook formulas, on dictionaries."""
    grams = lambda t: [tuple((["\x02"] * (order - 1) + units(t) + ["\x03"])[i : i + order]) for i in range(len(units(t)) + 1)]
    counts = {order: Counter(g for t in trusted for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    wanted = {g[-1:] for t in texts for g in grams(t)}
    d = {}
    for k, c in counts.items():
        n = Counter(c.values())
        if not n[1] or not n[2]:
            d[k] = (0.5, 0.75, 0.9)
            continue
        y = n[1] / (n[1] + 2 * n[2])
        raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d[k] = tuple(min(max(x, 0.05), m) for x, m in zip(raw, (0.95, 1.9, 2.85), strict=True))
    after = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            after[k][g[:-1]].append(n)

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(counts[1]) + 1)
        seen = after[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        cut = lambda n: d[k][min(n, 3) - 1]
        c = counts[k].get(g, 0)
        return ((c - cut(c) if c else 0) + sum(map(cut, seen)) * p(g[1:])) / sum(seen)

    assert wanted
    return [math.exp(-sum(math.log(p(g)) for g in grams(t)) / (len(units(t)) + 1)) for t in texts]


def test_quality_against_the_formulas(spark):
    r = random.Random(9)
    rows = [(k, sentences(r, "abcé", r.randint(1, 12)), r.choice(["x", "y", None])) for k in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (102, "!!!! ZZZZ", "x"), (103, "a" * 20_000, "y"), (0, rows[0][1], "x")]
    labels = [(k, int(k < 40)) for k in range(60)] + [(3, 0), (None, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    good = {k for k, q in labels if q == 1}
    trusted = [t for k, t, _ in rows if k in good and zlib.crc32(str(k).encode()) % 5]
    want = kneser_ney(trusted, [t or "" for _, t, _ in rows])
    out = quality.quality(docs(spark, rows), known, least=5).collect()
    got = sorted((g.doc_id, g.perplexity) for g in out)
    for (i, x), (j, y) in zip(got, sorted((k, w) for (k, _, _), w in zip(rows, want, strict=True)), strict=True):
        assert i == j and math.isclose(x, y, rel_tol=1e-6)
    kept = {g.doc_id: g.kept for g in out}
    assert not kept[100] and not kept[101] and not kept[102]
    # the thresholds: of trusted, held-back texts with characters, by language where there are five, else of all
    told = [(lang, p) for (k, t, lang), p in zip(rows, want, strict=True) if k in good and t and zlib.crc32(str(k).encode()) % 5 == 0]
    cut = lambda ps: sorted(ps)[math.ceil(0.99 * len(ps)) - 1]
    common = cut([p for _, p in told])
    own = {v: cut([p for lang, p in told if lang == v]) for v in ("x", "y") if sum(lang == v for lang, _ in told) >= 5}
    for g in out:
        limit = own.get(g.lang, common)
        assert math.isclose(g.threshold, limit, rel_tol=1e-6)
        if not math.isclose(g.perplexity, limit, rel_tol=1e-6):
            assert g.kept == (g.n_chars > 0 and g.perplexity < limit)


def test_quality_of_words_against_the_formulas(spark):
    """The mode of the query: words, order 3, the first of three units beside the packed two."""
    r = random.Random(19)
    vocabulary = ["one", "two", "Two", "thr_ee", "4", "é", "漢", "字漢", "x-y", "it's", "end."]
    line = lambda n: r.choice([" ", "  ", "\n"]).join(r.choice(vocabulary) for _ in range(n))
    rows = [(k, line(r.randint(1, 14)), r.choice(["x", "y", None])) for k in range(70)]
    rows += [(100, None, "x"), (101, " \n ", "x"), (102, "unseen words only", "x"), (103, "one " * 5000, "y"), (0, rows[0][1], "x")]
    labels = [(k, int(k < 50)) for k in range(70)]
    good = {k for k, q in labels if q == 1}
    trusted = [t for k, t, _ in rows if k in good and zlib.crc32(str(k).encode()) % 5]
    want = kneser_ney(trusted, [t for _, t, _ in rows], 3, parts_of)
    assert any(len(parts_of(t)) > 3 for t in trusted)
    out = quality.quality(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), least=5, words=True).collect()
    got = sorted((g.doc_id, g.perplexity) for g in out)
    assert len(got) == len(rows)
    for (i, x), (j, y) in zip(got, sorted((k, w) for (k, _, _), w in zip(rows, want, strict=True)), strict=True):
        assert i == j and math.isclose(x, y, rel_tol=1e-6), (i, x, y)
    told = [(lang, p) for (k, t, lang), p in zip(rows, want, strict=True) if k in good and parts_of(t) and zlib.crc32(str(k).encode()) % 5 == 0]
    cut = lambda ps: sorted(ps)[math.ceil(0.99 * len(ps)) - 1]
    own = {v: cut([p for lang, p in told if lang == v]) for v in ("x", "y") if sum(lang == v for lang, _ in told) >= 5}
    for g in out:
        assert math.isclose(g.threshold, own.get(g.lang, cut([p for _, p in told])), rel_tol=1e-6)


def test_quality_of_words(spark):
    """Shuffled words of trusted texts are poor text, blanks are none."""
    r = random.Random(4)
    follows = {f"w{k}": [f"w{(7 * k + j) % 90}" for j in range(3)] for k in range(90)}

    def fluent(n):
        out = [f"w{r.randrange(90)}"]
        while len(out) < n:
            out.append(r.choice(follows[out[-1]]))
        return out

    rows = [(k, " ".join(fluent(60)), "x") for k in range(300)]
    salad = fluent(80)
    r.shuffle(salad)
    rows += [(900, " ".join(salad), "x"), (901, " ".join(fluent(80)), "x"), (902, "  \n", "x"), (903, "漢字仮名 !!", None), (904, None, "x")]
    known = spark.createDataFrame([(k, 1) for k in range(300)], "doc_id long, quality int")
    got = {g.doc_id: g for g in quality.quality(docs(spark, rows), known, quantile=1.0, least=5, words=True).collect()}
    assert len(got) == len(rows)
    assert {k: got[k].kept for k in range(900, 905)} == {900: False, 901: True, 902: False, 903: False, 904: False}
    assert got[903].n_chars == 7 and len(quality.grams("漢字仮名 !!", True)) == 7


def test_quality_query_counts_words(spark, monkeypatch):
    monkeypatch.setattr(quality, "table", lambda s, d, name: docs(s, [(1, "one two three", "x")]) if name == "documents" else s.createDataFrame([(1, 1)], "doc_id long, quality int"))
    seen = []
    monkeypatch.setattr(quality, "counted", lambda d, words, f=quality.counted: seen.append(words) or f(d, words))
    assert quality.query(spark, "").count() == 1 and seen == [True]


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {g.doc_id: g.kept for g in quality.quality(docs(spark, [(1, "abc", "x"), (2, "", "x")]), none).collect()}
    assert got == {1: True, 2: False}
    assert quality.quality(docs(spark, []), none).count() == 0


def test_quality_of_words_in_rounds(spark, tmp_path, monkeypatch):
    """Each round deals a share of the trigrams only; split words and parts of the vocabulary change no row."""
    r = random.Random(21)
    rows = [(k, " ".join(r.choice(["the", "of", f"w{r.randrange(400)}"]) for _ in range(120)), "x") for k in range(60)]
    docs(spark, rows).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    source = word_trigrams.placed(read.select("text"), "row").withColumn("learn", F.col("row") % 2 == 0)
    one = word_trigrams.Deal(6, 4, np.array([], np.uint32), np.array([], np.int64))
    n = [word_trigrams.dealt(source, one, k, True).filter("kind = 2").agg(F.sum("n")).first()[0] for k in range(6)]
    assert sum(n) == 60 * 121 and max(n) < 0.6 * sum(n)

    monkeypatch.setattr(word_trigrams, "settled", lambda s: None)
    monkeypatch.setattr(word_trigrams, "ROUNDS", 2)

    def run(limit):
        out = word_trigrams.losses(source, quality.counted(source, True), 0.5, quality.discounts, limit)
        return sorted(out.collect())

    whole = run(1 << 20)
    monkeypatch.setattr(word_trigrams, "HEAVY", 100)
    assert len(word_trigrams.deal_of(word_trigrams.word_counts(source), 6).words) > 1
    assert run(2500) == whole and len(whole) == 60
