"""Main text of pages, prefix tries and manifests against plain versions and on odd input."""

import itertools
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from speechloom.llm import html_extract as H
from speechloom.llm import merkle, prefix_trie
from speechloom.llm.labelled_pages import labelled_pages

PAGES = [
    ("<html><body><article><p>One two three.</p></article></body></html>", "One two three."),
    ("<article>Bare text in the article. <b>bo</b>ld&nbsp;&amp; more</article>", "Bare text in the article. bold & more"),
    (
        "<header><h1>Site</h1><nav><a>Home</a><a>About</a></nav></header><main><h1>Title here</h1><p>Para one is long enough to count.</p><p>Be.</p><aside><h2>More</h2><p>Read this too, please, it is nice.</p></aside>"
        "<p>After aside.</p></main><section class=comments><h3>Comments</h3><p>I like this a lot, thanks for the article.</p></section><footer><p>© 2020 x</p></footer>",
        "Title here Para one is long enough to count. Be. After aside.",
    ),
    (
        "<div class=header>Site</div><div class='cookie-notice'><p>We use cookies to improve your experience.</p><button>OK</button></div><div id=content><h1>T</h1><div class=post-body><p>First paragraph of the post."
        "</p><ul><li>one</li><li>two</li></ul><form action=/s><label>Email</label><input><button>Send</button></form><p>Last.</p></div></div><div class=sidebar><p>Side text with a sentence.</p></div><div id=footer>Contact</div>",
        "T First paragraph of the post. one two Last.",
    ),
    ("<div role=navigation><ul><li><a href=x>a</a></ul></div><div role=main><p>Text a.<p>Text b.<table><tr><td>c<td>d</table></div><div role=complementary>zz zz</div>", "Text a. Text b. c d"),
    ("<article><header><h1>Big title</h1></header><p>Body text goes here.</p><footer>Posted in x</footer><div class=ad>Buy now!</div><p>tail</p><section id=comments><article class=comment><p>Nice!</p></article></section></article>", "Big title Body text goes here. tail"),
]


@pytest.fixture(scope="module")
def field():
    return H.default_field()


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(field, page, text):
    assert H.Extractor(field).text(page) == text


def test_held_out_pages(field):
    """Pages of other seeds than the training's, with hard ones (no class says anything on 15 of 100) among them."""
    reader, right, all_, kept, gold = H.Reader(lambda h: True), 0, 0, 0, 0
    own = H.Reader(field.names.__contains__)
    for p in labelled_pages(200, seed=77):
        want, got = [b.label == "main" for b in reader.blocks(p)], field.decode(own.blocks(p))
        right += sum(w and bool(g) for w, g in zip(want, got, strict=True))
        all_, kept, gold = all_ + len(want), kept + sum(got), gold + sum(want)
    assert right / kept > 0.95 and right / gold > 0.94


def test_blocks():
    read = lambda page: [b.text for b in H.Reader(lambda h: True).blocks(page)]
    assert read("") == [] and read("a < b &lt; c") == ["a < b < c"]
    assert read("<p>a<b>b</b> c<br>d\n\te<p>f</p>g") == ["ab c d e", "f", "g"]
    assert read("<!-- x --><script>if (a</b) '</p>';</script >t<style>p{}</style><template>no</template>u<!-- open") == ["tu"]
    assert read('<p title="a>b">x</p><p title=\'it"s\'>y</p><p t=it\'s>z') == ["x", "y", "z"]
    assert read("a<script>never closed <p>b") == ["a"] and read("a<p") == ["a"] and read("&notit; &am &#x41;&#0;") != []
    assert read("<table><tr><td>1<td>2<tr><th>3</table>") == ["1", "2", "3"]
    assert read("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>on</p>") == ["deep", "on"]
    assert [b.tag for b in H.Reader(lambda h: True).blocks("<ul><li><a>x</a><li>y</ul><p><b>z<p>w")] == ["li", "li", "p", "p"]
    long = "<p>" + "word " * 200_000 + "</p>"
    assert len(read(long)[0]) == 5 * 200_000 - 1


def test_field_against_all_labellings():
    """Likelihood, its slopes and Viterbi against sums over every labelling of short chains."""
    r = np.random.default_rng(5)
    lengths, longest = np.array([1, 4, 6]), 6
    scores, moves, tie, gold = r.normal(size=(3, longest)), r.normal(size=(3, 2, 2)), r.integers(0, 3, (3, longest)), r.integers(0, 2, (3, longest))

    def score(p, labels, scores, moves):
        return sum(scores[p, k] * y for k, y in enumerate(labels)) + sum(moves[tie[p, k], labels[k - 1], labels[k]] for k in range(1, len(labels)))

    def value(scores, moves):
        return sum(score(p, gold[p, :n], scores, moves) - np.log(sum(np.exp(score(p, y, scores, moves)) for y in itertools.product((0, 1), repeat=n))) for p, n in enumerate(lengths))

    got, by_block, moved = H.likelihood(scores, moves, tie, gold, lengths)
    assert np.isclose(got, value(scores, moves))
    for p, k in ((0, 0), (1, 2), (2, 5), (1, 5)):
        more = scores.copy()
        more[p, k] += 1e-5
        assert np.isclose(by_block[p, k], (value(more, moves) - got) / 1e-5, atol=1e-3)
    for t, a, b in itertools.product(range(3), (0, 1), (0, 1)):
        more = moves.copy()
        more[t, a, b] += 1e-5
        assert np.isclose(moved[t, a, b], (value(scores, more) - got) / 1e-5, atol=1e-3)
    for p, n in enumerate(lengths):
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: score(p, y, scores, moves))
        assert tuple(H.viterbi(scores[p, :n].tolist(), tie[p, :n].tolist(), moves.tolist())) == best


def test_extract_odd_rows(spark, field):
    rows = [(1, "u", PAGES[0][0], 5), (1, "u", PAGES[0][0], 5), (None, None, None, 0), (2, "v", "", 1), (3, "w", "<nav>a</nav>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(2)
    got = H.extract(df, field)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", "One two three.", 14), (1, "u", "One two three.", 14), (None, None, "", 0), (2, "v", "", 0), (3, "w", "", 0)], key=str)
    assert H.extract(df.limit(0), field).count() == 0


# -- manifests


def plain_manifest(docs, fanout):
    h = lambda s: sha256(s.encode()).hexdigest()
    mark = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = lambda t: None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    leaf = lambda d, t: h("".join(map(mark, (d[0], d[1], d[2], d[3], t))))
    groups = {}
    for d in docs:
        bad = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
        groups.setdefault(d[1], []).append((d[0] is not None, d[0] or 0, leaf(d, d[4]), leaf(d, lower(d[4])) if bad else None))

    def tree(nodes):
        """The root, and for each node the runs above it with its place."""
        paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(level) > 1:
            runs = [level[k : k + fanout] for k in range(0, len(level), fanout)]
            for p, k in zip(paths, at, strict=True):
                p.append((runs[k // fanout], k % fanout))
            at, level = [k // fanout for k in at], [h("".join(r)) for r in runs]
        return level[0], paths

    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(groups[s]), *tree([x[2] for x in sorted(groups[s])])) for s in sources}
    root, over = tree([trees[s][1] for s in sources]) if sources else (None, [])
    out = []
    for s, up in zip(sources, over, strict=True):
        leaves, subroot, paths = trees[s]
        for x, path in zip(leaves, paths, strict=True):
            now, said = x[3] or x[2], ""
            for run, k in path + up:
                said += "".join(run[:k] + run[k + 1 :])
                now = h("".join([*run[:k], now, *run[k + 1 :]]))
            out.append((x[1] if x[0] else None, x[2], subroot, root, h(said), now, now == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout,block", [(16, 4096), (2, 4), (3, 9)])
def test_manifest(spark, fanout, block):
    r = random.Random(3)
    docs = [(k, r.choice(["a", "a", "a", "b", None, "é", "z"]), r.choice(["en", None]), r.choice([None, 7]), r.choice([None, "", "Some TEXT é", "x"])) for k in range(70)]
    docs += [(5, "a", "en", 7, "Same"), (5, "a", "en", 7, "Same"), (None, "a", None, None, None), (None, "only", "de", 1, "ONE"), (-3, "z", "de", 1, "T")]
    r.shuffle(docs)
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, source string, lang string, n_chars long, text string, pos int, tree string").repartition(3)
    got = merkle.manifest(df, fanout=fanout, block=block)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(x) for x in got.collect()), key=repr) == plain_manifest(docs, fanout)


def test_manifest_small(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = [(7, "s", "en", 3, "ABC")]
    assert [tuple(x) for x in merkle.manifest(spark.createDataFrame(one, schema)).collect()] == plain_manifest(one, 16)
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame(one, schema), block=100)


def test_siblings_by_index():
    nodes = np.frombuffer("".join(f"{k:064d}" for k in range(23)).encode(), np.uint8).reshape(-1, 64)
    for k, s in enumerate(merkle.siblings(nodes, np.arange(23), 16)):
        first = k // 16 * 16
        assert s == b"".join(f"{j:064d}".encode() for j in range(first, min(first + 16, 23)) if j != k)


# -- tries


def plain_trie(rows):
    digest = lambda t: sha256(f"{len(t[0].encode())}:{t[0]}{t[1]}".encode()).digest()
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    convs = {c: [t for _, t in sorted(ts, key=lambda x: (x[0], digest(x[1])))] for c, ts in convs.items()}
    trail = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        trail[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    members = {}
    for c, t in trail.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    out = []
    for key, cs in members.items():
        below = [k for k in members if k[: len(key)] == key]
        has_child = {k[:-1] for k in members if k}
        ends = ",".join(str(c) for c in sorted(cs) if trail[c] == key)
        out.append(
            (min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), sum(1 for k in below if len(k) == len(key) + 1), sum(k not in has_child for k in below), sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k), sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def test_trie(spark):
    r = random.Random(8)
    rows = []
    for c in range(90):
        for k in range(r.randint(1, 11)):
            rows.append((c, k, ["user", "assistant"][k % 2], r.choice(["a", "b", "é"]) if k else "hello"))
    rows = [x for x in rows if x[0] not in (20, 45)]  # bases that are absent
    rows += [(300, None, None, None), (300, 0, "user", "x"), (300, 0, "user", "x"), (300, 1, "user", None), (301, 5, "user", "late")]
    rows += [(None, 0, "user", "nobody's"), (7, 3, "user", "a tie"), (7, 3, "user", "a tie")]
    rows += [(400, k, "user", str(k % 3)) for k in range(75)]  # a long one and its kin
    rows += [(c, k, "user", "own") for c in (401, 402, 403) for k in range(12)]
    df = spark.createDataFrame([(*x, 1, "n") for x in rows], "conv_id long, turn long, role string, text string, name int, n string").repartition(3)
    got = prefix_trie.prefix_trie(df)
    assert sorted((tuple(x) for x in got.collect()), key=repr) == plain_trie(rows)


def test_trie_small(spark):
    schema = "conv_id long, turn long, role string, text string"
    one = [(3, 0, "user", "x")]  # has no base, and is shorter than what it would take over
    assert [tuple(x) for x in prefix_trie.prefix_trie(spark.createDataFrame(one, schema)).collect()] == plain_trie(one)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
