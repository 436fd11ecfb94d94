r"""Main text of web pages, by a linear-chain conditional random field over the leaf blocks of the page.

A page is read once, from left to right, into leaf blocks: runs of text without a block-level tag in between. A block's
features are the elements above it (their names, and the words of their classes, ids and roles), the nearest element that
says what it is for, and the shape of its text (length, closing punctuation, share of links, digits, signs). Two
neighbouring blocks are tied by the labels' transition weights, which differ by whether both are in the same section, the
second is deeper, or the first section is over. Viterbi decoding finds the best labelling of all blocks of a page together.

The field is trained on labelled pages by maximum likelihood (forward and backward passes over all pages at once in numpy,
Adam steps, a quadratic penalty). By default those are `pages` pages written by the seeded rule in `labelled_pages`, as
the tables have no labels; `train` takes any pages whose elements carry `data-label="main"` or `"other"`, and at most
`most` of them. The weights are a few hundred numbers and go to the tasks with the code.

Text: character references are decoded, white space inside a block becomes one space, blocks of the main text are joined
by one space in page order; nothing else is dropped or cut. `<br>` is white space. Comments, scripts, styles, templates,
titles, drawings and the contents of text areas are no text. Unclosed tags are closed as browsers do it in the common
cases (paragraphs, list items, cells, options); elements nested deeper than 512 are taken for their 512th ancestor, as in browsers.

Defined results: null and empty html, and pages without main text, give an empty text of 0 characters; broken mark-up is
read as far as it goes (an unclosed comment, tag or script takes the rest of the page); each row gives one row, so repeated
rows and null ids do too; an empty table gives no rows; columns other than page_id, url and html are neither read nor
returned. A page of any length is read whole, in time linear in its length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Bounded, alone, ship, slices, table
from .labelled_pages import labelled_pages

# Element names of HTML by how they are laid out and closed.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents run to the closing tag, whatever stands in between, and are no text of the page.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Elements whose contents aren't shown as text.
SILENT = frozenset("template svg math object canvas audio video datalist".split())
#: An opening tag closes an open one of these, up to the element that bounds it.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "optgroup")),
}
CLOSES_P = BLOCKS - frozenset("body button caption head html noscript optgroup option select tbody td tfoot th thead tr".split())
SCOPE = frozenset("button caption html table td th template".split())
CELLS = frozenset("caption td th template".split())
OF_TABLES = frozenset("table tbody thead tfoot tr td th caption body html".split())
#: Elements that divide a page into sections.
SECTIONS = frozenset("article aside body details dialog div fieldset footer form header main nav section table ul ol".split())
SEMANTIC = frozenset("article aside dialog footer form header main nav".split())
#: A header inside an article or main element, which holds its title rather than the site's.
INNER = "header in article"
DEEPEST = 512

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>?|<[!?/][^>]*+>?""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))|\b(hidden)\b""")
WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}")
ENDING = re.compile(r"[.!?…。:;\"'»”)\]]\Z")
SIGNS = re.compile(r"[©|·»›•]")
KEYS = re.compile(r"©|[^\W\d_]+")
# Words of a text that tell what it is for.
TELLING = frozenset("© ad advertisement comment comments consent cookie cookies copyright email login newsletter privacy related replies reply rights search share sponsored subscribe tags terms".split())
MAIN, OTHER = 1, 0


class Block:
    """A leaf block: its text, the features of what is above it, its section and how deep that is."""

    __slots__ = ("above", "depth", "label", "linked", "section", "tag", "text")

    def __init__(self, text, linked, tag, above, section, depth, label):
        self.text, self.linked, self.tag, self.above, self.section, self.depth, self.label = text, linked, tag, above, section, depth, label


def hints(name: str, attributes: str) -> tuple[tuple[str, ...], bool, str | None]:
    """What an element says of its contents, whether that names a purpose, and its label if it has one."""
    out, label = [f"t:{name}"] if name in BLOCKS or name == INNER else [], None
    purpose = name in SEMANTIC
    if attributes:
        for key, a, b, c, hidden in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), a or b or c
            if hidden or (key == "aria-hidden" and value == "true") or (key == "style" and "none" in value):
                out.append("hidden")
            elif key in ("class", "id", "role"):
                found = [f"c:{w.lower()}" for w in WORD.findall(value[:200])]
                out += found
                purpose |= bool(found)
            elif key == "data-label":
                label = value
    return tuple(dict.fromkeys(out)), purpose, label


class Reader:
    """Pages into leaf blocks. `known` tells which hints have a number; others are passed over, so what is kept for an
    element is bounded by the model's size. Nearest hints get an `n:` before them."""

    def __init__(self, known: Callable[[str], object]):
        self.known = known
        self.memo = Bounded(self._hints, mb=8, owner="html_extract")

    def _hints(self, tag: str):
        found, purpose, label = hints(*tag.split("\n", 1))
        own = tuple(h for h in found if self.known(h))
        near = tuple(n for n in (f"n:{h}" for h in found if not h.startswith("t:") or h[2:] in SEMANTIC) if self.known(n)) if purpose else ()
        return own, near, label

    def blocks(self, page: str) -> list[Block]:
        out: list[Block] = []
        # of each open element: name, hints of it and all above, nearest hints, section, depth of the section, label
        stack = [("", (), (), 0, 0, None)]
        count: dict[str, int] = {}
        pieces, linked, links, silent, sections, at, end = [], 0, 0, 0, 0, 0, len(page)

        def say(text: str) -> None:
            nonlocal linked
            if not silent:
                text = html.unescape(text) if "&" in text else text
                pieces.append(text)
                if links:
                    linked += len(text.strip())

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    top = stack[-1]
                    tag = next((e[0] for e in reversed(stack) if e[0] in BLOCKS), "")
                    out.append(Block(text, linked / len(text), tag, top[1] + top[2], top[3], top[4], top[5]))
                pieces.clear()
            linked = 0

        def pop(n: int) -> None:
            nonlocal links, silent
            for e in stack[n:]:
                count[e[0]] -= 1
                links -= e[0] == "a"
                silent -= e[0] in SILENT
            del stack[n:]

        def close(names: tuple[str, ...], bounds: Iterable[str]) -> bool:
            if any(count.get(x) for x in names):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in names:
                        pop(k)
                        return True
                    if stack[k][0] in bounds:
                        break
            return False

        while at < end:
            m = TOKEN.search(page, at)
            if m is None:
                say(page[at:])
                break
            if m.start() > at:
                say(page[at : m.start()])
            at = m.end()
            if m[2] is None:  # a comment or a declaration
                continue
            name = m[2].lower()
            if m[1]:
                if name in BLOCKS:
                    flush()
                    close((name,), () if name in OF_TABLES else CELLS)
                elif name == "br":
                    say(" ")
                else:
                    close((name,), BLOCKS)
                continue
            if name in RAW:
                found = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
                at = found.start() if found else end
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                elif name == "br":
                    say(" ")
                continue
            if name in BLOCKS:
                flush()
                if name in CLOSES_P:
                    close(("p",), SCOPE)
                if name in IMPLIED:
                    close(*IMPLIED[name])
            if len(stack) > DEEPEST:
                continue
            _, above, near, section, depth, label = stack[-1]
            inner = name == "header" and (count.get("article") or count.get("main"))
            own, nearest, named = self.memo[f"{INNER if inner else name}\n{m[3]}"]
            fresh = tuple(h for h in own if h not in above)
            if name in SECTIONS:
                sections += 1
                section, depth = sections, depth + 1
            stack.append((name, above + fresh if fresh else above, nearest or near, section, depth, named or label))
            count[name] = count.get(name, 0) + 1
            links += name == "a"
            silent += name in SILENT
        flush()
        return out


def bucket(n: int) -> int:
    """Lengths by doublings, from 8 to 512."""
    return min(max(n, 4).bit_length(), 10)


def features(blocks: list[Block]) -> list[list[str]]:
    """The features of each block, as strings."""
    sizes = [bucket(len(b.text)) for b in blocks]
    titles, out = 0, []
    for k, b in enumerate(blocks):
        titles += b.tag == "h1"
        share = "0" if b.linked == 0 else "1" if b.linked < 0.34 else "2" if b.linked < 0.8 else "3"
        f = ["bias", f"size:{sizes[k]}", f"leaf:{b.tag}", f"links:{share}", "title:" + ("before" if not titles else "after")]
        if k:
            f.append(f"before:{sizes[k - 1]}")
        if k + 1 < len(blocks):
            f.append(f"after:{sizes[k + 1]}")
        if ENDING.search(b.text):
            f.append("ending")
        if SIGNS.search(b.text):
            f.append("sign")
        if sum(map(str.isdigit, b.text[:200])) * 3 > min(len(b.text), 200):
            f.append("digits")
        if len(b.text) < 400:
            f += [f"w:{w}" for w in {w.lower() for w in KEYS.findall(b.text)} & TELLING]
        f += b.above
        out.append(f)
    return out


def ties(blocks: list[Block]) -> list[int]:
    """How each block follows the one before: in the same section, in a deeper one, or in another that is not deeper."""
    return [0] + [0 if a.section == b.section else 1 if b.depth > a.depth else 2 for a, b in zip(blocks, blocks[1:], strict=False)]


class Field:
    """The trained field: a number for each known feature, its weights for main text, and transitions by tie."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves
        self.by_name = dict(zip(names, weights[list(names.values())].tolist(), strict=True))

    def scores(self, blocks: list[Block]) -> list[float]:
        """For each block how much main text is preferred, from its own features."""
        get = self.by_name.get
        return [sum([get(f, 0.0) for f in fs]) for fs in features(blocks)]

    def decode(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the labelling of the page with the highest score."""
        return viterbi(self.scores(blocks), ties(blocks), self.moves.tolist())


def viterbi(scores: list[float], tie: list[int], moves: list) -> list[int]:
    if not scores:
        return []
    other, main, back = 0.0, scores[0], []
    for s, t in zip(scores[1:], tie[1:], strict=True):
        (oo, om), (mo, mm) = moves[t]
        back.append((main + mo > other + oo, main + mm > other + om))
        other, main = max(other + oo, main + mo), max(other + om, main + mm) + s
    label = int(main > other)
    out = [label]
    for b in reversed(back):
        label = int(b[label])
        out.append(label)
    return out[::-1]


def likelihood(scores: np.ndarray, moves: np.ndarray, tie: np.ndarray, gold: np.ndarray, lengths: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels and its gradients in block scores and in moves; pages are rows, padded to the longest."""
    n, longest = gold.shape
    s = np.zeros((n, longest, 2))
    s[..., 1] = scores
    rows = np.arange(n)
    step = moves[tie]  # page, block, from, to
    forward = np.empty_like(s)
    forward[:, 0] = s[:, 0]
    for k in range(1, longest):
        forward[:, k] = np.logaddexp(forward[:, k - 1, 0, None] + step[:, k, 0], forward[:, k - 1, 1, None] + step[:, k, 1]) + s[:, k]
    total = np.logaddexp(*forward[rows, lengths - 1].T)
    backward = np.zeros_like(s)
    for k in range(longest - 2, -1, -1):
        on = s[:, k + 1] + backward[:, k + 1]
        new = np.logaddexp(step[:, k + 1, :, 0] + on[:, 0, None], step[:, k + 1, :, 1] + on[:, 1, None])
        backward[:, k] = np.where((k + 1 < lengths)[:, None], new, 0.0)
    real = np.arange(longest) < lengths[:, None]
    each = np.exp(np.clip(forward + backward - total[:, None, None], -60, 0)) * real[..., None]
    value = float((s[..., 1] * gold * real).sum() - total.sum())
    moved = np.zeros_like(moves)
    follows = real[:, 1:]
    joint = np.exp(np.clip(forward[:, :-1, :, None] + step[:, 1:] + (s + backward)[:, 1:, None, :] - total[:, None, None, None], -60, 0)) * follows[..., None, None]
    before, after, kind = gold[:, :-1], gold[:, 1:], tie[:, 1:]
    for t in range(len(moves)):
        here = follows & (kind == t)
        for a in (0, 1):
            for b in (0, 1):
                seen = (here & (before == a) & (after == b)).sum()
                value += float(seen * moves[t, a, b])
                moved[t, a, b] = seen - joint[..., a, b][here].sum()
    return value, (gold * real - each[..., 1]), moved


def train(pages: Iterable[str], most: int = 2000, steps: int = 150, rate: float = 0.15, penalty: float = 0.5, least: int = 3) -> Field:
    """The field of the first `most` labelled pages; features of fewer than `least` pages are left out."""
    reader = Reader(lambda h: True)
    read = [b for b in (reader.blocks(p) for _, p in zip(range(most), pages)) if b]
    listed = [features(b) for b in read]
    seen: dict[str, int] = {}
    for page in listed:
        for f in {f for fs in page for f in fs}:
            seen[f] = seen.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    moves = np.zeros((3, 2, 2))
    if not names:
        return Field(names, np.zeros(0), moves)
    lengths = np.array([len(b) for b in read])
    real = np.arange(lengths.max()) < lengths[:, None]
    tie, gold, scores = np.zeros(real.shape, np.int64), np.zeros(real.shape, np.int64), np.zeros(real.shape)
    tie[real] = [t for b in read for t in ties(b)]
    gold[real] = [c.label == "main" for b in read for c in b]
    x = np.zeros((lengths.sum(), len(names)), np.float32)
    for row, fs in zip(x, (fs for page in listed for fs in page), strict=True):
        row[[names[f] for f in fs if f in names]] = 1
    weights = np.zeros(len(names), np.float32)
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for k in range(1, steps + 1):
        scores[real] = x @ weights
        _, by_block, moved = likelihood(scores, moves, tie, gold, lengths)
        for value, slope, m, v in ((weights, by_block[real].astype(np.float32) @ x - penalty * weights, *state[:2]), (moves, moved - penalty * moves, *state[2:])):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            value += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Field(names, weights.astype(float), moves)


@cache
def default_field(pages: int = 1000) -> Field:
    return train(labelled_pages(pages), pages)


class Extractor:
    def __init__(self, field: Field):
        self.field, self.reader = field, Reader(field.names.__contains__)

    def text(self, page: str | None) -> str:
        blocks = self.reader.blocks(page or "")
        return " ".join(b.text for b, main in zip(blocks, self.field.decode(blocks), strict=True) if main)


_extractor: list = []


def extract(pages: DataFrame, field: Field | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), a row for each row of `pages`."""
    ship(pages.sparkSession)
    field = field or default_field()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    made = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("html_extract")
        if not _extractor or _extractor[0] is not field:
            _extractor[:] = [field, Extractor(field)]
        own = _extractor[1]
        for b in slices(batches, 64):
            texts = [own.text(v.as_py()) for v in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, made)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


#: What is expected of pages whose main text is their `article` element and which nest no other region in it, as in the given
#: tables. References are decoded by name; a reference cut short stays as it is, but for `&amp`.
ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS inner_html FROM pages
), t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(inner_html, '<(/?(p|h1)|br)>', ' ', 'g'), '<[^<>]*>', '', 'g') AS marked FROM a
), d AS (
  SELECT page_id, url, trim(regexp_replace(replace(replace(replace(regexp_replace(marked, '&amp;?', chr(1), 'g'), '&quot;', '"'), '&#x27;', ''''), chr(1), '&'), '\s+', ' ', 'g')) AS text FROM t
)
SELECT page_id, url, text, length(text) AS n_chars FROM d
"""
