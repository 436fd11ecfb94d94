"""Convolutional text classifier for toxicity, trained in numpy.

Words are hashed into two tables of embeddings whose rows are added (a word that shares a row in one table rarely shares
it in the other), filters of widths 1, 2 and 3 run over the sequence, each filter's maximum over the text is kept, and a
logistic layer gives the score. Training uses at most `sample` different labelled rows of each class, those of the smallest
hash of the id, then of the text; one whose text doesn't fit into what is left of half of `sample_bytes` is passed over, and
the ones after it are tried. If no text of a class fits at all, its shortest one is learned from. These bounds are fixed, so
the model and what reaches the driver have one size for any input, however often ids or rows repeat. A part of these rows is held
back to scale the scores, so that 0.5 is the even chance. All labelled rows but those trained on and those held out for
tests set the thresholds, from histograms by language, each shrunk towards the common one by the number of its rarer class.
A threshold lies from `LOWEST` to `HIGHEST`: beyond them the cut of the fewest errors would rest on a handful of rows.

Scoring reads whole texts in Arrow batches; the score depends on the text alone. The language only picks the threshold
of the column `rejected`.

Defined results: null and empty texts are one reserved word and get its score; ids that occur in several rows are scored
row by row, rows that repeat are learned from once; rows with a null id are scored, held out for nothing and not learned
from; null labels are not learned from; without positive or negative labels every score is the share of positives (0
without labels); other columns are neither read nor returned, but for those in `keep`. Ids may be of any type.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import alone, checkpoint, quoted, ship, slices, small_or_plain, table
from .decontaminate import hashes, words_of

BITS, DIM, WIDTHS, FILTERS = 16, 8, (1, 2, 3), 8
PAD = 2
FOLDS, HELD = 5, 0
#: Of the scores, in the histograms that thresholds come from.
BINS = 1000
#: Bounds of every threshold.
LOWEST, HIGHEST = 0.2, 0.8
_MASK = np.uint64((1 << BITS) - 1)


def hashed(text: str | None) -> np.ndarray:
    """Two table rows for each word, packed; the reserved word for a text without words."""
    h = hashes(words_of(text))
    one = np.uint64(1)  # row 0 is the reserved word's
    return (one + h % _MASK | one + (h >> np.uint64(32)) % _MASK << np.uint64(32)).view(np.int64) if len(h) else np.zeros(1, np.int64)


class Net:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.tables = [r.normal(0, 0.01, (1 << BITS, DIM)).astype(np.float32) for _ in range(2)]
        self.conv = [r.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = r.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.base = np.float32(0)
        self.scale = (1.0, 0.0)
        self.thresholds: dict[str, float] = {}
        self.common = 0.5

    def project(self) -> None:
        """The filters' products with every row of the tables, so that scoring is look-ups and sums."""
        self.parts = [[[t @ c[j] for j in range(len(c))] for c in self.conv] for t in self.tables]

    def laid(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of all words, texts apart by PAD places; where texts begin; which places are padding."""
        sizes = np.array([len(d) for d in docs])
        starts = np.concatenate([[0], np.cumsum(sizes + PAD)])
        flat = np.zeros(starts[-1], np.int64)
        pad = np.ones(starts[-1], bool)
        for d, s in zip(docs, starts, strict=False):
            flat[s : s + len(d)] = d
            pad[s : s + len(d)] = False
        return flat, starts, pad

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        flat, starts, pad = self.laid(docs)
        one, two = flat & 0xFFFFFFFF, flat >> 32
        pooled = []
        for k, w in enumerate(WIDTHS):
            z = np.zeros((len(flat), FILTERS), np.float32)
            for j in range(w):
                part = self.parts[0][k][j][one[j:]] + self.parts[1][k][j][two[j:]]
                if j:
                    part[pad[j:]] = 0
                z[: len(flat) - j] += part
            z[pad] = -1e9
            pooled.append(np.maximum(np.maximum.reduceat(z, starts[:-1], axis=0) + self.bias[k], 0))
        return np.concatenate(pooled, 1) @ self.out + self.base

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(docs).astype(np.float64) + b, -40, 40)))

    def train(self, docs: list[np.ndarray], y: np.ndarray, epochs: int = 3, batch: int = 32, rate: float = 0.01, decay: float = 1e-5, seed: int = 3) -> None:
        """Adam on the log loss; only the places that the maxima point at have gradients."""
        r = np.random.default_rng(seed)
        self._start(docs, y)
        dense = [*self.conv, *self.bias, self.out]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
        squares = [np.full(1 << BITS, 1e-8, np.float32) for _ in self.tables]
        base_m, step = 0.0, 0
        for _ in range(epochs):
            order = r.permutation(len(docs))
            for at in range(0, len(order), batch):
                step += 1
                pick = order[at : at + batch]
                flat, starts, pad = self.laid([docs[i] for i in pick])
                rows = (flat & 0xFFFFFFFF, flat >> 32)
                x = self.tables[0][rows[0]] + self.tables[1][rows[1]]
                x[pad] = 0
                pooled, where = [], []
                for k, w in enumerate(WIDTHS):
                    z = x @ self.conv[k][0]
                    for j in range(1, w):
                        z[: len(x) - j] += x[j:] @ self.conv[k][j]
                    z[pad] = -1e9
                    best = np.stack([s + z[s : e - PAD].argmax(0) for s, e in zip(starts, starts[1:], strict=False)])
                    where.append(best)
                    pooled.append(z[best, np.arange(FILTERS)] + self.bias[k])
                raw = np.concatenate(pooled, 1)
                act = np.maximum(raw, 0)
                p = 1 / (1 + np.exp(-np.clip(act @ self.out + self.base, -30, 30)))
                d = ((p - y[pick]) / len(pick)).astype(np.float32)
                g_out = act.T @ d
                g_act = np.outer(d, self.out) * (raw > 0)
                g_conv, g_bias = [np.zeros_like(c) for c in self.conv], []
                g_x: list[tuple[np.ndarray, np.ndarray]] = []
                for k, w in enumerate(WIDTHS):
                    g = g_act[:, k * FILTERS : (k + 1) * FILTERS]
                    g_bias.append(g.sum(0))
                    for j in range(w):
                        spot = np.minimum(where[k] + j, len(x) - 1)  # (texts, filters)
                        g_conv[k][j] = np.einsum("tfd,tf->df", x[spot], g)
                        g_x.append((spot.ravel(), (g[:, :, None] * self.conv[k][j].T[None]).reshape(-1, DIM)))
                for (m, v), par, grad in zip(moments, dense, [*g_conv, *g_bias, g_out], strict=True):
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad * grad - v)
                    par -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                base_m = 0.9 * base_m + 0.1 * float(d.sum())
                self.base = np.float32(self.base - rate * np.sign(base_m) * min(1, abs(base_m) * 10))
                spots = np.concatenate([s for s, _ in g_x])
                grads = np.concatenate([g for _, g in g_x])
                live = ~pad[spots]
                for t, row, sq in zip(self.tables, rows, squares, strict=True):
                    ids, inv = np.unique(row[spots[live]], return_inverse=True)
                    g = np.zeros((len(ids), DIM), np.float32)
                    np.add.at(g, inv, grads[live])
                    sq[ids] += (g * g).mean(1)
                    t[ids] -= 0.05 * g / np.sqrt(sq[ids])[:, None] + rate * decay * t[ids]
        self.project()

    def _start(self, docs: list[np.ndarray], y: np.ndarray) -> None:
        """The first filter of width 1 begins as the shrunk log odds of a word's rows; the others at random."""
        n = np.zeros((2, 2, 1 << BITS))
        for d, label in zip(docs, y, strict=True):
            u = np.unique(d)
            n[0, int(label)][u & 0xFFFFFFFF] += 1
            n[1, int(label)][np.unique(u >> 32)] += 1
        total = max(1.0, float(y.sum())), max(1.0, float((1 - y).sum()))
        for t, (neg, pos) in zip(self.tables, n, strict=True):
            share = (pos + 0.5) / (total[0] + 1), (neg + 0.5 * (total[1] / total[0])) / (total[1] + total[1] / total[0])
            seen = pos + neg
            t[:, 0] = np.log(share[0] / share[1]) * seen / (seen + 5) / 2
        self.conv[0][0, :, 0] = 0
        self.conv[0][0, 0, 0] = 1
        self.out[0] = 1.5
        self.bias[0][0] = -0.5
        self.base = np.float32(-2)


def best_cut(toxic: np.ndarray, clean: np.ndarray) -> float:
    """The threshold of the fewest errors, from counts by bins of the score; the middle of the gap around it."""
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])
    first = last = int(errors.argmin())
    while last < len(toxic) and not toxic[last] and not clean[last]:
        last += 1
    return (first + last) / 2 / len(toxic)


def levels(told: DataFrame, weight: int = 40) -> tuple[float, dict[str, float]]:
    """The common threshold and that of each language, from (lang, y, score) of all rows told.

    A language's own threshold is shrunk towards the common one by `weight` rows of its rarer class.
    """
    spot = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1))
    hist: dict[str | None, np.ndarray] = {}
    for lang, y, k, n in told.groupBy("lang", "y", spot.alias("bin")).count().collect():
        hist.setdefault(lang, np.zeros((2, BINS)))[y, k] += n
    if not hist:
        return 0.5, {}
    within = lambda t: min(HIGHEST, max(LOWEST, t))
    clean, toxic = sum(hist.values())
    common = within(best_cut(toxic, clean))
    out = {}
    for lang, (clean, toxic) in hist.items():
        n = min(clean.sum(), toxic.sum())
        if lang is not None and n:
            out[lang] = float(common + n / (n + weight) * (within(best_cut(toxic, clean)) - common))
    return common, out


def calibrate(net: Net, docs: list[np.ndarray], y: np.ndarray) -> None:
    """Scale and shift of the logits by Newton steps on the log loss."""
    x = np.concatenate([net.logits(docs[k : k + 256]) for k in range(0, len(docs), 256)]).astype(np.float64)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - y) * x).sum() + 1e-2 * (a - 1), (p - y).sum() + 1e-2 * b])
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1, 2 / np.abs(step).max()) if np.abs(step).max() else 1
        a, b = a - step[0], b - step[1]
    net.scale = (float(max(a, 1e-3)), float(b))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str | None, sample: int = 2500, sample_bytes: int = 64 << 20) -> Net:
    """Learn from at most `sample` labelled rows of each class with crc32(id) mod 5 other than 0; all others set thresholds."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.filter(F.col("toxic").isin(0, 1) & (F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) != HELD))
    known = checkpoint(known.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("y")).distinct())
    n_known = known.count()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("lang"))
    # rows of one id and text are one; their hashes and lengths are chosen from, by a top-k, before texts are taken up
    told = rows.join(small_or_plain(known, n_known, 24), "id").select("id", "y", F.xxhash64("text").alias("hash"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    told = checkpoint(told.groupBy("id", "y", "hash").agg(F.max("size").alias("size")))
    chosen = []
    for y in (0, 1):
        room, own = sample_bytes // 2, told.filter(F.col("y") == y)
        # longer ones can't fit, so at least the first of these does
        fitting = own.filter(F.col("size") <= room).orderBy(F.xxhash64("id"), "hash", "id").limit(sample).collect()
        for r in fitting or own.orderBy("size", F.xxhash64("id"), "hash", "id").limit(1).collect():
            if r["size"] <= room or not fitting:
                room -= r["size"]
                chosen.append(r)
    picked = spark.createDataFrame(chosen, told.schema).drop("size")  # at most twice `sample`

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("toxicity")
        for b in slices(batches):
            words = [hashed(t).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(words, pa.binary())], ["name", "y", "words"])

    # a row for each chosen one: repeated rows meet in partial aggregates
    joined = rows.withColumn("hash", F.xxhash64("text")).join(F.broadcast(picked), ["id", "hash"]).groupBy("id", "y", "hash").agg(F.first("text").alias("text"))
    got = joined.select(F.col("id").cast("string").alias("name"), "text", "y").mapInArrow(run, "name string, y int, words binary").collect()
    got = sorted(got, key=lambda r: (zlib.crc32(r[0].encode()), r[0], r[1], r[2]))
    net = Net()
    y = np.array([r[1] for r in got], np.float64)
    if not len(y) or y.min() == y.max():
        net.out[:] = 0
        net.base = np.float32(20 if len(y) and y.min() else -20)
        net.project()
        return net
    words = [np.frombuffer(r[2], np.int64) for r in got]
    back = np.array([zlib.crc32(f"c{r[0]}".encode()) % 4 == 0 for r in got])
    pick = lambda m: [w for w, k in zip(words, m, strict=True) if k]
    net.train(pick(~back), y[~back])
    calibrate(net, pick(back), y[back])
    learned = picked.filter(F.pmod(F.crc32(F.concat(F.lit("c"), F.col("id").cast("string")).cast("binary")), F.lit(4)) != 0).select("id").distinct()
    rest = known.join(F.broadcast(learned), "id", "left_anti")
    told = score_with(net, rows.join(small_or_plain(rest, n_known, 24), "id"), "id", "text", "lang", ("lang", "y"))
    net.common, net.thresholds = levels(told.select(F.col("kept_lang").alias("lang"), F.col("kept_y").alias("y"), "score"))
    return net


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", keep: tuple[str, ...] = (), sample: int = 2500, sample_bytes: int = 64 << 20) -> DataFrame:
    """(id_col, held_out, score, predicted, threshold, rejected, kept_*), one row for each row of `docs`."""
    net = fit(docs, labels, id_col, text_col, lang_col, sample, sample_bytes)
    return score_with(net, docs, id_col, text_col, lang_col, keep)


def score_with(net: Net, docs: DataFrame, id_col: str, text_col: str, lang_col: str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(net)
    # a text that is kept passes once, not beside itself
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("lang"), *[F.col(quoted(c)).alias(f"keep{i}") for i, c in enumerate(keep) if c != text_col])
    back = [f for f in source.schema if f.name != "text" or text_col in keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("toxicity")
        net = sent.value
        for b in slices(batches):
            scores, held, size = [], [], 0
            for t in b.column(1).to_pylist():
                held.append(hashed(t))
                size += len(held[-1])
                if size > 50_000:  # words at a time
                    scores.append(net.score(held))
                    held, size = [], 0
            if held:
                scores.append(net.score(held))
            cols = [b.column(b.schema.get_field_index(f.name)) for f in back]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.concatenate(scores) if scores else np.zeros(0))], [f.name for f in schema])

    schema = T.StructType([*back, T.StructField("score", T.DoubleType())])
    scored = source.mapInArrow(run, schema)
    threshold = F.lit(net.common)
    for lang, t in net.thresholds.items():
        threshold = F.when(F.col("lang") == lang, F.lit(t)).otherwise(threshold)
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        threshold.alias("threshold"),
        (F.col("score") >= threshold).alias("rejected"),
        *[F.col("text" if c == text_col else f"keep{i}").alias(f"kept_{c}") for i, c in enumerate(keep)],
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
