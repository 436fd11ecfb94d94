"""Quality by the perplexity under an interpolated modified Kneser-Ney model of trusted text.

The query's units are words, hashed to 32 bits, at order 3: what is counted grows with the corpus, and shuffled words or
word salad get poor scores. A word is a run of letters, digits and underscores; other signs but blanks, and each Han or
kana character, are units of their own. With `words` false the units are characters (code points folded to 16 bits) at
order 4. Trusted are documents labelled with quality 1; four fifths of them, by a hash of the id, are counted, the rest
sets the thresholds, so these are not flattered by texts the model has seen.

The formula of order k is p_k = max(c - D(c), 0) / total + gamma * p_(k-1); lower orders count different left neighbours.
Words: `word_trigrams`, in rounds over classes of middle words, which bound what is on disk. Characters: the tables are near
the size of the alphabet's n-grams, so counts, continuation counts and probabilities are aggregates and joins, order by order,
and each document's distinct n-grams are joined with the log-probabilities and summed. Contexts of one unit are broadcast if
they were counted to be few; adaptive execution splits the wanted side of joins with frequent ones.

A document is kept when its mean negative log-probability is at most the `quantile` of its language's trusted, held-back
documents; a language with fewer than `least` of these uses that of all.

Defined results: texts without a unit (null, empty, only blanks for words) have only the end mark and are never kept; a null language uses the common threshold;
without trusted text there is no threshold and everything but texts without a unit is kept; ids labelled more than once are trusted
if any of their labels is 1; rows with a null id are scored and never trusted; every row gives one row; other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import word_trigrams
from ._common import alone, checkpoint, ship, slices, small_or_plain, table

BEGIN, END = 2, 3
ORDER, BITS = 4, 16
CHUNK = 2_000_000


def grams(text: str | None, words: bool) -> np.ndarray:
    """The n-grams of a text with begin marks and an end mark, one for each unit and the end: three words, or a packed number."""
    if words:
        return word_trigrams.trigrams([text or ""])[0].T
    cp = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.empty(len(cp) + ORDER, np.int64)
    c[: ORDER - 1], c[-1] = BEGIN, END
    c[ORDER - 1 : -1] = (cp ^ (cp >> 16)) & 0xFFFF
    out = np.zeros(len(cp) + 1, np.int64)
    for k in range(ORDER):
        out = out << BITS | c[k : k + len(out)]
    return out


class Merged:
    """Counts by n-gram, merged whenever enough has come together."""

    def __init__(self) -> None:
        self.grams, self.counts, self.waiting = [], [], 0

    def add(self, grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        grams, n = np.unique(grams, return_counts=True)
        self.grams.append(grams)
        self.counts.append(n)
        self.waiting += len(grams)
        if self.waiting > 4 * CHUNK:
            self.settle()
            if self.waiting > 2 * CHUNK:  # hardly anything repeats: the shuffle merges the rest
                yield from self.take()

    def settle(self) -> None:
        if len(self.grams) > 1:
            grams, counts = np.concatenate(self.grams), np.concatenate(self.counts)
            grams, inv = np.unique(grams, return_inverse=True)
            self.grams, self.counts = [grams], [np.bincount(inv, counts).astype(np.int64)]
        self.waiting = sum(map(len, self.grams))

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What was gathered, in parts; nothing is left here."""
        self.settle()
        grams, counts, self.grams, self.counts, self.waiting = self.grams, self.counts, [], [], 0
        for g, c in zip(grams, counts, strict=True):
            for at in range(0, len(g), 100_000):
                yield g[at : at + 100_000], c[at : at + 100_000]


def counted(docs: DataFrame, words: bool) -> DataFrame:
    """(gram, c): counts in texts marked `learn`, 0 for those that only other texts hold. Of words, those that may be frequent."""
    if words:
        return word_trigrams.word_counts(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("quality")
        sums = {True: Merged(), False: Merged()}
        wait: dict[bool, list] = {True: [], False: []}
        size = {True: 0, False: 0}

        def batch(kind: bool, g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(g), pa.array(n if kind else np.zeros(len(n), np.int64))], ["gram", "c"])

        def flush(kind: bool) -> Iterator[pa.RecordBatch]:
            if wait[kind]:
                together = np.concatenate(wait[kind])
                wait[kind], size[kind] = [], 0
                for g, n in sums[kind].add(together):
                    yield batch(kind, g, n)

        for b in slices(batches):
            for text, learn in zip(b["text"].to_pylist(), b["learn"].to_pylist(), strict=True):
                g = grams(text, False)
                kind = bool(learn)
                wait[kind].append(g)
                size[kind] += len(g)
                if size[kind] > CHUNK // 2:
                    yield from flush(kind)
        for kind in (True, False):
            yield from flush(kind)
            for g, n in sums[kind].take():
                yield batch(kind, g, n)

    return docs.select("text", "learn").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def low(chars: int) -> Column:
    """The last characters of an n-gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << BITS * chars) - 1))


def context() -> Column:
    """All characters but the last."""
    return F.shiftrightunsigned(F.col("gram"), BITS)


def discounts(found: dict[int, int]) -> tuple[float, float, float]:
    """D1, D2 and D3+ of Chen and Goodman from how many n-grams have counts of 1 to 4; where these are missing, half a count and its like."""
    n = dict.fromkeys((1, 2, 3, 4), 0) | found
    if not n[1] or not n[2]:
        return 0.5, 0.75, 0.9
    y = n[1] / (n[1] + 2 * n[2])
    d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
    return tuple(min(max(x, 0.05), k) for x, k in zip(d, (0.95, 1.9, 2.85), strict=True))  # type: ignore[return-value]


def discounts_of(counts: DataFrame) -> tuple[float, float, float]:
    return discounts({int(r[0]): int(r[1]) for r in counts.filter(F.col("c").between(1, 4)).groupBy("c").count().collect()})


def smoothed(wanted: DataFrame, counts: DataFrame, lower: DataFrame, order: int, few: int | None) -> DataFrame:
    """(key, p) of an order for the wanted n-grams, from the counts of this order and the order below.

    few: how many contexts there are at most, if known. At the top order, `wanted` has its counts already.
    """
    d1, d2, d3 = discounts_of(counts)
    less = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    of = counts.groupBy(context().alias("before")).agg(F.sum("c").alias("total"), F.sum(less).alias("spare"))
    hint = (lambda x: small_or_plain(x, few, 24)) if few is not None else (lambda x: x)
    rows = wanted.withColumn("c", F.expr("nullif(c, 0)")) if order == ORDER else wanted.join(counts, "gram", "left")
    return (
        rows.withColumn("before", context())
        .join(hint(of), "before", "left")
        .withColumn("after", low(order - 1))
        .join(hint(lower.select(F.col("gram").alias("after"), F.col("p").alias("q"))), "after", "left")
        .select("gram", F.when(F.col("total").isNull(), F.col("q")).otherwise((F.coalesce(F.col("c") - less, F.lit(0.0)) + F.col("spare") * F.col("q")) / F.col("total")).alias("p"))
    )


def probabilities(found: DataFrame) -> DataFrame:
    """(gram, log): the natural logarithm of the probability of each n-gram's last character after the others."""
    counts = {ORDER: found.filter("c > 0")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        counts[k] = checkpoint(counts[k + 1].groupBy(low(k).alias("gram")).agg(F.count(F.lit(1)).alias("c")))
    wanted = {ORDER: found}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[k + 1].select(low(k).alias("gram")).distinct()
    d1, d2, d3 = discounts_of(counts[1])
    less = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    total, spare, kinds = counts[1].agg(F.sum("c"), F.sum(less), F.count(F.lit(1))).first()
    floor = (spare or 1.0) / ((kinds or 0) + 1) if total else 1 / 65536
    one = F.coalesce(F.col("c") - less, F.lit(0.0)) + F.lit(float(floor))
    p = checkpoint(wanted[1].join(counts[1], "gram", "left").select("gram", (one / F.lit(float(total or 1))).alias("p")))
    few = p.count() + 1  # the contexts of order 2 are characters too, or the begin mark
    for k in range(2, ORDER + 1):
        p = smoothed(wanted[k], counts[k], p, k, few if k == 2 else None)
        p = checkpoint(p) if k < ORDER else p
    return p.select("gram", F.ln("p").alias("log"))


def scored(rows: DataFrame, logs: DataFrame) -> DataFrame:
    """(row, units, loss): the mean negative log-probability of each text."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("quality")
        for b in slices(batches, 128):
            row, key, count = [], [], []
            for r, text in zip(b["row"].to_pylist(), b["text"].to_pylist(), strict=True):
                g, c = np.unique(grams(text, False), return_counts=True)
                row.append(np.full(len(g), r, np.int64))
                key.append(g)
                count.append(c)
            if row:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (row, key, count)], ["row", "gram", "k"])

    parts = rows.select("row", "text").mapInArrow(spread, "row long, gram long, k long").join(logs, "gram")
    sums = parts.groupBy("row").agg(F.sum("k").alias("n"), (-F.sum(F.col("k") * F.col("log"))).alias("sum"))
    return sums.select("row", (F.col("n") - 1).alias("units"), (F.col("sum") / F.col("n")).alias("loss"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", quantile: float = 0.99, least: int = 50, words: bool = False) -> DataFrame:
    """(id_col, lang, n_chars, perplexity, threshold, kept), one row for each row of `docs`."""
    ship(docs.sparkSession)
    trust = labels.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("good")).filter("good = 1 and id is not null").select("id", F.lit(True).alias("trusted"))
    source = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    source = word_trigrams.placed(source, "row").join(small_or_plain(trust, trust.count(), 16), "id", "left")
    back = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(5)) == 0
    trusted = F.col("trusted").isNotNull()
    source = source.withColumn("learn", trusted & F.coalesce(~back, F.lit(False)))
    rows = checkpoint(source.select("row", "id", "lang", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), "trusted", "learn"))
    found = counted(source, words)
    if words:
        part = rows.agg(F.avg(F.col("learn").cast("double"))).first()[0]
        losses = word_trigrams.losses(source, found, part or 0.0, discounts)
    else:
        losses = scored(source, checkpoint(probabilities(checkpoint(found))))
    out = checkpoint(rows.join(losses, "row"))
    told = out.filter(trusted & back & (F.col("units") > 0))
    cut = F.percentile_approx("loss", F.lit(quantile), F.lit(10_000)).alias("cut")
    common = told.agg(cut).first()[0]
    by = {r[0]: r[2] for r in told.filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), cut).filter(F.col("n") >= least).collect()}
    threshold = F.lit(common).cast("double")
    for lang, t in by.items():  # one for each language
        threshold = F.when(F.col("lang") == lang, F.lit(t)).otherwise(threshold)
    keep = (F.col("units") > 0) & F.coalesce(F.col("loss") <= threshold, F.lit(True))
    return out.select(F.col("id").alias(id_col), "lang", F.col("chars").alias("n_chars"), F.exp("loss").alias("perplexity"), F.exp(threshold).alias("threshold"), keep.alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), words=True)
