"""Perplexities of word trigrams, modified Kneser-Ney, in rounds over classes of the middle word.

A trigram's count, its context's total, the continuation counts of the bigram that ends it and that bigram's total all belong
to trigrams with one middle word. So texts are read once for each of `ROUNDS` classes of middle words; the class's trigrams
of all texts are dealt by middle word, in compressed blocks, to tasks that count those of trusted texts and give each text's
sums back. What a round holds on disk is its share of the trigrams, whatever the corpus; the last rounds' files are gone by then.

Across middle words go only the continuation counts of single words and the discounts' counts of counts, from a pass over
the trusted texts before. Words' counts are sent around in parts of at most 64 MB; of more parts, each has rounds of its own
that score the trigrams which end in its words.

A task holds the distinct trusted trigrams of its middle words and streams all else past them. A middle word with more trusted
occurrences than `HEAVY` and half a bucket is dealt by the word before it, too; the continuation counts of its bigrams are then
added up over its buckets by a join-free aggregate and sent to each of them.
"""

from __future__ import annotations

import gc
import math
import re
import time
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import BROADCAST_BYTES, alone, checkpoint, quoted, slices

BEGIN, END = 2, 3
#: Readings of all texts; trusted trigrams of a bucket that a task should hold; least trusted occurrences of a word that is split.
ROUNDS, HELD, HEAVY = 6, 1_000_000, 250_000
#: Trigrams that are gathered before they are dealt into blocks.
CHUNK = 1_000_000
#: Log-probabilities are whole numbers of this, so their sums don't depend on the order.
STEP = 2.0**-30
#: Kinds of blocks, in the order a task needs them.
BIGRAMS, LEARN, SCORE = 0, 1, 2
BLOCKS = "bucket int, kind int, n int, rows int, data binary"

SINGLE = r"぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
WINDOW = 1 << 16
FACTOR = 0x9E3779B97F4A7C15
U32, HALF = np.uint64(32), np.uint64(0xFFFFFFFF)


@cache
def classes() -> np.ndarray:
    """Of each code point: 0 blank, 1 part of a word, 2 a unit of its own."""
    out = np.full(0x110000, 2, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for pattern, kind in ((r"\s+", 0), (rf"[^\W{SINGLE}]+", 1)):
        for m in re.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a factor and of its inverse, modulo 2^64."""
    out = []
    for base in (FACTOR, pow(FACTOR, -1, 1 << 64)):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit hashes of the units of all texts, and how many units each text has."""
    cp = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[cp]
    begins = kind > 0
    begins[1:] &= (kind[1:] == 2) | (kind[:-1] != 1)
    at = np.flatnonzero(begins)
    out, i = np.empty(len(at), np.uint32), 0
    while i < len(at):
        a = at[i]
        j = len(at) if len(cp) <= a + WINDOW else max(i + 1, int(np.searchsorted(at, a + WINDOW, "right")) - 1)
        b = at[j] if j < len(at) else len(cp)
        x = (cp[a:b].astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x[kind[a:b] == 0] = 0
        up, down = powers(WINDOW) if b - a <= WINDOW else powers.__wrapped__(int(b - a))
        x *= up[: b - a]
        h = np.add.reduceat(x, at[i:j] - a) * down[at[i:j] - a]
        h ^= h >> U32
        h *= np.uint64(0x94D049BB133111EB)
        out[i:j] = h >> U32
        i = j
    ends = np.cumsum([len(t) + 1 for t in texts])
    return out, np.diff(np.searchsorted(at, ends), prepend=0)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(3, n): the words of each trigram, with two begin marks and an end mark a text; and the number of its text."""
    found, n = hashes(texts)
    first = np.concatenate([[0], np.cumsum(n + 3)[:-1]]).astype(np.int64)
    c = np.empty(int((n + 3).sum()), np.uint32)
    own = np.ones(len(c), bool)
    c[first] = c[first + 1] = BEGIN
    c[first + n + 2] = END
    own[first] = own[first + 1] = own[first + n + 2] = False
    c[own] = found
    whole = np.ones(len(c) - 2, bool)
    whole[(first + n + 1)[:-1]] = whole[(first + n + 2)[:-1]] = False
    return np.stack([c[:-2][whole], c[1:-1][whole], c[2:][whole]]), np.repeat(np.arange(len(n)), n + 1)


def share(x: np.ndarray, parts: int, salt: int) -> np.ndarray:
    """Which of so many equal shares of all numbers of 64 bits it falls into."""
    h = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(FACTOR)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (((h >> U32) * np.uint64(parts)) >> U32).astype(np.int64)


class Deal:
    """Which round and which buckets a middle word is in. heavy: (words ascending, into how many each is split)."""

    def __init__(self, rounds: int, buckets: int, words: np.ndarray, splits: np.ndarray):
        self.rounds, self.buckets, self.words, self.splits = rounds, buckets, words, splits

    def of_round(self, v: np.ndarray) -> np.ndarray:
        return share(v, self.rounds, 1)

    def split(self, v: np.ndarray) -> np.ndarray:
        """Into how many a word is split; 1 for most."""
        if not len(self.words):
            return np.ones(len(v), np.int64)
        at = np.minimum(np.searchsorted(self.words, v), len(self.words) - 1)
        return np.where(self.words[at] == v, self.splits[at], 1)

    def bucket(self, v: np.ndarray, part: np.ndarray) -> np.ndarray:
        return share(v.astype(np.uint64) | part.astype(np.uint64) << U32, self.buckets, 2)

    def buckets_of(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        part, split = np.zeros(len(v), np.int64), self.split(v)
        many = split > 1
        part[many] = share(u[many], 1 << 30, 3) % split[many]
        return self.bucket(v, part)


def blocks(bucket: np.ndarray, kind: int, columns: list[np.ndarray], rows: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The columns of each bucket in one compressed block; rows: each one's row, as runs of equal ones."""
    if not len(bucket):
        return
    bucket = bucket.astype(np.uint16 if bucket.max() < 1 << 16 else np.int64)  # short ones are sorted by counting
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    rows = rows[order] if rows is not None else None
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    out: list[tuple] = []
    for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        parts, n = [c[a:b] for c in columns], 0
        if rows is not None:
            run = np.flatnonzero(np.diff(rows[a:b], prepend=rows[a] - 1))
            parts, n = [rows[a:b][run], np.diff(run, append=b - a).astype(np.int32), *parts], len(run)
        out.append((int(bucket[a]), kind, int(b - a), n, pa.compress(b"".join(p.tobytes() for p in parts), codec="zstd", asbytes=True)))
    for at in range(0, len(out), 64):
        some = list(zip(*out[at : at + 64], strict=True))
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in some[:4]), pa.array(some[4], pa.binary())], ["bucket", "kind", "n", "rows", "data"])


def opened(n: int, rows: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(rows of each trigram, (3, n) words) of a block."""
    raw = pa.decompress(data, decompressed_size=12 * (n + rows), codec="zstd", asbytes=True)
    ids = np.repeat(np.frombuffer(raw, np.int64, rows), np.frombuffer(raw, np.int32, rows, 8 * rows))
    return ids, np.frombuffer(raw, np.uint32, 3 * n, 12 * rows).reshape(3, n)


def dealt(docs: DataFrame, deal: Deal, k: int, score: bool, part: int = 0, parts: int = 1) -> DataFrame:
    """The blocks of round k: trusted trigrams to be counted and, with `score`, those to be scored that end in words of the part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("quality")
        wait: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if wait:
                g, rows, learn = (np.concatenate(x, axis=-1) for x in zip(*wait, strict=True))
                to = deal.buckets_of(g[0], g[1])
                yield from blocks(to[learn], LEARN, list(g[:, learn]))
                if score:
                    here = g[2] % np.uint32(parts) == part
                    yield from blocks(to[here], SCORE, list(g[:, here]), rows[here])

        for b in slices(batches, 64):
            g, at = trigrams([t or "" for t in b["text"].to_pylist()])
            here = deal.of_round(g[1]) == k
            at = at[here]
            wait.append((g[:, here], b["row"].to_numpy()[at], b["learn"].to_numpy(zero_copy_only=False)[at]))
            size += len(at)
            if size > CHUNK:
                yield from flush()
                wait, size = [], 0
        yield from flush()

    return docs.select("row", "learn", "text").mapInArrow(run, BLOCKS)


def spread(found: DataFrame, deal: Deal) -> DataFrame:
    return found.repartitionById(deal.buckets, F.col("bucket")).sortWithinPartitions("bucket", "kind")


class Model:
    """The counts of a bucket's trusted trigrams, from their blocks."""

    def __init__(self) -> None:
        self.keys, self.counts, self.waiting, self.bigrams = [], [], 0, []

    def add(self, g: np.ndarray) -> None:
        order = np.lexsort((g[2], g[0], g[1]))
        self.merge([(g[:, order], np.ones(g.shape[1], np.int64))])
        self.waiting += self.counts[-1].size
        if self.waiting > 2 * CHUNK:
            self.settle()

    def merge(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        g, n = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
        if len(parts) > 1:
            order = np.lexsort((g[2], g[0], g[1]))
            g, n = g[:, order], n[order]
        if len(n):
            at = np.flatnonzero(np.concatenate([[True], (g[:, 1:] != g[:, :-1]).any(0)]))
            self.keys.append(g[:, at])
            self.counts.append(np.add.reduceat(n, at))

    def settle(self) -> None:
        """One table, ascending by middle, first and last word."""
        parts = list(zip(self.keys, self.counts, strict=True))
        if len(parts) != 1:
            self.keys, self.counts = [], []
            self.merge(parts or [(np.zeros((3, 0), np.uint32), np.zeros(0, np.int64))])
            if not self.keys:
                self.keys, self.counts = [np.zeros((3, 0), np.uint32)], [np.zeros(0, np.int64)]
        self.waiting = -len(self.counts[0])  # grows anew by as much as it holds, and more

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The trigrams and counts, and the bigrams that end them with their numbers of different first words."""
        self.settle()
        g = self.keys[0]
        pair, c = np.unique(g[1].astype(np.uint64) << U32 | g[2], return_counts=True)
        return g, self.counts[0], pair, c


def look(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys are in an ascending table, and whether they are."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def less(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


class Scorer:
    """The probabilities of a bucket's trigrams."""

    def __init__(self, model: Model, deal: Deal, d2: tuple, d3: tuple):
        g, self.c3, pair, c2 = model.tables()
        before = g[0].astype(np.uint64) | g[1].astype(np.uint64) << U32
        new = np.concatenate([[True], before[1:] != before[:-1]]) if len(before) else np.zeros(0, bool)
        self.before, place = before[new], np.cumsum(new) - 1
        self.tri = place.astype(np.uint64) << U32 | g[2]
        self.take3 = np.maximum(self.c3 - less(self.c3, d3), 0)
        self.total3 = np.bincount(place, self.c3, len(self.before))
        self.spare3 = np.bincount(place, less(self.c3, d3), len(self.before))
        if model.bigrams:  # of split words, from all their buckets
            whole = deal.split((pair >> U32).astype(np.uint32)) == 1
            keys, counts = (np.concatenate(x) for x in zip(*model.bigrams, strict=True))
            pair, c2 = np.concatenate([pair[whole], keys]), np.concatenate([c2[whole], counts])
            pair, at = np.unique(pair, return_index=True)
            c2 = c2[at]
        v = pair >> U32
        new = np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)
        self.middle, place, self.pair = v[new], np.cumsum(new) - 1, pair
        self.take2 = np.maximum(c2 - less(c2, d2), 0)
        self.total2 = np.bincount(place, c2, len(self.middle))
        self.spare2 = np.bincount(place, less(c2, d2), len(self.middle))

    @staticmethod
    def mixed(lower: np.ndarray, context: tuple, known: tuple, take: np.ndarray, total: np.ndarray, spare: np.ndarray) -> np.ndarray:
        (at, there), (own, seen) = context, known
        if not len(total):
            return lower
        top = np.where(seen, take[own], 0.0) if len(take) else 0.0
        return np.where(there, (top + spare[at] * lower) / total[at], lower)

    def log(self, g: np.ndarray, p1: np.ndarray) -> np.ndarray:
        u, v, w = g.astype(np.uint64)
        p2 = self.mixed(p1, look(self.middle, v), look(self.pair, v << U32 | w), self.take2, self.total2, self.spare2)
        at, there = look(self.before, u | v << U32)
        own, seen = look(self.tri, at.astype(np.uint64) << U32 | w)
        return np.log(self.mixed(p2, (at, there), (own, seen & there), self.take3, self.total3, self.spare3))


def counts_of(docs: DataFrame, deal: Deal, k: int) -> DataFrame:
    """(kind, v, w, n) of a round's trusted trigrams: counts of counts (v is the count) of orders 3 and 2, words' different
    words before (1), and for words that are split, bigrams' different words before (0)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("quality")

        def told(model: Model) -> Iterator[pa.RecordBatch]:
            _, c3, pair, c2 = model.tables()
            split = deal.split((pair >> U32).astype(np.uint32)) > 1
            word, n = np.unique((pair & HALF)[~split], return_counts=True)
            few = [np.bincount(np.minimum(c, 5), minlength=6)[1:5] for c in (c3, c2[~split])]
            four = np.arange(1, 5)
            kind = np.repeat([3, 2, 1, 0], [4, 4, len(word), split.sum()])
            v = np.concatenate([four, four, np.zeros(len(word), np.int64), (pair >> U32)[split].astype(np.int64)])
            w = np.concatenate([np.zeros(8, np.int64), word.astype(np.int64), (pair & HALF)[split].astype(np.int64)])
            n = np.concatenate([*few, n, c2[split]]).astype(np.int64)
            for at in range(0, len(kind), 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(kind[some], pa.int32()), pa.array(v[some]), pa.array(w[some]), pa.array(n[some])], ["kind", "v", "w", "n"])

        bucket, model = None, Model()
        for b in batches:
            for r in b.to_pylist():
                if bucket not in (None, r["bucket"]):
                    yield from told(model)
                    model = Model()
                bucket = r["bucket"]
                model.add(opened(r["n"], r["rows"], r["data"])[1])
        if bucket is not None:
            yield from told(model)

    return spread(dealt(docs.filter("learn"), deal, k, False), deal).mapInArrow(run, "kind int, v long, w long, n long")


def sent(bigrams: DataFrame, deal: Deal, k: int) -> DataFrame:
    """Blocks with the counts of split words' bigrams for each bucket of theirs in the round."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, w, n = (b[c].to_numpy() for c in ("v", "w", "n"))
            here = deal.of_round(v) == k
            v, w, n = v[here], w[here], n[here]
            split = deal.split(v.astype(np.uint32))
            each = np.repeat(np.arange(len(v)), split)
            part = np.arange(len(each)) - np.repeat(np.cumsum(split) - split, split)
            to = deal.bucket(v[each], part)
            yield from blocks(to, BIGRAMS, [x[each].astype(np.uint32) for x in (v, w, n)])

    return bigrams.select("v", "w", "n").mapInArrow(run, BLOCKS)


def sums(found: DataFrame, deal: Deal, words, d1: tuple, d2: tuple, d3: tuple, total: int, floor: float) -> DataFrame:
    """(row, n, sum): how many trigrams a text has in a bucket and the sum of their log-probabilities, in STEPs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("quality")
        bucket, model, scorer = None, Model(), None
        wait: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            if wait:
                row, log = (np.concatenate(x) for x in zip(*wait, strict=True))
                order = np.argsort(row, kind="stable")
                row, log = row[order], log[order]
                at = np.flatnonzero(np.diff(row, prepend=row[0] - 1))
                n, s, row = np.diff(at, append=len(row)).astype(np.int64), np.add.reduceat(log, at), row[at]
                for i in range(0, len(row), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000]) for x in (row, n, s)], ["row", "n", "sum"])

        for b in batches:
            for r in b.to_pylist():
                if r["bucket"] != bucket:
                    bucket, model, scorer = r["bucket"], Model(), None
                rows, g = opened(r["n"], r["rows"], r["data"])
                if r["kind"] == BIGRAMS:
                    model.bigrams.append((g[0].astype(np.uint64) << U32 | g[1], g[2].astype(np.int64)))
                elif r["kind"] == LEARN:
                    model.add(g)
                else:
                    scorer = scorer or Scorer(model, deal, d2, d3)
                    own, c = words.value
                    at, there = look(own, g[2])
                    c = np.where(there, c[at], 0).astype(np.int64) if len(c) else np.zeros(len(at), np.int64)
                    p1 = (c - less(c, d1) + floor) / (total or 1)
                    wait.append((rows, np.rint(scorer.log(g, p1) / STEP).astype(np.int64)))
                    size += len(rows)
                    if size > CHUNK:
                        yield from out()
                        wait, size = [], 0
        yield from out()

    return spread(found, deal).mapInArrow(run, "row long, n long, sum long").groupBy("row").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(v, n): middle words of trusted texts that make up more than a 16384th of some task's, and how often they were there; v is
    null for all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("quality")
        wait: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(wait), return_counts=True)
            often = n > size / 16384
            return pa.RecordBatch.from_arrays([pa.array([*found[often].tolist(), None], pa.int64()), pa.array([*n[often].tolist(), size], pa.int64())], ["v", "n"])

        for b in slices(batches, 64):
            wait.append(hashes([t or "" for t in b["text"].to_pylist()])[0])
            wait.append(np.full(b.num_rows, BEGIN, np.uint32))
            size += len(wait[-2]) + b.num_rows
            if size > 4 * CHUNK:
                yield out()
                wait, size = [], 0
        if size:
            yield out()

    return docs.filter("learn").select("text").mapInArrow(run, "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))


def placed(docs: DataFrame, row: str) -> DataFrame:
    """The rows with a number each that every scan finds again: their file's and their place in it.

    A table that isn't read from files, or has several rows for one of a file, is written to the checkpoint folder first.
    """
    key = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        if not docs.select(*key).groupBy("file_path", "row_index").count().filter("count > 1").isEmpty():
            return checkpoint(docs).withColumn(row, F.monotonically_increasing_id())
        files = sorted(r[0] for r in docs.select(F.col("_metadata.file_path")).distinct().collect())
        rows = docs.select("*", F.col("_metadata.file_path").alias("file of the row"), F.col("_metadata.row_index").alias("place of the row"))
    except AnalysisException:  # no files
        return checkpoint(docs).withColumn(row, F.monotonically_increasing_id())
    numbers = docs.sparkSession.createDataFrame([(f, k << 40) for k, f in enumerate(files)], "`file of the row` string, first long")
    rows = rows.join(F.broadcast(numbers), "file of the row")
    return rows.select(*[F.col(quoted(c)) for c in docs.columns], (F.col("first") + F.col("place of the row")).alias(row))


def deal_of(counts: DataFrame, rounds: int) -> Deal:
    found = [(r[0], r[1]) for r in counts.filter(F.col("v").isNull() | (F.col("n") > HEAVY)).collect()]
    size = sum(n for v, n in found if v is None)
    buckets = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / rounds / HELD))
    most = max(HEAVY, size / (2 * rounds * buckets))
    heavy = sorted((v, math.ceil(n / most)) for v, n in found if v is not None and n > most)
    return Deal(rounds, buckets, np.array([h[0] for h in heavy], np.uint32), np.array([h[1] for h in heavy], np.int64))


def settled(spark: SparkSession) -> None:
    """Let go of the shuffle files of a round that is over, before the next one writes its own.

    Spark's threads hold on to the last query they ran, so they get a small one; Python tells the JVM what it has dropped in a
    thread of its own, every second.
    """
    spark.range(1).repartition(1).collect()
    gc.collect()
    time.sleep(1.5)
    spark._jvm.System.gc()


def losses(source: DataFrame, counts: DataFrame, trusted: float, discounts, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(row, units, loss) of `source` (row, learn, text): the mean negative log-probability of each text.

    counts: what `word_counts` found; trusted: the part of the texts that is counted; discounts: from counts of counts.
    """
    spark, counts = source.sparkSession, checkpoint(counts)
    deal, told = deal_of(counts, max(1, math.ceil(ROUNDS * trusted))), None
    for k in range(deal.rounds):
        found = checkpoint(counts_of(source, deal, k).groupBy("kind", "v", "w").agg(F.sum("n").alias("n")))
        told = found if told is None else told.unionAll(found)
        found = None
        settled(spark)
    whole, deal = deal, deal_of(counts, ROUNDS)
    deal = Deal(ROUNDS, deal.buckets, whole.words, whole.splits)
    told = checkpoint(told.groupBy("kind", "v", "w").agg(F.sum("n").alias("n")))
    bigrams = checkpoint(told.filter("kind = 0").select("v", "w", "n"))
    words = told.filter("kind = 1").select("w", "n").unionAll(bigrams.groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    words = checkpoint(words.groupBy("w").agg(F.sum("n").alias("n")))
    few = lambda df: {int(r[0]): int(r[1]) for r in df.filter("n between 1 and 4").groupBy("n").count().collect()}
    at = {(r[0], r[1]): r[2] for r in told.filter("kind >= 2").select("kind", "v", "n").collect()}
    more = few(bigrams)
    d3 = discounts({c: at.get((3, c), 0) for c in range(1, 5)})
    d2 = discounts({c: at.get((2, c), 0) + more.get(c, 0) for c in range(1, 5)})
    d1 = discounts(few(words))
    taken = F.when(F.col("n") == 1, d1[0]).when(F.col("n") == 2, d1[1]).otherwise(d1[2])
    total, spare, kinds = words.agg(F.sum("n"), F.sum(taken), F.count(F.lit(1))).first()
    floor = (spare or 1.0) / (kinds + 1) if total else 1 / 65536
    told, split = None, bool(len(deal.words))
    parts = max(1, math.ceil(kinds * 8 / limit))
    out = None
    for part in range(parts):
        table = words.filter(F.col("w") % parts == part).toArrow()
        own, c = table["w"].to_numpy().astype(np.uint32), np.minimum(table["n"].to_numpy(), (1 << 32) - 1).astype(np.uint32)
        order = np.argsort(own)
        shared = spark.sparkContext.broadcast((own[order], c[order]))
        words = None if part == parts - 1 else words
        settled(spark)
        for k in range(deal.rounds):
            found = dealt(source, deal, k, True, part, parts)
            found = found.unionAll(sent(bigrams, deal, k)) if split else found
            got = checkpoint(sums(found, deal, shared, d1, d2, d3, total or 0, floor))
            out = got if out is None else out.unionAll(got)
            found = None
            settled(spark)
        shared.unpersist()
    out = out.groupBy("row").agg(F.sum("n").alias("n"), (F.sum("sum") * F.lit(-STEP)).alias("sum"))
    return out.select("row", (F.col("n") - 1).alias("units"), (F.col("sum") / F.col("n")).alias("loss"))
