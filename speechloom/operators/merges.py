"""Byte-pair merges over the codec alphabet: parameters, initial alphabet, training, application."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.alphabet import Alphabet
from ..session import remove, scratch_folder


@dataclass(frozen=True)
class MergePlan:
    alphabet: Alphabet = field(default_factory=Alphabet)
    vocab_size: int = 20_000
    max_ngrams: int | None = None
    chunk_seconds: int | None = None
    framerate: float | None = None
    special: tuple[str, ...] = ("<pad>", "<eos>")
    min_frequency: int = 2

    def __post_init__(self) -> None:
        a = self.alphabet
        if self.chunk_seconds is not None and (self.framerate is None or self.chunk_seconds < 1):
            raise ValueError("chunks need a frame rate and at least a second")
        if not self.special:
            raise ValueError("a pad or end token is needed")
        if self.max_ngrams is not None and self.max_ngrams < 0:
            raise ValueError("max_ngrams is negative")
        if self.vocab_size < a.codebooks * a.size + len(self.special):
            raise ValueError("the vocabulary doesn't hold the alphabet and the special tokens")

    @property
    def max_token_length(self) -> int | None:
        """In characters; 1 means that nothing is merged."""
        return None if self.max_ngrams is None else max(1, self.max_ngrams * self.alphabet.codebooks)

    @property
    def chunk_frames(self) -> int | None:
        return None if self.chunk_seconds is None else int(self.chunk_seconds * self.framerate)

    @property
    def merges(self) -> int:
        return self.vocab_size - self.alphabet.codebooks * self.alphabet.size - len(self.special)


def initial_alphabet(alphabet: Alphabet = Alphabet()) -> list[str]:
    return [chr(alphabet.offset + k) for k in range(alphabet.codebooks * alphabet.size)]


def joined(tokens: list[str], pairs: set[tuple[str, str]]) -> list[str]:
    """One pass from left to right that joins these pairs, no two of which share a token."""
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in pairs:
            out.append(tokens[i] + tokens[i + 1])
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def independent(ranked: list[tuple[str, str, int]], made: set[str], whole: bool) -> list[tuple[str, str]]:
    """Of the pairs in order, most frequent first, the leading ones that one round can merge with the result of one round each.

    They share no token, so merging one changes the count of no other. A pair with a new token occurs at most as often as
    the old pair it comes from, which shares a token with a merged one; so only pairs that occur more often than the first
    that shares a token are taken, or than the last of the list if there are more (`whole` is false). A pair of equal
    tokens, or one that makes a token there is already, is merged alone, as the pairs it brings have no such bound.
    """
    taken, used, bound, made = [], set(), 0 if whole else ranked[-1][2], set(made)
    for a, b, n in ranked:
        loose = a == b or a + b in made
        if loose and not taken:
            return [(a, b)]
        if loose or a in used or b in used:
            bound = max(bound, n)
            break
        taken.append((a, b, n))
        used |= {a, b}
        made.add(a + b)
    return [(a, b) for k, (a, b, n) in enumerate(taken) if not k or n > bound]


def pairs(tokens: list[str], limit: int | None) -> Iterator[tuple[str, str]]:
    return (p for p in zip(tokens, tokens[1:], strict=False) if limit is None or len(p[0]) + len(p[1]) <= limit)


def rewriter(found: set[tuple[str, str]] | None, limit: int | None):
    """Strings with these pairs joined, and how often each pair now occurs more or less; without pairs, how often each occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ends, a, b, n = [], [0], [], [], []
            for old, w in zip(batch["tokens"].to_pylist(), batch["w"].to_pylist(), strict=True):
                new = joined(old, found) if found else old
                rows.append(new)
                if found is None or len(new) < len(old):
                    change = Counter(pairs(new, limit))
                    if found is not None:
                        change.subtract(pairs(old, limit))
                    for (first, second), k in change.items():
                        if k:
                            a.append(first)
                            b.append(second)
                            n.append(k * w)
                ends.append(len(n))
            flat = pa.StructArray.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["a", "b", "n"])
            changes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch["part"], pa.array(rows, pa.list_(pa.string())), batch["w"], changes], ["part", "tokens", "w", "changes"])

    return run


STRINGS = "part int, tokens array<string>, w long, changes array<struct<a:string,b:string,n:long>>"


class Work(NamedTuple):
    """What a round of training did: its merges, and the buckets and strings it read to apply them."""

    merges: int
    buckets: int
    strings: int


class Buckets:
    """The strings of a training in tables of one folder, rewritten bucket by bucket, with what tells which to rewrite.

    strings/round/part: the tokens of a bucket since the last round that changed it, and the changes of its pairs' counts.
    index/round: (a, b, part), the buckets in which a round made a pair. A pair first comes where one of its two tokens is
    made, so it is found in the index of the rounds that made either. It may have gone from a bucket since; that costs a
    read. counts/round: how often each pair occurs, the last round's with the changes.
    The driver holds a bucket's last round and number of strings, two numbers for each file of strings.
    """

    def __init__(self, strings: DataFrame, column: str, limit: int | None, size: int):
        self.spark, self.limit, self.round = strings.sparkSession, limit, 0
        self.folder = scratch_folder(self.spark, "merges")
        self.made: dict[str, list[int]] = {}
        weighted = strings.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("s")).agg(F.count(F.lit(1)).alias("w"))
        weighted.write.parquet(f"{self.folder}/weighted")
        weighted = self.spark.read.parquet(f"{self.folder}/weighted")
        self.parts = max(1, -(-weighted.count() // size))
        dealt = weighted.withColumn("part", F.pmod(F.xxhash64("s"), F.lit(self.parts)).cast("int")).repartition("part")
        self.write(dealt.select("part", F.split("s", "").alias("tokens"), "w"), None)
        remove(self.spark, f"{self.folder}/weighted")
        self.strings = {r["part"]: r["count"] for r in self.written().groupBy("part").count().collect()}
        self.at = dict.fromkeys(self.strings, 0)

    def written(self) -> DataFrame:
        return self.spark.read.schema(STRINGS).parquet(f"{self.folder}/strings/round={self.round}")

    def write(self, rows: DataFrame, found: set[tuple[str, str]] | None) -> None:
        """The tables of this round: strings first, then what their changes add to the index and the counts."""
        rows.mapInArrow(rewriter(found, self.limit), STRINGS).write.partitionBy("part").parquet(f"{self.folder}/strings/round={self.round}")
        change = self.written().select("part", F.inline("changes"))
        if self.parts > 1:  # one bucket needs no index
            new = change.filter("n > 0").select("a", "b", "part").distinct()
            new.sortWithinPartitions("a", "b").write.parquet(f"{self.folder}/index/round={self.round}")
        if self.round:
            change = change.select("a", "b", "n").unionByName(self.counts(self.round - 1))
        change.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 0").write.parquet(f"{self.folder}/counts/round={self.round}")
        if self.round:
            remove(self.spark, f"{self.folder}/counts/round={self.round - 1}")

    def counts(self, number: int) -> DataFrame:
        return self.spark.read.schema("a string, b string, n long").parquet(f"{self.folder}/counts/round={number}")

    def ranked(self, least: int, most: int) -> list[tuple[str, str, int]]:
        rows = self.counts(self.round).filter(F.col("n") >= least).orderBy(F.desc("n"), "a", "b").limit(most)
        return [(r["a"], r["b"], r["n"]) for r in rows.collect()]

    def holding(self, found: list[tuple[str, str]]) -> list[int]:
        """The buckets in which one of the pairs has come up."""
        if self.parts == 1:
            return list(self.at)
        rounds = {k for p in found for t in p for k in self.made.get(t, [0])}
        index = self.spark.read.schema("a string, b string, part int").parquet(*[f"{self.folder}/index/round={k}" for k in sorted(rounds)])
        wanted = self.spark.createDataFrame(found, "a string, b string")
        return [r["part"] for r in index.join(F.broadcast(wanted), ["a", "b"], "left_semi").select("part").distinct().collect()]

    def merge(self, found: list[tuple[str, str]]) -> Work:
        """Join these pairs in the buckets that hold them; tables that are replaced are deleted."""
        parts = self.holding(found)
        self.round += 1
        for a, b in found:
            self.made.setdefault(a + b, []).append(self.round)
        base = f"{self.folder}/strings"
        old = {p: f"{base}/round={self.at[p]}/part={p}" for p in parts}
        rows = self.spark.read.schema("round int, " + STRINGS).option("basePath", base).parquet(*old.values())
        self.write(rows.select("part", "tokens", "w"), set(found))
        left = {k for p, k in self.at.items() if p not in old}
        for k in {self.at[p] for p in parts} - left:
            remove(self.spark, f"{base}/round={k}")
        for p, path in old.items():
            if self.at[p] in left:
                remove(self.spark, path)
            self.at[p] = self.round
        return Work(len(found), len(parts), sum(self.strings[p] for p in parts))

    def close(self) -> None:
        remove(self.spark, self.folder)


def train(
    strings: DataFrame,
    column: str,
    plan: MergePlan,
    rounds: int | None = None,
    at_once: int = 1000,
    bucket: int = 10_000,
    report: Callable[[Work], None] | None = None,
) -> list[tuple[str, str]]:
    """The merges in order: always the most frequent pair of neighbouring tokens, the first in order of text among equals.

    Pairs are counted once; a round merges all that are independent() and changes the counts by what it did. An index from
    pairs to buckets of about `bucket` distinct strings tells which to rewrite, so late rounds, whose pairs are rare, read
    few strings; `report` gets what each read. Only the `at_once` most frequent pairs reach the driver. Tables are in the
    checkpoint folder, one row for equal strings, and deleted at the end. `rounds` bounds the merges. Null strings are
    left out.
    """
    limit, learned = plan.max_token_length, []
    most = plan.merges if rounds is None else min(rounds, plan.merges)
    if limit == 1 or most <= 0:
        return learned
    state, made = Buckets(strings, column, limit, bucket), set()
    try:
        while len(learned) < most:
            ranked = state.ranked(plan.min_frequency, at_once)
            if not ranked:
                break
            found = independent(ranked, made, len(ranked) < at_once)[: most - len(learned)]
            learned += found
            made |= {a + b for a, b in found}
            if len(learned) < most:
                work = state.merge(found)
                if report:
                    report(work)
    finally:
        state.close()
    return learned


def apply(text: str, merges: list[tuple[str, str]]) -> list[str]:
    """The tokens of a text: merges in their order, each once from left to right; those without an effect are passed over."""
    places: dict[tuple[str, str], list[int]] = {}
    for k, p in enumerate(merges):
        places.setdefault(p, []).append(k)
    tokens, first = list(text), 0
    while True:
        waiting = [at[k] for p in set(zip(tokens, tokens[1:], strict=False)) if (at := places.get(p)) and (k := bisect_left(at, first)) < len(at)]
        if not waiting:
            return tokens
        first = min(waiting) + 1
        tokens = joined(tokens, {merges[first - 1]})


class Encoder:
    """`apply` for many texts, as ids: a linked list of tokens and a heap of (merge, place), so a text of n characters takes
    about n log n steps, however many merges there are."""

    def __init__(self, merges: list[tuple[str, str]], ids: dict[str, int]):
        self.ids = ids
        self.places: dict[tuple[str, str], list[int]] = {}
        for k, p in enumerate(merges):
            self.places.setdefault(p, []).append(k)

    def tokens(self, text: str) -> list[str]:
        token, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, str, str]] = []

        def wait(k: int, first: int) -> None:
            """The pair that begins at place k, by the first of its merges from `first` on."""
            if k >= 0 and after[k] < n:
                at = self.places.get((token[k], token[after[k]]))
                if at and (m := bisect_left(at, first)) < len(at):
                    heappush(heap, (at[m], k, token[k], token[after[k]]))

        for k in range(n - 1):
            wait(k, 0)
        while heap:
            merge, k, a, b = heappop(heap)
            if token[k] != a or after[k] >= n or token[after[k]] != b:
                continue  # one of them has been merged since
            gone = after[k]
            token[k], token[gone], after[k] = a + b, "", after[gone]
            if after[k] < n:
                before[after[k]] = k
            wait(before[k], merge + 1)
            wait(k, merge + 1)
        return [t for t in token if t]

    def encode(self, text: str) -> list[int]:
        return [self.ids.get(t, -1) for t in self.tokens(text)]


def vocabulary(plan: MergePlan, merges: list[tuple[str, str]]) -> dict[str, int]:
    """Ids: the special tokens, the alphabet, then what merges make, in their order; a token that is made twice has one id."""
    tokens = dict.fromkeys([*plan.special, *initial_alphabet(plan.alphabet), *(a + b for a, b in merges)])
    return {t: k for k, t in enumerate(tokens)}


#: Merges that a broadcast may hold; each takes about this many bytes in a worker.
MOST_MERGES, BYTES_EACH = 1_000_000, 400


def encoded(df: DataFrame, column: str, merges: list[tuple[str, str]], plan: MergePlan, name: str = "ids") -> DataFrame:
    """The rows with `name`, the ids of the text's tokens by the trained merges, -1 for a character outside the alphabet.

    Null texts have null ids. The merges go to every task once; how many there may be bounds their size.
    """
    if len(merges) > MOST_MERGES:
        raise ValueError(f"{len(merges)} merges would take {len(merges) * BYTES_EACH >> 20} MB in each worker")
    sent = df.sparkSession.sparkContext.broadcast((merges, vocabulary(plan, merges)))
    place = df.columns.index(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(*sent.value)
        for b in batches:
            found = [None if t is None else own.encode(t) for t in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int32()))], [*b.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(name, T.ArrayType(T.IntegerType()))]))
