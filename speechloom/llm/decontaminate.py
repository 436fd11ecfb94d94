"""Finds windows of benchmark items in documents, by a prefix-filtered set join.

Each window of an item (ten consecutive words; a shorter item is one window) is a set of shingles of up to three words
with their places. Shingles are ordered by rarity, the number of their occurrences in all documents. A document that
holds the window holds all its shingles, so for a containment of 1 the necessary prefix is a single token: the rarest one.
The join meets documents and windows on that token only; the length bound and the position (the window has to begin at
the token's place in the document less its place in the window, and to end within the document) leave few candidates, and
each is verified word by word.

Two passes over the texts: one counts how often each shingle of the benchmark occurs (partial counts in each task, then
a sum by key), one joins. The benchmark's words are counted first, as an index has an entry of some hundred bytes for each,
and it is dealt with in blocks of about `block_words` words, long items in parts that overlap by less than a window. A
block's index is broadcast; with several blocks each block's hits are written down before the next index is made, and a
document's hits are united by its row's key. So what the driver and the workers hold grows neither with the documents nor
with the benchmark.

Defined results: null and empty texts have no words, no hits, and the digest of no items; items without words have no
windows; items with a null id are left out, and rows of one item id are one item; each row of the documents gives one
row, also if ids repeat; other columns are neither read nor returned, but for those in `keep`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import alone, checkpoint, quoted, ship, slices, table

#: A-Z to a-z; every other ASCII character but digits and a-z separates words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit value for each run of k words."""
    out = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
        out ^= out >> np.uint64(29)
    return out


def windows(words: list[bytes], width: int) -> list[list[bytes]]:
    return [words[i : i + width] for i in range(len(words) - width + 1)] if len(words) >= width else [words] if words else []


class Index:
    """The windows of a block of items by their rarest shingle."""

    def __init__(self, items: list[tuple], width: int, k: int, counts: dict[int, int]):
        self.names: list = []
        found: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        number: dict = {}
        for item, text in items:
            if item is None:
                continue
            at = number.setdefault(str(item), len(number))
            for w in windows(words_of(text), width):
                found[tuple(w)].add(at)
        self.names = list(number)
        probes: dict[int, dict[int, list]] = {j: defaultdict(list) for j in range(1, k + 1)}
        for w, owners in found.items():
            size = min(k, len(w))
            keys = shingles(hashes(list(w)), size)
            rarest = min(range(len(keys)), key=lambda i: (counts.get(int(keys[i]), 0), int(keys[i]), i))
            probes[size][int(keys[rarest])].append((rarest, list(w), sorted(owners)))
        self.probes = {j: dict(p) for j, p in probes.items() if p}
        self.keys = {j: np.array(sorted(p), np.uint64) for j, p in self.probes.items()}

    def hits(self, words: list[bytes], h: np.ndarray) -> tuple[np.ndarray | None, set[int]]:
        """(mask of words inside windows or None, items that occur)."""
        mask, items = None, set()
        for j, keys in self.keys.items():
            if len(h) < j:
                continue
            s = shingles(h, j)
            at = np.searchsorted(keys, s)
            at[at == len(keys)] = 0
            for i in np.flatnonzero(keys[at] == s).tolist():
                for place, window, owners in self.probes[j][int(s[i])]:
                    begin = i - place
                    end = begin + len(window)
                    if begin >= 0 and end <= len(words) and words[begin:end] == window:
                        if mask is None:
                            mask = np.zeros(len(words), bool)
                        mask[begin:end] = True
                        items.update(owners)
        return mask, items


def rarity(docs: DataFrame, wanted: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """How often each wanted shingle, of so many words, occurs in all documents."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("decontaminate")
        keys = sent.value
        total = np.zeros(len(keys), np.int64)
        for b in slices(batches):
            parts = []
            for text in b.column(0).to_pylist():
                h = hashes(words_of(text))
                parts.extend(shingles(h, j) for j in sizes if len(h) >= j)
            s = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            at = np.searchsorted(keys, s)
            at[at == len(keys)] = 0
            total += np.bincount(at[keys[at] == s], minlength=len(keys))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["key", "n"])

    if not len(wanted):
        return {}
    rows = docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()  # at most one for each of the benchmark's shingles
    return {int(wanted[r[0]]): int(r[1]) for r in rows}


def parts_of(words: list[bytes], width: int, most: int) -> list[list[bytes]]:
    """Stretches of at most `most` words that have each window of the whole once."""
    if len(words) <= most:
        return [words] if words else []
    return [words[i : i + most] for i in range(0, len(words) - width + 1, most - width + 1)]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_words: int, width: int) -> Iterator[list[tuple]]:
    """(item, words joined by blanks) in blocks of about block_words words; a stretch has an eighth of that at most."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("item is not null")
    most = max(2 * width, block_words // 8)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                parts = parts_of(words_of(text), width, most)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(parts), pa.string()), pa.array([b" ".join(w).decode("utf-8", "surrogatepass") for w in parts], pa.string()), pa.array([len(w) for w in parts], pa.int64())], ["item", "text", "n"])

    parts = checkpoint(items.mapInArrow(run, "item string, text string, n long"))
    n = -(-(parts.agg(F.sum("n")).first()[0] or 0) // block_words) or 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for k in range(n):
        yield [(r[0], r[1]) for r in parts.filter(block == k).select("item", "text").collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 10, k: int = 3, block_words: int = 200_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items_sha256, contaminated, items, spans, *keep), one row for each document.

    items: the item ids, sorted as strings. spans: [begin, end) of words inside windows. keep: columns passed through.
    """
    spark = docs.sparkSession
    ship(spark)
    # a text that is kept passes once, not beside itself
    source = docs.select(*[F.col(quoted(c)).alias(f"keep{i}") for i, c in enumerate(keep) if c != text_col], F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = blocks_of(benchmark, item_col, item_text, block_words, width)
    first = next(blocks)
    rest = next(blocks, None)
    many = rest is not None
    if many:  # hits of a row are united by a key of its own, in the order of the scan that a checkpoint fixes
        source = checkpoint(source.withColumn("row", F.monotonically_increasing_id()))
    head = [f for f in source.schema if f.name != "text" or text_col in keep]
    schema = T.StructType([*head, *T.StructType.fromDDL("n_words long, items array<string>, spans array<array<int>>")])

    def passed(items: list[tuple]) -> DataFrame:
        every = [w for _, text in items for w in windows(words_of(text), width)]
        wanted = np.unique(np.concatenate([np.zeros(0, np.uint64), *(shingles(hashes(w), min(k, len(w))) for w in every)]))
        sizes = sorted({min(k, len(w)) for w in every})
        index = Index(items, width, k, rarity(source.select("text"), wanted, sizes))
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            alone("decontaminate")
            index = sent.value
            for b in slices(batches):
                n_words, names, spans = [], [], []
                for text in b.column(b.schema.get_field_index("text")).to_pylist():
                    words = words_of(text)
                    mask, items = index.hits(words, hashes(words)) if words else (None, set())
                    n_words.append(len(words))
                    names.append(sorted(index.names[i] for i in items))
                    if mask is None:
                        spans.append([])
                    else:
                        turn = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                        spans.append(turn.reshape(-1, 2).tolist())
                cols = [b.column(b.schema.get_field_index(f.name)) for f in head]
                cols += [pa.array(n_words, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in schema])

        return source.mapInArrow(run, schema)

    if not many:
        out = passed(first)
    else:
        # the first block's pass has the rows; of the others only hits are written down, one block after another
        out = checkpoint(passed(first))
        hits = None
        for block in chain([rest], blocks):
            found = checkpoint(passed(block).filter(F.size("spans") > 0).select("row", "items", "spans"))
            hits = found if hits is None else hits.unionByName(found)
        more = hits.groupBy("row").agg(F.flatten(F.collect_list("items")).alias("more_items"), F.flatten(F.collect_list("spans")).alias("more_spans"))
        none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
        out = out.join(more, "row", "left").select(
            *[f.name for f in head],
            "n_words",
            F.array_sort(F.array_distinct(F.concat("items", none("more_items", "array<string>")))).alias("items"),
            united(F.concat("spans", none("more_spans", "array<array<int>>"))).alias("spans"),
        )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "items",
        "spans",
        *[F.col("text" if c == text_col else f"keep{i}").alias(f"kept_{c}") for i, c in enumerate(keep)],
    )


def united(spans: Column) -> Column:
    """Spans in order, those that touch or overlap as one."""
    return F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(-1).alias("end"), F.array().cast("array<array<int>>").alias("done"), F.lit(-1).alias("begin")),
        lambda a, s: F.when(s[0] <= a["end"], F.struct(F.greatest(a["end"], s[1]).alias("end"), a["done"].alias("done"), a["begin"].alias("begin"))).otherwise(
            F.struct(s[1].alias("end"), F.when(a["begin"] < 0, a["done"]).otherwise(F.concat(a["done"], F.array(F.array(a["begin"], a["end"])))).alias("done"), s[0].alias("begin"))
        ),
        lambda a: F.when(a["begin"] < 0, a["done"]).otherwise(F.concat(a["done"], F.array(F.array(a["begin"], a["end"])))),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL
), bw AS (
  SELECT DISTINCT item, n, win FROM (
    SELECT item, least(10, len(ws)) AS n, unnest([array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') FOR i IN range(1, greatest(1, len(ws) - 9) + 1)]) AS win
    FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS pos, unnest([array_to_string(ws[i:i + n - 1], ' ') FOR i IN range(1, len(ws) - n + 2)]) AS win
  FROM w, sizes WHERE len(ws) >= n
), m AS (SELECT doc_id, pos, dw.n, item FROM dw JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
