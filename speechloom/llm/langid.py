"""Language identification by a string kernel: presence of character n-grams of blended lengths, Nystroem landmarks, ridge.

A text's features are the distinct n-grams of 1 to 3 characters of its lower-cased whole, hashed into `2**BITS` places;
the kernel of two texts is the number of places in both over the geometric mean of their numbers. Landmarks are labelled
texts; K(text, landmarks) times the inverse root of K(landmarks, landmarks) approximates the kernel's feature space, and
one ridge regression per language against the rest is solved there. Scoring is one matrix product for a batch of texts.

Learning takes at most `sample` different rows of each language, those of the smallest hash of the id, then of the text,
chosen by rates from counts over all rows before texts are taken up; so the model's size and what reaches the driver depend
on the number of languages alone, however often ids or rows repeat.

Defined results: a null text, or one without a letter, is `und` with score 1; null languages are not learned from; without
any labelled row every text is `und` with score 0; every row is predicted, repeated and null ids too (the latter are held
out for nothing and not learned from); repeated rows are learned from once; other columns are not read. Ids may be of any
type.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import checkpoint, ship, small_or_plain, table

BITS = 14
ORDERS = (1, 2, 3)
FOLDS, HELD = 4, 2


def presence(text: str) -> np.ndarray:
    """0/1 for each hashed n-gram, as bytes."""
    out = np.zeros(1 << BITS, np.uint8)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint32)
    h = np.zeros(len(c), np.uint32)
    for k in ORDERS:
        if len(c) < k:
            break
        h = h[: len(c) - k + 1] * np.uint32(0x01000193) + c[k - 1 :] + np.uint32(k)
        out[(h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = 1
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over the root of their numbers: the product of two such rows is the kernel."""
    x = x.astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


class Kernel:
    def __init__(self, x: np.ndarray, langs: list[str], per_lang: int = 48, ridge: float = 0.3):
        self.langs = sorted(set(langs))
        y = np.array([self.langs.index(v) for v in langs])
        pick = np.sort(np.concatenate([np.flatnonzero(y == k)[:per_lang] for k in range(len(self.langs))])) if len(self.langs) else np.zeros(0, int)
        u = unit(x)
        marks = u[pick]
        value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
        root = vector / np.sqrt(np.maximum(value, 1e-3))
        phi = (u @ marks.T) @ root
        phi = np.hstack([phi, np.ones((len(phi), 1))])
        target = np.where(y[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        weight = 1 / np.bincount(y, minlength=len(self.langs))[y]
        weight *= len(y) / weight.sum()
        w = np.linalg.solve(phi.T @ (phi * weight[:, None]) + ridge * np.eye(phi.shape[1]), phi.T @ (target * weight[:, None]))
        #: texts times this, plus the shift, are the margins
        self.map = (marks.T.astype(np.float64) @ root @ w[:-1]).astype(np.float32)
        self.shift = w[-1].astype(np.float32)

    def predict(self, x: np.ndarray, sharp: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
        m = unit(x) @ self.map + self.shift
        best = m.argmax(1)
        e = np.exp(sharp * (m - m.max(1, keepdims=True)))
        return best, e.max(1) / e.sum(1)


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = 400) -> Kernel | None:
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & (F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(FOLDS)) != HELD)
    )
    rows = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("share", F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / (1 << 40))
    counts = {r[0]: max(1, r[1]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("id")).collect()}
    rate = F.lit(0.0)
    for lang, n in counts.items():  # a little more than asked for, then cut to it
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, 1.5 * sample / n + 20 / n))).otherwise(rate)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = [np.packbits(presence(t)).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.binary())], ["lang", "share", "bits"])

    few = rows.filter(F.col("share") < rate).withColumn("hash", F.xxhash64("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("share", "hash", "id"))
    picked = checkpoint(few.select("lang", "share", "hash", "id").distinct().withColumn("place", place).filter(F.col("place") <= sample).drop("place"))
    if picked.isEmpty():
        return None
    # a row for each chosen one: repeated rows meet in partial aggregates
    keys = ["lang", "share", "hash", "id"]
    texts = few.join(small_or_plain(picked, sample * len(counts), 64), keys).groupBy(*keys).agg(F.first("text").alias("text"))
    got = texts.select("lang", "share", "text").mapInArrow(run, "lang string, share double, bits binary").collect()
    chosen = sorted(got, key=lambda r: (r[1], r[0], r[2]))
    x = np.stack([np.unpackbits(np.frombuffer(r[2], np.uint8)) for r in chosen])
    return Kernel(x, [r[0] for r in chosen])


def language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 400, batch: int = 256) -> DataFrame:
    """(id_col, held_out, lang_pred, score), one row for each row of `docs`."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col, sample))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            texts = b.column(1).to_pylist()
            pred, score = ["und"] * len(texts), np.ones(len(texts)) * (model is not None)
            known = [i for i, t in enumerate(texts) if has_letter(t)] if model is not None else []
            for at in range(0, len(known), batch):
                part = known[at : at + batch]
                best, p = model.predict(np.stack([presence(texts[i]) for i in part]))
                score[part] = p
                for i, k in zip(part, best, strict=True):
                    pred[i] = model.langs[k]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    sent = model
    out = source.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS)) == HELD, F.lit(False))
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(table(spark, sf_dir, "documents"))
