"""A model's vocabulary and embedding table when tokens are added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .statistics import mean_vector, new_rows


def extended(vocab: DataFrame, added: list[str]) -> DataFrame:
    """(token, id): the vocabulary, then the added tokens that it lacks, numbered on from its largest id in their order.

    A token that is added twice counts once. What reaches the driver is at most the added tokens and one number.
    """
    spark = vocab.sparkSession
    wanted = list(dict.fromkeys(added))
    rows = spark.createDataFrame([(t,) for t in wanted], "token string")
    known = {r[0] for r in rows.join(vocab, "token", "left_semi").collect()}
    last = vocab.agg(F.max("id")).first()[0]
    first = 0 if last is None else last + 1
    fresh = [(t, first + k) for k, t in enumerate(t for t in wanted if t not in known)]
    return vocab.select("token", F.col("id").cast("long").alias("id")).unionByName(spark.createDataFrame(fresh, "token string, id long"))


def ids_of(vocab: DataFrame, roles: dict[str, str]) -> dict[str, int | None]:
    """The id of the token in each role, such as begin and end of a text; None for a token that isn't there."""
    found = {r["token"]: r["id"] for r in vocab.filter(F.col("token").isin(list(roles.values()))).collect()}
    return {role: found.get(token) for role, token in roles.items()}


def resized(table: DataFrame, size: int, trained: int | None = None, scale: float = 0.02, seed: int = 42) -> DataFrame:
    """(id, vector) for the ids below `size`: rows below `trained` (default: all) stay, the others are new.

    A new row is the mean of those that stay, with normal noise of this scale. Rows are numbered from 0 without gaps; rows
    between the trained ones and the table's end are padding, and are replaced.
    """
    trained = min(size, table.count() if trained is None else trained)
    kept = table.filter(F.col("id") < trained).select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    drawn = new_rows(mean_vector(kept, "vector"), size - trained, scale, seed)
    vector = F.transform(F.array_sort(F.collect_list(F.struct("dimension", "x"))), lambda s: s["x"]).alias("vector")
    return kept.unionByName(drawn.groupBy("row").agg(vector).select((F.col("row") + trained).alias("id"), "vector"))
