"""From utterances to documents: joins of texts and codes, ordered grouping, fan-out, long chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alphabet import Alphabet
from ..functions.markup import audio_first, text_first


def imploded(df: DataFrame, keys: list[str], order: list[str | Column], **fields: Column) -> DataFrame:
    """(keys, chunks): each group's rows as array<struct<fields>>, in order. The order travels with the rows."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[c.alias(f"_{k}") for k, c in enumerate(by)], F.struct(*[c.alias(n) for n, c in fields.items()]).alias("_c")))).alias("rows"))
    return rows.select(*keys, F.transform("rows", lambda r: r["_c"]).alias("chunks"))


def chunks_of(raw: DataFrame, alphabet: Alphabet = Alphabet()) -> DataFrame:
    """(audio_id, chunks) of raw documents with maps of texts and codes: chunks of both, in the order of the texts.

    Documents without codes or text, chunks without codes, and documents left without chunks are dropped. Of a repeated
    key the last value counts: the maps are built anew under the session's LAST_WIN policy by the reader.
    """
    both = raw.filter("codes is not null and text is not null")
    pairs = F.transform(F.map_entries("text"), lambda e: F.struct(e["value"].alias("text"), F.try_element_at(F.col("codes"), e["key"]).alias("codes")))
    whole = F.filter(pairs, lambda p: p["codes"].isNotNull() & (F.size(p["codes"]) > 0) & p["text"].isNotNull())
    chunks = F.transform(whole, lambda p: F.struct(p["text"].alias("text"), alphabet.encode(p["codes"]).alias("audio")))
    return both.select("audio_id", chunks.alias("chunks")).filter(F.size("chunks") > 0)


def pretrain_rows(docs: DataFrame, id_col: str, split: Column | str = "train") -> DataFrame:
    """(id, split, text): two rows for each document (id_col, chunks), text first and audio first, in one pass."""
    split = F.lit(split) if isinstance(split, str) else split
    name = F.col(id_col).cast("string")
    both = F.array(
        F.struct(F.concat(name, F.lit("_type1")).alias("id"), text_first(F.col("chunks")).alias("text")),
        F.struct(F.concat(name, F.lit("_type2")).alias("id"), audio_first(F.col("chunks")).alias("text")),
    )
    return docs.select(split.alias("split"), F.explode(both).alias("r")).select("r.id", "split", "r.text")


def long_parts(seconds: Column, rate: int = 24_000, limit: float = 60.0) -> Column:
    """array<struct<part, first, length>> in samples: pieces of `limit` seconds; a chunk of exactly that is one."""
    total, step = (seconds * rate).cast("long"), int(limit * rate)
    cut = F.transform(F.sequence(F.lit(0).cast("long"), total - 1, F.lit(step).cast("long")), lambda s, k: F.struct(k.alias("part"), s.alias("first"), F.least(F.lit(step).cast("long"), total - s).alias("length")))
    whole = F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("first"), total.alias("length")))
    return F.when(seconds > limit, cut).otherwise(whole)


def sample_range(start_cs: Column, end_cs: Column, rate: int = 24_000) -> Column:
    """struct(first, length) in samples of a range in centiseconds."""
    at = lambda c: (c * rate / 100).cast("long")
    return F.struct(at(start_cs).alias("first"), (at(end_cs) - at(start_cs)).alias("length"))


def sliced(samples: Column, bounds: Column) -> Column:
    return F.slice(samples, (bounds["first"] + 1).cast("int"), bounds["length"].cast("int"))


def frames(samples: Column, rate: int = 24_000, per_second: float = 12.5) -> Column:
    """Codec frames of so many samples, the last one filled up."""
    return F.ceil(samples / (rate / per_second))


def joined_parts(parts: DataFrame, key: str, part: str, codes: str) -> DataFrame:
    """Code matrices of a chunk's parts joined along time."""
    rows = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(part, codes))).alias("p"))
    books = F.sequence(F.lit(0), F.size(F.col("p")[0][codes]) - 1)
    return rows.select(key, F.transform(books, lambda k: F.flatten(F.transform("p", lambda p: F.get(p[codes], k)))).alias(codes))
