"""Counts, token totals, extrapolations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import commas


def token_stats(df: DataFrame, by: str, tokens: Column, total: bool = False) -> DataFrame:
    """(by, num_documents, total_tokens, avg_tokens); with `total`, a row with a null key for all."""
    group = df.withColumn("_t", tokens)
    group = group.rollup(by) if total else group.groupBy(by)
    agg = group.agg(F.count(F.lit(1)).alias("num_documents"), F.coalesce(F.sum("_t"), F.lit(0)).cast("long").alias("total_tokens"))
    return agg.withColumn("avg_tokens", F.col("total_tokens") / F.greatest(F.col("num_documents"), F.lit(1)))


def extrapolated(total_tokens: Column, sample: Column, population: Column) -> Column:
    """int(tokens * (population / sample)): the ratio first, in doubles, then cut."""
    return (total_tokens * (population / sample.cast("double"))).cast("long")


def rows_by_language(files: DataFrame, lang: str = "lang", shard: str = "shard", sub: str = "sub", rows: str = "n") -> DataFrame:
    """(lang, rows, shards, subshards) with a total; a file whose rows are unknown counts as a file only."""
    return files.rollup(lang).agg(F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("rows"), F.countDistinct(shard).alias("shards"), F.countDistinct(shard, sub).alias("subshards"))


def with_tokens(stats: DataFrame, tokens: DataFrame, lang: str = "lang", rows: str = "rows") -> DataFrame:
    """Language statistics with a token column for display, `XXX` where the count is missing; tokens: (lang, stat, extra)."""
    known = tokens.select(lang, F.coalesce("stat", "extra").alias("tokens"))
    return stats.join(known, lang, "left").withColumn("shown", F.coalesce(commas(F.col("tokens")), F.lit("XXX")))


def unit_summary(df: DataFrame, count: str) -> DataFrame:
    """(total, shards, average, most, least), the last four over counts above 0."""
    some = F.when(F.col(count) > 0, F.col(count))
    return df.agg(F.sum(count).alias("total"), F.count(some).alias("shards"), F.avg(some).alias("average"), F.max(some).alias("most"), F.min(some).alias("least"))


def filter_ratio(df: DataFrame, keep: Column, by: list[str]) -> DataFrame:
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("original"), F.count_if(keep).alias("filtered"))
    return agg.withColumn("pct", F.try_divide(F.col("filtered"), F.col("original")) * 100)


def next_number(df: DataFrame, stem: str) -> DataFrame:
    """The largest numeric stem and one; other stems are passed over, 0 if there is none."""
    return df.agg((F.coalesce(F.max(F.col(stem).try_cast("int")), F.lit(-1)) + 1).alias("next"))


def mean_vector(df: DataFrame, vector: str, first: int = 0, last: int | None = None, id_col: str | None = None) -> DataFrame:
    """(dimension, mean) over rows, within an id range if one is given."""
    if id_col is not None:
        df = df.filter(F.col(id_col).between(first, last) if last is not None else F.col(id_col) >= first)
    return df.select(F.posexplode(vector).alias("dimension", "x")).groupBy("dimension").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def new_rows(means: DataFrame, n: int, scale: float = 0.02, seed: int = 42) -> DataFrame:
    """(row, dimension, x): n new vectors, the mean with normal noise of this scale. Means are a row for each dimension."""
    rows = means.sparkSession.range(n).withColumnRenamed("id", "row").join(F.broadcast(means))
    return rows.select("row", "dimension", (F.col("mean") + F.randn(seed) * scale).alias("x"))


#: Columns of the report's numbers, as they stand in a line.
NUMBERS = ("rows", "shards", "subshards")

#: Head of the language report: the four lines a reader skips.
HEAD = "# Rows by language\n\n| Language | Rows | Shards | Sub-shards |\n|---|---|---|---|"


def report_lines(stats: DataFrame) -> DataFrame:
    """(ord, lang, line): the rows of a Markdown table with a total, from rows_by_language()."""
    name = F.when(F.col("lang").isNull(), "**TOTAL**").otherwise(F.col("lang"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", name, *[commas(F.col(n)) for n in NUMBERS]), F.lit(" |"))
    return stats.select(F.col("lang").isNull().cast("int").alias("ord"), "lang", line.alias("line"))


def parsed_report(lines: DataFrame, value: str = "value") -> DataFrame:
    """(lang, rows, shards, subshards) of the lines of report_lines(): a line is cut at its bars into the name and NUMBERS.

    The head, the rule below it and the total have no name of letters or no numbers, and are left out.
    """
    cells = F.transform(F.split(F.btrim(value, F.lit("| ")), "\\|"), lambda c: F.trim(c))
    number = lambda k: F.translate(F.get(cells, F.lit(k)), ",", "").try_cast("long")
    named = (F.size(cells) == 1 + len(NUMBERS)) & F.get(cells, F.lit(0)).rlike("^[A-Za-z0-9_]+$")
    out = lines.filter(named).select(F.get(cells, F.lit(0)).alias("lang"), *[number(k).alias(n) for k, n in enumerate(NUMBERS, 1)])
    return out.dropna(subset=list(NUMBERS))
