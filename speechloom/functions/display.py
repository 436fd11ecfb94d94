"""Numbers, durations and bars for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def commas(n: Column) -> Column:
    return F.when(n.isNotNull(), F.format_string("%,d", n.cast("long")))


def human(n: Column) -> Column:
    """With commas, and in billions, millions or thousands where it has them."""
    n = n.cast("long")
    scaled = lambda unit, letter: F.format_string(f"%,d (%.2f{letter})", n, n / unit)
    return F.when(n >= 10**9, scaled(10**9, "B")).when(n >= 10**6, scaled(10**6, "M")).when(n >= 10**3, scaled(10**3, "K")).otherwise(n.cast("string"))


def duration(seconds: Column) -> Column:
    s = lambda unit, letter: F.format_string(f"%.1f{letter}", seconds / unit)
    return F.when(seconds < 60, F.format_string("%.0fs", seconds.cast("double"))).when(seconds < 3600, s(60.0, "m")).when(seconds < 86400, s(3600.0, "h")).otherwise(s(86400.0, "d"))


def bar(percentage: Column, width: int = 30) -> Column:
    filled = (percentage * width / 100).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled), F.lit("]"))
