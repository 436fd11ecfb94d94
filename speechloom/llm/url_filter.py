"""URL filter: rules first, then the ratio of two character language models.

A rule names a host and the beginning of a path; it fits the host and its subdomains, and the longest fitting rule decides,
of equally long ones the last that is listed.
URLs that no rule fits are judged by two smoothed variable-order Markov models, one of accepted and one of rejected URLs:
each character's probability given up to `ORDER` characters before it blends all orders (Witten-Bell weights), and the
difference of the two log-likelihoods per character is compared with a threshold.

What rules accept and reject is what the models learn from, all distinct URLs of it: three quarters are counted, the other
quarter, by a hash, sets the threshold of the fewest errors. Counts are a table of (`ORDER` + 1)-grams, summed by key over
all tasks, that grows with the input; those of lower orders are sums over it, and the difference of the models' logarithms
for each gram follows by joins, order by order. It is rounded once, to a whole number of 2^-40, so that sums are the same in
any order. It is broadcast to score URLs only if it was counted to be small; beyond that the grams of each URL are joined
with it, and every difference is the same number. The threshold comes from a histogram of all held-back URLs with bins of
1/`BINS`, between the extremes of its neighbouring bins. Without URLs of one kind, the verdict is that of the other kind
(allow, when there are none).

Defined results: a null url, or one without `://`, has an empty host and path and fits no rule; the models judge its
string as it is, null as empty; an empty string has a difference of 0. Every row gives one row, repeated and null ids too; other
columns are neither read nor returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import BROADCAST_BYTES, checkpoint, ship, slices, small_or_plain, table

#: (verdict, host, path) — fixed values
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 4
BINS = 1 << 14
#: Bytes of an entry of the dictionary that scores URLs, with its key.
ENTRY = 200
CAP = 200_000
#: Parts of 1 that a gram's delta is rounded to.
UNITS = 1 << 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3, F.length(u))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host and path, verdict), null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def grams(url: str, order: int = ORDER) -> list[str]:
    s = "\x02" * order + url + "\x03"
    return [s[i - order : i + 1] for i in range(order, len(s))]


def counted(urls: DataFrame) -> DataFrame:
    """(gram, allow, block): counts in the ruled URLs that are not held back, 0 for grams of other URLs only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), *(pa.array([v[k] for v in sums.values()], pa.int64()) for k in (0, 1))], ["gram", "allow", "block"])
                sums.clear()

        for b in slices(batches):
            for url, ruled, back in zip(*(b[c].to_pylist() for c in ("url", "ruled", "back")), strict=True):
                kind = None if ruled is None or back else int(ruled == "block")
                for g in grams(url):
                    n = sums.get(g)
                    if n is None:
                        n = sums[g] = [0, 0]
                    if kind is not None:
                        n[kind] += 1
                if len(sums) > CAP:
                    yield from out()
        yield from out()

    return urls.mapInArrow(run, "gram string, allow long, block long").groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))


def deltas(found: DataFrame) -> DataFrame:
    """(gram, delta): by how many `UNITS`ths the accepted model's logarithm exceeds the rejected one's for its last character."""
    p = found.select("gram", *[F.lit(1 / 256).alias(f"p_{v}") for v in ("allow", "block")])
    for k in range(ORDER + 1):
        last, before = F.substring("gram", ORDER + 1 - k, k + 1), F.substring("gram", ORDER + 1 - k, k)
        seen = checkpoint(found.groupBy(last.alias("last")).agg(F.sum("allow").alias("n_allow"), F.sum("block").alias("n_block")))
        n = seen.count()
        of = seen.groupBy(F.substring("last", 1, k).alias("before")).agg(*[x for v in ("allow", "block") for x in (F.sum(f"n_{v}").alias(f"total_{v}"), F.count_if(F.col(f"n_{v}") > 0).alias(f"kinds_{v}"))])
        p = p.withColumns({"last": last, "before": before}).join(small_or_plain(seen, n, ENTRY), "last").join(small_or_plain(of, n, ENTRY), "before")
        mixed = lambda v: F.when(F.col(f"total_{v}") > 0, (F.col(f"n_{v}") + F.col(f"kinds_{v}") * F.col(f"p_{v}")) / (F.col(f"total_{v}") + F.col(f"kinds_{v}"))).otherwise(F.col(f"p_{v}"))
        p = p.select("gram", *[mixed(v).alias(f"p_{v}") for v in ("allow", "block")])
    return p.select("gram", F.round((F.ln("p_allow") - F.ln("p_block")) * UNITS).cast("long").alias("delta"))


def differences(urls: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """The rows of `urls` with `difference`, the mean delta of a character; 0 for an empty string."""
    names = urls.columns
    if n * ENTRY <= BROADCAST_BYTES:
        got = table.toPandas()  # n was counted
        sent = urls.sparkSession.sparkContext.broadcast(dict(zip(got["gram"], got["delta"], strict=True)))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            delta = sent.value
            for b in batches:
                d = [float(sum(delta[g] for g in grams(u))) / UNITS / len(u) if u and r is None else 0.0 for u, r in zip(b["url"].to_pylist(), b["asked"].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(b[c] for c in names), pa.array(d, pa.float64())], [*names, "difference"])

        head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
        return urls.mapInArrow(run, head + ", difference double")

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            rows = [(u, g, c) for u in b["url"].to_pylist() for g, c in Counter(grams(u)).items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else ((), (), ()), (pa.string(), pa.string(), pa.int64()), strict=True)], ["url", "gram", "k"])

    asked = urls.filter("asked is null and url <> ''").select("url").distinct()
    parts = asked.mapInArrow(spread, "url string, gram string, k long").join(table, "gram")
    whole = F.sum(F.col("k").cast("decimal(18,0)") * F.col("delta").cast("decimal(19,0)"))
    sums = parts.groupBy("url").agg((whole.cast("double") / UNITS / F.length("url")).alias("d"))
    judged = urls.filter("asked is null").join(sums, "url", "left").select(*names, F.coalesce("d", F.lit(0.0)).alias("difference"))
    return judged.unionByName(urls.filter("asked is not null").withColumn("difference", F.lit(0.0)))


def threshold(told: DataFrame) -> float:
    """Of the fewest errors, from (difference, ruled) of held-back URLs; 0 without any."""
    bins = told.groupBy(F.floor(F.col("difference") * BINS).alias("bin"))
    got = sorted(bins.agg(F.min("difference"), F.max("difference"), F.count_if(F.col("ruled") == "allow"), F.count_if(F.col("ruled") == "block")).collect())
    if not got:
        return 0.0
    errors = sum(r[4] for r in got)  # everything allowed
    best, cut = errors, got[0][1] - 1.0
    for k, (_, _, most, yes, no) in enumerate(got):
        errors += yes - no
        if errors < best:
            best, cut = errors, (most + got[k + 1][1]) / 2 if k + 1 < len(got) else most + 1e-9
    return cut


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id_col, host, path, rule, verdict, difference), one row for each row of `pages`."""
    spark = pages.sparkSession
    ship(spark)
    host, path = parsed(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    names = [F.col("id").alias(id_col), "host", "path", "rule"]
    urls = checkpoint(rows.select("url", "ruled").distinct().withColumn("back", F.col("ruled").isNotNull() & (F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(4)) == 0)))
    kinds = {r[0] for r in urls.select("ruled").distinct().collect()}
    if not {"allow", "block"} <= kinds:
        only = "block" if "block" in kinds else "allow"
        return rows.select(*names, F.coalesce("ruled", F.lit(only)).alias("verdict"), F.when(F.col("ruled").isNull(), 0.0).alias("difference"))
    found = checkpoint(counted(urls))
    learned = checkpoint(deltas(found))
    n = learned.count()
    cut = threshold(differences(urls.filter("back").select("url", "ruled", F.lit(None).cast("string").alias("asked")), learned, n))
    out = differences(rows.withColumn("asked", F.col("ruled")), learned, n)
    by_model = F.when(F.col("difference") >= cut, "allow").otherwise("block")
    return out.select(*names, F.coalesce("ruled", by_model).alias("verdict"), F.when(F.col("ruled").isNull(), F.col("difference")).alias("difference"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))
