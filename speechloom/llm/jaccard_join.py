"""Near duplicates by an exact similarity join on word n-grams: rare-first prefix, length, positional and suffix filters.

1. The only full pass over words per stage is in Arrow batches: a text's words give 64-bit shingle values.
2. The first pass counts, in `2**sketch_bits` counters of fixed total size, in how many texts shingles occur (a task sends
   its counters in slices; slices are summed in a tree). The logarithm of a shingle's counter, then its value, is the one
   order that all documents share: frequent shingles come last. Rarity only sets the order, so an over-estimate from
   shingles that share a counter costs candidates, never links.
3. The second pass emits of each set its prefix: floor(|x| - 0.8|x|) + 1 rarest shingles with their place. Sets that share
   no prefix shingle can't reach 0.8. Equal sets met in one task send one of them.
4. Postings without a possible partner in their list are dropped in the sorted stream, by bounds from the best sizes and
   places of the others. Lists that the counters say are long (`hot` or more, and 16 times the mean counter) are dealt over
   `SPREAD` tasks instead of one, and their postings are judged by the bound of their own row alone. Equal sets are reduced
   to the smallest id before pairs are formed; copies are never expanded into pairs.
5. Links are looked for in rounds. Each representative is first verified against one partner, the leader it meets in most
   of its lists; what linked forms components. A pair within a component needs no further look: its result wouldn't change
   any component. Then all remaining pairs across components that pass the length and positional filters are formed, in a
   plain equi-join on the shingle that the engine may split where it is skewed; in each posting list the largest
   component's members are not paired with each other. So a group of thousands of near copies costs pairs in proportion to
   its size, and no link between different components is lost.
6. A pair is verified once, from both full sets: the suffix filter bounds the overlap by counts of both sets on either
   side of pivots, then the intersection is counted.

Defined results: null and empty texts, and texts of blanks, have no shingles and are linked with nothing; texts of fewer
than five words have one shingle, the whole sequence; inside, each row has a key of its own, and rows are linked by their
texts; rows of one id are one document, so their components are one; rows with a null id are linked like others, and a
component of such rows alone has a null id; each row is returned; an empty table gives no rows; other columns are neither
read nor returned. Ids may be of any type that has an order; those that aren't whole numbers cost a join to number rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import alone, checkpoint, keyed, quoted, ship, slices, small_or_plain, table
from .components import components

WIDTH = 5
#: A pair is linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
SLICE = 1 << 15
SPREAD = 256
KEY = "row key of the join"
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles as sorted 64-bit values. bytes.lower() and bytes.split() know A-Z and the six blanks only."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    out = h[: len(h) - n + 1] + np.uint64(n)
    for j in range(1, n):
        out = (out ^ (out >> np.uint64(31))) * _GOLD + h[j : len(h) - n + 1 + j]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out.sort()
    fresh = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out if fresh.all() else out[fresh]


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def summaries(docs: DataFrame, bits: int, width: int) -> DataFrame:
    """One pass: a row (id, n, sig) for each document, and rows (slice, salt, counts) with a task's counters."""
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("jaccard_join")
        counts, seen, salt = np.zeros(1 << bits, np.uint32), set(), 0
        names = ["id", "n", "sig", "slice", "salt", "counts"]
        for b in slices(batches):
            n, sig, fresh = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, width)
                n.append(len(s))
                d = digest(s) if len(s) else None
                sig.append(d)
                if d is not None and d not in seen:
                    seen.add(d)
                    fresh.append(s & mask)
                    salt = zlib.crc32(d, salt)
            if fresh:
                at = np.concatenate(fresh)
                at.sort()
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                counts[at[first]] += np.diff(np.append(first, len(at))).astype(np.uint32)
            rows = len(n)
            empty = pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), *empty], names)
        used = [k for k in range((1 << bits) // SLICE) if counts[k * SLICE : (k + 1) * SLICE].any()]
        blobs = [zlib.compress(counts[k * SLICE : (k + 1) * SLICE].tobytes(), 1) for k in used]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()), pa.array(used, pa.int32()), pa.array([salt & 0x7FFFFFFF] * len(used), pa.int32()), pa.array(blobs, pa.binary())], names)

    return docs.mapInArrow(run, "id long, n long, sig binary, slice int, salt int, counts binary")


def level(count: np.ndarray | float) -> np.ndarray:
    """A counter as a byte: six steps for each doubling."""
    return np.minimum(np.round(6 * np.log2(np.asarray(count, np.float64) + 1)), 255).astype(np.uint8)


def rarity(slices: DataFrame, bits: int, hot: int, fan_in: int = 32) -> tuple[np.ndarray, int]:
    """Levels of the summed counters, 2**bits bytes whatever the input, and the level from which a list is spread."""

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.uint64)
        for blob in t["counts"]:
            total += np.frombuffer(zlib.decompress(blob.as_py()), np.uint32)
        total = np.minimum(total, (1 << 32) - 1).astype(np.uint32)
        return pa.table({"slice": t["slice"][:1], "salt": pa.array([t["salt"][0].as_py() // fan_in], pa.int32()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    at = slices.select("slice", "salt", "counts")
    n = at.groupBy("slice").count().agg(F.max("count")).first()[0] or 0
    while n:
        n = -(-n // fan_in)
        at = at.withColumn("part", F.pmod(F.hash("salt"), F.lit(n))).groupBy("slice", "part").applyInArrow(add, "slice int, salt int, counts binary")
        n = n if n > 1 else 0
    out, total = np.zeros(1 << bits, np.uint8), 0
    for r in at.select("slice", "counts").collect():  # of a fixed size
        c = np.frombuffer(zlib.decompress(r[1]), np.uint32)
        out[r[0] * SLICE : (r[0] + 1) * SLICE] = level(c)
        total += int(c.sum(dtype=np.uint64))
    return out, int(level(max(hot, 16 * total / len(out))))


def postings(docs: DataFrame, order: np.ndarray, long: int, bits: int, width: int, percent: int) -> DataFrame:
    """(token, id, n, place, salt) for the prefix of each set; of equal sets in a task, one. The salt is 0 but in lists of
    at least level `long`, whose rows it spreads by id."""
    sent = docs.sparkSession.sparkContext.broadcast(order)
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("jaccard_join")
        rare, seen = sent.value, set()
        for b in slices(batches):
            tokens, ids, sizes, places, salts = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingle_set(text, width)
                if not len(s) or i is None:
                    continue
                d = digest(s)
                if d in seen:
                    continue
                seen.add(d)
                p = prefix_size(len(s), percent)
                levels = rare[(s & mask).astype(np.int64)]
                first = np.argsort(levels, kind="stable")[:p]  # values are in order already
                tokens.append(s[first].view(np.int64))
                ids.append(np.full(p, i, np.int64))
                sizes.append(np.full(p, len(s), np.int32))
                places.append(np.arange(p, dtype=np.int32))
                salts.append(np.where(levels[first] >= long, 1 + zlib.crc32(i.to_bytes(8, "little", signed=True)) % SPREAD, 0).astype(np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, ids, sizes, places, salts)], ["token", "id", "n", "place", "salt"])

    return docs.mapInArrow(run, "token long, id long, n int, place int, salt int")


def other_best(value: np.ndarray, group: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row the largest value among the other rows of its group; groups have two rows or more, `first` begins them."""
    order = np.lexsort((value, group))
    last = np.append(first[1:], len(value)) - 1  # of the groups, in sorted order
    best, second = order[last], order[last - 1]
    out = value[best][group]
    out[best] = value[second]
    return out


def viable(token: np.ndarray, n: np.ndarray, place: np.ndarray, before: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Rows that may have a partner in their posting list by the length and positional filters: a bound from the best
    values among the other rows, so no pair is lost. Lists are complete and in order of token. `before` bounds what a row's
    set can share before the token: its place, or better the number of its earlier tokens that are left in any list."""
    same = token[1:] == token[:-1]
    keep = np.zeros(len(token), bool)
    keep[1:] |= same
    keep[:-1] |= same
    at = np.flatnonzero(keep)
    if not len(at):
        return keep
    t, n, place, before = token[at], n[at].astype(np.int64), place[at].astype(np.int64), before[at].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(t))))
    rest = n - place - 1
    most, least = other_best(n, group, first), -other_best(-n, group, first)
    near = (100 * most >= percent * n) & (percent * least <= 100 * n)
    shared = np.minimum(before, other_best(before, group, first)) + 1 + np.minimum(rest, other_best(rest, group, first))
    smallest = np.maximum(least, -(-percent * n // 100))
    keep[at] = near & ((100 + percent) * shared >= percent * (n + smallest))
    return keep


def hopeful(n: np.ndarray, place: np.ndarray, before: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Rows that a partner of the smallest size allowed could be linked with, whoever is in their list."""
    n, place, before = n.astype(np.int64), place.astype(np.int64), before.astype(np.int64)
    return (100 + percent) * (before + n - place) >= percent * (n + -(-percent * n // 100))


def shared_only(rows: DataFrame, percent: int, most: int = 200_000) -> DataFrame:
    """Postings that may have a partner. The stream is sorted by token; the last list of a batch is held back until it is
    whole. Rows with a salt belong to lists dealt over many tasks and are judged one by one; any other list of more than
    `most` rows passes in parts and unpruned, so that what is held is bounded."""
    schema = rows.schema
    use = ("n", "place", "before" if "before" in rows.columns else "place")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        passing = None  # the token of a list that passes unpruned
        for b in batches:
            t = pa.Table.from_batches([b])
            salted = t["salt"].to_numpy() > 0
            if salted.any():
                spread = t.filter(pa.array(salted))
                yield from spread.filter(pa.array(hopeful(*(spread[c].to_numpy() for c in use), percent))).to_batches()
                t = t.filter(pa.array(~salted))
            if held is not None:
                t = pa.concat_tables([held, t]).combine_chunks()
            if not t.num_rows:
                continue
            token = t["token"].to_numpy()
            if passing is not None:
                k = int(np.searchsorted(token != passing, True)) if token[0] == passing else 0
                if k:
                    yield from t.slice(0, k).to_batches()
                    t, token = t.slice(k), token[k:]
                if not len(token):
                    held = None
                    continue
                passing = None
            cut = int(np.flatnonzero(token == token[-1])[0])
            done = t.slice(0, cut)
            if cut:
                yield from done.filter(pa.array(viable(token[:cut], *(done[c].to_numpy() for c in use), percent))).to_batches()
            held = t.slice(cut)
            if held.num_rows > most:
                yield from held.to_batches()
                passing, held = token[-1], None
        if held is not None and held.num_rows:
            yield from held.filter(pa.array(viable(held["token"].to_numpy(), *(held[c].to_numpy() for c in use), percent))).to_batches()

    return rows.repartition("token", "salt").sortWithinPartitions("token").mapInArrow(run, schema)


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingle_set(t, width).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def overlap_bound(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """The suffix filter: no more than this can be shared, by how many lie between the quantiles of x."""
    cuts = x[(len(x) * np.arange(1, 1 << depth)) >> depth] if len(x) >= 1 << depth else x[:0]
    inside = [np.diff(np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]])) for s in (x, y)]
    return int(np.minimum(*inside).sum())


def needed(n: int, m: int, percent: int = PERCENT) -> int:
    """The smallest intersection that links sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def linked(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    need = needed(len(x), len(y), percent)
    if min(len(x), len(y)) < need or overlap_bound(x, y) < need:
        return False
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= need


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, ys = b.column(2), b.column(3)
            ok = [linked(np.frombuffer(xs[i].as_buffer(), np.uint64), np.frombuffer(ys[i].as_buffer(), np.uint64), percent) for i in range(b.num_rows)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def may_link(a: str, b: str, percent: int):
    """Length and positional filters for two postings of one token, as an expression.

    need = ceil(p (n + m) / (100 + p)); what is shared from this token on is at most 1 and the shorter rest, and before it
    no more than the smaller `before`.
    """
    n, m, i, j = f"{a}.n", f"{b}.n", f"{a}.place", f"{b}.place"
    return F.expr(f"""100 * least({n}, {m}) >= {percent} * greatest({n}, {m})
        and {100 + percent} * (least({a}.before, {b}.before) + 1 + least({n} - {i} - 1, {m} - {j} - 1)) >= {percent} * ({n} + {m})""")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, sketch_bits: int = 22, hot: int = 1000) -> DataFrame:
    """(id_col, n_shingles, component_id), one row for each row of `docs`."""
    spark = docs.sparkSession
    ship(spark)
    rows, odd = keyed(docs, id_col, KEY)
    source = rows.select(F.col(KEY).alias("id"), F.col(text_col).alias("text"))
    first = checkpoint(summaries(source, sketch_bits, width))
    is_doc = F.col("slice").isNull()
    info = first.filter(is_doc).select("id", "n", "sig")
    order, long = rarity(first.filter(~is_doc), sketch_bits, hot)

    # equal sets: the smallest id stands for them. Sets that occur once need no look-up; the others are written down, so
    # that the join has an exchange of its own, which the engine may split where one set has very many rows
    leaders = checkpoint(info.filter("sig is not null").groupBy("sig").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k"))
    own = F.when(F.col("sig").isNotNull(), F.coalesce("rep", "id")).alias("rep")
    known = checkpoint(info.join(small_or_plain(leaders, leaders.count(), 48), "sig", "left").select("id", "n", own))
    reps = known.filter("rep is not null").select("id", "rep").distinct()

    shared = checkpoint(shared_only(postings(source, order, long, sketch_bits, width, percent), percent))
    # the salt is drawn anew: equal sets met in several tasks have several
    anew = F.when(F.col("salt") > 0, 1 + F.pmod(F.hash("rep"), F.lit(SPREAD))).otherwise(0).alias("salt")
    lists = shared.join(reps, "id").select("token", F.col("rep").alias("id"), "n", "place", anew).distinct()
    # what two linked sets share before a common prefix token is in both prefixes, so in lists: earlier tokens that are in
    # none, the rarest above all, can't be shared, and rows drop out that places alone would let pass
    for _ in range(2):
        ranked = lists.select("token", "id", "n", "place", "salt", (F.row_number().over(Window.partitionBy("id").orderBy("place", "token")) - 1).alias("before"))
        lists = checkpoint(shared_only(ranked, percent))
    members = lists.select("id").distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among the pairs; only the texts of their members are taken up again."""
        wanted = checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        chosen = source.join(small_or_plain(wanted, wanted.count(), 16), "id", "left_semi")
        return checkpoint(verify(pairs, checkpoint(sets_of(chosen, width)), percent))

    # one partner each, twice: the second time across what the first has joined
    links = tried = None
    roots = members.select(F.col("id").alias("node"), F.col("id").alias("root"))
    for _ in range(2):
        pairs = partners(lists, roots, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = checkpoint(pairs)
        found = verified(pairs)
        links = found if links is None else links.unionByName(found)
        tried = pairs if tried is None else tried.unionByName(pairs)
        roots = checkpoint(rooted(members, links))
    pairs = checkpoint(across(lists, roots, percent).join(tried, ["a", "b"], "left_anti"))
    roots = rooted(members, links.unionByName(verified(pairs))).select(F.col("node").alias("rep"), "root")
    found = known.join(roots, "rep", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "id").alias("root"))
    if not odd:
        kind = docs.schema[id_col].dataType
        return found.select(F.col("id").cast(kind).alias(id_col), "n_shingles", F.col("root").cast(kind).alias("component_id"))
    found = checkpoint(found.join(rows.select(F.col(KEY).alias("id"), F.col(quoted(id_col)).alias("name")), "id"))
    least = found.filter("name is not null").groupBy("name").agg(F.min("root").alias("a"))
    edges = found.join(least, "name").select("a", F.col("root").alias("b")).filter("a <> b").distinct()
    joined = components(edges).select(F.col("node").alias("root"), F.col("root").alias("whole"))
    found = checkpoint(found.join(joined, "root", "left").select("name", "n_shingles", F.coalesce("whole", "root").alias("root")))
    return found.join(found.groupBy("root").agg(F.min("name").alias("component_id")), "root").select(F.col("name").alias(id_col), "n_shingles", "component_id")


def rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for all nodes, those without links too."""
    found = components(links)
    return nodes.select(F.col("id").alias("node")).join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


ROW = ["id", "n", "place", "before", "root"]


def partners(lists: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """For each representative the list leader of another component that it meets in most of its lists.

    A list's leader has the token at the smallest place: least in it is rare, so it is next to what copies have been made
    from. Members of the leader's component get the leader of the rest. So a list of m postings gives at most m pairs.
    """
    rows = lists.join(roots.select(F.col("node").alias("id"), "root"), "id")
    lead = F.min(F.struct("place", "id", "n", "before", "root"))
    first = rows.groupBy("token").agg(lead.alias("p"))
    rows = rows.join(first, "token")
    others = rows.filter("root <> p.root").groupBy("token").agg(lead.alias("q"))
    met = rows.join(others, "token").select(F.struct(*ROW).alias("r"), F.when(F.col("root") != F.col("p.root"), F.col("p")).otherwise(F.col("q")).alias("s"))
    votes = met.filter(may_link("r", "s", percent)).groupBy(F.col("r.id").alias("id"), F.col("s.id").alias("b")).agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("id").agg(F.max(F.struct("votes", "b")).alias("best"))
    return best.select(F.least("id", "best.b").alias("a"), F.greatest("id", "best.b").alias("b")).distinct()


def across(lists: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share a prefix token and pass the filters, once each."""
    rows = lists.join(roots.select(F.col("node").alias("id"), "root"), "id")
    parts = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = parts.groupBy("token").agg(F.max(F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("token", F.col("top.root").alias("top"))
    rows = rows.join(largest, "token")
    minor = rows.filter("root <> top").select("token", F.struct(*ROW).alias("p"))
    every = rows.select("token", F.struct(*ROW).alias("q"), "top")
    # a pair of two minor rows is met twice, and counted from the smaller id
    return (
        minor.join(every, "token")
        .filter("p.root <> q.root and (q.root = top or p.id < q.id)")
        .filter(may_link("p", "q", percent))
        .select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"))
        .distinct()
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT links.b, r.root FROM r JOIN links ON r.doc_id = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""
