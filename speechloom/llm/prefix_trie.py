r"""Prefix trie of conversations, by prefix doubling.

Turns get dense names: equal (role, text) have one number, whole texts meet only as digests. Two neighbouring blocks of
2^k turns make a block of 2^(k+1), named by a join with the distinct pairs of names, so that after log2(longest) rounds
every aligned block has a name. A prefix is made of the blocks of its length's binary digits, longest first, so its name is
the list of their names, at most one for each digit; nodes are groups of equal lists, and are numbered in turn.

Sums over subtrees take a round for each power of two as well: what a node gathered from less than 2^k levels below goes to
the ancestor 2^k levels above. Ancestors are looked up once, as prefixes of the node's first member, a unique key.

Names are written once (a task that ran again might number them differently) and hold by count: a partition's local
number after the number of names in the partitions before. Every join is by keys that are unique on one side; sides that
were counted as small are broadcast, others are joined by Spark's sort and merge, which splits a frequent key. No
conversation, node or turn meets in one row or task, but for the digest of a node's own conversations: SHA-256 is
sequential, so their ids pass in order through one task, of which only the digest's state is kept.

Defined results: null roles and texts are empty; turns of a conversation are ordered by turn, null first, then by the
digest of role and text; repeated rows are turns each; rows with a null conversation id belong to no conversation and are
passed over; an empty table gives no nodes, not even the root; conversations without rebuilt turns are members of the root only;
other columns, whatever their names, are neither read nor returned. `c % 5` has the sign of c, as in SQL.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import checkpoint, ship, small_or_plain, table
from .merkle import SENT, placed

EMPTY = sha256(b"").hexdigest()


def numbered(keys: DataFrame, name: str, first: int = 0) -> tuple[DataFrame, int]:
    """The rows of `keys`, which are distinct, with dense numbers from `first` on, and how many rows there are."""
    held = checkpoint(keys.withColumn("_at", F.monotonically_increasing_id()))
    sizes = {r[0]: r[1] for r in held.groupBy(F.shiftright("_at", 33)).count().collect()}  # a row for each partition
    starts, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(part, 0)
    start = F.get(F.lit(starts or [0]), F.shiftright("_at", 33).cast("int"))
    return held.select("*", (start + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + first).alias(name)).drop("_at"), total


def turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, n, digest, bytes): the turns of every conversation in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    told = rows.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return placed(told, "conv", ["turn", "digest"]).select("conv", "pos", "n", "digest", "bytes")


def borrowed(conv: Column, most: int = 9) -> Column:
    """How many turns of its base a conversation takes over."""
    return F.crc32(conv.cast("string").cast("binary")) % most


def rebuilt(named: DataFrame, family: int = 5) -> tuple[DataFrame, DataFrame]:
    """(conv, at, turn name, bytes), each rebuilt turn, and (conv, len), each conversation.

    A turn of a base goes to the members of its family that exist and take it over, a turn of any other conversation to that
    itself; the sizes of conversations, not their turns, are joined.
    """
    sizes = named.filter("pos = 0").select("conv", F.col("n").alias("own"), (F.col("conv") - F.col("conv") % family).alias("base"), borrowed(F.col("conv")).alias("h"))
    bases = sizes.filter("conv = base").select("base", F.col("own").alias("base_n"))
    convs = sizes.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = checkpoint(convs.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")))
    small = convs.count()
    own = named.join(small_or_plain(convs.select("conv", "h", "taken"), small, 48, SENT), "conv").filter("pos >= h").select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("at"), "name", "bytes")
    # a base's first turns, at most 8 of them
    heads = named.filter(f"conv % {family} = 0 and pos < 8").select(F.col("conv").alias("base"), "pos", "name", "bytes")
    given = heads.join(small_or_plain(convs.select("conv", "base", "h"), small, 48, SENT), "base").filter("pos < h").select("conv", F.col("pos").alias("at"), "name", "bytes")
    return own.unionByName(given), convs.select("conv", "len")


def named_pairs(pairs: DataFrame, first: int, keep: list[str]) -> tuple[DataFrame, int]:
    """Rows with (left, right) get a number for each distinct pair, from `first` on; (keep, name) and the first free number."""
    names, n = numbered(pairs.select("left", "right").distinct(), "name", first)
    return checkpoint(pairs.join(small_or_plain(names, n, 32, SENT), ["left", "right"]).select(*keep, "name")), first + n


def blocks_of(units: DataFrame, longest: int) -> list[DataFrame]:
    """(conv, at, name) of the aligned blocks of 1, 2, 4 ... turns, `at` counted in blocks of that size."""
    free, out = 0, [units]
    while 1 << len(out) <= longest:
        half = lambda side: F.max(F.when(F.col("at") % 2 == side, F.col("name")))
        pairs = out[-1].groupBy("conv", F.shiftright("at", 1).alias("at")).agg(half(0).alias("left"), half(1).alias("right"))
        made, free = named_pairs(pairs.filter("right is not null"), free, ["conv", "at"])
        out.append(made)
    return out


def prefixes(units: DataFrame, convs: DataFrame, longest: int) -> DataFrame:
    """(conv, depth, key, bytes, ends): each prefix of each conversation, with the names of the blocks it is made of, longest
    first, the bytes of its last turn, and whether it is the whole conversation.

    A block of 2^k turns at an even place is part of the prefixes that end within the 2^k turns from its end on, so a prefix
    gets one name for each binary digit of its length.
    """
    none = F.lit(None).cast("long")
    rows = convs.select("conv", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("depth"), (F.col("len") == 0).alias("ends")), F.struct(F.col("len").alias("depth"), F.lit(True).alias("ends")))).alias("e")).select("conv", "e.depth", "e.ends", none.alias("part"), none.alias("bytes"))
    rows = rows.unionByName(units.select("conv", (F.col("at") + 1).alias("depth"), F.lit(False).alias("ends"), none.alias("part"), "bytes"))
    parts = units.select("conv").filter("false").select("conv", none.alias("depth"), none.alias("name"), F.lit(0).alias("k"))
    for k, block in enumerate(blocks_of(units.select("conv", "at", "name"), longest)):
        end = (F.col("at") + 1) * (1 << k)
        parts = parts.unionByName(block.filter("at % 2 = 0").select("conv", F.explode(F.sequence(end, end + (1 << k) - 1)).alias("depth"), "name", F.lit(k).alias("k")))
    # prefixes beyond the conversation's end are none: only those with a last turn, or of no turn, stay
    part = F.struct((-F.col("k")).alias("k"), F.col("name"))
    rows = rows.select("conv", "depth", "ends", "bytes", F.lit(None).cast("struct<k:int,name:bigint>").alias("part")).unionByName(parts.select("conv", "depth", F.lit(False).alias("ends"), none.alias("bytes"), part.alias("part")))
    found = rows.groupBy("conv", "depth").agg(F.transform(F.sort_array(F.collect_list("part")), lambda x: x["name"]).alias("key"), F.max("bytes").alias("bytes"), F.max("ends").alias("ends"))
    return checkpoint(found.filter("bytes is not null or depth = 0"))


def own_members(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end: their ids, ascending, joined by commas."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for b in batches:
            done, nodes = [], b.column(0).to_pylist()
            for n, c in zip(nodes, b.column(1).to_pylist(), strict=True):
                if n != node:
                    if state is not None:
                        done.append((node, state.hexdigest()))
                    node, state = n, sha256(str(c).encode())
                else:
                    state.update(b",%d" % c)
            yield made(done)
        if state is not None:
            yield made([(node, state.hexdigest())])

    def made(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])

    return ends.select("node", "conv").repartition("node").sortWithinPartitions("node", "conv").mapInArrow(run, "node long, ends_sha256 string")


def jumps(nodes: DataFrame, found: DataFrame, deepest: int) -> DataFrame:
    """(node, ups): the ancestors 1, 2, 4 ... levels above a node, nearest first, as (node, first member)."""
    steps = [1 << k for k in range(deepest.bit_length())] or [1]
    wanted = nodes.select("node", F.col("conv_id").alias("conv"), F.explode(F.transform(F.filter(F.lit(steps), lambda s: s <= F.col("depth")), lambda s: F.struct(s.alias("step"), (F.col("depth") - s).alias("depth")))).alias("w")).select("node", "conv", "w.step", "w.depth")
    up = found.select("conv", "depth", F.col("node").alias("up"), F.col("first").alias("first"))
    return wanted.join(up, ["conv", "depth"]).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("step", "up", "first"))).alias("ups"))


def summed(nodes: DataFrame, deepest: int) -> DataFrame:
    """(node, n_children, n_leaves, saved_tokens, and the node's own columns): sums over subtrees.

    In each round a node's row goes to itself and to an ancestor; Spark adds up within each task first, so that an ancestor of
    many nodes gets a row from each task.
    """
    own = F.struct("conv_id", "depth", "n_convs", "ups")
    zero, nobody = F.lit(0).cast("long"), F.lit(None).cast(nodes.select(own.alias("own")).schema["own"].dataType)
    parent = F.get("ups", F.lit(0))["up"]
    rows = nodes.select(F.explode(F.array(F.struct(F.col("node"), own.alias("own"), "saved", zero.alias("kids")), F.struct(parent.alias("node"), nobody.alias("own"), zero.alias("saved"), F.lit(1).cast("long").alias("kids")))).alias("r")).select("r.*")
    now = rows.filter("node is not null").groupBy("node").agg(F.max("own").alias("own"), F.sum("saved").alias("saved"), F.sum("kids").alias("kids"))
    now = now.withColumn("leaves", (F.col("kids") == 0).cast("long"))
    for k in range(deepest.bit_length()):
        up = F.get(F.col("own.ups"), F.lit(k))["up"]
        there = F.struct(up.alias("node"), nobody.alias("own"), "saved", zero.alias("kids"), "leaves")
        rows = now.select(F.explode(F.array(F.struct("node", "own", "saved", "kids", "leaves"), there)).alias("r")).select("r.*").filter("node is not null")
        now = rows.groupBy("node").agg(F.max("own").alias("own"), F.sum("saved").alias("saved"), F.sum("kids").alias("kids"), F.sum("leaves").alias("leaves"))
    return now.select("node", "own.*", F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node."""
    ship(rows.sparkSession)
    told = checkpoint(turns(rows, conv_col, turn_col, role_col, text_col))
    names, n = numbered(told.groupBy("digest").agg(F.count(F.lit(1)).alias("many")).select("digest"), "name")
    named = checkpoint(told.join(small_or_plain(names, n, 96, SENT), "digest").select("conv", "pos", "n", "name", "bytes"))
    units, convs = rebuilt(named)
    units = checkpoint(units)
    longest = convs.agg(F.max("len")).first()[0] or 0
    found = prefixes(units, convs, longest)
    # a node's first member tells its ancestors
    groups = found.groupBy("depth", "key").agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"))
    nodes, n = numbered(groups, "node")
    held = nodes.select("depth", "key", "node", F.col("conv_id").alias("first"))
    found = checkpoint(found.join(small_or_plain(held, n, 160, SENT), ["depth", "key"]).select("conv", "depth", "node", "first", "ends"))
    nodes = nodes.select("node", "depth", "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.coalesce("bytes", F.lit(0))).alias("saved"))
    nodes = checkpoint(nodes.join(jumps(nodes, found, longest), "node", "left"))
    out = summed(nodes, longest).join(own_members(found.filter("ends")), "node", "left")
    parent = F.get("ups", F.lit(0))["first"]
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH RECURSIVE bits AS (SELECT 0 AS k, i AS v, i AS byte FROM range(256) t(i) UNION ALL SELECT k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, byte FROM bits WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8
), crc AS (
  SELECT conv_id, conv_id::VARCHAR AS s, 0 AS k, 4294967295 AS c FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL SELECT conv_id, s, k + 1, xor(c // 256, t[1 + xor(c % 256, ascii(s[k + 1]))]) FROM crc, crc_table WHERE k < length(s)
), h AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE k = length(s)
), o AS (
  SELECT conv_id, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, octet_length(encode(coalesce(text, ''))) AS bytes,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL
), r AS (
  SELECT h.conv_id, 0 AS part, pos, d, bytes FROM h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 5 AND pos < h
  UNION ALL SELECT h.conv_id, 1, pos, d, bytes FROM h JOIN o USING (conv_id) WHERE pos >= h
), u AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, d, bytes FROM r
), pre AS (
  SELECT conv_id, depth, sha256(string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key, bytes FROM u
  UNION ALL SELECT conv_id, 0, '', 0 FROM h
), node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM pre GROUP BY key, depth
), par AS (SELECT n.*, p.key AS parent FROM node n LEFT JOIN pre p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), kids AS (SELECT parent AS key, count(*) AS n FROM par WHERE parent IS NOT NULL GROUP BY parent
), sums AS (
  SELECT p.key, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
  FROM par n LEFT JOIN kids k USING (key) JOIN pre p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.key
), fin AS (SELECT conv_id, max(depth) AS depth FROM pre GROUP BY conv_id
), ends AS (SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM pre JOIN fin USING (conv_id, depth) GROUP BY key)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM par n LEFT JOIN node q ON q.key = n.parent LEFT JOIN kids k ON k.key = n.key JOIN sums s ON s.key = n.key LEFT JOIN ends e ON e.key = n.key
"""
