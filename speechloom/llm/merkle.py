r"""Merkle manifest of a dataset: contiguous digest matrices in numpy, block by block.

Each row is a leaf. The leaves of a source form a tree in order of their ids, and the sources' roots form the tree above
them. Leaves are placed in their trees by one range sort (`placed`), so that no source meets in one task, and a tree's
positions are cut into aligned blocks of `block` = fanout^k nodes. In a block the nodes' hex digests are one matrix of
64-byte rows; a level is that matrix reshaped to `fanout` nodes a row, each row hashed; the siblings of every node are
gathered by index arithmetic (run times fanout, plus 0, 1, ... without the node's own place).

Blocks go up first: each becomes one node of a smaller tree, which is cut into blocks again, until one node is left; then the
sources' roots do the same. The way down follows: a block's path to the root (the siblings of each level above and its
place among them) is sent to its nodes, which put their own levels before it. A path is as long as the levels are many; in
the tree it holds its block's part only once for `block` leaves. A task reads its blocks one after another in Arrow
batches, and holds one block's matrices and copies of them, whatever the size of the source.

H is the lowercase hex SHA-256. A leaf is H of id, source, lang, n_chars and text, each `-` if null, else its UTF-8 byte
count, a colon and itself. The proof folds the leaf with its siblings, level by level, to the root.

Defined results: nulls are the mark `-`; the null source is the first one; null ids come first in their source and are
never tampered with; equal ids are ordered by their leaves, so repeated rows are leaves each, and equal rows differ in their
place only; an empty table gives no rows; a tree of one leaf is that leaf, and one source's root is the root. Other columns
of the input, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import checkpoint, ship, small_or_plain, table

FANOUT = 16
#: Nodes of a block: a power of the fanout.
BLOCK = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<place:int,others:binary>>"


def marked(value: Column) -> Column:
    """A field as it goes into a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(marked, fields)).cast("binary"), 256))


def tampered(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: Tables of counts are broadcast up to this many bytes: what is broadcast passes through the driver.
SENT = 2 << 20


def placed(rows: DataFrame, key: str, order: list[str], numbers: bool = False) -> DataFrame:
    """The rows with pos, their place among the rows of their key, and n, how many those are; with `numbers` also tree, the
    number of their key in the order of keys.

    One range sort by key and order, written once so that places hold if a task is run again; then places come from the
    counts of (partition, key), as many rows as there are keys and partitions together.
    """
    rows = checkpoint(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_here"), F.min("_at").alias("_first"))
    same, before = Window.partitionBy(key), Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_part").alias("_p"), F.col(key).alias("_key"), (F.coalesce(F.sum("_here").over(before), F.lit(0)) - F.col("_first")).alias("_base"), F.sum("_here").over(same).alias("n"))
    starts = checkpoint(starts)
    if numbers:
        trees = in_order(starts.select("_key").distinct(), "_key", "tree").withColumnRenamed("_key", "_name")
        starts = checkpoint(starts.join(trees, F.col("_key").eqNullSafe(F.col("_name"))).drop("_name"))
    found = rows.join(small_or_plain(starts, starts.count(), 64, SENT), (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
    return found.withColumn("pos", F.col("_base") + F.col("_at")).drop("_part", "_at", "_p", "_key", "_base")


def in_order(keys: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct keys with their number in order."""
    rows = checkpoint(keys.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("k"))
    # a row for each shuffle partition
    before = sizes.select("_part", F.coalesce(F.sum("k").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), part == F.col("_part")).select(key, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))


def height(n: int, fanout: int) -> int:
    """Levels until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def hashed(matrix: np.ndarray, last: int) -> np.ndarray:
    """H of each row of bytes as a matrix of 64-byte hex rows; the last row has only `last` bytes."""
    rows = [sha256(r) for r in matrix[:-1]] + [sha256(matrix[-1][:last].tobytes())]
    return np.frombuffer("".join(h.hexdigest() for h in rows).encode(), np.uint8).reshape(-1, 64)


def padded(nodes: np.ndarray, fanout: int) -> tuple[np.ndarray, int]:
    """The nodes as runs of `fanout`, (runs, fanout, 64), and how many nodes the last run has."""
    runs = -(-len(nodes) // fanout)
    out = np.zeros((runs * fanout, 64), np.uint8)
    out[: len(nodes)] = nodes
    return out.reshape(runs, fanout, 64), len(nodes) - (runs - 1) * fanout


def levels_of(nodes: np.ndarray, levels: int, fanout: int) -> list[np.ndarray]:
    """The matrices of a block, from its nodes to its top."""
    out = [nodes]
    for _ in range(levels):
        runs, last = padded(out[-1], fanout)
        out.append(hashed(runs.reshape(len(runs), -1), last * 64))
    return out


def siblings(nodes: np.ndarray, at: np.ndarray, fanout: int) -> list[bytes]:
    """For each index in `at` the other nodes of its run as bytes, from left to right."""
    runs, last = padded(nodes, fanout)
    run, place = at // fanout, at % fanout
    others = np.arange(fanout - 1)[None, :]
    index = run[:, None] * fanout + others + (others >= place[:, None])
    whole = runs.reshape(-1, 64)[index].reshape(len(at), -1)
    size = np.where(run == len(runs) - 1, last - 1, fanout - 1) * 64
    return [w[:s].tobytes() for w, s in zip(whole, size.tolist(), strict=True)]


def folded(digests: np.ndarray, nodes: np.ndarray, at: np.ndarray, fanout: int) -> np.ndarray:
    """H of each run of `at` with the given digests in the nodes' places."""
    runs, last = padded(nodes, fanout)
    run, place = at // fanout, at % fanout
    own = runs[run]
    own[np.arange(len(at)), place] = digests
    size = np.where(run == len(runs) - 1, last, fanout) * 64
    joined = "".join(sha256(r[:s]).hexdigest() for r, s in zip(own.reshape(len(at), -1), size.tolist(), strict=True))
    return np.frombuffer(joined.encode(), np.uint8).reshape(-1, 64)


def hexed(column: pa.Array) -> np.ndarray:
    return np.frombuffer("".join(v.hex() for v in column.to_pylist()).encode(), np.uint8).reshape(-1, 64)


def by_block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (tree, block) as one table for each block."""
    held, key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        trees, blocks = b.column("tree").to_numpy(), b.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero((trees[1:] != trees[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), b.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            now = (trees[low], blocks[low])
            if held and now != key:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held, key = [*held, b.slice(low, high - low)], now
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def up(fanout: int, block: int):
    """Blocks to nodes: (tree, pos, n, digest) of the tree above."""
    most = height(block, fanout)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_block(batches):
            n = t.column("n")[0].as_py()
            top = levels_of(hexed(t.column("digest")), min(most, height(n, fanout)), fanout)[-1]
            yield pa.RecordBatch.from_arrays([pa.array([t.column("tree")[0].as_py()], pa.int64()), pa.array([t.column("block")[0].as_py()], pa.int64()), pa.array([-(-n // block)], pa.int64()), pa.array([bytes.fromhex(top[0].tobytes().decode())], pa.binary())], names=["tree", "pos", "n", "digest"])

    return run


def down(fanout: int, block: int):
    """Paths of the nodes of a block: their own levels, then the block's path, which its first row has."""
    most = height(block, fanout)
    kind = pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_block(batches):
            above, t = t.column("path")[0].as_py(), t.slice(1)
            n, at = t.column("n")[0].as_py(), np.arange(t.num_rows)
            levels = min(most, height(n, fanout))
            paths: list[list] = [[] for _ in at]
            for k, nodes in enumerate(levels_of(hexed(t.column("digest")), levels, fanout)[:levels]):
                here = at // fanout**k
                for path, place, others in zip(paths, (here % fanout).tolist(), siblings(nodes, here, fanout), strict=True):
                    path.append({"place": place, "others": others})
            yield pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in ("tree", "pos")), pa.array([p + above for p in paths], kind)], names=["tree", "pos", "path"])

    return run


def last(fanout: int, block: int):
    """The leaves of a block: proofs and folded roots."""
    most = height(block, fanout)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_block(batches):
            first, t = t.slice(0, 1), t.slice(1)
            above, subroot, root = (first.column(c)[0].as_py() for c in ("path", "subroot", "root"))
            leaves, at = hexed(t.column("digest")), np.arange(t.num_rows)
            levels = levels_of(leaves, min(most, height(t.column("n")[0].as_py(), fanout)), fanout)
            proofs = [sha256() for _ in at]
            now = leaves.copy()
            for k, d in enumerate(t.column("other").to_pylist()):
                if d is not None:
                    now[k] = np.frombuffer(d.hex().encode(), np.uint8)
            for k, nodes in enumerate(levels[:-1]):
                here = at // fanout**k
                for p, s in zip(proofs, siblings(nodes, here, fanout), strict=True):
                    p.update(s)
                now = folded(now, nodes, here, fanout)
            rest, ends = b"".join(a["others"] for a in above), {}
            tops = [r.tobytes() for r in now]
            for top in set(tops):  # leaves that fold to the same top go the same way on
                d = top
                for a in above:
                    d = sha256(a["others"][: a["place"] * 64] + d + a["others"][a["place"] * 64 :]).hexdigest().encode()
                ends[top] = d.decode()
            for p in proofs:
                p.update(rest)
            folds = [ends[top] for top in tops]
            text = lambda values: pa.array(values, pa.string())
            yield pa.RecordBatch.from_arrays(
                [t.column("id").combine_chunks(), text([r.tobytes().decode() for r in leaves]), text([subroot] * len(at)), text([root] * len(at)), text([p.hexdigest() for p in proofs]), text(folds), pa.array([f == root for f in folds], pa.bool_())],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return run


def blocks(nodes: DataFrame, block: int, paths: DataFrame | None = None) -> DataFrame:
    """Each block's nodes together and in order, after a row with the block's path if there are paths."""
    rows = nodes.withColumn("block", F.expr(f"pos div {block}")).withColumn("rank", F.lit(1))
    if paths is not None:
        rows = rows.unionByName(paths.withColumnRenamed("pos", "block").withColumn("rank", F.lit(0)), allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank", "pos")


NODE = "tree long, pos long, n long, digest binary"


def climbed(nodes: DataFrame, fanout: int, block: int) -> list[DataFrame]:
    """The nodes of every round, from those given to one for each tree; trees that are done pass through the later rounds."""
    out, most = [nodes.select("tree", "pos", "n", "digest")], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(checkpoint(blocks(out[-1], block).mapInArrow(up(fanout, block), NODE)))
        most = -(-most // block) if most > block else 1
    return out


def descended(rounds: list[DataFrame], paths: DataFrame, fanout: int, block: int) -> DataFrame:
    """(tree, pos, path) of the nodes of the first of the rounds, from the paths of the last."""
    for nodes in rounds[-2::-1]:
        paths = checkpoint(blocks(nodes, block, paths).mapInArrow(down(fanout, block), f"tree long, pos long, path {PATH}"))
    return paths


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text", fanout: int = FANOUT, block: int = BLOCK) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row of `docs`.

    folded_root is folded from the leaf of the row as it would be after its text's A-Z were lower-cased, where 5 divides the
    CRC-32 of the id, and from its leaf elsewhere, with the siblings of the manifest.
    """
    if block < fanout or fanout ** height(block, fanout) != block:
        raise ValueError("a block is a power of the fanout")
    ship(docs.sparkSession)
    lower = [F.translate(text_col, UPPER, LOWER) if c == text_col else F.col(c) for c in fields]
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), leaf([F.col(c) for c in fields]).alias("digest"), F.when(tampered(F.col(id_col)), leaf(lower)).alias("other"))
    leaves = placed(rows, "source", ["id", "digest"], numbers=True).drop("source")
    rounds = climbed(leaves, fanout, block)
    tops = rounds[-1].select("tree", "digest")
    over = climbed(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(tops.count()).cast("long").alias("n"), "digest"), fanout, block)
    found = over[-1].select(F.lower(F.hex("digest")).alias("root")).first()
    root = found.root if found else None
    start = over[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"))
    paths = descended(over, start, fanout, block).select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path")
    paths = descended(rounds[1:], paths, fanout, block) if len(rounds) > 1 else paths
    heads = paths.join(tops.select("tree", F.lower(F.hex("digest")).alias("subroot")), "tree").withColumn("root", F.lit(root))
    made = f"id {docs.schema[id_col].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return blocks(leaves, block, heads).mapInArrow(last(fanout, block), made).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
    coalesce(octet_length(encode(text)) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS changed
  FROM documents
), bits AS (SELECT 0 AS k, i AS v, i AS byte FROM range(256) t(i) UNION ALL SELECT k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, byte FROM bits WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE k = 8
), crc AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295 AS c FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL SELECT doc_id, s, k + 1, xor(c // 256, t[1 + xor(c % 256, ascii(s[k + 1]))]) FROM crc, crc_table WHERE k < length(s)
), l AS (
  SELECT doc_id, source, sha256(head || body) AS leaf, CASE WHEN EXISTS (SELECT 1 FROM crc WHERE crc.doc_id = f.doc_id AND k = length(s) AND xor(c, 4294967295) % 5 = 0) THEN sha256(head || changed) END AS other FROM f
), p AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM l
), node AS (
  SELECT 0 AS level, tree, pos, n, leaf AS digest FROM p
  UNION ALL
  SELECT level + 1, tree, pos // 16, max(CAST(ceil(n / 16) AS BIGINT)), sha256(string_agg(digest, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY level, tree, pos // 16
), sub AS (SELECT tree, level AS h, digest AS subroot FROM node WHERE n = 1
), above AS (
  SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, subroot AS digest FROM sub
  UNION ALL
  SELECT level + 1, pos // 16, max(CAST(ceil(n / 16) AS BIGINT)), sha256(string_agg(digest, '' ORDER BY pos)) FROM above WHERE n > 1 GROUP BY level, pos // 16
), step AS (
  SELECT p.tree, p.pos, a.level, string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS before, string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS after
  FROM p JOIN node a ON a.tree = p.tree AND a.n > 1 AND a.pos = p.pos // CAST(16 ** a.level AS BIGINT) JOIN node b ON b.tree = a.tree AND b.level = a.level AND b.pos // 16 = a.pos // 16 GROUP BY ALL
  UNION ALL
  SELECT p.tree, p.pos, s.h + a.level, string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos)
  FROM p JOIN sub s USING (tree) JOIN above a ON a.n > 1 AND a.pos = p.tree // CAST(16 ** a.level AS BIGINT) JOIN above b ON b.level = a.level AND b.pos // 16 = a.pos // 16 GROUP BY ALL
), proof AS (SELECT tree, pos, string_agg(coalesce(before, '') || coalesce(after, ''), '' ORDER BY level) AS siblings FROM step GROUP BY tree, pos
), fold AS (
  SELECT tree, pos, 0 AS level, coalesce(other, leaf) AS now FROM p
  UNION ALL SELECT f.tree, f.pos, f.level + 1, sha256(coalesce(before, '') || now || coalesce(after, '')) FROM fold f JOIN step s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
), folded AS (SELECT tree, pos, arg_max(now, level) AS folded_root FROM fold GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = r.digest AS verified
FROM p JOIN sub USING (tree) JOIN (SELECT digest FROM above WHERE n = 1) r ON true LEFT JOIN proof USING (tree, pos) JOIN folded USING (tree, pos)
"""
