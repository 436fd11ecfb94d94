"""Packs tokenised documents into sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens; a piece that fills a sequence alone is done. The others are dealt
by a hash of their row key into shards of about `shard_size` pieces, so that a shard is bounded whatever the input. For
each shard several islands evolve populations of packings: a crossover injects whole well-filled bins of one parent into
the other, bins of the other that hold one of the injected pieces are dissolved, and the pieces that lose their place are
put back by best fit, longest first. Between epochs each island sends its best packing to the next one; that exchange
is a shuffle by (shard, island), and each evolution is a task of its own that can be run again from its input: the random
numbers are seeded by shard, island and epoch. The best packing of each shard counts (fewest bins, then the largest sum
of squared fillings); evolution goes on after the fewest bins are reached, as fuller bins leave more room in the worst.

No shard alone can use the room in its worst bins, so these (at most a sixteenth of a shard's) are dissolved at the end and
dealt, whole bins together, into a sixteenth as many shards at least, which evolve in the same way from the old bins as one
of their founders, so that no round needs more bins than the one before; and so on until one shard is left.

Defined results: a null text is empty; an empty document is the end mark alone (one token); documents longer than
`capacity` are cut, the first piece takes what is left over; every row gives its pieces, repeated and null ids too; an empty table
gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import json
import random
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import alone, checkpoint, ship, slices, table
from .token_counts import VOCABULARY, byte_letters, vocabulary_path

END = b"\0\0\0\0"


class Encoder:
    """Token ids of whole texts, as the `tokenizers` library gives them for the file.

    A byte-level BPE file without normalizer, whose merged tokens are numbered in order of their merges, is also what the
    `tiktoken` core computes from the tokens' bytes, at a seventh of the time and without a memo. Runs of blanks too long
    for its pattern matcher, and files of any other kind, go to the library itself.
    """

    #: The published pattern of this pre-tokenizer — fixed value
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.core = self._core(path)

    def _core(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before, letters = spec["model"], spec["pre_tokenizer"] or {}, byte_letters()
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["normalizer"]:
            return None
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            return None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if any(x >= y for x, y in zip(made, made[1:], strict=False)) or not made or made[0] < 0:
            return None
        ranks = {bytes(letters[c] for c in t): k for t, k in model["vocab"].items() if t not in special}
        return tiktoken.Encoding("speechloom", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.core is not None:
            try:
                return self.core.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:  # the pattern matcher's stack
                pass
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    over = n % capacity
    head = [(0, over)] if over else []
    return head + [(s, capacity) for s in range(over, n, capacity)]


def tokenised(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int) -> DataFrame:
    """(id, piece, start, length, crc, row): the pieces of all documents."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("packing")
        e = encoder(vocabulary_path(vocabulary))
        for b in slices(batches, 128):
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = memoryview(e.ids(text or "") + END)
                for k, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    at.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
            names = ["id", "piece", "start", "length", "crc"]
            cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, crc long").withColumn("row", F.monotonically_increasing_id())


class Open:
    """Bins by the room they have; the one with the least room that suffices is found in a bit mask."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.slots = capacity, 0, defaultdict(list)

    def put(self, bin_: int, room: int) -> None:
        self.slots[room].append(bin_)
        self.mask |= 1 << room

    def take(self, size: int) -> tuple[int, int] | None:
        m = self.mask >> size
        if not m:
            return None
        room = size + (m & -m).bit_length() - 1
        s = self.slots[room]
        bin_ = s.pop()
        if not s:
            self.mask ^= 1 << room
        return bin_, room


def best_fit(order: list[int], sizes: list[int], bins: np.ndarray, rooms: dict[int, int], fresh: int, capacity: int) -> int:
    """Place the pieces in this order into `rooms` or new bins, numbered from `fresh`; the next free number."""
    opened = Open(capacity)
    for b, room in rooms.items():
        if room:
            opened.put(b, room)
    for i in order:
        size = sizes[i]
        got = opened.take(size)
        if got is None:
            got, fresh = (fresh, capacity), fresh + 1
        bins[i] = got[0]
        if got[1] > size:
            opened.put(got[0], got[1] - size)
    return fresh


def tight(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(bins: np.ndarray, sizes: np.ndarray) -> tuple[int, int]:
    """Smaller is better: the number of bins, then the negative sum of squared fillings."""
    fill = np.bincount(bins, sizes).astype(np.int64)
    return len(fill), -int((fill * fill).sum())


def crossover(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, capacity: int, rng: random.Random, well: float = 0.97) -> np.ndarray:
    """Well-filled bins of b go into a whole."""
    fill_b = np.bincount(b, sizes)
    good = np.flatnonzero(fill_b >= well * capacity)
    if not len(good):
        good = np.array([int(fill_b.argmax())])
    lucky = np.array(rng.sample(good.tolist(), max(1, len(good) // rng.choice((2, 3, 4)))))
    injected = np.isin(b, lucky)
    n_a = int(a.max()) + 1
    broken = np.zeros(n_a, bool)
    broken[a[injected]] = True
    # of the others the worst bins are dissolved too, so that their pieces may find a better place
    fill_a = np.bincount(a, sizes, n_a)
    whole = np.flatnonzero(~broken)
    broken[whole[np.argsort(fill_a[whole])[: 1 + len(whole) // 20]]] = True
    child = a.copy()
    child[injected] = n_a + b[injected]
    lost = np.flatnonzero(broken[a] & ~injected)
    order = lost[np.argsort(-sizes[lost], kind="stable")].tolist()
    rooms = {int(k): int(capacity - fill_a[k]) for k in np.flatnonzero(~broken)}
    rooms |= {n_a + int(k): int(capacity - fill_b[k]) for k in lucky}
    best_fit(order, sizes.tolist(), child, rooms, n_a + len(fill_b), capacity)
    return tight(child)


def founders(sizes: np.ndarray, n: int, capacity: int, rng: random.Random) -> list[np.ndarray]:
    """Best-fit decreasing, and the same on sizes blurred at random."""
    out = []
    for k in range(n):
        blur = np.array([rng.random() for _ in range(len(sizes))]) * capacity * 0.05 * k
        bins = np.zeros(len(sizes), np.int32)
        best_fit(np.argsort(-(sizes + blur), kind="stable").tolist(), sizes.tolist(), bins, {}, 0, capacity)
        out.append(tight(bins))
    return out


def perfect(sizes: np.ndarray, capacity: int) -> tuple[int, int]:
    """The fitness that none can be better than: all bins full but one."""
    full, rest = divmod(int(sizes.sum()), capacity)
    return full + (rest > 0), -(full * capacity * capacity + rest * rest)


def evolve(people: list[np.ndarray], sizes: np.ndarray, size: int, generations: int, capacity: int, rng: random.Random) -> list[np.ndarray]:
    """The fittest first. A perfect packing is left alone."""
    best = perfect(sizes, capacity)
    ranked = sorted(((fitness(p, sizes), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])[:size]
    tried = len(people)
    for _ in range(generations):
        if ranked[0][0] <= best or len(ranked) < 2:
            break
        a, b = rng.sample(range(len(ranked)), 2)
        children = [crossover(ranked[min(a, b)][2], ranked[max(a, b)][2], sizes, capacity, rng), crossover(ranked[max(a, b)][2], ranked[min(a, b)][2], sizes, capacity, rng)]
        ranked += [(fitness(c, sizes), tried + k, c) for k, c in enumerate(children)]
        tried += 2
        ranked = sorted(ranked, key=lambda x: x[:2])[:size]
    return [x[2] for x in ranked]


#: Bins of a shard, at most.
MOST = 1 << 31
STATE = "shard long, island int, rows binary, sizes binary, people binary"


def pack_rows(rest: DataFrame, capacity: int, shard_size: int = 4096, **how) -> DataFrame:
    """(row, sequence_id, offset) for rows (row, length) of less than `capacity`; ids are from 0 on."""
    rest, done, first = rest.withColumn("old", F.lit(None).cast("long")), [], 0
    n = rest.count()
    while True:
        shards = max(1, -(-n // shard_size))
        placed = checkpoint(pack_shards(rest, capacity, shards, **how).withColumn("sequence_id", F.col("shard") * MOST + F.col("bin") + first))
        first += shards * MOST
        done.append(placed.filter("not loose") if shards > 1 else placed)
        if shards == 1:
            break
        rest = placed.filter("loose").select("row", "length", F.col("sequence_id").alias("old"))
        n = min(rest.count(), shards // 16 * shard_size)  # a sixteenth as many shards at least, whatever is left
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("row", "sequence_id", "offset")


def pack_shards(rest: DataFrame, capacity: int, shards: int, islands: int = 2, epochs: int = 2, population: int = 6, generations: int = 12) -> DataFrame:
    """(row, length, shard, bin, offset, loose) for rows (row, length, old); rows of one old bin stay in one shard."""

    def state(shard: int, island: int, rows: bytes, sizes: np.ndarray, people: list[np.ndarray]) -> dict:
        return {"shard": shard, "island": island, "rows": rows, "sizes": sizes.astype(np.int32).tobytes(), "people": b"".join(p.astype(np.int32).tobytes() for p in people)}

    def table_of(out: list[dict]) -> pa.Table:
        kinds = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("rows", pa.binary()), ("sizes", pa.binary()), ("people", pa.binary())])
        return pa.Table.from_pylist(out, kinds)

    def leaving(own: dict) -> dict:
        """The best packing on its way to the next island."""
        return own | {"island": (own["island"] + 1) % islands, "rows": None, "sizes": None, "people": own["people"][: len(own["sizes"])]}

    def found(t: pa.Table) -> pa.Table:
        order = np.argsort(t["row"].to_numpy(), kind="stable")
        rows, sizes, shard = t["row"].to_numpy()[order].astype(np.int64), t["length"].to_numpy()[order].astype(np.int64), int(t["shard"][0].as_py())
        before = [] if t["old"].null_count else [tight(t["old"].to_numpy()[order])]
        out = [state(shard, k, rows.tobytes(), sizes, before + founders(sizes, population - len(before), capacity, random.Random(f"{shard}/{k}"))) for k in range(islands)]
        return table_of(out + [leaving(r) for r in out])

    def lived(t: pa.Table, k: int) -> tuple[dict, np.ndarray, list[np.ndarray]]:
        """An island's state, its sizes and its population after epoch k."""
        got = t.to_pylist()
        own = next(r for r in got if r["rows"] is not None)
        sizes = np.frombuffer(own["sizes"], np.int32).astype(np.int64)
        people = [p for r in sorted(got, key=lambda r: r["rows"] is None) for p in np.frombuffer(r["people"], np.int32).reshape(-1, len(sizes))]
        rng = random.Random(f"{own['shard']}/{own['island']}/{k}")
        return own, sizes, evolve(people, sizes, population, generations, capacity, rng)

    def epoch(k: int):
        def step(t: pa.Table) -> pa.Table:
            own, sizes, people = lived(t, k)
            own = state(own["shard"], own["island"], own["rows"], sizes, people)
            return table_of([own, leaving(own)])

        return step

    def last(t: pa.Table) -> pa.Table:
        own, sizes, people = lived(t, epochs - 1)
        bins, squares = fitness(people[0], sizes)
        out = {"shard": own["shard"], "rank": {"bins": bins, "squares": squares, "island": own["island"]}, "packing": {"rows": own["rows"], "sizes": own["sizes"], "best": people[0].astype(np.int32).tobytes()}}
        kinds = pa.schema([("shard", pa.int64()), ("rank", pa.struct([("bins", pa.int64()), ("squares", pa.int64()), ("island", pa.int32())])), ("packing", pa.struct([("rows", pa.binary()), ("sizes", pa.binary()), ("best", pa.binary())]))])
        return pa.Table.from_pylist([out], kinds)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows, sizes, bins = (np.frombuffer(r["packing"][c], t) for c, t in (("rows", np.int64), ("sizes", np.int32), ("best", np.int32)))
                order = np.argsort(bins, kind="stable")
                total = np.cumsum(sizes[order], dtype=np.int64) - sizes[order]
                first = np.concatenate([[True], np.diff(bins[order]) != 0])
                offset = total - np.maximum.accumulate(np.where(first, total, 0))
                fill = np.bincount(bins, sizes)
                worst = np.argsort(fill, kind="stable")[: max(1, len(fill) // 16)]
                loose = np.isin(bins, worst[fill[worst] < capacity])
                cols = [rows[order], sizes[order].astype(np.int64), np.full(len(rows), r["shard"], np.int64), bins[order].astype(np.int64), offset, loose[order]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["row", "length", "shard", "bin", "offset", "loose"])

    shard = F.pmod(F.xxhash64(F.coalesce("old", "row")), F.lit(shards)).alias("shard")
    states = rest.select(shard, "row", "length", "old").groupBy("shard").applyInArrow(found, STATE)
    for k in range(epochs - 1):
        states = states.groupBy("shard", "island").applyInArrow(epoch(k), STATE)
    scored = states.groupBy("shard", "island").applyInArrow(last, "shard long, rank struct<bins: long, squares: long, island: int>, packing struct<rows: binary, sizes: binary, best: binary>")
    best = scored.groupBy("shard").agg(F.min_by("packing", "rank").alias("packing"))
    return best.mapInArrow(place, "row long, length long, shard long, bin long, offset long, loose boolean")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = 2048, **how) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece."""
    pieces = checkpoint(tokenised(docs, id_col, text_col, vocabulary, capacity))
    full = F.col("length") == capacity
    placed = pack_rows(pieces.filter(~full).select("row", "length"), capacity, **how)
    alone = pieces.filter(full).select("*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = pieces.filter(~full).join(placed, "row").select(*pieces.columns, "sequence_id", "offset")
    return alone.unionByName(shared).select(F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
