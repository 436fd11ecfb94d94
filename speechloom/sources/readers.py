"""Readers: parquet shards, JSON arrays and trees, lists, listings, archives, arrays, generated sequences."""

from __future__ import annotations

import io
import itertools
import json
import lzma
import pickle
import re
import tarfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint

#: Raw utterance documents. Never inferred: each chunk id would become a column.
RAW = "audio_id string, text map<string,string>, codes map<string,array<array<int>>>"
UTTERANCE = "entry_id string, original_path string, speaker_id string, book_id string, transcript string, begin_time string, end_time string, audio_duration string, audio_str string"
#: Files and folders of a tree that the driver lists.
FEW = 1000
BLANK = re.compile(r"[ \t\n\r]*")
#: What is escaped in a file's URI.
SIGNS = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')
PROGRESS_SUBSHARDS = "shard_id string, completed_subshards array<string>, failed_subshards array<string>, parquet_counter int"
PROGRESS_ROWS = "shard_id string, processed_count int, total_count int, last_processed_index int"
PROGRESS_STATUS = "shard_id string, split string, lang string, status string, timestamp string, hf_repo_id string, num_samples int"


def parquet(spark: SparkSession, *paths: str, source_file: bool = False, skip_corrupt: bool = False) -> DataFrame:
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    df = reader.parquet(*paths)
    return df.withColumn("source_file", F.col("_metadata.file_path")) if source_file else df


def by_language(spark: SparkSession, base: str, langs: list[str]) -> DataFrame:
    """One folder for each language, in one union with a literal column."""
    parts = [spark.read.parquet(f"{base}/{lang}").withColumn("lang", F.lit(lang)) for lang in langs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def last_wins(map_column: str | Column) -> Column:
    """A JSON map with repeated keys, rebuilt so that the last value counts, in the place of the key's first."""
    entries = F.map_entries(map_column)
    keys = F.transform(entries, lambda e: e["key"])
    last = lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"))
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)  # rare
    return F.map_from_entries(F.when(repeated, F.transform(F.array_distinct(keys), last)).otherwise(entries))


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of JSON array files; a file that can't be parsed gives rows with `_corrupt_record`."""
    df = spark.read.schema(RAW + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("text", last_wins("text")).withColumn("codes", last_wins("codes"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over."""
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _children(store, folder: str) -> Iterator[tuple[str, bool]]:
    """(path, whether it is a folder) of what a folder holds; local folders are read as a stream, others by the file system's list."""
    import os

    from pyarrow import fs

    if store.type_name == "local":
        with os.scandir(folder) as found:
            for f in found:
                if not hidden(f.name):
                    yield f"{folder.rstrip('/')}/{f.name}", f.is_dir()
    else:
        for f in store.get_file_info(fs.FileSelector(folder)):
            if not hidden(f.base_name):
                yield f.path, f.type == fs.FileType.Directory


def _below(store, folder: str) -> Iterator[tuple[str, bool]]:
    """(path, whether it is a folder) of all that is below a folder, a folder after another."""
    open_folders = [_children(store, folder)]
    while open_folders:
        entry = next(open_folders[-1], None)
        if entry is None:
            open_folders.pop()
            continue
        yield entry
        if entry[1]:
            open_folders.append(_children(store, entry[0]))


def tree_files(spark: SparkSession, base: str, suffix: str = "") -> DataFrame:
    """(path) of the files below a folder, as the base's file system names them, listed by tasks.

    Spark's own listing asks for a folder at a time on the driver and keeps all files there; here the folders of the first
    two levels are dealt over tasks, and each task walks through those it gets. A task holds the names of one folder at a time.
    """
    from pyarrow import fs

    store, top = fs.FileSystem.from_uri(base)
    kind = store.get_file_info(top).type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(base)
    spread = 4 * spark.sparkContext.defaultParallelism
    shape = pa.schema([("path", pa.string()), ("folder", pa.bool_())])

    def rows(found: Iterable[tuple[str, bool]]) -> Iterator[pa.RecordBatch]:
        while some := list(itertools.islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), shape.types, strict=True)], schema=shape)

    def walk(batches: Iterable[pa.RecordBatch], deep: bool) -> Iterator[pa.RecordBatch]:
        own, _ = fs.FileSystem.from_uri(base)

        def found() -> Iterator[tuple[str, bool]]:
            for b in batches:
                for path, folder in zip(b["path"].to_pylist(), b["folder"].to_pylist(), strict=True):
                    below = iter([(path, False)]) if not folder else _below(own, path) if deep else _children(own, path)
                    yield from (e for e in below if (e[1] and not deep) or (not e[1] and e[0].endswith(suffix)))

        return rows(found())

    out = spark.createDataFrame([(top, kind == fs.FileType.Directory)], "path string, folder boolean")
    for deep in (False, False, True):
        out = out.mapInArrow(lambda batches, deep=deep: walk(batches, deep), "path string, folder boolean").repartition(spread, "path")
    return out.select("path")


def exact(text: str) -> str:
    """A JSON object, or an array of objects, with a string for each value that is none: its own signs, as Spark's readers of
    files take them (1.50, NaN, {"a": 1}) and from_json does not. Any other text stays as it is."""
    decode = json.JSONDecoder().raw_decode

    def after(at: int) -> int:
        return BLANK.match(text, at).end()

    def one(at: int) -> tuple[dict[str, str | None], int]:
        out, at = {}, after(at + 1)
        while text[at] != "}":
            key, at = decode(text, at)
            at = after(after(at) + 1)
            value, end = decode(text, at)
            out[key] = value if value is None or isinstance(value, str) else text[at:end]
            at = after(end)
            at = after(at + 1) if text[at] == "," else at
        return out, at + 1

    try:
        whole = json.loads(text)
    except (ValueError, RecursionError):
        return text
    first = after(0)
    if isinstance(whole, dict):
        return json.dumps(one(first)[0])
    if not isinstance(whole, list) or not all(isinstance(x, dict) for x in whole):
        return text
    out, at = [], after(first + 1)
    for _ in whole:
        x, at = one(at)
        out.append(x)
        at = after(after(at) + 1)
    return json.dumps(out)


def _tree(spark: SparkSession, base: str) -> DataFrame:
    """The objects of all JSON files below a folder: a file's object, or each of its array's. A tree of few files and folders is
    listed and scanned by Spark's reader; any other by tasks, which give the same rows."""
    from pyarrow import fs

    store, plain = fs.FileSystem.from_uri(base)
    if store.get_file_info(plain).type != fs.FileType.Directory or sum(1 for _ in itertools.islice(_below(store, plain), FEW + 1)) <= FEW:
        reader = spark.read.schema(UTTERANCE + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE")
        return reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(base).withColumn("path", F.col("_metadata.file_path"))
    prefix = base.rstrip("/").removesuffix(plain.rstrip("/")) or "file:"

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(base)
        names: list[str] = []
        texts: list[str | None] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["path", "content"])

        for b in batches:
            for path in b["path"].to_pylist():
                with store.open_input_file(path) as file:
                    content = file.read()
                held += len(content)
                try:
                    text = content.decode(json.detect_encoding(content))
                except UnicodeDecodeError:
                    text = None
                if text is None or text.strip():  # as Spark does, nothing of an empty file
                    names.append(prefix + SIGNS.sub(lambda m: f"%{ord(m[0]):02X}", path))
                    texts.append(text if text is None else exact(text))
                if held > 8 << 20 or len(names) == 1000:
                    yield batch()
                    names, texts, held = [], [], 0
        if names:
            yield batch()

    files = tree_files(spark, base, ".json").mapInArrow(read, "path string, content string")
    listed = F.col("content").rlike(r"^\s*\[")
    one = F.from_json("content", UTTERANCE + ", _corrupt_record string", {"mode": "PERMISSIVE"})
    several = F.from_json(F.when(listed, F.col("content")), T.ArrayType(T.StructType.fromDDL(UTTERANCE)))
    several = F.when(~F.exists(several, F.isnull), F.transform(several, lambda r: r.withField("_corrupt_record", F.lit(None).cast("string"))))
    none = [F.lit(None).cast("string").alias(f.name) for f in T.StructType.fromDDL(UTTERANCE)]
    wrong = F.array(F.struct(*none, F.coalesce("content", F.lit("")).alias("_corrupt_record")))
    objects = F.when(F.col("content").isNull(), wrong).when(listed, F.coalesce(several, wrong)).otherwise(F.array(one))
    return files.select("path", F.explode(objects).alias("o")).select("o.*", "path")


def unreadable_utterances(spark: SparkSession, base: str) -> DataFrame:
    """(path) of the files that utterance_tree() passes over, to be counted."""
    named = F.concat("path", F.coalesce(F.substring("entry_id", 1, 0), F.lit("")))  # Spark wants a column of the file besides
    return _tree(spark, base).filter(F.col("_corrupt_record").isNotNull()).select(named.alias("path"))


def footers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, rows, error) of parquet files, from their footers alone: rows is null where a footer can't be read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        for b in batches:
            found = []
            for name in b["path"].to_pylist():
                try:
                    store, place = fs.FileSystem.from_uri(name)
                    with store.open_input_file(place) as file:
                        found.append((name, parquet.read_metadata(file).num_rows, None))
                except (pa.ArrowException, OSError) as e:
                    found.append((name, None, str(e)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["path", "rows", "error"])

    return listing(spark, path, "*.parquet").select("path").mapInArrow(run, "path string, rows long, error string")


def unreadable_parquet(spark: SparkSession, path: str) -> DataFrame:
    """(path, error) of files whose footer can't be read: what a scan that skips corrupt files leaves out."""
    return footers(spark, path).filter("error is not null").select("path", "error")


def utterance_tree(spark: SparkSession, base: str, seen: Observation | None = None) -> DataFrame:
    """One object for each file below speaker and book; unreadable files are passed over, `unreadable_utterances` lists them.
    Times become doubles, 0 where missing.

    seen: after an action on the result, `seen.get` has how many objects were `read` and how many files `skipped`, counted in
    the same scan.
    """
    df = _tree(spark, base)
    bad = F.col("_corrupt_record").isNotNull()
    if seen is not None:
        df = df.observe(seen, F.count_if(~bad).alias("read"), F.count_if(bad).alias("skipped"))
    df = df.filter(~bad).drop("_corrupt_record", "path")
    times = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in ("begin_time", "end_time", "audio_duration")}
    return df.withColumns(times)


def id_list(spark: SparkSession, path: str, comments: bool = True, indented: bool = True) -> DataFrame:
    """(id): one for each line that isn't blank; lines that begin with # are left out if comments are known, those with
    blanks before it only if `indented`."""
    lines = spark.read.text(path).select(F.trim("value").alias("id"), "value").filter("id <> ''")
    return (lines.filter(~F.col("id" if indented else "value").startswith("#")) if comments else lines).select("id")


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(shard_id, n) of a JSON object."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,int>")).alias("shard_id", "n"))


def first_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(shard_id, n) of the first of these files that exists; without any, no rows, so that defaults hold."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return counts(spark, path)
    return spark.createDataFrame([], "shard_id string, n int")


def total_rows(spark: SparkSession, data: str, known: list[str]) -> int:
    """The row count that the first metadata file has as `num_rows`, a JSON object each; else that of the data's footers."""
    for path in known:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            n = spark.read.text(path, wholetext=True).select(F.get_json_object("value", "$.num_rows").try_cast("long")).first()[0]
            if n is not None:
                return n
    return row_count(spark, data)


def listing(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """(path, size, modified) of files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def row_count(spark: SparkSession, path: str) -> int:
    """From the parquet footers: the count is pushed into the scan, in a session of its own with the settings it needs."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count(F.lit(1))).first()[0]


def pairs_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(shard_id, subshard_id); lines of another number of fields are passed over."""
    parts = F.split(F.trim("value"), "\t")
    return spark.read.text(path).filter(F.size(parts) == 2).select(parts[0].alias("shard_id"), parts[1].alias("subshard_id"))


def _read_archives(archives: DataFrame, suffix: str) -> DataFrame:
    """The columns of `archives` (path first) with name, content and error: a row for each member, then one without a name, whose
    error says why the archive couldn't be read further, null if it is whole."""

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for k, archive in enumerate(b.column(0).to_pylist()):
                own, error = [c.slice(k, 1) for c in b.columns], None
                row = lambda *last: pa.RecordBatch.from_arrays([*own, *(pa.array([x], t) for x, t in zip(last, kinds, strict=True))], [*b.schema.names, "name", "content", "error"])  # noqa: B023, E731
                try:
                    store, place = fs.FileSystem.from_uri(archive)
                    with store.open_input_stream(place, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as t:
                        for m in t:
                            if m.isfile() and m.name.endswith(suffix):
                                yield row(m.name, t.extractfile(m).read(), None)
                except (tarfile.TarError, EOFError, OSError, zlib.error, lzma.LZMAError) as e:
                    error = f"{type(e).__name__}: {e}"
                yield row(None, None, error)

    kinds = (pa.string(), pa.binary(), pa.string())
    return archives.mapInArrow(members, T.StructType([*archives.schema, *(T.StructField(n, t) for n, t in (("name", T.StringType()), ("content", T.BinaryType()), ("error", T.StringType())))]))


def archive_members(spark: SparkSession, path: str | list[str], suffix: str = "") -> DataFrame:
    """(archive, name, content) of tar and tar.gz files, read as streams: a task holds one member at a time, and an archive
    may have any size. A lost task reads its archive again; of a broken archive come the members before the break."""
    archives = listing(spark, path).select(F.col("path").alias("archive"))
    return _read_archives(archives, suffix).filter("name is not null").drop("error")


def extracted(spark: SparkSession, target: str) -> DataFrame:
    """(archive, size, modified, members, error) of the archives that `extract` has read, as they were then."""
    of = spark.read.parquet(target).groupBy("archive", "size", "modified")
    return of.agg(F.count("name").alias("members"), F.max("error").alias("error"))


def extract(spark: SparkSession, path: str, target: str, suffix: str = "") -> DataFrame:
    """The members of all whole archives, from a table in `target` with a folder for each archive.

    A folder appears when its job commits, with the archive's size and time of change and a last row that says whether it
    was read to its end: that is the mark of completion, of empty archives too. What an interrupted job leaves is done again; a
    broken archive stops no other, is told by `extracted`, and is read again when it has changed.
    """
    fresh = listing(spark, path).select(F.col("path").alias("archive"), "size", "modified")
    try:
        state = extracted(spark, target)
        done = state.filter("error is null").select("archive")
        as_before = state.filter("error is not null").select("archive", "size", "modified")
        fresh = fresh.join(done, "archive", "left_anti").join(as_before, ["archive", "size", "modified"], "left_anti")
    except AnalysisException:  # nothing yet
        pass
    fresh = checkpoint(fresh)  # what is written must not be read by the same plan
    if not fresh.isEmpty():
        _read_archives(fresh, suffix).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("archive").parquet(target)
    rows = spark.read.parquet(target)
    broken = rows.filter("error is not null").select("archive")
    return rows.filter("name is not null").join(broken, "archive", "left_anti").select("archive", "name", "content")


class _Arrays(pickle.Unpickler):
    """Unpickles arrays of numbers and nothing else: a file can't have code run."""

    ALLOWED = {("numpy", "ndarray"), ("numpy", "dtype"), *((f"numpy.{core}.{part}", name) for core in ("core", "_core") for part, name in (("multiarray", "_reconstruct"), ("multiarray", "scalar"), ("numeric", "_frombuffer"))), ("_codecs", "encode")}

    def find_class(self, module: str, name: str):
        if (module, name) not in self.ALLOWED:
            raise pickle.UnpicklingError(f"{module}.{name} is no array")
        return super().find_class(module, name)


def load_array(content: bytes):
    """An .npy file's array; arrays of objects may hold arrays of numbers only."""
    import numpy as np

    stream = io.BytesIO(content)
    version = np.lib.format.read_magic(stream)
    shape, fortran, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(stream)
    if not kind.hasobject:
        return np.load(io.BytesIO(content), allow_pickle=False)
    out = _Arrays(stream).load()
    return out.reshape(shape, order="F" if fortran else "C")


def code_arrays(spark: SparkSession, path: str) -> DataFrame:
    """(path, item, codes) of .npy files: object arrays of matrices, or dense arrays of rank 2 to 4."""

    def arrays(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            for name, content in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                a = load_array(content)
                if a.dtype == object:
                    items = [a.item()] if a.ndim == 0 else list(a)
                else:
                    while a.ndim > 2:
                        a = a[0]
                    items = [a]
                codes = [np.asarray(m).astype("int32").tolist() for m in items]
                cols = [pa.array([name] * len(items)), pa.array(range(len(items)), pa.int32()), pa.array(codes, pa.list_(pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays(cols, ["path", "item", "codes"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(arrays, "path string, item int, codes array<array<int>>")


def numbered(spark: SparkSession, n: int, pattern: str = "%08d", name: str = "id", first: int = 0) -> DataFrame:
    return spark.range(first, first + n).select(F.format_string(pattern, F.col("id")).alias(name))


def numbered_by(spark: SparkSession, prefix: str, last: int) -> DataFrame:
    """`{prefix}-B000000` to `last`, both included."""
    return numbered(spark, last + 1, f"{prefix}-B%06d")


def work_state(files: DataFrame, audio: tuple[str, ...] = (".mp3", ".wav")) -> DataFrame:
    """(shard_id, cache_exists, cache_files, audio_files, extracted, archived) of listed work folders: path is `.../shard/file`."""
    name, shard = F.substring_index("path", "/", -1), F.substring_index(F.substring_index("path", "/", -2), "/", 1)
    is_audio = F.lit(False)
    for a in audio:
        is_audio = is_audio | name.endswith(a)
    cached = name.endswith(".cache.json")
    return files.groupBy(shard.alias("shard_id")).agg(
        (F.count_if(cached) > 0).alias("cache_exists"),
        F.count_if(cached).alias("cache_files"),
        F.count_if(is_audio).alias("audio_files"),
        (F.count_if(name == ".extraction_complete") > 0).alias("extracted"),
        (F.count_if(name.endswith(".tar") | name.endswith(".tar.gz")) > 0).alias("archived"),
    )


def available(spark: SparkSession, wanted: DataFrame, listed: DataFrame, path: str = "path") -> DataFrame:
    """Wanted paths with a flag: is the file listed? In place of asking for each one."""
    return wanted.join(listed.select(path).distinct().withColumn("exists", F.lit(True)), path, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
