"""Identifiers: time stamps, chunk ids, text digests, and what shard names say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .markup import BLANKS, strip

#: Languages that a file list may name — fixed values
LISTED = ("EN", "DE", "FR", "JA", "KO", "ZH")


def centiseconds(seconds: Column) -> Column:
    """Eight digits at least, cut towards zero after the multiplication in doubles."""
    return F.format_string("%08d", (seconds.cast("double") * 100).cast("long"))


def folded(text: Column) -> Column:
    """Stripped, lower case, runs of blanks as one. Compatibility forms are left to `plugins.nfkc`, which goes before."""
    plain = F.translate(F.lower(strip(text)), BLANKS, " " * len(BLANKS))
    return F.regexp_replace(plain, "  +", " ")  # few places, and a pattern that is found fast


def digest(canonical: Column, bits: int = 128) -> Column:
    """URL-safe base 64 of the first bits of the SHA-256, without padding."""
    head = F.unhex(F.substring(F.sha2(canonical.cast("binary"), 256), 1, bits // 4))
    return F.translate(F.rtrim(F.replace(F.base64(head), F.lit("="), F.lit(" "))), "+/", "-_")


def entry_id(speaker: Column, book: Column, begin: Column, end: Column, text: Column) -> Column:
    return F.concat_ws("-", speaker, book, centiseconds(begin), centiseconds(end), digest(folded(text)))


def chunk_id(audio: Column, index: Column, start: Column, end: Column) -> Column:
    return F.concat(audio, F.format_string("-%05d-%08d-%08d", index, start, end))


def chunk_parts(c: Column) -> Column:
    """struct(audio_id, idx, start_cs, end_cs), split from the right: the audio id may hold hyphens."""
    part = lambda k: F.regexp_extract(c, r"^(.*)-([^-]*)-([^-]*)-([^-]*)$", k)
    return F.struct(part(1).alias("audio_id"), *(part(k).try_cast("int").alias(n) for k, n in ((2, "idx"), (3, "start_cs"), (4, "end_cs"))))


def valid_range(start: Column, end: Column) -> Column:
    """True for a range with samples, false for an empty one; a reversed one stops the job."""
    return F.when(start > end, F.raise_error(F.lit("a range ends before it starts")).cast("boolean")).otherwise(start < end)


def document_key(file_id: Column) -> Column:
    """Without the last part after `_`; empty if there is none."""
    return F.when(F.instr(file_id, "_") == 0, F.lit("")).otherwise(F.regexp_replace(file_id, "_[^_]*$", ""))


def file_id(path: Column, root: str, suffix: str) -> Column:
    """What follows the last `root` and one character, without any `suffix`."""
    return F.replace(F.substr(F.substring_index(path, root, -1), F.lit(2)), F.lit(suffix), F.lit(""))


def language_of_path(path: Column) -> Column:
    """Two lower-case letters before digits and a slash; null where the path has none."""
    return F.nullif(F.regexp_extract(path, r"^([a-z]{2})\d+/", 1), F.lit(""))


def language_of_split(split: Column) -> Column:
    return F.substring(F.split_part(split, F.lit("/"), F.lit(1)), 1, 2)


def language_of_shard(shard: Column) -> Column:
    return F.when(F.length(shard) >= 2, F.substring(shard, 1, 2)).otherwise("unknown")


def listed_language(shard: Column) -> Column:
    lang = F.split_part(shard, F.lit("-"), F.lit(1))
    return F.when(lang.isin(*LISTED), lang).otherwise(F.raise_error(F.concat(F.lit("no such language: "), lang)).cast("string"))


def subset_of_shard(shard: Column) -> Column:
    return F.when(shard.contains("clean"), "clean").when(shard.contains("other"), "other").otherwise(F.raise_error(F.lit("neither clean nor other")).cast("string"))


def published_shard(path: Column, split: str) -> Column:
    """The shard of a published file of this split, null for other paths."""
    return F.nullif(F.regexp_extract(path, f"^{split}/(.*)\\.parquet$", 1), F.lit(""))


def listed_folder(line: Column) -> Column:
    """struct(speaker, book) of `speaker-book`; the book may hold hyphens."""
    part = lambda k: F.regexp_extract(line, "^([^-]*)-(.*)$", k)
    return F.struct(part(1).alias("speaker_id"), part(2).alias("book_id"))


def in_shard(path: Column, shard: Column | str, suffix: str = ".parquet") -> Column:
    """A file of this shard's folder."""
    return path.startswith(F.concat(shard if isinstance(shard, Column) else F.lit(shard), F.lit("/"))) & path.endswith(suffix)


def in_split(path: Column, split: str = "train") -> Column:
    return path.contains(split)


def speaker(name: Column) -> Column:
    """The name, if it has the form that the diarisation gives; any other stops the job."""
    return F.when(name.contains("SPEAKER_"), name).otherwise(F.raise_error(F.concat(F.lit("no such speaker: "), F.coalesce(name, F.lit("null")))).cast("string"))


def in_order(languages: Column) -> Column:
    """Languages once each, in the order of their first mention."""
    return F.array_distinct(languages)


def job_name(shard: Column, prefix: str = "job") -> Column:
    return F.concat(F.lit(prefix), F.regexp_extract(shard, r"train-(\d+)", 1))
