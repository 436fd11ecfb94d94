"""One declarative recipe for each kind of corpus: from its columns to documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.markup import audio_first, bare, speaker_tagged, strip, text_first, translation, unquoted, zero_shot_pair
from ..operators.documents import imploded, pretrain_rows
from ..operators.sequences import consecutive_pairs, first_appearance, gap_sessions, segment_documents, segment_id


@dataclass(frozen=True)
class Recipe:
    """How a corpus names its columns and cleans its transcripts; `audio` is the codec string."""

    id: str = "id"
    text: str = "text"
    audio: str = "audio_str"
    clean: str = "none"

    def transcript(self) -> Column:
        c = F.col(self.text)
        return {"none": lambda x: x, "lower": F.lower, "strip": strip, "unquoted": unquoted}[self.clean](c)

    def chunk(self) -> Column:
        return F.struct(self.transcript().alias("text"), F.col(self.audio).alias("audio"))


PEOPLE = Recipe(clean="none")
COMMON = Recipe(id="path", text="sentence")
LIBRI = Recipe(id="file_path", text="transcript", clean="lower")
BOOKS = Recipe(id="entry_id", text="transcript", clean="strip")
PAIRS = Recipe(text="text_normalized", clean="unquoted")


def single_utterances(df: DataFrame, r: Recipe, name: Column | None = None) -> DataFrame:
    """Two documents for each utterance. Rows without a transcript are left out."""
    rows = df.filter(F.col(r.text).isNotNull()).select((name if name is not None else F.col(r.id)).alias("doc"), F.array(r.chunk()).alias("chunks"))
    return pretrain_rows(rows, "doc")


def bare_rows(df: DataFrame, r: Recipe) -> DataFrame:
    """(id, view, text): recognition and synthesis rows without the frame."""
    views = F.array(F.struct(F.lit("asr").alias("view"), bare(r.transcript(), F.col(r.audio), True).alias("text")), F.struct(F.lit("tts").alias("view"), bare(r.transcript(), F.col(r.audio), False).alias("text")))
    return df.select(F.col(r.id).alias("id"), F.explode(views).alias("v")).select("id", "v.view", "v.text")


def book_documents(df: DataFrame, r: Recipe = BOOKS, tolerance: float = 0.2) -> DataFrame:
    """Utterances of a recording joined where they follow one another; two documents for each segment."""
    keys = ["speaker_id", "book_id", "original_path"]
    cut = gap_sessions(df, keys, "begin_time", "end_time", r.id, tolerance)
    segs = segment_documents(cut, keys, "begin_time", r.id, r.chunk())
    both = F.explode(F.array(*[F.struct(segment_id(F.col("entry"), F.col("segment_index"), F.col("n_segments"), k).alias("id"), (text_first if k == 1 else audio_first)(F.col("chunks")).alias("text")) for k in (1, 2)]))
    return segs.select(both.alias("r"), "original_path", "segment_index", "num_segments", "speaker_id", "book_id").select("r.id", "original_path", "r.text", F.col("segment_index").cast("long").alias("segment_index"), F.col("num_segments").cast("long").alias("num_segments"), "speaker_id", "book_id")


def conversations(df: DataFrame, doc: str, order: str, speaker: str, r: Recipe) -> DataFrame:
    """(id, split, text, speaker_ids, speaker_count): speakers numbered by first appearance."""
    rows = imploded(df, [doc], [order], text=F.col(r.text), audio=F.col(r.audio), name=F.col(speaker))
    rows = rows.withColumn("speaker_ids", first_appearance(F.transform("chunks", lambda c: c["name"])))
    tagged = F.zip_with("chunks", "speaker_ids", lambda c, k: F.struct(c["text"].alias("text"), c["audio"].alias("audio"), k.alias("speaker")))
    return rows.select(F.col(doc).cast("string").alias("id"), F.lit("train").alias("split"), speaker_tagged(tagged).alias("text"), "speaker_ids", F.size(F.array_distinct("speaker_ids")).alias("speaker_count"))


def tts_pairs(df: DataFrame, keys: list[str], order: list[str], r: Recipe = PAIRS) -> DataFrame:
    """(id, text, keys): each utterance with the next of its group."""
    rows = df.select(*keys, *[c for c in order if c not in keys], F.col(r.id).alias("pid"), r.transcript().alias("ptext"), F.col(r.audio).alias("paudio"))
    rows = consecutive_pairs(rows, keys, order, ["pid", "ptext", "paudio"])
    return rows.select(F.concat_ws("#", F.col("pid").cast("string"), F.col("next_pid").cast("string")).alias("id"), zero_shot_pair(F.col("ptext"), F.col("paudio"), F.col("next_ptext"), F.col("next_paudio")).alias("text"), *keys)


def translations(df: DataFrame, method: str = "method1") -> DataFrame:
    text = translation(F.col("original_audio_str"), F.col("original_text"), F.col("translated_text"), F.col("translated_audio_str"), F.col("lang"), method)
    return df.select("id", "lang", text.alias("text"))


def file_documents(df: DataFrame, r: Recipe, file_col: str) -> DataFrame:
    """Utterance files grouped by the name without its last part, in order of the name."""
    rows = imploded(df.withColumn("doc", ids.document_key(F.col(file_col))), ["doc"], [file_col], text=r.transcript(), audio=F.col(r.audio))
    return pretrain_rows(rows, "doc")
