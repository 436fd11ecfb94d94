"""Grammar of interleaved documents and the rewrites that make views of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .alphabet import Alphabet

#: Special tokens — fixed values
BOS, EOS = "<|begin_of_text|>", "<|end_of_text|>"
TS, TE = "<|text_start|>", "<|text_end|>"
AS, AE = "<|audio_start|>", "<|audio_end|>"

#: What str.strip() removes, as a regex class.
SPACES = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


#: The same, one by one.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _lit(s: str) -> str:
    return s.replace("|", "\\|")


def strip(c: Column) -> Column:
    """Without blanks of any script at both ends. Never for strings of the codec alphabet after interleaving."""
    return F.btrim(c, F.lit(BLANKS))


def unquoted(c: Column) -> Column:
    """Stripped, then without double quotes at both ends, then without single ones."""
    c = F.regexp_replace(strip(c), '^"+|"+$', "")
    return F.regexp_replace(c, "^'+|'+$", "")


def spoken(audio: Column) -> Column:
    return F.concat(F.lit(AS), audio, F.lit(AE))


def written(text: Column, tag: Column | str = "") -> Column:
    return F.concat(F.lit(TS), tag if isinstance(tag, Column) else F.lit(tag), text, F.lit(TE))


def framed(*parts: Column) -> Column:
    return F.concat(F.lit(BOS), *parts, F.lit(EOS))


def text_first(chunks: Column) -> Column:
    """Type 1: (text audio)* of array<struct<text, audio>>."""
    return framed(F.array_join(F.transform(chunks, lambda c: F.concat(written(c["text"]), spoken(c["audio"]))), ""))


def audio_first(chunks: Column) -> Column:
    """Type 2: (audio text)*."""
    return framed(F.array_join(F.transform(chunks, lambda c: F.concat(spoken(c["audio"]), written(c["text"]))), ""))


def speaker_tagged(chunks: Column) -> Column:
    """Type 1 with the speaker's number before each text; array<struct<text, audio, speaker: int>>."""
    one = lambda c: F.concat(written(strip(c["text"]), F.concat(F.lit("["), c["speaker"].cast("string"), F.lit("]"))), spoken(c["audio"]))
    return framed(F.array_join(F.transform(chunks, one), ""))


def bare(text: Column, audio: Column, audio_leads: bool) -> Column:
    """Recognition (audio leads) or synthesis rows without the frame."""
    return F.concat(spoken(audio), written(text)) if audio_leads else F.concat(written(text), spoken(audio))


def zero_shot_pair(text: Column, audio: Column, next_text: Column, next_audio: Column) -> Column:
    return framed(written(text, "[0]"), spoken(audio), written(next_text, "[0]"), spoken(next_audio))


def translation(source_audio: Column, source_text: Column, target_text: Column, target_audio: Column, lang: Column, method: str = "method1") -> Column:
    if method == "method2":
        return F.lit(BOS)
    if method != "method1":
        raise ValueError(f"unknown method {method}")
    tag = F.concat(F.lit("<language>"), lang, F.lit("</language>"))
    return framed(spoken(source_audio), written(source_text, tag), written(target_text, "<language>en</language>"), spoken(target_audio))


def has_type(doc_id: Column, kind: int) -> Column:
    return doc_id.endswith(f"_type{kind}")


def without_type(doc_id: Column, kind: int) -> Column:
    return F.regexp_replace(doc_id, f"_type{kind}$", "")


def tts_prompt(text: Column) -> Column:
    return F.replace(text, F.lit(TS), F.lit(TS + "[0]"))


def acoustic(text: Column) -> Column:
    """Without transcripts. Only a line feed ends a line here; a transcript that holds one stays."""
    return F.regexp_replace(text, f"(?d){_lit(TS)}.*?{_lit(TE)}", "")


def semantic(text: Column, alphabet: Alphabet = Alphabet()) -> Column:
    """Of an acoustic document the characters of codebook 0; a segment that isn't of whole frames stops the job."""
    parts = F.regexp_extract_all(text, F.lit(f"(?s){_lit(AS)}(.*?){_lit(AE)}"), F.lit(1))
    whole = F.forall(parts, lambda p: F.length(p) % alphabet.codebooks == 0)
    return F.when(whole, F.regexp_replace(text, alphabet.semantic_pattern(), "$1")).otherwise(F.raise_error(F.lit("a segment is not of whole frames")).cast("string"))


def repaired(text: Column) -> Column:
    """One blank less after each text start, one less before each text end."""
    return F.replace(F.replace(text, F.lit(TS + " "), F.lit(TS)), F.lit(" " + TE), F.lit(TE))


def codec_tokens(text: Column, alphabet: Alphabet = Alphabet()) -> Column:
    """Tokens under a vocabulary without merges: one for each codec character and special token, one for each word else."""
    marks = "|".join(map(_lit, (BOS, EOS, TS, TE, AS, AE))) + f"|[{alphabet._class(0, alphabet.codebooks - 1)}]"
    n_marks = F.size(F.regexp_extract_all(text, F.lit(f"({marks})"), F.lit(1)))
    return (n_marks + words(F.regexp_replace(text, marks, " "))).cast("long")


def words(text: Column) -> Column:
    """Runs without blanks, tabs and line ends."""
    return F.size(F.regexp_extract_all(text, F.lit("([^ \\t\\n\\r]+)"), F.lit(1)))
