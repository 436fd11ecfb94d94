"""Queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import plugins
from ..functions import display, ids, markup
from ..functions.alphabet import Alphabet
from ..operators import audits, documents, encoding, merges, sequences, statistics
from ..session import bound_batches, checkpoint_folder
from ..sources import numbered, publish, readers, writers
from ..streaming import ingest, late
from . import recipes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
A = Alphabet()


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def scratch(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors see."""
    return f"{checkpoint_folder(spark)}/scratch-{uuid.uuid4()}"


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def codes(self) -> DataFrame:
        """(vec_id, codes): 64 floats as 8 codebooks of 8 frames."""
        level = lambda x: F.least(F.lit(2047), F.greatest(F.lit(0), F.floor((x.cast("double") + 1) * 1024).cast("int")))
        row = lambda k: F.transform(F.slice("embedding", k * 8 + 1, F.lit(8)), level)
        return self.embeddings.select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(7)), row).alias("codes"))

    def audio(self) -> DataFrame:
        return self.codes().select("vec_id", A.encode(F.col("codes")).alias("audio_str"))

    def utterances(self) -> DataFrame:
        """Conversation turns, each with the codec string of one vector."""
        n = F.broadcast(self.embeddings.agg(F.count(F.lit(1)).alias("n")))  # one row
        keyed = self.conversations.join(n).withColumn("vec_id", (F.col("conv_id") * 8 + F.col("turn")) % F.col("n")).drop("n")
        return keyed.join(self.audio(), "vec_id")

    def chats(self) -> DataFrame:
        return documents.imploded(self.utterances(), ["conv_id"], ["turn"], text=F.col("text"), audio=F.col("audio_str"))

    def pretrain(self) -> DataFrame:
        return documents.pretrain_rows(self.chats(), "conv_id")

    def spans(self) -> DataFrame:
        """Events as utterances: seconds from the start of 2024, lasting value minutes."""
        begin = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") / 1e6
        return self.events.select("event_id", "user_id", "event_type", "value", begin.alias("begin")).withColumn("end", F.col("begin") + F.col("value") * 60.0)


AUDIO = """audio AS (
  SELECT vec_id, array_to_string([chr(CAST(57344 + (i % 8) * 2048 + least(2047, greatest(0, floor((CAST(embedding[(i % 8) * 8 + i // 8 + 1] AS DOUBLE) + 1) * 1024))) AS INT)) FOR i IN range(64)], '') AS audio_str
  FROM embeddings)"""
UTTERANCES = AUDIO + """, u AS (
  SELECT conv_id, turn, role, text, audio_str FROM conversations c JOIN audio a ON (c.conv_id * 8 + c.turn) % (SELECT count(*) FROM embeddings) = a.vec_id)"""
PRETRAIN = UTTERANCES + """, one AS (
  SELECT conv_id, '<|begin_of_text|>' || string_agg('<|text_start|>' || text || '<|text_end|><|audio_start|>' || audio_str || '<|audio_end|>', '' ORDER BY turn) || '<|end_of_text|>' AS text FROM u GROUP BY conv_id
), two AS (
  SELECT conv_id, '<|begin_of_text|>' || string_agg('<|audio_start|>' || audio_str || '<|audio_end|><|text_start|>' || text || '<|text_end|>', '' ORDER BY turn) || '<|end_of_text|>' AS text FROM u GROUP BY conv_id
), p AS (SELECT conv_id || '_type1' AS id, 'train' AS split, text FROM one UNION ALL SELECT conv_id || '_type2', 'train', text FROM two)"""
SPANS = "s AS (SELECT event_id, user_id, event_type, value, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS b, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 + value * 60.0 AS e FROM events)"
WORDS = "len(regexp_extract_all(text, '[^ \\t\\n\\r]+'))"

#: The code of codebook k at frame t.
LEVELS = "CAST(least(2047, greatest(0, floor((CAST(embedding[k * 8 + t + 1] AS DOUBLE) + 1) * 1024))) AS INT)"

# codec


@query(f"WITH {AUDIO} SELECT vec_id, audio_str FROM audio")
def codec_encode(spark, d):
    return Tables(spark, d).audio()


@query(f"SELECT vec_id, CAST(k AS INT) AS codebook, array_to_string([{LEVELS} FOR t IN range(8)], ',') AS codes FROM embeddings, range(8) r(k)")
def codec_roundtrip(spark, d):
    back = Tables(spark, d).codes().select("vec_id", F.posexplode(A.decode(A.encode(F.col("codes")))).alias("codebook", "row"))
    return back.select("vec_id", "codebook", F.array_join("row", ",").alias("codes"))


@query(f"WITH {AUDIO} SELECT CAST(least(7, (unicode(audio_str[i]) - 57344) // 2048) AS INT) AS codebook, count(*) AS n FROM audio, range(1, 65) r(i) GROUP BY 1")
def codec_resolve_histogram(spark, d):
    return Tables(spark, d).audio().select(F.explode(A.points(F.col("audio_str"))).alias("c")).groupBy(A.codebook(F.col("c")).alias("codebook")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {AUDIO}, c AS (SELECT vec_id, substr(audio_str, 4, 57) AS s FROM audio), "
    r"b AS (SELECT vec_id, s, regexp_extract(s, '^[^\x{E000}-\x{E7FF}]*') AS begin_hanging FROM c), r AS (SELECT vec_id, begin_hanging, substr(s, length(begin_hanging) + 1) AS rest FROM b) "
    r"SELECT vec_id, begin_hanging, regexp_extract(rest, '^(?s:.*[\x{11800}-\x{11FFF}])?') AS body, substr(rest, length(regexp_extract(rest, '^(?s:.*[\x{11800}-\x{11FFF}])?')) + 1) AS end_hanging FROM r"
)
def codec_drop_hanging(spark, d):
    rows = Tables(spark, d).audio().select("vec_id", A.trimmed(F.substring("audio_str", 4, 57)).alias("t"))
    return rows.select("vec_id", F.col("t.begin").alias("begin_hanging"), F.col("t.body").alias("body"), F.col("t.end").alias("end_hanging"))


@query(
    f"""WITH RECURSIVE {AUDIO}, c AS (SELECT vec_id, array_to_string([audio_str[i] FOR i IN range(1, 65) IF i % 11 <> 0], '') AS s FROM audio),
 f AS (SELECT vec_id, s, 0 AS pos, greatest(0, least(7, (unicode(s[1]) - 57344) // 2048)) AS wait, '' AS kept FROM c
   UNION ALL SELECT vec_id, s, pos + 1, CASE WHEN least(7, (unicode(s[pos + 1]) - 57344) // 2048) = wait THEN (wait + 1) % 8 ELSE wait END,
     CASE WHEN least(7, (unicode(s[pos + 1]) - 57344) // 2048) = wait THEN kept || s[pos + 1] ELSE kept END FROM f WHERE pos < length(s))
 SELECT vec_id, kept FROM f WHERE pos = length(s)"""
)
def codec_drop_inconsistent(spark, d):
    cut = F.array_join(F.filter(F.split("audio_str", ""), lambda c, i: (i + 1) % 11 != 0), "")
    return Tables(spark, d).audio().select("vec_id", A.consistent(cut).alias("kept"))


@query(f"WITH {AUDIO} SELECT vec_id, CAST(k AS INT) AS chunk, substr(audio_str, k * 24 + 1, 24) AS chunk_str FROM audio, range(3) r(k)")
def bpe_chunks(spark, d):
    parts = Tables(spark, d).codes().select("vec_id", F.posexplode(A.chunked(F.col("codes"), 3)).alias("chunk", "m"))
    return parts.select("vec_id", "chunk", A.encode(F.col("m")).alias("chunk_str"))


@query(f"WITH {AUDIO}, p AS (SELECT unicode(audio_str[i]) AS point FROM audio, range(1, 65) r(i)) SELECT CAST(point AS BIGINT) AS point, CAST(least(7, (point - 57344) // 2048) AS INT) AS codebook, CAST((point - 57344) % 2048 AS INT) AS code, count(*) AS n FROM p GROUP BY ALL")
def codec_alphabet(spark, d):
    """The part of the initial alphabet that the codec strings use."""
    letters = spark.createDataFrame([(c,) for c in merges.initial_alphabet(A)], "letter string")
    used = Tables(spark, d).audio().select(F.explode(F.split("audio_str", "")).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    point = F.ascii("letter")
    return used.join(F.broadcast(letters), "letter").select(point.cast("long").alias("point"), A.codebook(point).alias("codebook"), ((point - A.offset) % A.size).cast("int").alias("code"), "n")


@query()
def merged_tokens(spark, d):
    """Token counts and ids of every codec string by merges trained on all of them; brute force in the tests."""
    rows, plan = Tables(spark, d).audio(), merges.MergePlan(A, vocab_size=17_000, max_ngrams=2)
    learned = merges.train(rows, "audio_str", plan, rounds=24)
    out = merges.encoded(rows, "audio_str", learned, plan)
    return out.select("vec_id", F.size("ids").cast("long").alias("n_tokens"), F.array_join("ids", ",").alias("ids"))


@query(f"SELECT vec_id, CAST(k AS INT) AS codebook, array_to_string([{LEVELS} FOR t IN range(8)], ',') AS codes FROM embeddings, range(2) r(k)")
def codec_truncate(spark, d):
    two = Alphabet(codebooks=2)
    rows = Tables(spark, d).codes().select("vec_id", F.posexplode(two.truncated(F.col("codes"))).alias("codebook", "row"))
    return rows.select("vec_id", "codebook", F.array_join("row", ",").alias("codes"))


@query(f"WITH r AS (SELECT vec_id, k, [{LEVELS} FOR t IN range(1, 8)] AS codes FROM embeddings, range(8) r(k)) SELECT vec_id, CAST(k AS INT) AS codebook, array_to_string(codes, ',') AS codes FROM r")
def codec_robust(spark, d):
    """Strings that begin within a frame: what hangs over goes, the whole frames are left."""
    back = Tables(spark, d).audio().select("vec_id", F.posexplode(A.robust(F.substring("audio_str", 4, 61))).alias("codebook", "row"))
    return back.select("vec_id", "codebook", F.array_join("row", ",").alias("codes"))


@query(
    """WITH c AS (SELECT doc_id, generate_subscripts(string_split(text, ''), 1) - 1 AS place, unicode(unnest(string_split(text, ''))) AS point FROM documents WHERE text <> ''),
    f AS (SELECT doc_id, place // 1920 AS frame, CAST(floor((sum(CAST(point % 256 AS DOUBLE) / 256 - 0.5) / 1920 + 1) / 2 * 2047) AS INT) AS v FROM c GROUP BY ALL)
    SELECT doc_id, CAST(k AS INT) AS codebook, count(*) AS n_frames, CAST((max(frame) + 5) // 5 AS INT) AS parts, string_agg(CAST((v + k) % 2048 AS VARCHAR), ',' ORDER BY frame) AS codes FROM f, range(8) r(k) GROUP BY doc_id, k"""
)
def encoded_recordings(spark, d):
    """Whole texts as recordings, a sample for each character, in parts of five frames: encoded in batches of like length."""
    sample = lambda c: ((F.ascii(c) % 256).cast("float") / 256 - 0.5).cast("float")
    recordings = Tables(spark, d).documents.select("doc_id", F.when(F.col("text") != "", F.transform(F.split("text", ""), sample)).alias("samples"))
    whole = encoding.encoded_audio(recordings, "doc_id", "samples", plugins.Energy, limit=0.4)
    rows = whole.select("doc_id", "parts", F.posexplode("codes").alias("codebook", "row"))
    return rows.select("doc_id", "codebook", F.size("row").cast("long").alias("n_frames"), "parts", F.array_join("row", ",").alias("codes"))


# documents and views


@query(f"WITH {PRETRAIN} SELECT id, split, text FROM p")
def pretrain_rows(spark, d):
    return Tables(spark, d).pretrain()


@query(f"WITH {PRETRAIN} SELECT conv_id, text FROM one")
def interleave_type1(spark, d):
    return Tables(spark, d).chats().select("conv_id", markup.text_first(F.col("chunks")).alias("text"))


@query(f"WITH {PRETRAIN} SELECT conv_id, text FROM two")
def interleave_type2(spark, d):
    return Tables(spark, d).chats().select("conv_id", markup.audio_first(F.col("chunks")).alias("text"))


@query(
    f"""WITH {UTTERANCES}, f AS (SELECT conv_id, role, min(turn) AS first FROM u GROUP BY 1, 2), k AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY first) - 1 AS n FROM f),
 t AS (SELECT u.*, n FROM u JOIN k USING (conv_id, role))
 SELECT CAST(conv_id AS VARCHAR) AS id, 'train' AS split, '<|begin_of_text|>' || string_agg('<|text_start|>[' || n || ']' || trim(text, ' ' || chr(9) || chr(10) || chr(13)) || '<|text_end|><|audio_start|>' || audio_str || '<|audio_end|>', '' ORDER BY turn) || '<|end_of_text|>' AS text,
   string_agg(CAST(n AS VARCHAR), ',' ORDER BY turn) AS speakers, CAST(count(DISTINCT n) AS INT) AS speaker_count FROM t GROUP BY conv_id"""
)
def speaker_tagged_docs(spark, d):
    rows = recipes.conversations(Tables(spark, d).utterances(), "conv_id", "turn", "role", recipes.Recipe(audio="audio_str"))
    return rows.select("id", "split", "text", F.array_join(F.col("speaker_ids").cast("array<string>"), ",").alias("speakers"), "speaker_count")


@query(
    f"""WITH {UTTERANCES}, c AS (SELECT conv_id, turn, conv_id || ':' || turn AS pid, trim(trim(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '"'), '''') AS t, audio_str AS a FROM u),
 n AS (SELECT *, lead(pid) OVER w AS pid2, lead(t) OVER w AS t2, lead(a) OVER w AS a2 FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
 SELECT pid || '#' || pid2 AS id, '<|begin_of_text|><|text_start|>[0]' || t || '<|text_end|><|audio_start|>' || a || '<|audio_end|><|text_start|>[0]' || t2 || '<|text_end|><|audio_start|>' || a2 || '<|audio_end|><|end_of_text|>' AS text, conv_id
 FROM n WHERE pid2 IS NOT NULL"""
)
def tts_pairs(spark, d):
    rows = Tables(spark, d).utterances().withColumn("pid", F.concat_ws(":", "conv_id", "turn"))
    return recipes.tts_pairs(rows, ["conv_id"], ["turn"], recipes.Recipe(id="pid", clean="unquoted"))


@query(f"WITH {PRETRAIN} SELECT regexp_replace(id, '_type2$', '') AS id, text FROM p WHERE id LIKE '%\\_type2' ESCAPE '\\'")
def asr_view(spark, d):
    return _view(spark, d, 2, lambda t: t)


@query(f"WITH {PRETRAIN} SELECT regexp_replace(id, '_type2$', '') AS id, regexp_replace(text, '<\\|text_start\\|>.*?<\\|text_end\\|>', '', 'g') AS text FROM p WHERE id LIKE '%\\_type2' ESCAPE '\\'")
def acoustic_view(spark, d):
    return _view(spark, d, 2, markup.acoustic)


@query(
    f"WITH {PRETRAIN} SELECT regexp_replace(id, '_type2$', '') AS id, regexp_replace(regexp_replace(text, '<\\|text_start\\|>.*?<\\|text_end\\|>', '', 'g'), "
    "'([\\x{E000}-\\x{E7FF}])[\\x{E800}-\\x{11FFF}]{7}', '\\1', 'g') AS text FROM p WHERE id LIKE '%\\_type2' ESCAPE '\\'"
)
def semantic_view(spark, d):
    return _view(spark, d, 2, lambda t: markup.semantic(markup.acoustic(t)))


@query(f"WITH {PRETRAIN} SELECT regexp_replace(id, '_type1$', '') AS id, replace(text, '<|text_start|>', '<|text_start|>[0]') AS text FROM p WHERE id LIKE '%\\_type1' ESCAPE '\\'")
def tts0_view(spark, d):
    return _view(spark, d, 1, markup.tts_prompt)


def _view(spark, d, kind, rewrite):
    rows = Tables(spark, d).pretrain().filter(markup.has_type(F.col("id"), kind))
    return rows.select(markup.without_type(F.col("id"), kind).alias("id"), rewrite(F.col("text")).alias("text"))


@query(
    """SELECT conv_id, turn, replace(replace('<|text_start|>  ' || text || ' <|text_end|>', '<|text_start|> ', '<|text_start|>'), ' <|text_end|>', '<|text_end|>') AS text FROM conversations"""
)
def whitespace_repair(spark, d):
    padded = F.concat(F.lit("  "), F.col("text"), F.lit(" "))
    return Tables(spark, d).conversations.select("conv_id", "turn", markup.repaired(markup.written(padded)).alias("text"))


@query(
    f"""WITH {UTTERANCES}, n AS (SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN 'de' ELSE 'fr' END AS lang, text, audio_str, lead(text) OVER w AS t2, lead(audio_str) OVER w AS a2 FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
 SELECT conv_id || ':' || turn AS id, lang, '<|begin_of_text|><|audio_start|>' || audio_str || '<|audio_end|><|text_start|><language>' || lang || '</language>' || text || '<|text_end|><|text_start|><language>en</language>' || t2
  || '<|text_end|><|audio_start|>' || a2 || '<|audio_end|><|end_of_text|>' AS text FROM n WHERE t2 IS NOT NULL"""
)
def speech_translation_text(spark, d):
    pairs = sequences.consecutive_pairs(Tables(spark, d).utterances(), ["conv_id"], ["turn"], ["text", "audio_str"])
    rows = pairs.select(
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.when(F.col("conv_id") % 2 == 0, "de").otherwise("fr").alias("lang"),
        F.col("text").alias("original_text"),
        F.col("audio_str").alias("original_audio_str"),
        F.col("next_text").alias("translated_text"),
        F.col("next_audio_str").alias("translated_audio_str"),
    )
    return recipes.translations(rows)


@query(
    f"""WITH {UTTERANCES} SELECT conv_id || ':' || turn AS id, 'asr' AS view, '<|audio_start|>' || audio_str || '<|audio_end|><|text_start|>' || lower(text) || '<|text_end|>' AS text FROM u
 UNION ALL SELECT conv_id || ':' || turn, 'tts', '<|text_start|>' || lower(text) || '<|text_end|><|audio_start|>' || audio_str || '<|audio_end|>' FROM u"""
)
def bare_asr_tts(spark, d):
    rows = Tables(spark, d).utterances().withColumn("uid", F.concat_ws(":", "conv_id", "turn"))
    return recipes.bare_rows(rows, recipes.Recipe(id="uid", clean="lower"))


@query("SELECT lang, count(*) AS original, count(*) FILTER (n_chars >= 1500) AS filtered, 100.0 * count(*) FILTER (n_chars >= 1500) / count(*) AS pct FROM documents GROUP BY lang")
def view_ratio(spark, d):
    return statistics.filter_ratio(Tables(spark, d).documents.select("lang", "n_chars"), F.col("n_chars") >= 1500, ["lang"])


@query(
    f"WITH {PRETRAIN} SELECT id, CAST(len(regexp_extract_all(text, '<\\|(?:begin_of_text|end_of_text|text_start|text_end|audio_start|audio_end)\\|>|[\\x{{E000}}-\\x{{11FFF}}]'))"
    " + len(regexp_extract_all(regexp_replace(text, '<\\|(?:begin_of_text|end_of_text|text_start|text_end|audio_start|audio_end)\\|>|[\\x{E000}-\\x{11FFF}]', ' ', 'g'), '[^ \\t\\n\\r]+')) AS BIGINT) AS n_tokens FROM p"
)
def codec_token_counts(spark, d):
    return Tables(spark, d).pretrain().select("id", markup.codec_tokens(F.col("text")).alias("n_tokens"))


# sequences


@query(
    f"""WITH {SPANS}, n AS (SELECT *, CASE WHEN abs(b - lag(e) OVER (PARTITION BY user_id ORDER BY b, event_id)) > 3600 THEN 1 ELSE 0 END AS new FROM s)
 SELECT event_id, user_id, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY b, event_id ROWS UNBOUNDED PRECEDING) AS INT) AS segment_index FROM n"""
)
def gap_sessions(spark, d):
    return sequences.gap_sessions(Tables(spark, d).spans(), ["user_id"], "begin", "end", "event_id", 3600.0).select("event_id", "user_id", "segment_index")


@query(
    f"""WITH {SPANS}, n AS (SELECT *, CASE WHEN abs(b - lag(e) OVER (PARTITION BY user_id ORDER BY b, event_id)) > 3600 THEN 1 ELSE 0 END AS new FROM s),
 g AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY b, event_id ROWS UNBOUNDED PRECEDING) AS INT) AS seg FROM n),
 a AS (SELECT user_id, seg, arg_min(event_id, (b, event_id)) AS entry, CAST(count(*) AS INT) AS num_segments, string_agg(event_type, ' ' ORDER BY b, event_id) AS said FROM g GROUP BY 1, 2)
 SELECT user_id, entry || CASE WHEN count(*) OVER (PARTITION BY user_id) > 1 THEN '_seg' || seg ELSE '' END || '_type1' AS id, num_segments, said FROM a"""
)
def gap_session_docs(spark, d):
    cut = sequences.gap_sessions(Tables(spark, d).spans(), ["user_id"], "begin", "end", "event_id", 3600.0)
    segs = sequences.segment_documents(cut, ["user_id"], "begin", "event_id", F.col("event_type"))
    name = sequences.segment_id(F.col("entry").cast("string"), F.col("segment_index"), F.col("n_segments"), 1)
    return segs.select("user_id", name.alias("id"), "num_segments", F.array_join("chunks", " ").alias("said"))


@query("WITH c AS (SELECT o_custkey, (dense_rank() OVER (ORDER BY o_custkey) - 1) // 10 AS b FROM orders) SELECT CAST(b AS INT) AS batch, count(DISTINCT o_custkey) AS speakers, count(*) AS n FROM c GROUP BY b")
def speaker_batches(spark, d):
    rows = sequences.group_batches(Tables(spark, d).orders.select("o_custkey"), "o_custkey", 10)
    return rows.groupBy("batch").agg(F.countDistinct("o_custkey").alias("speakers"), F.count(F.lit(1)).alias("n"))


@query("WITH r AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS c FROM documents) SELECT CAST(c AS INT) AS chunk, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last, CAST(sum(length(text)) AS BIGINT) AS chars, min(md5(text)) AS least, count(DISTINCT source || lang) AS kinds FROM r GROUP BY c")
def fixed_chunks(spark, d):
    path = scratch(spark)
    writers.fixed_chunks(Tables(spark, d).documents, path, ["doc_id"], 100)
    rows = spark.read.parquet(path).groupBy("chunk")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum(F.length("text")).alias("chars"), F.min(F.md5(F.col("text").cast("binary"))).alias("least"), F.countDistinct(F.concat("source", "lang")).alias("kinds"))


@query("WITH r AS (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS c FROM documents) SELECT CAST(c AS INT) AS chunk, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last, CAST(sum(length(text)) AS BIGINT) AS chars FROM r GROUP BY c")
def resumed_chunks(spark, d):
    """Chunks of which an interrupted job has left some, and some only in part."""
    path, docs = scratch(spark), Tables(spark, d).documents
    left = sequences.indexed(docs, ["doc_id"]).withColumn("chunk", F.floor(F.col("position") / 100).cast("int"))
    left = left.filter((F.col("chunk") % 3 != 1) & ((F.col("chunk") % 5 != 2) | (F.col("position") % 100 < 50))).drop("position")
    left.write.partitionBy("chunk").parquet(path)
    writers.fixed_chunks(docs, path, ["doc_id"], 100, resume=True)
    return spark.read.parquet(path).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum(F.length("text")).alias("chars"))


@query("SELECT o_orderkey::VARCHAR AS entry_id, o_custkey::VARCHAR AS speaker_id, o_orderstatus AS book_id, CAST(o_totalprice AS DOUBLE) AS begin_time FROM orders WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders GROUP BY o_custkey)")
def utterance_files(spark, d):
    """The first order of each customer as a file of its own; half of them were written by a job before."""
    path = scratch(spark)
    first = Tables(spark, d).orders.groupBy("o_custkey").agg(F.min_by(F.struct("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey").alias("o"))
    text = lambda c: F.col(c).cast("string")
    rows = first.select(text("o.o_orderkey").alias("entry_id"), text("o_custkey").alias("speaker_id"), F.col("o.o_orderstatus").alias("book_id"), F.col("o.o_totalprice").cast("double").alias("begin_time"), F.lit(0.0).alias("end_time"))
    writers.utterance_tree(rows.filter(F.crc32(F.col("entry_id").cast("binary")) % 2 == 0), path)
    writers.utterance_tree(rows, path)
    return readers.utterance_tree(spark, path).select("entry_id", "speaker_id", "book_id", "begin_time")


@query("WITH g AS (SELECT coalesce(source, 'none') || '-' || doc_id % 8 AS part, doc_id % 8 = 3 AS failed, count(*) AS n FROM documents GROUP BY 1, 2) SELECT part, failed, CASE WHEN failed THEN 0 ELSE n END AS documents, CASE WHEN failed THEN 0 ELSE 2 * n END AS n_rows FROM g")
def ingest_ledger(spark, d):
    """Documents as JSON array files, some of them cut short, taken by the stream: what the ledger tells, and the rows there are."""
    base, docs = scratch(spark), Tables(spark, d).documents
    part = F.concat(F.coalesce("source", F.lit("none")), F.lit("-"), (F.col("doc_id") % 8).cast("string"))
    code = F.array_repeat(F.array((F.col("doc_id") % A.size).cast("int")), A.codebooks)
    one = F.struct(F.col("doc_id").cast("string").alias("audio_id"), F.create_map(F.lit("0"), F.coalesce("text", F.lit(""))).alias("text"), F.create_map(F.lit("0"), code).alias("codes"))
    files = docs.groupBy(part.alias("part"), (F.col("doc_id") % 8 == 3).alias("cut")).agg(F.to_json(F.collect_list(one)).alias("line"))
    files.select("part", F.when(F.col("cut"), F.expr("substring(line, 1, length(line) - 9)")).otherwise(F.col("line")).alias("line")).write.partitionBy("part").text(f"{base}/in")
    ingest.prepare(spark, f"{base}/in", f"{base}/out", f"{base}/log", 1000, A)
    told = ingest.ledger(spark, f"{base}/out").select(F.regexp_extract("path", "/part=([^/]*)/", 1).alias("part"), "failed", "documents")
    made = ingest.prepared(spark, f"{base}/out").select(F.regexp_extract("id", "^(.*)_type[12]$", 1).cast("long").alias("doc_id"))
    made = made.join(docs.select("doc_id", part.alias("part")), "doc_id").groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))
    return told.join(made, "part", "left").select("part", "failed", "documents", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, source, lang, n_chars, md5(text) AS digest FROM documents")
def indexed_rows(spark, d):
    rows = sequences.indexed(Tables(spark, d).documents, ["doc_id"])
    return rows.select("doc_id", "position", "source", "lang", "n_chars", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    """WITH d AS (SELECT source, doc_id, l.doc_id IS NOT NULL AS ok FROM documents LEFT JOIN labels l USING (doc_id)),
 r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos, sum(ok::INT) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS island FROM d),
 f AS (SELECT *, sum((NOT ok)::INT) OVER (PARTITION BY source, island ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS fails FROM r),
 c AS (SELECT source, min(pos) AS cut FROM f WHERE fails = 5 GROUP BY source)
 SELECT source, doc_id FROM f LEFT JOIN c USING (source) WHERE ok AND (cut IS NULL OR pos < cut)"""
)
def consecutive_missing_cut(spark, d):
    t = Tables(spark, d)
    rows = t.documents.select("source", "doc_id").join(t.labels.select("doc_id", F.lit(True).alias("ok")), "doc_id", "left")
    return sequences.until_misses(rows, "source", "doc_id", F.coalesce("ok", F.lit(False))).select("source", "doc_id")


@query(
    """WITH RECURSIVE u AS (SELECT lang, source, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY source) AS pos FROM documents GROUP BY 1, 2),
 f AS (SELECT lang, source, n, pos, 0 AS batch, CASE WHEN n >= 25 THEN 0 ELSE n END AS held, n >= 25 AS full FROM u WHERE pos = 1
  UNION ALL SELECT u.lang, u.source, u.n, u.pos, f.batch + f.full::INT, CASE WHEN f.held + u.n >= 25 THEN 0 ELSE f.held + u.n END, f.held + u.n >= 25 FROM f JOIN u ON u.lang = f.lang AND u.pos = f.pos + 1)
 SELECT lang, source, n, CAST(batch AS INT) AS batch FROM f"""
)
def threshold_batches(spark, d):
    units = Tables(spark, d).documents.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return sequences.threshold_batches(units, "lang", "source", "n", 25)


@query("WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(source || '|' || doc_id || '|42'), doc_id) AS n FROM documents) SELECT source, doc_id FROM r WHERE n <= 5")
def shard_sample_k(spark, d):
    return sequences.sample_per_group(Tables(spark, d).documents.select("source", "doc_id"), "source", ["doc_id"], 5)


@query("SELECT n_name FROM nation WHERE n_name >= 'NATION_15'")
def resume_from(spark, d):
    return sequences.resume_from(Tables(spark, d).nation.select("n_name"), "n_name", "NATION_15")


# statistics


@query(f"SELECT lang, count(*) AS num_documents, CAST(sum({WORDS}) AS BIGINT) AS total_tokens, sum({WORDS}) / greatest(count(*), 1) AS avg_tokens FROM documents GROUP BY lang")
def tokens_by_language(spark, d):
    return statistics.token_stats(Tables(spark, d).documents, "lang", markup.words(F.col("text")))


@query(f"SELECT coalesce(lang, 'TOTAL') AS lang, count(*) AS num_documents, CAST(sum({WORDS}) AS BIGINT) AS total_tokens FROM documents GROUP BY GROUPING SETS ((lang), ())")
def tokens_total_rollup(spark, d):
    rows = statistics.token_stats(Tables(spark, d).documents, "lang", markup.words(F.col("text")), total=True)
    return rows.select(F.coalesce("lang", F.lit("TOTAL")).alias("lang"), "num_documents", "total_tokens")


@query(
    f"""WITH r AS (SELECT lang, {WORDS} AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n, count(*) OVER (PARTITION BY lang) AS docs FROM documents)
 SELECT lang, count(*) AS sample, CAST(sum(t) AS BIGINT) AS tokens, CAST(trunc(sum(t) * (max(docs) / CAST(count(*) AS DOUBLE))) AS BIGINT) AS estimate FROM r WHERE n <= 50 GROUP BY lang"""
)
def extrapolate_tokens(spark, d):
    docs = Tables(spark, d).documents
    first = sequences.first_per_group(docs.select("lang", "doc_id", "text"), "lang", ["doc_id"], F.lit(50))
    sums = first.groupBy("lang").agg(F.count(F.lit(1)).alias("sample"), F.sum(markup.words(F.col("text"))).alias("tokens"))
    sized = sums.join(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "lang")
    return sized.select("lang", "sample", "tokens", statistics.extrapolated(F.col("tokens"), F.col("sample"), F.col("docs")).alias("estimate"))


@query(
    f"""WITH q AS (SELECT lang, greatest(1, CAST(trunc(200 * (count(*) / (SELECT count(*) FROM documents)::DOUBLE)) AS INT)) AS quota FROM documents GROUP BY lang),
 r AS (SELECT lang, {WORDS} AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents)
 SELECT lang, quota, count(*) AS taken, CAST(sum(t) AS BIGINT) AS tokens FROM r JOIN q USING (lang) WHERE n <= quota GROUP BY lang, quota ORDER BY tokens DESC, lang LIMIT 10"""
)
def stratified_sample(spark, d):
    docs = Tables(spark, d).documents
    counts = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    quotas = counts.join(F.broadcast(total)).select("lang", sequences.proportional_quota(F.col("n"), F.col("all"), 200).alias("quota"))
    # ids are ranked, and only the few chosen ones meet their texts; quotas have a row for each language
    chosen = sequences.first_per_group(docs.select("lang", "doc_id").join(F.broadcast(quotas), "lang"), "lang", ["doc_id"], F.col("quota"), most=200)
    rows = docs.select("lang", "doc_id", "text").join(chosen, ["lang", "doc_id"])
    return rows.groupBy("lang", "quota").agg(F.count(F.lit(1)).alias("taken"), F.sum(markup.words(F.col("text"))).alias("tokens")).orderBy(F.desc("tokens"), "lang").limit(10)


ROWS = "SELECT lang, source AS shard, source || '/' || (doc_id // 50) AS sub, count(*) AS n FROM documents GROUP BY ALL"


def _files(t: Tables) -> DataFrame:
    sub = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 50))
    return t.documents.groupBy("lang", F.col("source").alias("shard"), sub.alias("sub")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH f AS ({ROWS}) SELECT coalesce(lang, '**TOTAL**') AS lang, CAST(sum(n) AS BIGINT) AS rows, count(DISTINCT shard) AS shards, count(DISTINCT (shard, sub)) AS subshards FROM f GROUP BY GROUPING SETS ((lang), ())")
def rows_per_language(spark, d):
    rows = statistics.rows_by_language(_files(Tables(spark, d)))
    return rows.select(F.coalesce("lang", F.lit("**TOTAL**")).alias("lang"), "rows", "shards", "subshards")


@query(f"WITH f AS ({ROWS}) SELECT lang, CAST(sum(n) AS BIGINT) AS rows, count(DISTINCT shard) AS shards, count(DISTINCT sub) AS subshards FROM f GROUP BY lang")
def report_roundtrip(spark, d):
    lines = statistics.report_lines(statistics.rows_by_language(_files(Tables(spark, d))))
    return statistics.parsed_report(lines.select(F.col("line").alias("value")))


@query(
    f"""WITH r AS (SELECT lang, count(*) AS rows, CAST(sum({WORDS}) AS BIGINT) AS t FROM documents GROUP BY lang)
 SELECT lang, rows, CASE WHEN lang <> 'de' THEN t END AS tokens, CASE WHEN lang <> 'de' THEN format('{{:,}}', t) ELSE 'XXX' END AS shown FROM r"""
)
def stats_with_tokens(spark, d):
    docs = Tables(spark, d).documents
    sums = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.sum(markup.words(F.col("text"))).alias("t"))
    # as two layouts of a statistics file: some languages have the full count, others the estimate
    layout = F.when(F.col("lang") == "en", F.to_json(F.struct(F.struct(F.col("t").alias("total_tokens")).alias("statistics")))).otherwise(F.to_json(F.struct(F.struct(F.col("t").alias("total_tokens")).alias("extrapolated_statistics"))))
    told = sums.filter("lang <> 'de'").select("lang", layout.alias("j"))
    told = told.select("lang", *[F.get_json_object("j", f"$.{k}.total_tokens").cast("long").alias(n) for k, n in (("statistics", "stat"), ("extrapolated_statistics", "extra"))])
    return statistics.with_tokens(sums.select("lang", "rows"), told)


@query("WITH c AS (SELECT source, count(*) FILTER (toxic = 1) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source) SELECT CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (n > 0) AS shards, avg(n) FILTER (n > 0) AS average, max(n) FILTER (n > 0) AS most, min(n) FILTER (n > 0) AS least FROM c")
def shard_summary(spark, d):
    t = Tables(spark, d)
    counts = t.documents.select("source", "doc_id").join(t.labels, "doc_id", "left").groupBy("source").agg(F.count_if(F.col("toxic") == 1).alias("n"))
    return statistics.unit_summary(counts, "n")


@query("SELECT coalesce(max(TRY_CAST(regexp_extract(url, '([^/.?#]+)(?:\\.html)?(?:[?#].*)?$', 1) AS INT)), -1) + 1 AS next FROM pages")
def next_file_number(spark, d):
    stem = F.regexp_extract("url", r"([^/.?#]+)(?:\.html)?(?:[?#].*)?$", 1)
    return statistics.next_number(Tables(spark, d).pages.select(stem.alias("stem")), "stem")


@query("SELECT CAST(i - 1 AS INT) AS dimension, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean FROM embeddings, range(1, 65) r(i) GROUP BY i")
def embedding_mean(spark, d):
    return statistics.mean_vector(Tables(spark, d).embeddings, "embedding").select("dimension", F.round("mean", 6).alias("mean"))


# audits


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_shards(spark, d):
    t = Tables(spark, d)
    return audits.pending(t.documents.select("doc_id"), t.labels, "doc_id")


@query("WITH e AS (SELECT doc_id AS id FROM documents WHERE lang = 'en'), p AS (SELECT doc_id AS id FROM labels) SELECT id, 'missing' AS side FROM (SELECT id FROM e EXCEPT SELECT id FROM p) UNION ALL SELECT id, 'extra' FROM (SELECT id FROM p EXCEPT SELECT id FROM e)")
def missing_extra(spark, d):
    t = Tables(spark, d)
    return audits.missing_extra(t.documents.filter("lang = 'en'").select(F.col("doc_id").alias("id")), t.labels.select(F.col("doc_id").alias("id")), "id")


@query("SELECT lang, count(*) AS total, count(l.doc_id) AS existing, count(*) - count(l.doc_id) AS missing, count(l.doc_id) * 100.0 / count(*) AS pct FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY lang")
def completeness_by_lang(spark, d):
    t = Tables(spark, d)
    return audits.completeness(t.documents.select("doc_id", "lang"), t.labels, "doc_id", ["lang"])


PROGRESS = """t AS (SELECT s_suppkey, 500 + s_suppkey AS n FROM supplier WHERE s_suppkey % 3 <> 0),
 g AS (SELECT l_suppkey AS s_suppkey, count(*) FILTER (l_returnflag = 'R') AS completed, count(*) FILTER (l_returnflag = 'A') AS failed FROM lineitem GROUP BY 1),
 s AS (SELECT s_suppkey, completed, failed, CAST(coalesce(n, 1000) AS BIGINT) AS total, greatest(0, coalesce(n, 1000) - completed - failed) AS remaining FROM g LEFT JOIN t USING (s_suppkey))"""


def _progress(t: Tables) -> DataFrame:
    totals = t.supplier.filter("s_suppkey % 3 <> 0").select("s_suppkey", (F.col("s_suppkey") + 500).alias("n"))
    units = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_returnflag")
    return audits.progress(units, totals, "s_suppkey", F.col("l_returnflag") == "R", F.col("l_returnflag") == "A")


@query(f"WITH {PROGRESS} SELECT s_suppkey, completed, failed, total, CAST(remaining AS BIGINT) AS remaining, round(completed / total * 100, 6) AS pct, '[' || repeat('█', CAST(trunc(30 * (completed / total * 100) / 100) AS INT)) || repeat('░', 30 - CAST(trunc(30 * (completed / total * 100) / 100) AS INT)) || ']' AS bar FROM s")
def progress_by_shard(spark, d):
    rows = _progress(Tables(spark, d))
    return rows.select("s_suppkey", "completed", "failed", "total", "remaining", F.round("pct", 6).alias("pct"), display.bar(F.col("pct")).alias("bar"))


@query(
    f"""WITH {PROGRESS}, l AS (SELECT n_name, s.* FROM s JOIN supplier USING (s_suppkey) JOIN nation ON s_nationkey = n_nationkey)
 SELECT coalesce(n_name, 'TOTAL') AS n_name, count(*) AS shards, CAST(sum(completed) AS BIGINT) AS completed, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(total) AS BIGINT) AS total, CAST(sum(remaining) AS BIGINT) AS remaining, round(sum(completed) / sum(total) * 100, 6) AS pct
 FROM l GROUP BY GROUPING SETS ((n_name), ())"""
)
def progress_by_language(spark, d):
    t = Tables(spark, d)
    named = _progress(t).join(t.supplier.select("s_suppkey", "s_nationkey"), "s_suppkey").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = audits.rolled_up(named, "n_name")
    return rows.select(F.coalesce("n_name", F.lit("TOTAL")).alias("n_name"), "shards", "completed", "failed", "total", "remaining", F.round("pct", 6).alias("pct"))


@query("SELECT o_orderstatus AS status, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 1")
def status_histogram(spark, d):
    return audits.histogram(Tables(spark, d).orders, F.col("o_orderstatus")).select("status", "n", F.round("pct", 6).alias("pct"))


@query("SELECT lang, CASE WHEN h.doc_id IS NOT NULL THEN 'on_hf' WHEN k.doc_id IS NOT NULL THEN 'local_only' ELSE 'missing' END AS state, count(*) AS n FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 1) h USING (doc_id) LEFT JOIN labels k USING (doc_id) GROUP BY 1, 2")
def upload_state(spark, d):
    t = Tables(spark, d)
    rows = audits.where_kept(t.documents.select("doc_id", "lang"), t.labels.filter("quality = 1"), t.labels, ["doc_id"])
    return rows.groupBy("lang", "state").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'completed' WHEN s_suppkey % 4 = 1 THEN 'not_started' WHEN s_suppkey % 3 = 0 AND s_suppkey % 5 > 0 THEN
   printf('processing_audio (%d/%d = %.1f%%)', s_suppkey, s_suppkey * 4, 25.0) WHEN s_suppkey % 3 = 0 THEN 'processing_audio' WHEN s_suppkey % 7 = 0 THEN 'extraction_complete' WHEN s_suppkey % 2 = 0 THEN 'tar_downloaded' ELSE 'in_progress' END AS state FROM supplier"""
)
def shard_state(spark, d):
    s = Tables(spark, d).supplier.select("s_suppkey")
    k = F.col("s_suppkey")
    done = s.filter(k % 4 == 0).withColumn("status", F.lit("completed"))
    work = s.filter(k % 4 != 1).select(k, (k % 3 == 0).alias("cache_exists"), k.alias("cache_files"), F.when(k % 5 > 0, k * 4).alias("audio_files"), (k % 7 == 0).alias("extracted"), (k % 2 == 0).alias("archived"))
    return audits.shard_state(s, done, work, "s_suppkey")


@query("SELECT doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 0 ELSE 1 END AS part FROM documents LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 1) l USING (doc_id)")
def resume_merge(spark, d):
    t = Tables(spark, d)
    return audits.merged_resume(t.documents.select("doc_id"), t.labels.select("doc_id", "quality"), "doc_id", F.col("quality") == 1).select("doc_id", "part")


@query("WITH g AS (SELECT l_suppkey, count(*) FILTER (l_linestatus = 'F') AS done, count(*) AS total FROM lineitem GROUP BY 1), s AS (SELECT CASE WHEN total > 0 AND done = total THEN 'completed' WHEN done > 0 THEN 'in_progress' ELSE 'not_started' END AS state FROM g) SELECT state, count(*) AS n, CAST(count(*) * 100 // (SELECT count(*) FROM s) AS BIGINT) AS pct FROM s GROUP BY state")
def three_states(spark, d):
    g = Tables(spark, d).lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_linestatus") == "F").alias("done"), F.count(F.lit(1)).alias("total"))
    return audits.three_states(g, "done", "total")


@query("SELECT conv_id, count(*) FILTER (length(text) % 7 = 0) = 0 AS complete FROM conversations GROUP BY conv_id")
def encoded_check(spark, d):
    rows = Tables(spark, d).conversations.withColumn("codes", F.when(F.length("text") % 7 != 0, F.array(F.lit(1))))
    return audits.all_encoded(rows, "conv_id", "codes")


# identifiers

FOLD = "regexp_replace(lower(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[\\t-\\r \\x{85}\\x{A0}]+', ' ', 'g')"
DIGEST = f"replace(replace(rtrim(to_base64(unhex(substr(sha256({FOLD}), 1, 32))), '='), '+', '-'), '/', '_')"


@query(f"SELECT doc_id, source || '-' || lang || '-' || printf('%08d', CAST(trunc(n_chars * CAST(0.29 AS DOUBLE) * 100) AS BIGINT)) || '-' || printf('%08d', CAST(trunc(n_chars * 1.5 * 100) AS BIGINT)) || '-' || {DIGEST} AS entry_id FROM documents")
def entry_ids(spark, d):
    n = F.col("n_chars").cast("double")
    return Tables(spark, d).documents.select("doc_id", ids.entry_id(F.col("source"), F.col("lang"), n * 0.29, n * 1.5, F.col("text")).alias("entry_id"))


@query(f"SELECT {DIGEST} AS digest, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def dedup_entry_first(spark, d):
    rows = Tables(spark, d).documents.select("doc_id", ids.digest(ids.folded(F.col("text"))).alias("digest"))
    return audits.first_by_id(rows, "digest", ["doc_id"]).select("digest", "doc_id")


@query("SELECT event_id, 'user-' || user_id AS audio_id, CAST(event_id % 100000 AS INT) AS idx, CAST(trunc(value * 100) AS INT) AS start_cs, CAST(trunc(value * 100) AS INT) + CAST(event_id % 3 AS INT) AS end_cs, event_id % 3 > 0 AS valid FROM events")
def chunk_id_parse(spark, d):
    e = Tables(spark, d).events
    start = (F.col("value") * 100).cast("int")
    made = ids.chunk_id(F.concat(F.lit("user-"), F.col("user_id").cast("string")), (F.col("event_id") % 100000).cast("int"), start, start + (F.col("event_id") % 3).cast("int"))
    rows = e.select("event_id", ids.chunk_parts(made).alias("p")).select("event_id", "p.*")
    return rows.withColumn("valid", ids.valid_range(F.col("start_cs"), F.col("end_cs")))


@query("SELECT page_id, replace(substr(list_last(string_split(url, 'example')), 2), '.html', '') AS file_id FROM pages")
def file_id_extract(spark, d):
    return Tables(spark, d).pages.select("page_id", ids.file_id(F.col("url"), "example", ".html").alias("file_id"))


@query("WITH p AS (SELECT regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) || regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) || '/' AS path FROM pages) SELECT regexp_extract(path, '^([a-z]{2})[0-9]+/', 1) AS lang, count(*) AS n FROM p WHERE regexp_matches(path, '^[a-z]{2}[0-9]+/') GROUP BY 1")
def lang_from_path(spark, d):
    path = F.concat(F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 1), F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 2), F.lit("/"))
    return Tables(spark, d).pages.select(ids.language_of_path(path).alias("lang")).filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type, count(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def props_json(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return Tables(spark, d).events.groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).alias("total"))


@query(
    """WITH t AS (SELECT event_id, value * 3 AS s, CAST(trunc(value * 3 * 24000) AS BIGINT) AS n FROM events)
 SELECT event_id, CASE WHEN s > 60 THEN (n + 1439999) // 1440000 ELSE 1 END AS parts, CASE WHEN s > 60 THEN n - ((n - 1) // 1440000) * 1440000 ELSE n END AS last_length, CAST(ceil(n / 1920.0) AS BIGINT) AS frames FROM t"""
)
def long_chunk_split(spark, d):
    seconds = F.col("value") * 3
    rows = Tables(spark, d).events.select("event_id", seconds.alias("s"), documents.long_parts(seconds).alias("p"))
    return rows.select("event_id", F.size("p").cast("long").alias("parts"), F.element_at("p", -1)["length"].alias("last_length"), documents.frames((F.col("s") * 24000).cast("long")).alias("frames"))


@query("SELECT event_id, CAST(trunc(value * 100) AS BIGINT) * 24000 // 100 AS first, 240 * (event_id % 7) AS length FROM events")
def sample_ranges(spark, d):
    start = (F.col("value") * 100).cast("long")
    return Tables(spark, d).events.select("event_id", documents.sample_range(start, start + F.col("event_id") % 7).alias("r")).select("event_id", "r.*")



# lists, listings and unions


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5) GROUP BY l_suppkey")
def batch_restricted(spark, d):
    t = Tables(spark, d)
    listed = t.supplier.filter("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey"))
    return audits.restricted(t.lineitem, listed, "l_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH e AS (SELECT source || '/' || lang || '/' || printf('%08d', doc_id) || '.parquet' AS path, source, lang FROM documents),
 p AS (SELECT DISTINCT source || '/' || lang || '/' || printf('%08d', doc_id) || '.parquet' AS path FROM documents JOIN labels USING (doc_id))
 SELECT source, lang, count(*) AS total, count(p.path) AS existing, count(*) - count(p.path) AS missing, count(p.path) * 100.0 / count(*) AS pct FROM e LEFT JOIN p USING (path) GROUP BY source, lang"""
)
def path_completeness(spark, d):
    t = Tables(spark, d)
    path = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), F.format_string("%08d", F.col("doc_id")), F.lit(".parquet")).alias("path")
    published = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi").select(path)
    return audits.completeness(t.documents.select("source", "lang", path), published, "path", ["source", "lang"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')")
def not_queued(spark, d):
    t = Tables(spark, d)
    open_ = t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey")
    return audits.pending(open_, t.lineitem.filter("l_linestatus = 'O'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query(
    "WITH g AS (SELECT l_orderkey, count(*) AS total, count(*) FILTER (l_linestatus = 'F') AS done FROM lineitem GROUP BY 1) SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM g WHERE total = done AND total > 0)"
)
def not_finished(spark, d):
    t = Tables(spark, d)
    done = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("l_linestatus") == "F").alias("done")).filter("total = done and total > 0")
    return audits.pending(t.orders.select("o_orderkey"), done, "o_orderkey")


@query("SELECT lang, lang AS split, count(*) AS n FROM documents WHERE lang IN ('de', 'fr', 'es') GROUP BY lang")
def union_languages(spark, d):
    """A folder for each of the listed languages, read back as one table."""
    docs, path, listed = Tables(spark, d).documents.select("lang", "doc_id"), scratch(spark), ["de", "fr", "es"]
    for lang in listed:
        writers.batched_parquet(docs.filter(F.col("lang") == lang).select("doc_id"), f"{path}/{lang}", 500)
    rows = readers.by_language(spark, path, listed)
    return rows.withColumn("split", ids.language_of_split(F.concat("lang", F.lit("000/1")))).groupBy("lang", "split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT lang || '/' || source AS split, lang FROM documents")
def distinct_splits(spark, d):
    split = F.concat_ws("/", "lang", "source")
    return Tables(spark, d).documents.select(split.alias("split")).distinct().select("split", ids.language_of_split(F.col("split")).alias("lang"))


@query(f"WITH r AS (SELECT doc_id, {WORDS} AS t FROM documents ORDER BY doc_id LIMIT 100) SELECT count(*) AS sample, CAST(sum(t) AS BIGINT) AS tokens, CAST(trunc(sum(t) * ((SELECT count(*) FROM documents) / CAST(count(*) AS DOUBLE))) AS BIGINT) AS estimate, avg(t) * 1000000 AS projected FROM r")
def first_n_estimate(spark, d):
    docs = Tables(spark, d).documents
    sums = docs.orderBy("doc_id").limit(100).select(markup.words(F.col("text")).alias("t")).agg(F.count(F.lit(1)).alias("sample"), F.sum("t").alias("tokens"), F.avg("t").alias("mean"))
    sized = sums.join(F.broadcast(docs.agg(F.count(F.lit(1)).alias("docs"))))  # one row
    return sized.select("sample", "tokens", statistics.extrapolated(F.col("tokens"), F.col("sample"), F.col("docs")).alias("estimate"), (F.col("mean") * 1_000_000).alias("projected"))


@query("SELECT count(DISTINCT lang) AS done, round(count(DISTINCT lang) * 100.0 / 145, 6) AS pct FROM documents")
def token_completion(spark, d):
    return Tables(spark, d).documents.agg(F.countDistinct("lang").alias("done")).select("done", F.round(F.col("done") * 100.0 / 145, 6).alias("pct"))


@query("SELECT 'subshard' AS kind, lpad(CAST(i AS VARCHAR), 8, '0') AS id FROM (SELECT unnest(range((SELECT count(*) FROM documents))) AS i) UNION ALL SELECT 'listed', 'EN-B' || lpad(CAST(i AS VARCHAR), 6, '0') FROM (SELECT unnest(range((SELECT max(s_suppkey) + 1 FROM supplier))) AS i) UNION ALL SELECT 'job', 'job' || lpad(CAST(i AS VARCHAR), 4, '0') FROM (SELECT unnest(range((SELECT count(*) FROM nation))) AS i)")
def generated_ids(spark, d):
    """As many ids as a table has rows by its footers, or as its last number says."""
    named = lambda kind, rows: rows.select(F.lit(kind).alias("kind"), "id")
    last = Tables(spark, d).supplier.agg(F.max("s_suppkey")).first()[0]
    jobs = readers.numbered(spark, readers.row_count(spark, f"{d}/nation.parquet"), "train-%04d-of-1416").select(ids.job_name(F.col("id")).alias("id"))
    return named("subshard", readers.numbered(spark, readers.row_count(spark, f"{d}/documents.parquet"))).unionByName(named("listed", readers.numbered_by(spark, "EN", last))).unionByName(named("job", jobs))


@query("SELECT c_custkey, c_mktsegment || '_' || c_name AS file_id, CASE WHEN contains(c_name, '_') THEN c_mktsegment || '_' || regexp_replace(c_name, '_[^_]*$', '') ELSE c_mktsegment END AS doc_key, substr(c_mktsegment, 1, 2) AS split_lang FROM customer")
def document_keys(spark, d):
    rows = Tables(spark, d).customer.select("c_custkey", F.concat_ws("_", "c_mktsegment", "c_name").alias("file_id"))
    return rows.select("c_custkey", "file_id", ids.document_key(F.col("file_id")).alias("doc_key"), ids.language_of_shard(F.col("file_id")).alias("split_lang"))


@query(
    """WITH s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS n FROM documents GROUP BY source), t AS (SELECT source, n FROM s UNION ALL SELECT source, n * 1000 FROM s UNION ALL SELECT source, n // 1000000 FROM s)
 SELECT source, n, CASE WHEN n >= 1000000000 THEN format('{:,}', n) || ' (' || printf('%.2fB', n / 1e9) || ')' WHEN n >= 1000000 THEN format('{:,}', n) || ' (' || printf('%.2fM', n / 1e6) || ')'
 WHEN n >= 1000 THEN format('{:,}', n) || ' (' || printf('%.2fK', n / 1000.0) || ')' ELSE CAST(n AS VARCHAR) END AS shown FROM t"""
)
def human_numbers(spark, d):
    sums = Tables(spark, d).documents.groupBy("source").agg(F.sum("n_chars").alias("s"))
    rows = sums.select("source", F.explode(F.array("s", F.col("s") * 1000, F.expr("s div 1000000"))).alias("n"))
    return rows.select("source", "n", display.human(F.col("n")).alias("shown"))


# streams


@query(ORACLES["gap_sessions"])
def streamed_sessions(spark, d):
    """Events that come up to an hour late, in three runs of a stream that goes on from its checkpoint; a row of a later time ends it."""
    path = scratch(spark)
    spans = Tables(spark, d).spans().select("event_id", "user_id", F.expr("timestamp_micros(CAST(round(begin * 1e6) AS BIGINT))").alias("time"), "begin", "end")
    came = spans.withColumn("came", F.col("begin") + F.pmod(F.xxhash64("event_id"), F.lit(3600)))
    first, last = came.agg(F.min("came"), F.max("came")).first()
    third = F.when(F.lit(last == first), 0).otherwise(F.floor((F.col("came") - first) * 3 / ((last or 0) - (first or 0) + 1)))
    ending = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(None).cast("long").alias("user_id"), F.timestamp_seconds(F.lit((last or 0) + 2_000_000_000)).alias("time"), F.lit(0.0).alias("begin"), F.lit(0.0).alias("end"))
    for k, part in enumerate([*(came.filter(third == k).drop("came") for k in range(3)), ending]):
        part.select([F.col(f.name).cast(f.dataType) for f in spans.schema]).write.parquet(f"{path}/in/{k}")
        stream = spark.readStream.schema(spans.schema).option("recursiveFileLookup", True).parquet(f"{path}/in")
        rows = late.late_sessions(stream, "user_id", "time", "event_id", "begin", "end", 3600.0, "1 hour", buckets=1024)
        rows.writeStream.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return spark.read.schema("event_id long, user_id long, segment_index int").parquet(f"{path}/out")


# round trips through writers and readers


@query("SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def sharded_roundtrip(spark, d):
    """A folder for each language; one that is written again replaces itself and leaves the others."""
    docs, path = Tables(spark, d).documents.select("doc_id", "lang", "n_chars"), scratch(spark)
    writers.sharded_parquet(docs, path, "lang")
    writers.sharded_parquet(docs.filter("lang = 'en'"), path, "lang")
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT doc_id, md5(text) AS digest, true AS bounded, true AS gapless FROM documents")
def numbered_roundtrip(spark, d):
    """Whole documents in numbered files of at most 500 rows, by two jobs; each row tells whether the files are as they should be."""
    docs, path = Tables(spark, d).documents.select("doc_id", "text", "lang"), scratch(spark)
    numbered.numbered_parquet(docs.filter("lang = 'en'"), path, 500)
    numbered.numbered_parquet(docs.filter("lang IS DISTINCT FROM 'en'"), path, 500)
    files = numbered.units_of_files(spark, path, "lang").groupBy("number").agg(F.sum("rows").alias("rows"), F.countDistinct(F.coalesce(F.col("lang") == "en", F.lit(False))).alias("jobs"))
    state = files.agg((F.max("rows") <= 500).alias("bounded"), ((F.max("number") + 1 == F.count(F.lit(1))) & (F.max("jobs") == 1)).alias("gapless"))
    return spark.read.parquet(path).select("doc_id", F.md5("text").alias("digest")).join(F.broadcast(state))  # one row


@query("SELECT n_name AS shard_id, CAST(n_regionkey AS VARCHAR) AS subshard_id FROM nation")
def tsv_roundtrip(spark, d):
    path = scratch(spark)
    rows = Tables(spark, d).nation.select("n_name", "n_regionkey")
    writers.tsv(rows.filter("n_regionkey < 2"), path)
    writers.tsv(rows.filter("n_regionkey >= 2"), path, append=True)
    return readers.pairs_tsv(spark, path)


@query("SELECT n_name AS id FROM nation WHERE n_regionkey <> 0 UNION ALL SELECT '# ' || n_name FROM nation WHERE n_regionkey = 1")
def list_roundtrip(spark, d):
    """Lines of a list: comments go, but for those that stand behind a blank, if that is how the list is read."""
    path = scratch(spark)
    n = F.col("n_regionkey")
    line = F.when(n == 0, F.concat(F.lit("#"), "n_name")).when(n == 1, F.concat(F.lit(" # "), "n_name")).otherwise(F.concat("n_name", F.lit(" ")))
    both = Tables(spark, d).nation.select(F.explode(F.array(line, F.when(n == 1, F.col("n_name")).otherwise(F.lit("")))).alias("line"))
    writers.lines(both, "line", path)
    return readers.id_list(spark, path, indented=False)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def json_array_roundtrip(spark, d):
    """A file of one array for each order status and priority."""
    path = scratch(spark)
    rows = Tables(spark, d).orders.groupBy("o_orderstatus", F.pmod("o_orderkey", F.lit(8)).alias("file")).agg(F.to_json(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("line"))
    rows.select(F.concat("o_orderstatus", "file").alias("part"), "line").write.partitionBy("part").text(path)
    return readers.json_array(spark, path, "o_orderkey long, o_orderstatus string").select("o_orderkey", "o_orderstatus")


@query(
    f"""WITH {UTTERANCES} SELECT conv_id, count(*) AS chunks, string_agg(text, '|' ORDER BY turn) AS said, string_agg(audio_str, '' ORDER BY turn) AS audio
 FROM u WHERE turn % 3 <> 1 GROUP BY conv_id"""
)
def raw_chunks(spark, d):
    """Raw documents with maps of texts and of codes, of which some chunks have none."""
    t = Tables(spark, d)
    n = F.broadcast(t.embeddings.agg(F.count(F.lit(1)).alias("n")))  # one row
    rows = t.conversations.join(n).withColumn("vec_id", (F.col("conv_id") * 8 + F.col("turn")) % F.col("n")).join(t.codes(), "vec_id")
    listed = F.array_sort(F.collect_list(F.struct("turn", "text", "codes")))
    texts = F.map_from_entries(F.transform("rows", lambda r: F.struct(r["turn"].cast("string"), r["text"])))
    codes = F.map_from_entries(F.transform(F.filter("rows", lambda r: r["turn"] % 3 != 1), lambda r: F.struct(r["turn"].cast("string"), r["codes"])))
    raw = rows.groupBy("conv_id").agg(listed.alias("rows")).select(F.col("conv_id").alias("audio_id"), texts.alias("text"), codes.alias("codes"))
    found = documents.chunks_of(raw, A)
    return found.select(F.col("audio_id").alias("conv_id"), F.size("chunks").cast("long").alias("chunks"), F.array_join(F.transform("chunks", lambda c: c["text"]), "|").alias("said"), F.array_join(F.transform("chunks", lambda c: c["audio"]), "").alias("audio"))


@query("SELECT doc_id, source AS speaker_id, lang || '-' || doc_id AS book_id FROM documents")
def listed_folders(spark, d):
    line = F.concat_ws("-", "source", "lang", "doc_id")
    return Tables(spark, d).documents.select("doc_id", ids.listed_folder(line).alias("f")).select("doc_id", "f.*")


@query(f"SELECT doc_id, {DIGEST} AS digest FROM documents")
def compatible_digests(spark, d):
    """Latin letters widened to their compatibility forms, which the normal form takes back."""
    bound_batches(spark)
    plain = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    wide = "".join(chr(ord(c) + 0xFEE0) for c in plain)
    return Tables(spark, d).documents.select("doc_id", ids.digest(ids.folded(plugins.nfkc(F.translate("text", plain, wide)))).alias("digest"))


@query("SELECT o_custkey, o_orderkey FROM orders o JOIN (SELECT c_custkey, c_nationkey * 1000000 AS last FROM customer WHERE c_nationkey < 3) ON o_custkey = c_custkey WHERE o_orderkey > last UNION ALL SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 3)")
def resume_after_row(spark, d):
    t = Tables(spark, d)
    done = t.customer.filter("c_nationkey < 3").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") * 1_000_000).alias("last_processed_index"))
    return audits.after_row(t.orders.select("o_custkey", "o_orderkey"), done, "o_custkey", "o_orderkey")


@query("SELECT count(*) FILTER (o_orderstatus <> 'P') AS processed, count(*) FILTER (o_orderstatus = 'F') AS succeeded, 100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*) FILTER (o_orderstatus <> 'P') AS rate FROM orders")
def success_rate(spark, d):
    state = F.col("o_orderstatus")
    return audits.success(Tables(spark, d).orders, state, "F", state != "P")


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'complete' ELSE 'queue' END AS action FROM documents")
def reconciled_units(spark, d):
    t = Tables(spark, d)
    return publish.reconciled(t.documents, t.labels, "doc_id")


@query("SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 20)")
def last_rows(spark, d):
    return audits.last_rows(Tables(spark, d).documents.select("doc_id", "n_chars"), ["n_chars", "doc_id"], 20)


@query("SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, count(*) AS n FROM documents GROUP BY source")
def ordered_languages(spark, d):
    rows = documents.imploded(Tables(spark, d).documents.select("source", "lang", "doc_id"), ["source"], ["lang", "doc_id"], lang=F.col("lang"))
    return rows.select("source", F.array_join(ids.in_order(F.transform("chunks", lambda c: c["lang"])), ",").alias("langs"), F.size("chunks").cast("long").alias("n"))
