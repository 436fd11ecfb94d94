r"""Chat formatting by a grammar round trip, in DataFrame operations only.

A conversation is rendered as `<s>[INST]role[/INST]text</s>` for each turn. The deterministic parser splits the string at
`</s>` and at the first `[/INST]` of a turn, undoes escapes, and accepts the string only if it holds no other control
string. Rendering starts with the texts as they are; if the turns read back differ from the source, every control string
inside roles and texts gets a backslash after its bracket (`[INST]` to `[\INST]`, and `[\INST]` to `[\\INST]`, so that one
backslash less is always the source), and the result is parsed and compared again; a difference then stops the job.

The loss mask is a list of [begin, end) in code points, each assistant text in order, with the turn and the place in it, so
that reading all of them takes one pass. All steps are about linear in the number of turns.

Defined results: null roles and texts are empty; turns are ordered by turn, then role and text, null turns first; rows
with a null conversation id are one conversation; repeated rows are turns each; an empty table gives no rows; other
columns are neither read nor returned. All rows of a conversation meet in one row, as its digest needs them in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"
CONTROL = r"\[/?INST\]|</?s>"
#: A turn has four control strings of this many characters together.
FRAME = len(OPEN + MID + CLOSE)
TURNS = "array<struct<role: string, text: string>>"


def escape(c: Column) -> Column:
    c = F.regexp_replace(c, r"\[(\\*)(/?INST\])", r"[\\$1$2")
    return F.regexp_replace(c, r"<(\\*)(/?s>)", r"<\\$1$2")


def unescape(c: Column) -> Column:
    c = F.regexp_replace(c, r"\[\\(\\*)(/?INST\])", r"[$1$2")
    return F.regexp_replace(c, r"<\\(\\*)(/?s>)", r"<$1$2")


def rendered(turns: Column) -> Column:
    one = F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MID), t["text"], F.lit(CLOSE)))
    return F.array_join(one, "")


def pieces(formatted: Column) -> Column:
    """Turns as they stand between the control strings, escapes in place."""
    each = F.split(formatted, "</s>", -1)
    each = F.slice(each, 1, F.size(each) - 1)
    cut = F.transform(each, lambda s: F.split(s, r"\[/INST\]", 2))
    return F.transform(cut, lambda p: F.struct(F.substring(p[0], len(OPEN) + 1, 1 << 30).alias("role"), F.coalesce(F.get(p, F.lit(1)), F.lit("")).alias("text")))


def recovered(formatted: Column) -> Column:
    """The parser: the turns of an accepted string, null for any other."""
    found = F.transform(pieces(formatted), lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))
    controls = F.size(F.split(formatted, CONTROL, -1)) - 1
    return F.when(controls == 4 * (F.size(F.split(formatted, "</s>", -1)) - 1), found)


def chat_format(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, turns read back, loss_spans, escaped), one row for each conversation."""
    source = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"),
    )
    convs = source.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    convs = convs.select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    plain = convs.withColumn("formatted", rendered(F.col("source")))
    plain = plain.withColumn("back", recovered(F.col("formatted")))
    # where the first rendering doesn't read back, the escaped one takes its place
    safe = F.transform("source", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    escaped = ~F.coalesce(F.col("back") == F.col("source"), F.lit(False))
    out = plain.select("conv_id", "source", escaped.alias("escaped"), F.when(escaped, rendered(safe)).otherwise(F.col("formatted")).alias("formatted"))
    out = out.withColumn("turns", recovered(F.col("formatted")))
    same = F.coalesce(F.col("turns") == F.col("source"), F.lit(False))
    out = out.withColumn("turns", F.when(same, F.col("turns")).otherwise(F.raise_error(F.lit("a conversation can't be read back")).cast(TURNS)))
    return out.select("conv_id", "formatted", "turns", spans(F.col("formatted")).alias("loss_spans"), "escaped")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def before(lengths: Column) -> Column:
    """What stands before each entry of an array of lengths. A fold copies its list at each step, so it is done in blocks of
    the root of the number, and again over the blocks' sums."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("at"))
    fold = lambda xs: F.aggregate(xs, start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["at"], F.array(a["sum"])).alias("at")))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(lengths))).cast("int"))
    blocks = F.transform(F.filter(F.sequence(F.lit(0), F.size(lengths), width), lambda k: k < F.size(lengths)), lambda k: fold(F.slice(lengths, k + 1, width)))
    return let(blocks, lambda bs: F.flatten(F.zip_with(bs, fold(F.transform(bs, lambda b: b["sum"]))["at"], lambda b, first: F.transform(b["at"], lambda x: x + first))))


def spans(formatted: Column, role: str = "assistant") -> Column:
    """The assistant's texts in the formatted string: [begin, end) in code points, and the same begin within its turn."""

    def masked(turns: Column, at: Column) -> Column:
        def one(t: Column, k: Column) -> Column:
            local = F.length(t["role"]) + F.lit(len(OPEN + MID))
            begin = F.get(at, k) + local
            return F.when(unescape(t["role"]) == role, F.struct(begin.alias("begin"), (begin + F.length(t["text"])).alias("end"), k.alias("turn"), local.alias("local")))

        return F.filter(F.transform(turns, one), lambda x: x.isNotNull())

    size = lambda t: F.length(t["role"]) + F.length(t["text"]) + F.lit(FRAME)
    return let(pieces(formatted), lambda turns: let(F.transform(turns, size), lambda sizes: let(before(sizes), lambda at: masked(turns, at))))


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts that the mask covers, unescaped, one after another; each is looked up within its turn, not from the start."""
    return let(F.split(formatted, CLOSE, -1), lambda turns: F.array_join(F.transform(mask, lambda s: unescape(F.substr(F.get(turns, s["turn"]), s["local"] + 1, s["end"] - s["begin"]))), ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    clash = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(0, 2, 1, 1).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(clash).alias("text"))
    chats = chat_format(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    # all that follows is read from the formatted string and its mask
    turns = F.array_join(F.transform(recovered(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = under_mask(F.col("formatted"), F.col("loss_spans"))
    read = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), turns.alias("said"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, max(regexp_matches(role, '\[\\*/?INST\]|<\\*/?s>') OR regexp_matches(text, '\[\\*/?INST\]|<\\*/?s>')) OVER (PARTITION BY conv_id) AS clash FROM c
), e AS (
  SELECT *, 20 + length(role) + length(text) + CASE WHEN clash THEN
    len(regexp_extract_all(role, '\[\\*/?INST\]|<\\*/?s>')) + len(regexp_extract_all(text, '\[\\*/?INST\]|<\\*/?s>')) ELSE 0 END AS chars FROM m
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
