import pytest
from pyspark.sql import functions as F

from speechloom import plugins
from speechloom.functions import display, ids, markup
from speechloom.functions.markup import AE, AS, BOS, EOS, TE, TS


def one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} {'double' if isinstance(v, float) else 'long' if isinstance(v, int) else 'string'}" for c, v in cols.items()))
    return row.select(expr).first()[0]


def test_views(spark):
    doc = BOS + AS + "X" + AE + TS + "a" + TE + AS + "Y" + AE + TS + "b" + TE + EOS
    assert one(spark, markup.acoustic(F.col("t")), t=doc) == BOS + AS + "X" + AE + AS + "Y" + AE + EOS
    assert one(spark, markup.acoustic(F.col("t")), t=TS + "a\nb" + TE) == TS + "a\nb" + TE
    for c in "\r\u0085 ":
        assert one(spark, markup.acoustic(F.col("t")), t=TS + "a" + c + "b" + TE) == ""
    assert one(spark, markup.tts_prompt(F.col("t")), t=doc).count(TS + "[0]") == 2
    assert one(spark, markup.without_type(F.col("t"), 2), t="x_type2_type2") == "x_type2"
    assert one(spark, markup.repaired(F.col("t")), t=TS + "  a" + TE) == TS + " a" + TE
    assert one(spark, markup.repaired(F.col("t")), t=TS + "a " + TE) == TS + "a" + TE


def test_semantic(spark):
    frames = "".join(chr(0xE000 + k * 2048 + c) for c in (0, 1) for k in range(8))
    assert one(spark, markup.semantic(F.col("t")), t=BOS + AS + frames + AE + EOS) == BOS + AS + chr(0xE000) + chr(0xE001) + AE + EOS
    with pytest.raises(Exception, match="whole frames"):
        one(spark, markup.semantic(F.col("t")), t=AS + frames[:12] + AE)


def test_strip(spark):
    assert one(spark, markup.strip(F.col("t")), t=" 　 a b\x1f ") == "a b"
    assert one(spark, markup.unquoted(F.col("t")), t=" \u3000\"'\"hi\"'\"") == '"hi"'


def test_translation(spark):
    t = markup.translation(F.lit("A"), F.lit("s"), F.lit("t"), F.lit("B"), F.lit("de"))
    assert spark.range(1).select(t).first()[0] == BOS + AS + "A" + AE + TS + "<language>de</language>s" + TE + TS + "<language>en</language>t" + TE + AS + "B" + AE + EOS
    with pytest.raises(ValueError):
        markup.translation(*[F.lit("")] * 5, method="other")


def test_ids(spark):
    for t in ("Hello  World", "hello world", " Ｈｅｌｌｏ\tworld "):
        assert one(spark, ids.digest(ids.folded(plugins.nfkc(F.col("t")))), t=t) == "uU0nuZNNPgilLlLX2n2r-g"
    assert one(spark, ids.digest(F.col("t")), t="") == "47DEQpj8HBSa-_TImW-5JA"
    assert one(spark, ids.digest(ids.folded(plugins.nfkc(F.col("t")))), t="ﬁne") == "0UpYuugEorgLW3agECOciA"
    assert [one(spark, ids.centiseconds(F.col("t")), t=x) for x in (10.29, 0.29, 1234567.891)] == ["00001029", "00000028", "123456789"]
    p = one(spark, ids.chunk_parts(F.col("t")), t="Y-6-5x5_9PNO8-00026-00003279-00003280")
    assert (p.audio_id, p.idx, p.start_cs, p.end_cs) == ("Y-6-5x5_9PNO8", 26, 3279, 3280)
    assert one(spark, ids.valid_range(F.col("a"), F.col("b")), a=5, b=5) is False
    with pytest.raises(Exception, match="before it starts"):
        one(spark, ids.valid_range(F.col("a"), F.col("b")), a=6, b=5)
    assert one(spark, ids.document_key(F.col("t")), t="EN_B00000_S00040_W000004") == "EN_B00000_S00040"
    assert one(spark, ids.document_key(F.col("t")), t="plain") == ""
    assert one(spark, ids.file_id(F.col("t"), "Corpus", ".flac"), t="/d/Corpus/x/y.flac") == "x/y"
    assert one(spark, ids.language_of_path(F.col("t")), t="en000/1.parquet") == "en"
    assert one(spark, ids.language_of_path(F.col("t")), t="eng000/1.parquet") is None
    assert one(spark, ids.published_shard(F.col("t"), "clean"), t="clean_sa/x.parquet") is None
    assert one(spark, ids.job_name(F.col("t")), t="train-00012-of-01416") == "job00012"


def test_display(spark):
    assert one(spark, display.commas(F.col("n")), n=1234567) == "1,234,567"
    assert one(spark, display.human(F.col("n")), n=2_500_000) == "2,500,000 (2.50M)"
    assert [one(spark, display.duration(F.col("s")), s=x) for x in (5.0, 90.0, 7200.0, 172800.0)] == ["5s", "1.5m", "2.0h", "2.0d"]
    assert one(spark, display.bar(F.col("p"), 10), p=50.0) == "[" + "█" * 5 + "░" * 5 + "]"
