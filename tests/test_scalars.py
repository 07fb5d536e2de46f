from pyspark.sql import functions as F

from talkmill.functions import scalars as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_times(spark):
    assert one(spark, fn.srt_time(F.lit(1.9996))) == "00:00:02,000"
    assert one(spark, fn.srt_time(F.lit(3661.0625))) == "01:01:01,062"
    assert one(spark, fn.parse_time(F.lit("1:02:03.5"))) == 3723.5
    assert one(spark, fn.parse_time(F.lit(None).cast("string"))) is None


def test_rates(spark):
    for text, want in (("25/1", 25.0), ("30/", 30.0), ("30", 30.0), ("30/0", 0.0), ("x/1", 0.0), ("", 0.0)):
        assert one(spark, fn.frame_rate(F.lit(text))) == want
    assert one(spark, fn.frame_rate(F.lit(None).cast("string"))) == 0.0


def test_rounding_is_half_even(spark):
    assert [one(spark, fn.rounded(F.lit(x))) for x in (0.5, 1.5, 2.5, -0.5)] == [0, 2, 2, 0]


def test_words_and_wrap(spark):
    assert one(spark, F.size(fn.words(F.lit(" \n ")))) == 0
    assert one(spark, fn.wrapped(F.lit("aa bb  cccc dd"), F.lit(5))) == ["aa bb", "cccc", "dd"]
    assert one(spark, fn.wrapped(F.lit("aaaaaaa b"), F.lit(3))) == ["aaaaaaa", "b"]
    assert one(spark, fn.fitted_size(F.lit("short"), 1680, 389)) == 64
    assert one(spark, fn.fitted_size(F.lit("word " * 400), 1680, 389)) == 32


def test_mute_gain_ramps_inside_the_span(spark):
    gain = [one(spark, fn.mute_gain(F.lit(s), F.lit(1000), F.lit(3000))) for s in (999, 1000, 1479, 1480, 2519, 2520, 2999, 3000)]
    assert gain == [1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0]
    assert one(spark, fn.mute_gain(F.lit(1500), F.lit(1000), F.lit(1960))) == 0.0


def test_vectors(spark):
    v = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, fn.normalised(v)) == [0.6, 0.8]
    assert one(spark, fn.normalised(F.array(F.lit(0.0), F.lit(0.0)))) == [0.0, 0.0]
