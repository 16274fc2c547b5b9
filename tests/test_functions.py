"""Column expressions on literal edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from vitrine.functions import noise, pricing, text
from vitrine.functions.category import normalize_category
from vitrine.functions.numeric import clip, half_even, numeric_column, parse_number, steady_mean


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_numbers(spark):
    got = column(spark, ["12", " -3.5 ", "1e3", ".5", "n/a", "12.5d", "", None, "1_000"], "string", parse_number)
    assert got == [12.0, -3.5, 1000.0, 0.5, None, None, None, None, None]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "i int, v double")
    assert [r[0] for r in df.orderBy("i").select(numeric_column(df, "v")).collect()] == [None, 1.5]


def test_half_even(spark):
    assert column(spark, [0.0625, 2.5, -0.5, 1.2345], "double", lambda v: half_even(v, 3)) == [0.062, 2.5, -0.5, 1.234]


def test_clip_keeps_null(spark):
    assert column(spark, [None, -1.0, 2.0, 9.0], "double", lambda v: clip(v, 0, 5)) == [None, 0.0, 2.0, 5.0]


def test_price_segment(spark):
    got = column(spark, [0.0, 0.01, 20.0, 20.01, 50.0, 200.0, 200.01, None, float("nan")], "double", pricing.price_segment)
    assert got == [None, "Très_bas", "Très_bas", "Bas", "Bas", "Haut", "Premium", None, None]


def test_discount_ratio(spark):
    df = spark.createDataFrame([(10.0, 7.5), (0.0, 1.0), (10.0, 12.0)], "p double, q double")
    got = df.select(pricing.discount_ratio(F.col("p"), F.col("q"))).collect()
    assert [r[0] for r in got] == [0.25, 0.0, -0.2]


@pytest.mark.parametrize("country, code", [("USA", "USD"), ("FRA", "EUR"), ("GBR", "GBP"), ("MAR", "MAD"), ("CHN", "AED")])
def test_currency(spark, country, code):
    assert column(spark, [country], "string", pricing.currency) == [code]


def test_category(spark):
    cases = {None: "X", "  ": "X", "Gift Set": "X", "bundle": "X", "Bath": "Home", "Men's Apparel": "Fashion",
             "Slippers": "Beauty", "SWIMWEAR": "Sport", "Green Tea Leaves": "Food", "zzz": "X", "bath & body": "Beauty"}
    got = column(spark, list(cases), "string", lambda v: normalize_category(v, F.lit("X")))
    assert got == list(cases.values())


def test_strip_html(spark):
    assert column(spark, ["<p>a</p>\n<b>c</b>", None, "\t x "], "string", text.strip_html) == ["a \n c", "", "x"]


def test_tags(spark):
    raw = ["a, b ,,c,d,e,f", '["x"," y ",""]', "", None]
    assert column(spark, raw, "string", lambda v: text.join_tags(text.tag_list(v), 5)) == ["a; b; c; d; e", "x; y", "", ""]
    assert column(spark, raw, "string", lambda v: text.join_tags(text.tag_list(v))) == ["a; b; c; d; e; f", "x; y", "", ""]


def test_quality_words(spark):
    assert column(spark, ["Bestseller", "renewed", "plain", None], "string", text.has_quality_word) == [True, True, False, False]


def test_title(spark):
    got = column(spark, ["  hello*** WORLD usb-c led", "a" * 80], "string", text.normalize_title)
    assert got == ["Hello World USB-C LED", "A" + "a" * 59]


def test_date_prefix(spark):
    got = column(spark, ["2024-02-03T10:00:00Z", "soon", None, ""], "string", text.date_prefix)
    assert [str(d) if d else None for d in got] == ["2024-02-03", None, None, None]


def test_urls(spark):
    got = column(spark, ["http://a//", "http://b"], "string", lambda v: text.store_url(v, F.lit("/x")))
    assert got == ["http://a/x", "http://b/x"]


def test_noise_is_stable_and_sane(spark):
    df = spark.range(4000).select("id", noise.normal("s", F.col("id"), 4.1, 0.4).alias("n"), noise.uniform("u", F.col("id")).alias("u"))
    stats = df.agg(F.avg("n"), F.stddev("n"), F.min("u"), F.max("u")).first()
    assert abs(stats[0] - 4.1) < 0.03 and abs(stats[1] - 0.4) < 0.03 and 0 < stats[2] < stats[3] < 1
    again = df.repartition(7).orderBy("id").collect()
    assert again == df.orderBy("id").collect()


def test_steady_mean(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert df.agg(steady_mean(F.col("v"))).first()[0] == pytest.approx(0.15)
    assert df.where("v > 9").agg(steady_mean(F.col("v"))).first()[0] is None
    assert math.isclose(df.agg(steady_mean(F.lit(0.3))).first()[0], 0.3)
