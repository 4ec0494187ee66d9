from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import clean, text


def values(spark, items, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", column("v").alias("o")).orderBy("i").collect()]


def test_ids_and_blanks(spark):
    assert values(spark, [" 12.0 ", "a.0.0", None, "", "0"], clean.clean_id) == ["12", "a.0", "", "", "0"]
    assert values(spark, ["0012", "000", "0a", None, " 07 "], clean.plain_digits) == ["12", "0", "0a", None, "7"]
    assert values(spark, [" \t", "x ", None], clean.not_blank) == [None, "x", None]
    df = spark.createDataFrame([(" ", "nan", "x"), ("NULL", None, "")], "a string, b string, c string")
    assert [r[0] for r in df.select(clean.first_filled("a", "b", "c")).collect()] == ["x", None]


def test_numbers(spark):
    assert values(spark, ["1,5", " 2 ", "1e3", ".5", "nan", "NO_BODY", "Infinity", None, "", "-3.25", "9" * 30], clean.parse_number) == [Decimal("1.5000"), Decimal("2.0000"), Decimal("1000.0000"), Decimal("0.5000"), None, None, None, None, None, Decimal("-3.2500"), None]
    assert values(spark, ["1.5", "1e3", ".5", "1,5", " -2 ", "x", None], clean.guarded_number) == [Decimal("1.5000"), None, None, None, Decimal("-2.0000"), None, None]


def test_flags_dates_times(spark):
    assert values(spark, ["TRUE", " y", "0", "No", "maybe", None, ""], clean.parse_bool) == [True, True, False, False, None, None, None]
    assert values(spark, ["x", None], lambda c: clean.parse_bool(c, True)) == [True, True]
    assert values(spark, ["2025-02-28", "28/02/2025", "20250228", "28.02.2025", "2025-02-30", "soon", None], clean.parse_date) == [date(2025, 2, 28)] * 4 + [None] * 3
    assert values(spark, ["2025-02-28 10:20:30", "20250228102030", "2025-02-28T10:20:30", "28/02/2025", ""], clean.parse_time) == [datetime(2025, 2, 28, 10, 20, 30)] * 3 + [datetime(2025, 2, 28), None]


def test_all_forms_of_dates(spark):
    day, at, minute = date(2025, 2, 8), datetime(2025, 2, 8, 9, 20, 30), datetime(2025, 2, 8, 9, 20)
    days = ["2025-02-08", "2025/02/08", "08/02/2025", "08-02-2025", "2025-2-8", "8/2/2025", "08.02.2025", "20250208"]
    assert values(spark, days, clean.parse_date) == [day] * len(days)
    assert values(spark, days, clean.parse_time) == [datetime(2025, 2, 8)] * len(days)
    minutes = ["2025-02-08 09:20", "2025/02/08 09:20", "08/02/2025 09:20", "08-02-2025 09:20", "2025-02-08T09:20", "8/2/2025 9:20", "20250208T0920"]
    assert values(spark, minutes, clean.parse_time) == [minute] * len(minutes)
    seconds = ["2025-02-08 09:20:30", "2025/02/08 09:20:30", "08/02/2025  09:20:30", "08-02-2025 09:20:30", "2025/02/08T09:20:30", "20250208092030", "20250208T092030", "2025-02-08T09:20:30.000"]
    assert values(spark, seconds, clean.parse_time) == [at] * len(seconds)
    assert values(spark, [*minutes, *seconds], clean.parse_date) == [day] * (len(minutes) + len(seconds))
    fractions = ["2025-02-08T09:20:30.25", "2025-02-08 09:20:30,250", "2025-02-08 09:20:30.250000999"]
    assert values(spark, fractions, clean.parse_time) == [at.replace(microsecond=250_000)] * 3
    zoned = ["2025-02-08T23:30:00+02:00", "2025-02-08T23:30:00.000+0200", "2025-02-08 23:30+02", "2025-02-08T21:30:00Z", "2025-02-08T21:30Z", "2025-02-08T21Z"]
    assert values(spark, zoned, clean.parse_date) == [day] * 6
    assert values(spark, zoned, lambda c: F.unix_seconds(clean.parse_time(c)), "string") == [1739050200] * 5 + [1739048400]
    assert values(spark, ["2025-02-08T00:30:00+02:00", "2025-02-08T23:30:00-05:00"], clean.parse_date) == [day] * 2
    wrong = ["2025-02-30 10:00", "2025/13/01", "31/04/2025 10:00:00", "2025-02-08 25:00", "2025-02-08T09:61:00Z", "2025-02-30T10:00:00Z", "T", "nan", "", None]
    assert values(spark, wrong, clean.parse_date) == [None] * len(wrong) and values(spark, wrong, clean.parse_time) == [None] * len(wrong)


def test_names(spark):
    assert values(spark, ["PriceFullFile", "storeXMLFeed", None], clean.upper_snake) == ["PRICE_FULL_FILE", "STORE_XML_FEED", None]
    assert values(spark, ["a.xml.gz", "b.aspx", "c.gz.xml", None], clean.without_endings) == ["a", "b", "c.gz", None]
    assert values(spark, ["Shop-Rite 2!", "שוק, 3"], clean.letters_and_digits) == ["shoprite2", "שוק3"]
    assert values(spark, ["<a href='x'>&\"" + "z" * 100], clean.html_escaped)[0].startswith("&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;zzz")
    df = spark.createDataFrame([({"ChainId": "7", "x": "NaN"},), ({},), (None,)], "m map<string,string>")
    assert [(r[0], r[1]) for r in df.select(clean.ci_element("m", "chainid"), clean.ci_element("m", "X")).collect()] == [("7", None), (None, None), (None, None)]
    assert values(spark, [1.005, 2.675, None, -0.125], clean.half_up, "double") == [1.0, 2.68, None, -0.12]


@pytest.mark.parametrize(("words", "terms", "expected"), [
    (["a", "b"], ["a", "b"], 0.1), (["a", "x", "b"], ["a", "b"], 0.05), (["a", "x", "x", "b", "a"], ["a", "b"], 0.1 / 3 + 0.1), (["a", "a"], ["a"], 0.2), ([], ["a"], 0.0), (["a"], ["a", "b"], 0.0), (["a", "b", "c"], ["c", "a"], 0.05),
])
def test_cover_density(words, terms, expected):
    assert text.cover_density_of(words, terms) == pytest.approx(expected)


def test_search(spark):
    docs = ["Milk chocolate bar", "dark CHOCOLATE", "milk-drink", None, "", "chocolate milk " * 3000]
    assert values(spark, docs, lambda c: text.matches_all(text.tokens(c), "chocolate MILK")) == [True, False, False, False, False, True]
    assert values(spark, docs, lambda c: text.matches_web(text.tokens(c), '"milk chocolate" OR drink -dark')) == [True, False, True, False, False, True]
    assert values(spark, docs, lambda c: text.matches_all(text.tokens(c), "!!")) == [False] * 6
    assert values(spark, docs[:3], lambda c: text.cover_density(text.tokens(c), "milk chocolate")) == pytest.approx([0.1, 0.0, 0.0])
    assert values(spark, ["word", "wird", None, ""], lambda c: text.trigram_similarity(c, F.lit("word"))) == pytest.approx([1.0, 3 / 7 if False else 2 / 8, 0.0, 0.0])
    assert values(spark, ["100% off", "100 off"], lambda c: text.contains_text(c, "100%")) == [True, False]
