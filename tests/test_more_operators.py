import json
import random

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import clean, text
from shelfspark.operators import folding, merge, relational
from shelfspark.streaming.feeds import bounded_records, refresh_due


def test_word_similarity_equals_brute_force():
    random.seed(2)
    for _ in range(300):
        query = " ".join("".join(random.choice("abc") for _ in range(random.randrange(1, 5))) for _ in range(random.randrange(1, 3)))
        words = " ".join("".join(random.choice("abc") for _ in range(random.randrange(1, 5))) for _ in range(random.randrange(0, 6)))
        wanted, grams = set(text._trigrams_in_order(query)), text._trigrams_in_order(words)
        best = max((len(wanted & set(grams[a:b])) / len(wanted | set(grams[a:b])) for a in range(len(grams)) for b in range(a + 1, len(grams) + 1)), default=0.0)
        assert text.word_similarity_of(query, words) == pytest.approx(best)
    assert text.word_similarity_of("word", "two words") == pytest.approx(0.8) and text.word_similarity_of("", "a") == 0 and text.word_similarity_of("a", None) == 0


def test_ranks_of_words(spark):
    df = spark.createDataFrame([(1, "price price milk"), (2, "price"), (3, None), (4, "x " * 3000 + "milk")], "i int, t string")
    found = {r["i"]: r["r"] for r in df.select("i", text.frequency_rank(text.tokens("t"), "price milk").alias("r")).collect()}
    assert found[1] == pytest.approx((1.25 + 1) * 0.1 / 1.64493406685 / 2) and found[2] == found[4] == pytest.approx(0.1 / 1.64493406685 / 2) and found[3] == 0
    similar = df.select("i", text.word_similarity("t", "pricee").alias("s")).collect()
    assert [r["s"] > 0.5 for r in similar] == [True, True, False, False]


def test_pages_and_orders(spark):
    df = spark.range(45).withColumn("total_", F.lit(1))
    last = relational.page_info(df, [F.col("id")], 40, 20)
    assert [tuple(r)[2:] for r in last.collect()] == [(45, False, None, 20)] * 5
    assert relational.page_info(df, [F.col("id")], 0, 20).first()[2:] == (45, True, 20, None)
    assert relational.page_info(df.limit(0), [F.col("id")], 0, 20).count() == 0
    orders = {"a": [F.col("x")]}
    assert relational.chosen_order("a", orders, []) == orders["a"] and relational.chosen_order(None, orders, []) == [] and relational.chosen_order("b", orders, []) == []


def test_deleting_and_wiping(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "c")], "k int, v string")
    stays, goes = merge.delete_listed(df, spark.createDataFrame([(2,), (2,), (None,), (9,)], "k int"), ["k"])
    assert sorted(r["v"] for r in stays.collect()) == ["a", "b"] and goes.count() == 2
    stays, goes = merge.delete_but(df, spark.createDataFrame([(2,)], "k int"), ["k"])
    assert stays.count() == 2 and goes.count() == 2
    assert merge.wipe_order({"prices": ["products", "stores"], "links": ["prices", "promotions"]}) == ["links", "prices", "products", "promotions", "stores"]
    with pytest.raises(ValueError):
        merge.wipe_order({"a": ["b"], "b": ["a"]})


def test_items(spark):
    row = spark.createDataFrame([(" 5 ", None, "", 'a"b')], "a string, b string, c string, d string")
    assert row.select(folding.item_of({n: F.col(n) for n in "abcd"})).first()[0] == '{"a":"5","d":"a\\"b"}'
    old = spark.createDataFrame([(1, '[{"a": 1, "b": 2}, 3]'), (2, None), (3, "no")], "k int, items string")
    new = spark.createDataFrame([(1, '[{"b":2,"a":1}, {"c": 1}, {"c":1}]'), (2, '["x"]'), (4, "[]")], "k int, items string")
    found = {r["k"]: json.loads(r["items"]) for r in folding.append_unique(old, new, ["k"]).collect()}
    assert found == {1: [{"a": 1, "b": 2}, 3, {"c": 1}], 2: ["x"], 3: [], 4: []}
    values = spark.createDataFrame([("{'a': None, 'b': True}",), ("{'a': None, 'b': \"None\", 'c': undefined}",), ("[1, 2]",), ("{'x': null, 'y': None}",), ("{",), (None,)], "v string")
    assert [r[0] for r in values.select(folding.lenient_json("v")).collect()] == ['{"a": null, "b": true}', None, "[1, 2]", '{"x": null, "y": null}', None, None]


def test_json_kinds_and_names(spark):
    df = spark.createDataFrame([("[1]",), ("{}",), ('"a"',), ("1.5",), ("true",), ("null",), ("nope",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(clean.json_kind("v")).collect()] == ["array", "object", "string", "number", "boolean", "null", None, None, None]
    kind, owner = clean.index_parts("v")
    names = spark.createDataFrame([("a@b@c",), ("a",)], "v string").select(kind, owner)
    assert [tuple(r) for r in names.collect()] == [("a", "b@c"), ("a", None)]


def test_bounded_records_and_throttle(spark):
    messages = spark.createDataFrame([(3, '{"a":1}'), (1, '{"type":"flush"}'), (2, '{"a":1}'), (5, '{"a":2}'), (9, '{"a":3}')], "o long, value string")
    assert [r["o"] for r in bounded_records(messages, "o", 2).collect()] == [2, 5]
    assert refresh_due(None, 0, 5) and refresh_due(0, 300, 5) and not refresh_due(0, 299, 5)
