import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import relational as R


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_optional_filters(spark):
    df = spark.createDataFrame([("a", "Abc"), ("b", "abd"), ("a", None), ("a", "x%")], "k string, v string")
    assert len(rows(R.optional_filters(df, {"k": None}, {"v": ""}))) == 4
    assert rows(R.optional_filters(df, {"k": "a"}, {"v": "aB"})) == [("a", "Abc")]
    assert rows(R.optional_filters(df, prefix={"v": "%"})) == []


def test_valid_at_and_words(spark):
    df = spark.createDataFrame([(1, None, None), (2, "2025-01-02", None), (3, None, "2025-01-01"), (4, "2025-01-01", "2025-01-01")], "i int, a string, b string").withColumns({"a": F.col("a").cast("date"), "b": F.col("b").cast("date")})
    assert [r[0] for r in rows(df.filter(R.valid_at("a", "b", "2025-01-01")).select("i"))] == [1, 3, 4]
    words = spark.createDataFrame([("ווג",), ("xווגx",), ("אווג",), ("a ווג!",), (None,)], "v string")
    assert rows(words.filter(R.has_word("v", "ווג", "א-ת"))) == [("a ווג!",), ("xווגx",), ("ווג",)]
    assert rows(words.filter(R.matches_none("v", ["X", "!"]))) == [("אווג",), ("ווג",), (None,)]


def test_best_top_and_page(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "c"), (None, 1, "d")], "k int, v int, t string")
    order = [F.desc_nulls_last("v"), F.col("t")]
    assert rows(R.best_per_key(df, ["k"], order)) == [(1, 5, "a"), (None, 1, "d")]
    assert rows(R.top_per_key(df, ["k"], order, 2)) == [(1, 5, "a", 1), (1, 5, "b", 2), (None, 1, "d", 1)]
    assert R.top_per_key(df.limit(0), ["k"], order, 2).count() == 0
    assert [r["t"] for r in R.page(df, [F.col("t")], -3, 2).collect()] == ["a", "b"]
    assert [r["t"] for r in R.page(df, [F.col("t")], 3, 0).collect()] == ["d"]
    assert R.page(df, [F.col("t")], 9, None).count() == 0


def test_forward_fill(spark):
    df = spark.createDataFrame([("f", 1, None), ("f", 2, "x"), ("f", 3, None), ("g", 4, None)], "k string, i int, v string")
    assert [r["v"] for r in R.forward_fill(df, ["v"], ["i"], ["k"]).orderBy("i").collect()] == [None, "x", "x", None]


def test_next_after_equals_brute_force(spark):
    random.seed(5)
    left = [(i, random.choice([1, 2, None]), random.choice([None, *range(30)])) for i in range(60)]
    right = [(random.choice([1, 2, None]), random.choice([None, *range(30)])) for _ in range(25)]
    found = R.next_after(spark.createDataFrame(left, "i int, k int, at int"), spark.createDataFrame(right, "k int, at2 int"), ["k"], "at", "at2", "next")
    expected = {i: min((b for x, b in right if x == k and b is not None and at is not None and b >= at), default=None) for i, k, at in left if at is not None}
    got = {r["i"]: r["next"] for r in found.filter("at IS NOT NULL").collect()}
    assert got == expected and found.count() == len(left)


def test_match_exclusive_equals_greedy(spark):
    random.seed(6)
    left = [(random.choice(["c", "d", None]), random.choice([None, *range(40)])) for _ in range(60)]
    right = [(random.choice(["c", "d", None]), random.choice([None, *range(40)])) for _ in range(50)]
    expected = []
    for key in ("c", "d", None):
        free = sorted(b for k, b in right if k == key and b is not None)
        for a in sorted(a for k, a in left if k == key and a is not None):
            hit = next((b for b in free if b >= a), None)
            if hit is not None:
                free.remove(hit)
            expected.append((key, a, hit))
    found = R.match_exclusive(spark.createDataFrame(left, "k string, a int"), spark.createDataFrame(right, "k string, b int"), "k", "a", "b")
    assert rows(found) == sorted(expected, key=str)


@pytest.mark.parametrize("p", [0, 50, 95, 100])
def test_nearest_ranks(spark, p):
    values = {"a": [5, 1, 4, 2, 3, 9, 7, 7, 7], None: [3, 3], "c": [8]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in [*vs, None]], "k string, v int").repartition(5)
    found = {r["k"]: (r["at"], r["greatest"], r["group_size"]) for r in R.nearest_ranks(df, ["k"], "v", {"at": p}).collect()}
    assert found == {k: (sorted(vs)[int(p / 100 * (len(vs) - 1) + 0.5)], max(vs), len(vs)) for k, vs in values.items()}
    assert R.nearest_ranks(df.limit(0), ["k"], "v", {"at": p}).count() == 0


def test_next_after_in_a_key_of_many_rows(spark):
    left = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 3).alias("at"))
    right = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") * 3 + 1).alias("at2"))
    found = R.next_after(left, right, ["k"], "at", "at2", "next")
    assert found.filter("next = at + 1").count() == 200_000
