import random
from decimal import Decimal
from itertools import groupby

from pyspark.sql import functions as F

from shelfspark.operators.history import history, merge_history

SCHEMA = "p long, s long, price decimal(18,4), promo decimal(18,4), at long, bucket string"


def brute(rows):
    out = []
    by_key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)
    for _, group in groupby(sorted({r[:5] for r in rows if r[4] is not None}, key=lambda r: (*by_key(r), r[4])), key=by_key):
        runs = []
        for r in group:
            if not runs or runs[-1][2:4] != r[2:4]:
                runs.append(r)
        out += [(*r[:4], r[4], n[4] if n else -1) for r, n in zip(runs, [*runs[1:], None])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("p", "s", "price", "promo", "valid_from", "valid_to").collect()), key=str)


def sample(n, seed, hot=0.35):
    random.seed(seed)
    rows, times = [], {}
    for _ in range(n):
        key = (1, 1) if random.random() < hot else (random.choice([2, 3, None]), random.randrange(3))
        at = times[key] = times.get(key, 0) + random.choice([1, 1, 7, 100])
        price = random.choice([None, Decimal("1.0000"), Decimal("2.0000")])
        promo = random.choice([None, Decimal("1.0000")])
        rows += [(*key, price, promo, at, "x")] * random.choice([1, 1, 1, 2])
    random.shuffle(rows)
    return rows


def test_versions_equal_brute_force(spark):
    rows = sample(800, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(history(df, ["p", "s"], F.col("at"), ["price", "promo"])) == brute(rows)


def test_hot_keys_by_slices_equal_brute_force(spark):
    for seed in (2, 3):
        rows = sample(900, seed)
        df = spark.createDataFrame(rows, SCHEMA)
        assert found(history(df, ["p", "s"], F.col("at"), ["price", "promo"], hot_rows=20, buckets=16)) == brute(rows)


def test_hot_null_keys_equal_brute_force(spark):
    rows = [(None if r[0] == 1 else r[0], None if r[0] == 1 else r[1], *r[2:]) for r in sample(900, 5)]
    rows += [(None, 7, *r[2:]) for r in sample(200, 6, hot=1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(history(df, ["p", "s"], F.col("at"), ["price", "promo"], hot_rows=20, buckets=16)) == brute(rows)


def test_null_moves_between_attributes_are_changes(spark):
    one = Decimal("1.0000")
    rows = [(1, 1, one, None, 1, "x"), (1, 1, None, one, 2, "x"), (1, 1, None, one, 3, "x")]
    assert found(history(spark.createDataFrame(rows, SCHEMA), ["p", "s"], F.col("at"), ["price", "promo"])) == brute(rows)


def test_empty_and_null_times(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(history(empty, ["p", "s"], F.col("at"), ["price", "promo"])) == []
    rows = [(1, 1, None, None, None, "x")]
    assert found(history(spark.createDataFrame(rows, SCHEMA), ["p", "s"], F.col("at"), ["price", "promo"])) == []


def test_merging_later_snapshots_equals_building_at_once(spark):
    rows = sample(400, 4)
    cut = 150
    early, late = [r for r in rows if r[4] < cut], [r for r in rows if r[4] >= cut]
    make = lambda part: spark.createDataFrame(part, SCHEMA)
    current = history(make(early), ["p", "s"], F.col("at"), ["price", "promo"])
    merged = merge_history(current, make(late), ["p", "s"], F.col("at"), ["price", "promo"])
    assert found(merged) == brute(rows)


def test_both_paths_agree_on_null_keys_and_merges(spark):
    rows = [(None, 7, *r[2:]) if r[0] == 1 else r for r in sample(600, 8)]
    early, late = [r for r in rows if r[4] < 200], [r for r in rows if r[4] >= 200]
    make = lambda part: spark.createDataFrame(part, SCHEMA)
    for hot_rows in (25, 2_000_000):
        assert found(history(make(rows), ["p", "s"], F.col("at"), ["price", "promo"], hot_rows, 16)) == brute(rows)
        current = history(make(early), ["p", "s"], F.col("at"), ["price", "promo"], hot_rows, 16)
        assert found(merge_history(current, make(late), ["p", "s"], F.col("at"), ["price", "promo"], hot_rows, 16)) == brute(rows)


def test_late_snapshots_split_closed_versions(spark):
    a, b, c, d = (Decimal(f"{i}.0000") for i in range(1, 5))
    make = lambda part: spark.createDataFrame([(*k, v, None, t, "x") for k, v, t in part], SCHEMA)
    current = history(make([((1, None), a, 10), ((1, None), b, 20), ((1, None), a, 30), ((2, 2), a, 1), ((2, 2), b, 9)]), ["p", "s"], F.col("at"), ["price", "promo"])
    updates = make([((1, None), c, 5), ((1, None), d, 25), ((1, None), b, 26), ((1, None), a, 40), ((2, 2), b, 11), ((3, 3), a, 1), ((3, 3), a, None)])
    merged = merge_history(current, updates, ["p", "s"], F.col("at"), ["price", "promo"])
    expected = [(1, None, c, 5, 10), (1, None, a, 10, 20), (1, None, b, 20, 25), (1, None, d, 25, 26), (1, None, b, 26, 30), (1, None, a, 30, -1), (2, 2, a, 1, 9), (2, 2, b, 9, -1), (3, 3, a, 1, -1)]
    assert {(r["p"], r["s"], r["price"], r["valid_from"], r["valid_to"]) for r in merged.collect()} == set(expected) and merged.count() == len(expected)
    nothing = make([])
    assert merge_history(current, nothing, ["p", "s"], F.col("at"), ["price", "promo"]).count() == current.count() == 5
