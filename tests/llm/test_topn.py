import random
from decimal import Decimal

from pyspark.sql import functions as F

from shelfspark.llm.topn import top_items, top_positions

SCHEMA = "g string, h int, item_code string, score decimal(18,4), promotion_id string, part_ int, position int, best_ string"


def brute(rows, most):
    best = {}
    for g, h, item, score, promo, *_ in rows:
        if score is None or item is None:
            continue
        rank = (-score, promo is None, promo or "")
        if (g, h, item) not in best or rank < best[g, h, item]:
            best[g, h, item] = rank
    out = []
    for group in {k[:2] for k in best}:
        items = sorted((r[0], k[2].encode(), k[2], r[2] if not r[1] else None) for k, r in best.items() if k[:2] == group)
        out += [("|".join("" if x is None else str(x) for x in group), n + 1, i[2], i[3]) for n, i in enumerate(items[:most])]
    return sorted(out, key=str)


def run(df, most):
    found = top_items(df, "t", ["g", "h"], "item_code", "score", "promotion_id", most)
    return sorted((tuple(r) for r in found.select("group_key", "rank_no", "item_code", "promotion_id").collect()), key=str)


def test_equals_brute_force_with_hot_group_ties_and_nulls(spark):
    random.seed(1)
    rows = []
    for _ in range(1500):
        g = "hot" if random.random() < 0.4 else random.choice(["a", "b", None, ""])
        rows.append((g, random.choice([1, 2, None]), random.choice([None, *(f"i{n}" for n in range(60)), "פריט", "é"]), random.choice([None, Decimal("1.0000"), Decimal("2.5000"), Decimal("-1.0000")]), random.choice([None, "p1", "p2"]), 7, 8, "x"))
    # null and '' make one key text but two groups
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert run(df, 5) == brute(rows, 5)


def test_positions_go_on_over_partitions(spark):
    df = spark.range(0, 5000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 5000).alias("v"))
    found = top_positions(df, ["g"], [F.col("v")], 1200, partitions=16)
    assert sorted((r["position"], r["v"]) for r in found.collect()) == [(v + 1, v) for v in range(1200)]


def test_empty(spark):
    assert run(spark.createDataFrame([], SCHEMA), 3) == []
