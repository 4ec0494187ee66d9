import random

from pyspark.sql import functions as F

from shelfspark.functions import clean
from shelfspark.operators.ranking import rank_all, running
from shelfspark.operators.search import search_ranked, two_stage_search
from shelfspark.streaming.feeds import with_flush_records


def test_positions_equal_sorting_also_in_hot_groups(spark):
    random.seed(1)
    rows = [(random.choice(["hot"] * 5 + ["a", "b", None]), random.randrange(50), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    found = {r["i"]: r["place"] for r in rank_all(df, ["g"], [F.desc("v"), F.col("i")], "place", partitions=9).collect()}
    for g in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [found[r[2]] for r in ordered] == list(range(1, len(ordered) + 1))
    assert rank_all(df.limit(0), ["g"], [F.col("i")]).count() == 0


def test_search_stages(spark):
    products = spark.createDataFrame([(1, "milk chocolate", "a"), (2, "Milk drink", "chocolate co"), (3, "chocolote milk", None), (4, None, None)], "id long, item_name string, manufacturer_name string")
    chains = spark.createDataFrame([(1, 3)], "id long, chain_count long")
    ranked = {r["id"]: r["search_rank"] for r in search_ranked(products, chains, "chocolate").collect()}
    assert set(ranked) == {1, 2} and ranked[1] > ranked[2] > 0
    stages = {r["id"]: r["stage"] for r in two_stage_search(products, chains, "chocolate", 3, 0.2).collect()}
    assert stages == {1: "words", 2: "words", 3: "similar"}
    assert {r["id"] for r in two_stage_search(products, chains, "chocolate", 2, 0.2).collect()} == {1, 2}
    assert search_ranked(products, chains, " ").count() == 0


def test_rules_and_flush_records(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i int, v string")
    rule = clean.first_rule([(F.col("v") == "x", "first"), (F.col("i") < 3, F.col("v"))], "rest")
    assert [r[0] for r in df.select(rule.alias("o"), "i").orderBy("i").select("o").collect()] == ["first", None, "rest"]
    messages = sorted(tuple(r) for r in with_flush_records(spark.createDataFrame([("f", 1), ("f", 2)], "file_name string, v int")).collect())
    assert messages == [("f", '{"file_name":"f","v":1}'), ("f", '{"file_name":"f","v":2}'), ("f", '{"type":"flush","file_name":"f"}')]


def test_running_equals_brute_force(spark):
    random.seed(9)
    rows = [(random.choice(["hot", "hot", "hot", "a", None]), i, random.choice([None, None, f"v{i}"]), random.randrange(-3, 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int, v string, n long").withColumn("m", F.col("n"))
    for partitions in (1, 7):
        found = {r["i"]: (r["v"], r["n"], r["m"]) for r in running(df, ["k"], [F.col("i")], {"v": "last", "n": "sum", "m": "min"}, partitions).collect()}
        state, expected = {}, {}
        for k, i, v, n in rows:
            last, total, least = state.get(k, (None, 0, 99))
            state[k] = expected[i] = (v if v is not None else last, total + n, min(least, n))
        assert found == expected
    assert running(df.limit(0), ["k"], [F.col("i")], {"v": "last"}).count() == 0
