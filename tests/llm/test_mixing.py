import pytest

from shelfspark.llm import mixing, queries
from shelfspark.llm.mixing import actual_shares, chosen_repeats, distinct_texts, emitted, source_rates


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, f"text number {i} of the large source with several words", " Big ") for i in range(3000)]
    rows += [(10_000 + i, f"small text {i}", "small") for i in range(100)]
    rows += [(20_000 + i, "the same text again and again", "copies") for i in range(500)]
    rows += [(30_000, None, "big"), (30_001, " \n", "big"), (30_002, "no target", "other"), (30_003, "no source", None), (30_004, "x " * 40_000, "BIG"), (30_005, "small text 1", "BIG")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 2), ("SMALL", 0.2, 3), ("copies", 0.2, 4), ("absent", 0.1, 2)], "source string, target_share double, max_repeats int")
    return documents, targets


def shares(tables, total=None):
    documents, targets = tables
    texts = distinct_texts(documents, targets).cache()
    rates = source_rates(texts, targets, total)
    chosen = chosen_repeats(texts, rates)
    return texts, chosen, {r["source_name"]: r for r in actual_shares(rates, chosen).collect()}


def test_equal_texts_are_one_and_tokens_are_counted(tables):
    documents, targets = tables
    texts = {r["doc_id"]: r for r in distinct_texts(documents, targets).collect()}
    assert 20_000 in texts and 20_001 not in texts and 30_005 not in texts and 10_001 in texts
    assert not {30_000, 30_001, 30_002, 30_003} & texts.keys()
    encoding = mixing._encoding(mixing.TOKENIZER)
    assert texts[5]["tokens"] == len(encoding.encode_ordinary("text number 5 of the large source with several words"))


def test_no_text_is_used_too_often_and_rates_reach_the_shares(tables):
    _, chosen, found = shares(tables)
    assert max(r["copies"] for r in chosen.filter("source_name = 'copies'").collect()) <= 4
    assert found["copies"]["rate"] == pytest.approx(4.0)
    used = {n: r["rate"] * r["available_tokens"] for n, r in found.items()}
    assert used["small"] / sum(used.values()) == pytest.approx(0.2 / 0.9)
    assert found["absent"]["rate"] == 0 and found["absent"]["actual_share"] == 0
    assert sum(r["actual_share"] for r in found.values()) == pytest.approx(1.0)


def test_given_total_is_met_up_to_the_limits(tables):
    texts, chosen, found = shares(tables, 20_000)
    assert found["big"]["rate"] * found["big"]["available_tokens"] == pytest.approx(0.5 / 0.9 * 20_000)
    assert found["small"]["most_repeats"] == 3 and found["copies"]["rate"] == 4.0
    assert all(r["copies"] <= 3 for r in chosen.filter("source_name = 'small'").collect())


def test_choice_is_the_same_at_every_run_and_partitioning(tables):
    documents, targets = tables
    once = sorted(chosen_repeats((t := distinct_texts(documents, targets)), source_rates(t, targets)).collect())
    again = sorted(chosen_repeats((t := distinct_texts(documents.repartition(7), targets)), source_rates(t, targets)).collect())
    assert once == again


def test_copies_follow_the_rate(spark):
    texts = spark.range(20_000).selectExpr("id AS doc_id", "'s' AS source_name", "1L AS tokens")
    rates = spark.createDataFrame([("s", 1.3)], "source_name string, rate double")
    chosen = chosen_repeats(texts, rates).groupBy("copies").count().collect()
    counts = {r["copies"]: r["count"] for r in chosen}
    assert set(counts) == {1, 2} and counts[2] == pytest.approx(6000, abs=250)


def test_empty_tables(tables):
    documents, targets = tables
    assert distinct_texts(documents.limit(0), targets).collect() == []
    texts = distinct_texts(documents.limit(0), targets)
    assert {r["rate"] for r in source_rates(texts, targets).collect()} == {0.0}
    assert source_rates(texts, targets.limit(0)).collect() == []


def test_shares_stay_within_the_tolerance(tables, spark, data):
    _, _, found = shares(tables)
    assert all(abs(r["actual_share"] - r["expected_share"]) <= r["tolerance"] + 1e-9 for r in found.values())
    assert found["small"]["expected_share"] == pytest.approx(0.2 / 0.9)
    real = queries.QUERIES["p9_shares"](spark, data.replace("sf0.001", "sf0.01")).collect()
    assert all(abs(r["actual_share"] - r["expected_share"]) <= r["tolerance"] + 1e-9 for r in real) and sum(r["tolerance"] > 0 for r in real) > 3


def test_copies_are_emitted(tables):
    documents, targets = tables
    _, chosen, _ = shares(tables)
    rows = emitted(documents, chosen).collect()
    assert len(rows) == sum(r["copies"] for r in chosen.collect())
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in rows) and max(r["copy_no"] for r in rows) == 4
    assert emitted(documents.limit(0), chosen).count() == 0
