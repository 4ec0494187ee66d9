import random

import pytest

from shelfspark.llm.canonical import Dictionary, Entry, damerau, deletions, map_to_reference

NAMES = [(1, "גבעת ניחנו", "Givat Niheno"), (2, "נווה קבפי", "Neve Kebepi"), (3, "מעלה קבפי", "Maale Kebepi"), (4, "זונוחי", "Zonohi"), (5, "כפר דושאתו", "Kfar Doshato"), (6, "רמת סאסף", "Ramat Sasepe")]
CASES = [
    ("גבעת  ניחנו ", 1), ("גבעת-ניחנו", 1), ("ניחנו, גבעת", 1), ("ניחנו / גבעת", 1), ("ונחינ תעבג", 1), ("גבעתניחנו", 1), ("יישוב גבעת ניחנו", 1), ("גבעת ניחנו, רח' ראשי 5", 1), ("גבעת ניחנו - אזור תעשייה", 1), ("גִבִעתֹ נִיחנוּ", 1), ("‏גבעת ניחנו", 1),
    ("GIVAT NIHENO", 1), ("Givaat Niheno", 1), ("givat_niheno", 1), ("גבעת נחנו", 1), ("גבעת ניחנוו", 1), ("גבעת ינחנו", 1), ("ג. ניחנו", 1), ("ג.ניחנו", 1), ("ניחנו", 1), ("Doshato", 5), ("רמת סאספ", 6), ("זונחי", 4),
    ("קבפי", -1), ("אינטרנט", -1), ("NO_BODY", -1), ("-", -1), ("0", -1), ("רמת ניחנו", -1), ("x" * 20000, -1), ("מ. קבפי", 3), ("נ. קבפי", 2),
]


@pytest.fixture
def dictionary():
    return Dictionary.of(Entry(i, [a, b], 10 - i) for i, a, b in NAMES)


@pytest.mark.parametrize(("value", "expected"), CASES)
def test_values(dictionary, value, expected):
    assert dictionary.find(value) == expected


def test_more_frequent_entry_wins_ties():
    d = Dictionary.of([Entry(1, ["abcde"], 1), Entry(2, ["abcdf"], 5)])
    assert d.find("abcdx") == 2


def test_distances_and_deletions():
    random.seed(2)
    for _ in range(300):
        a, b = ("".join(random.choice("abc") for _ in range(random.randrange(6))) for _ in range(2))
        d = [[max(i, j) if not min(i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j - 1] + (a[i - 1] != b[j - 1]), d[i - 1][j] + 1, d[i][j - 1] + 1)
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        assert damerau(a, b, False) == d[-1][-1]
        assert damerau(a, b) <= damerau(a, b, False)
        if d[-1][-1] <= 1:
            assert deletions(a, 1) & deletions(b, 1)


@pytest.mark.parametrize("most", [100, 2])
def test_rows_with_broadcast_and_with_join(spark, most):
    refs = spark.createDataFrame([*NAMES, (7, None, "x"), (None, "y", None)], "ref_id long, city_name string, city_name_latin string")
    values = [(i, v, "extra") for i, (v, _) in enumerate(CASES)] + [(100, None, ""), (101, " \t", ""), (102, "גבעת ניחנו", ""), (103, "גבעת-ניחנו", "")]
    df = spark.createDataFrame(values, "id long, city string, names string")
    found = {r["id"]: r["ref_id"] for r in map_to_reference(df, "id", "city", refs, "ref_id", ["city_name", "city_name_latin"], most).collect()}
    assert found == {i: e for i, (_, e) in enumerate(CASES)} | {103: 1}


def test_empty_tables(spark):
    refs = spark.createDataFrame([], "ref_id long, city_name string, city_name_latin string")
    df = spark.createDataFrame([(1, "a")], "id long, city string")
    names = ["city_name", "city_name_latin"]
    assert [tuple(r) for r in map_to_reference(df, "id", "city", refs, "ref_id", names).collect()] == [(1, "a", -1)]
    assert map_to_reference(df.limit(0), "id", "city", refs, "ref_id", names).collect() == []
