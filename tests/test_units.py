import pytest

from shelfspark.operators.units import normalise_quantities, quantity_misses

CASES = [
    ("500", "גרם", False, None), ("500", 'מ"ל', None, None), ("6", "יחידה", None, None), ("500.0", "גרם", False, ("g", 500000)), (" 500 ", "גרם", False, ("g", 500000)),
    ("0,5", "KG", False, ("g", 500000)), ("1,000", 'מ״ל', False, ("ml", 1000000)), ("1,000.5", "g", False, ("g", 1000500)), ("1.5", "ליטר", False, ("ml", 1500000)),
    ('חצי ק"ג', None, False, ("g", 500000)), ("רבע ק״ג", None, None, ("g", 250000)), ("½ ק״ג", None, False, ("g", 500000)), ("1½ ליטר", None, False, ("ml", 1500000)),
    ('1 1/2 ק"ג', None, False, ("g", 1500000)), ("1/3 kg", None, False, ("g", 333333)), ("מארז 6 יח'", None, False, ("unit", 6000)), ("מארז 4x750", 'מ"ל', False, ("ml", 3000000)),
    ("6×330 מ\"ל", None, False, ("ml", 1980000)), ("תריסר", None, False, ("unit", 12000)), ("2 תריסר", None, False, ("unit", 24000)), ("14 fl. oz", None, False, ("ml", 414029)),
    ("24 OZ", None, False, ("g", 680389)), ("12", "fl oz", False, ("ml", 354882)), ("16", "אונקיה", False, ("g", 453592)), ("5.0 lbs", None, False, ("g", 2267962)), ('100000 מ"ג', None, False, ("g", 100000)),
    ("75cl", None, False, ("ml", 750000)), ("10", "dl", False, ("ml", 1000000)), ("330", "cc", False, ("ml", 330000)), ("כ-100 גרמים", None, False, ("g", 100000)), ("500 ג'", "ל-100 גרם", False, ("g", 500000)),
    ("0.15", None, True, ("g", 150000)), ("0.15", None, False, None), ("0.15", None, None, None), ("0.15", "NO_BODY", True, ("g", 150000)), ("גרם", "100 גרם", False, None), ("-", "גרם", False, None), ("", "גרם", True, None),
    (None, "גרם", True, None), ("nan", 'מ"ל', False, None), ("0", "יחידה", False, None), ("0.0", "KG", False, None), ("x" * 5000 + "1 kg", None, False, ("g", 1000000)), ("9" * 40, "kg", False, None), ("1/0 kg", None, False, None),
    ("⅓ kg", None, False, ("g", 333333)), ("⅔ תריסר", None, False, ("unit", 8000)), ("1 2/3 kg", None, False, ("g", 1666667)), ("0." + "0" * 60 + "1 kg", None, False, ("g", 0)), ("1" + "0" * 12 + " kg", None, False, ("g", 10**18)),
    ("9" * 5000 + " kg", None, False, None), ("1." + "5" * 100 + " kg", None, False, ("g", 1555556)), ("0.0000005 kg", None, False, ("g", 1)), ("0.00000049 kg", None, False, ("g", 0)), ("9000000000000000 g", None, False, ("g", 9 * 10**18)), ("99999999999999999 g", None, False, None),
]


def test_notations(spark):
    rows = [(i, q, m, w, "x", 1.0) for i, (q, m, w, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "unit long, unit_qty string, unit_of_measure string, b_is_weighted boolean, amount_ignored string, factor double")
    found = {r["unit"]: (r["base_unit"], r["amount_milli"]) for r in normalise_quantities(df, ["unit"]).collect()}
    for i, case in enumerate(CASES):
        assert found.get(i) == case[3], case


def test_misses_are_told(spark):
    rows = [("500", "גרם"), ("2 kg", None), (None, "גרם"), ("nan", "גרם"), ("0.15", None), ("0", "kg"), ("9" * 40, "kg"), ("9" * 5000, "kg"), ("99999999999999999 g", None), ("0", "kg")]
    df = spark.createDataFrame([(i, *r, False) for i, r in enumerate(rows)], "k long, unit_qty string, unit_of_measure string, b_is_weighted boolean")
    found = {r["k"]: r["reason"] for r in quantity_misses(df, ["k"]).collect()}
    assert found == {2: "no amount", 3: "no amount", 4: "no unit", 5: "zero", 6: "too large", 7: "too large", 8: "too large", 9: "zero"}


def test_repeats_and_differing_quantities_give_one_row(spark):
    df = spark.createDataFrame([(1, "2 kg", None, False)] * 3 + [(1, "1 kg", None, False), (None, "3 l", None, None)], "k long, unit_qty string, unit_of_measure string, b_is_weighted boolean")
    assert sorted(normalise_quantities(df, ["k"]).collect(), key=str) == sorted([(1, "g", 1000000), (None, "ml", 3000000)], key=str)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)]])
def test_nothing_to_read(spark, rows):
    df = spark.createDataFrame(rows, "k long, unit_qty string, unit_of_measure string, b_is_weighted boolean")
    assert normalise_quantities(df, ["k"]).collect() == []
