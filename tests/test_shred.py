import json
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.operators.shred import REPEATED, _parsed_deep, child_rows, leaf_paths, nested_rows, parse_json, places, shred, sparse_columns, sparse_places

SCALARS = st.one_of(st.integers(0, 99).map(str), st.none(), st.text("ab ", max_size=3))
KEYS = st.sampled_from(["ItemCode", "item_code", "GroupId", "groupid", "items", "Group", "x"])
TREES = st.recursive(SCALARS, lambda t: st.one_of(st.lists(t, max_size=4), st.dictionaries(KEYS, t, max_size=4)), max_leaves=25)


def brute(value, group="", parent=""):
    out = []
    if isinstance(value, list):
        for v in value:
            out += brute(v, group, parent)
    elif isinstance(value, dict):
        named = lambda name: next((str(v).strip() for k, v in value.items() if k.replace("_", "").lower() == name and isinstance(v, (str, bool)) and str(v).strip()), "")
        group = named("groupid") or group
        if code := named("itemcode"):
            out.append((group, parent, code))
        for v in value.values():
            out += brute(v, group, code or parent)
    return out


@settings(max_examples=300, deadline=None)
@given(TREES)
def test_rows_equal_recursion(value):
    assert sorted(nested_rows(value)) == sorted(brute(value))


@settings(max_examples=200, deadline=None)
@given(TREES)
def test_levels_give_every_leaf_its_place(value):
    paths = leaf_paths(value, lambda _: True)
    columns = shred(value, paths)

    def leaves(at, path=(), index=()):
        if isinstance(at, dict):
            for k, v in at.items():
                yield from leaves(v, (*path, k), index)
        elif isinstance(at, list):
            for i, v in enumerate(at):
                yield from leaves(v, (*path, REPEATED), (*index, i))
        elif at is not None and path and path[-1] is not REPEATED:
            yield path, index, str(at)

    rebuilt = {(p, i, v) for p in paths for i, v in places(p, columns[p]).items()}
    assert rebuilt == set(leaves(value))
    assert all(c[0][0] == 0 for c in columns.values())


@settings(max_examples=200, deadline=None)
@given(TREES)
def test_sparse_columns_hold_what_full_ones_do(value):
    paths, columns = sparse_columns(value, lambda _: True)

    def steps(path):
        return () if path == 0 else (*steps(paths.above[path]), paths.step[path])

    full = shred(value, leaf_paths(value, lambda _: True))
    expected = {p: places(p, c) for p, c in full.items()}
    assert {steps(p): sparse_places(c) for p, c in columns.items()} == {p: v for p, v in expected.items() if v}


def test_time_grows_with_the_record():
    def seconds(n):
        text = json.dumps([{"items": [{"itemcode": str(i), f"key{i}": [{"itemcode": f"x{i}"}]}]} for i in range(n)])
        began = time.perf_counter()
        assert len(nested_rows(parse_json(text))) == 2 * n
        return time.perf_counter() - began

    seconds(100)
    assert seconds(20_000) < 40 * max(0.05, seconds(2_000))  # ten times the elements; a square would be a hundred
    deep = 10_000
    text = '{"itemcode": "1", "items": [' * deep + "]}" * deep
    assert nested_rows(parse_json(text)) .count(("", "1", "1")) == deep - 1


def test_texts():
    assert nested_rows(parse_json('﻿ {"groupid": 2, "items": "[{\\"itemcode\\": 7}]"} ')) == [("2", "", "7")]
    assert nested_rows(parse_json(json.dumps(json.dumps([{"ITEMCODE": " 5 ", "gifts": [{"itemCode": "6"}]}])))) == [("", "", "5"), ("", "5", "6")]
    for text in (None, "", "nan", "NO_BODY", "null", "[]", "{}", "[null]", "[{", '"a"', '{"itemcode": null}', '{"itemcode": " "}'):
        assert nested_rows(parse_json(text)) == []
    assert nested_rows(parse_json('[{"itemcode": 7990000008379.0}]')) == [("", "", "7990000008379.0")]
    assert nested_rows(parse_json("[" * 100000 + "]" * 100000)) == []


def test_child_rows_over_all_rows_of_a_promotion(spark):
    rows = [("c", "p", '[{"itemcode": "1"}]', [" 5 ", None, "", "5"], "x"), ("c", "p", '[{"itemcode": "1"}, {"itemcode": "2"}]', None, "y"), (None, None, None, [], "z"), ("c", "q", '{"itemcode": "' + "9" * 20000 + '"}', [" 7\t"], None)]
    df = spark.createDataFrame(rows, "chain_id string, promotion_id string, items string, available_in_store_ids array<string>, child_key string")
    found = sorted(tuple(r) for r in child_rows(df).collect())
    assert found == sorted([("c", "p", "store", "", "", "5"), ("c", "p", "item", "", "", "1"), ("c", "p", "item", "", "", "2"), ("c", "q", "item", "", "", "9" * 20000), ("c", "q", "store", "", "", "7")])
    assert child_rows(df.limit(0)).collect() == []


def test_long_lists(spark):
    random.seed(1)
    value = [{"groupid": str(i), "items": [{"itemcode": f"{i}-{j}"} for j in range(random.randrange(5))]} for i in range(3000)]
    assert sorted(nested_rows(value)) == sorted(brute(value))


def test_nested_at_any_depth():
    for levels in (150, 300, 1_000):
        text = "".join(f'{{"itemcode": {i}, "items": [' for i in range(levels)) + "]}" * levels
        expected = sorted(("", str(i - 1) if i else "", str(i)) for i in range(levels))
        assert sorted(nested_rows(parse_json(text))) == expected
    text = "[" * 20_000 + '{"itemcode": "x"}' + "]" * 20_000
    assert nested_rows(parse_json(text)) == [("", "", "x")]
    assert parse_json("[" * 20_000) is None


def test_deep_parser_equals_json():
    texts = ['{"a": [1, -2.50e3, true, false, null, NaN, -Infinity], "b": {}, "c": [], "é\\u00e9": "x\\n"}', " [ ] ", '"s"', "1", '{"a": 1, "a": 2}', "[1,]", '{"a": 1,}', "[1 2]", '{"a" 1}', "{1: 2}", "", "[", '["x]', "[1]]", "01", "tru"]
    for text in texts:
        try:
            expected = json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
        except ValueError:
            with pytest.raises(ValueError):
                _parsed_deep(text)
        else:
            assert _parsed_deep(text) == expected
