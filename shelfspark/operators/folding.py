"""Folding several versions of a record into one: scalars, maps, arrays and keyed items."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys under which an item's code is found, in this order.
CODE_KEYS = ("itemcode", "item_code", "ItemCode", "itemCode", "Item_Code", "ITEMCODE")


def fold_rows(rows: DataFrame, keys: Sequence[str], order: str, first_filled: Sequence[str] = (), any_true: Sequence[str] = (), merge_maps: Sequence[str] = (), merge_arrays: Sequence[str] = ()) -> DataFrame:
    """One row per key. Scalars: first filled value in ``order``; flags: whether any is true;
    maps: later rows win; arrays: distinct values of all rows, sorted.

    Scalars and flags are combined in the map tasks. Maps and arrays are
    exploded and aggregated by entry before they are gathered, so a key with
    very many rows gathers each entry once. ``order`` must be unique in a key.
    """
    scalars = rows.groupBy(*keys).agg(
        *[F.min_by(F.when(F.trim(c) != "", F.col(c)), F.when(F.trim(c) != "", F.col(order))).alias(c) for c in first_filled],
        *[F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in any_true],
        F.count(F.lit(1)).alias("folded_rows"),
    )
    for c in merge_maps:
        entries = rows.select(*keys, order, F.explode(c).alias("k_", "v_")).groupBy(*keys, "k_").agg(F.max_by("v_", order).alias("v_"))
        merged = entries.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k_", "v_")))).alias(c))
        scalars = scalars.join(merged, list(keys), "left")
    for c in merge_arrays:
        values = rows.select(*keys, F.explode(c).alias("v_")).filter(F.col("v_").isNotNull()).distinct()
        scalars = scalars.join(values.groupBy(*keys).agg(F.array_sort(F.collect_list("v_")).alias(c)), list(keys), "left")
    return scalars


def map_concat_right(left: Column, right: Column) -> Column:
    """Both maps' entries, the right side's value where both have a key; null counts as empty."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    a, b = F.coalesce(left, empty), F.coalesce(right, empty)
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)


def item_code(item: Column) -> Column:
    """An item's code under the first of its keys that is filled, else null."""
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(item, f"$['{k}']")), F.lit("")) for k in CODE_KEYS])


def item_key(item: Column) -> Column:
    """An item's code under any of its keys, else its whole JSON."""
    return F.coalesce(item_code(item), item)


def _as_json(item: Column) -> Column:
    """An array's element as JSON again; text that is no JSON was a string."""
    quoted = F.to_json(F.array(item))
    return F.when(F.try_parse_json(item).isNotNull(), item).otherwise(F.substr(quoted, F.lit(2), F.length(quoted) - 2))


def merge_items(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], items: str = "items") -> DataFrame:
    """One JSON array per key of both sides' items: of equal item codes the incoming one stays.

    Existing items come before incoming ones, each in its order; a replaced item
    takes the incoming place; nulls among the items are left out. An array that is null, empty or no array on one
    side leaves the other as it is. Keys that only one side has stay.
    """
    parts = []
    for source, df in ((0, existing), (1, incoming)):
        listed = F.from_json(F.col(items), "array<string>")
        parts.append(df.select(*keys, F.lit(source).alias("source_"), F.posexplode_outer(listed).alias("place_", "item_")))
    rows = parts[0].unionByName(parts[1])
    code = rows.filter(F.col("item_").isNotNull()).withColumn("code_", item_key(F.col("item_")))
    w = Window.partitionBy(*keys, "code_").orderBy(F.desc("source_"), "place_")
    kept = code.withColumn("n_", F.row_number().over(w)).filter("n_ = 1")
    merged = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("source_", "place_", "item_"))).alias("all_"))
    text = F.concat(F.lit("["), F.array_join(F.transform("all_", lambda s: _as_json(s["item_"])), ","), F.lit("]"))
    every = rows.select(*keys).distinct()
    return every.join(merged.select(*keys, text.alias(items)), list(keys), "left").fillna("[]", [items])


def item_of(fields: Mapping[str, Column]) -> Column:
    """An item as JSON from the fields of a flat row, trimmed; null and blank ones are left out."""
    return F.to_json(F.struct(*[F.nullif(F.trim(c), F.lit("")).alias(n) for n, c in fields.items()]))


def append_unique(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], items: str = "items") -> DataFrame:
    """One JSON array per key: the existing items, then incoming ones that differ from all before.

    Items are compared by their canonical JSON (keys sorted), in which they are
    also written. What is null, empty or no array has no items. Each item is one
    row until the arrays are made, and equal ones of a key are combined before.
    """
    parts = []
    for source, df in ((0, existing), (1, incoming)):
        listed = F.from_json(F.col(items), "array<string>")
        parts.append(df.select(*keys, F.lit(source).alias("source_"), F.posexplode_outer(listed).alias("place_", "item_")))
    rows = parts[0].unionByName(parts[1])
    once = rows.filter(F.col("item_").isNotNull()).withColumn("item_", lenient_json(_as_json(F.col("item_")))).groupBy(*keys, "item_").agg(F.min(F.struct("source_", "place_")).alias("first_"))
    merged = once.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first_", "item_"))).alias("all_"))
    text = F.concat(F.lit("["), F.array_join(F.transform("all_", lambda s: s["item_"]), ","), F.lit("]"))
    return rows.select(*keys).distinct().join(merged.select(*keys, text.alias(items)), list(keys), "left").fillna("[]", [items])


def lenient_json(column: str | Column) -> Column:
    """JSON text of a value written as JSON, as a Python literal or with single quotes; null if none of these."""

    def read(batch: pd.Series) -> pd.Series:
        return batch.map(_lenient)

    return F.pandas_udf(read, "string")(column)


def _words(text: str) -> str:
    """Python's words for nothing, true and false as JSON's, outside strings."""
    words = {"None": "null", "True": "true", "False": "false"}
    return re.sub(r'"(?:[^"\\]|\\.)*"|\b(?:None|True|False)\b', lambda m: words.get(m[0], m[0]), text)


def _lenient(text: str | None) -> str | None:
    if not text or not text.strip():
        return None
    for parse in (json.loads, ast.literal_eval, lambda t: json.loads(_words(t.replace("'", '"')))):
        try:
            return json.dumps(parse(text.strip()), ensure_ascii=False, sort_keys=True, default=str)
        except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
            continue
    return None
