"""Flat child tables from deeply nested records, by columnar shredding.

A record is split into one column per leaf path. Each entry of a column has a
repetition level (which repeated step of the path began anew, 0 at the record's
start) and a definition level (how many steps of the path are there), as in
Dremel's record format. Tables of a repeated ancestor are rebuilt from these
level sequences alone: counting the levels gives each value's place in every
list above it, and two leaves belong together where those places agree.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPEATED = None  # the step of a path into the elements of a list
Path = tuple  # of key names and REPEATED
Column_ = list[tuple[int, int, str | None]]
SparseColumn = list[tuple[int, int, tuple[int, ...], str]]
_ABSENT = object()  # stands where a step of a path is not there
ROWS_PER_FRAME = 20_000


def parse_json(text: str | None) -> object:
    """The value of a JSON text, with JSON inside its strings parsed too, nested to any depth; None if it is no JSON.

    Numbers stay as written. A byte-order mark and white space around the text
    don't matter.
    """
    top = [_parsed(text)]
    stack: list[tuple[dict | list, object]] = [(top, 0)]
    while stack:
        holder, at = stack.pop()
        value = holder[at]
        if isinstance(value, str):
            if value.strip().lstrip("\ufeff").lstrip()[:1] in ("{", "[", '"') and (held := _parsed(value)) is not None:
                holder[at] = held
                stack.append((holder, at))
        elif isinstance(value, (dict, list)):
            stack += [(value, k) for k, v in (value.items() if isinstance(value, dict) else enumerate(value)) if isinstance(v, (str, dict, list))]
    return top[0]


def _parsed(text: str | None) -> object:
    if text is None:
        return None
    text = text.strip().lstrip("\ufeff").strip()
    try:
        return json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
    except RecursionError:
        pass
    except ValueError:
        return None
    try:
        return _parsed_deep(text)
    except ValueError:
        return None


_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null|NaN|-?Infinity")
_WORDS = {"true": True, "false": False, "null": None}


def _parsed_deep(text: str) -> object:
    """As ``json.loads``, with a stack of its own."""

    def skip(i: int) -> int:
        return _SPACE.match(text, i).end()

    def key_at(i: int) -> tuple[str, int]:
        if text[i : i + 1] != '"':
            raise ValueError("no key")
        key, i = scanstring(text, i + 1, True)
        i = skip(i)
        if text[i : i + 1] != ":":
            raise ValueError("no colon")
        return key, skip(i + 1)

    open_: list[tuple[dict | list, str | None]] = []
    i = skip(0)
    while True:
        c = text[i : i + 1]
        if c in ("{", "["):
            i = skip(i + 1)
            value = {} if c == "{" else []
            if text[i : i + 1] != ("}" if c == "{" else "]"):
                key, i = key_at(i) if c == "{" else (None, i)
                open_.append((value, key))
                continue
            i += 1
        elif c == '"':
            value, i = scanstring(text, i + 1, True)
        elif m := _SCALAR.match(text, i):
            value, i = _WORDS.get(m[0], m[0]), m.end()
        else:
            raise ValueError("no value")
        while True:
            i = skip(i)
            if not open_:
                if i != len(text):
                    raise ValueError("more than one value")
                return value
            holder, key = open_[-1]
            if isinstance(holder, list):
                holder.append(value)
            else:
                holder[key] = value
            c = text[i : i + 1]
            if c == ",":
                i = skip(i + 1)
                if isinstance(holder, dict):
                    key, i = key_at(i)
                    open_[-1] = (holder, key)
                break
            if c != ("]" if isinstance(holder, list) else "}"):
                raise ValueError("not closed")
            value, _ = open_.pop()
            i += 1


def leaf_paths(value: object, wanted: Callable[[str], bool]) -> list[Path]:
    """Paths that lead to a scalar under a wanted key, in the order of their first value."""
    found: dict[Path, None] = {}
    stack: list[tuple[object, tuple | None]] = [(value, None)]  # with (path above, step): long paths are made for leaves alone
    while stack:
        at, path = stack.pop()
        if isinstance(at, dict):
            stack += [(v, (path, k)) for k, v in reversed(at.items())]
        elif isinstance(at, list):
            stack += [(v, (path, REPEATED)) for v in reversed(at)]
        elif path and path[1] is not REPEATED and at is not None and wanted(path[1]):
            steps = []
            while path:
                path, step = path
                steps.append(step)
            found[tuple(reversed(steps))] = None
    return list(found)


def shred(value: object, paths: Sequence[Path]) -> dict[Path, Column_]:
    """The columns (repetition level, definition level, value) of these leaf paths."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path:
            node = node.setdefault(step, {})
        node[...] = path
    columns: dict[Path, Column_] = {p: [] for p in paths}

    stack: list[tuple[object, dict, int, int, int]] = [(value, tree, 0, 0, 0)]
    while stack:
        at, node, r, d, repeats = stack.pop()
        for step, below in node.items():
            if step is ...:
                scalar = at is not None and not isinstance(at, (dict, list))
                columns[below].append((r, d, None) if at is _ABSENT else (r, d if scalar else d - 1, _text(at) if scalar else None))
            elif step is REPEATED and isinstance(at, list) and at:
                stack += [(at[i], below, repeats + 1 if i else r, d + 1, repeats + 1) for i in range(len(at) - 1, -1, -1)]
            elif step is not REPEATED and isinstance(at, dict) and step in at:
                stack.append((at[step], below, r, d + 1, repeats))
            else:
                stack.append((_ABSENT, below, r, d, repeats))
    return columns


def _text(value: object) -> str:
    return {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)


class Paths:
    """Paths as a tree: the step and the path above of each, by number; the whole record is number 0."""

    def __init__(self) -> None:
        self.above, self.step, self.repeats = [-1], [None], [0]
        self._below: list[dict] = [{}]

    def below(self, path: int, step: str | None) -> int:
        found = self._below[path].get(step)
        if found is None:
            found = self._below[path][step] = len(self.above)
            self.above.append(path)
            self.step.append(step)
            self.repeats.append(self.repeats[path] + (step is REPEATED))
            self._below.append({})
        return found


def sparse_columns(value: object, wanted: Callable[[str], bool]) -> tuple[Paths, dict[int, SparseColumn]]:
    """The columns of the wanted leaves, without entries for what is absent.

    An entry is (repetition level, elements passed over at that level, places in
    the lists below, value): where ``shred`` writes an entry for every element
    that lacks the path, here the next entry tells how many were passed over,
    and where in deeper lists it stands. So a record takes time and space in
    proportion to its values and their levels, however its keys differ.
    """
    paths, columns, last = Paths(), {}, {}
    stack: list[tuple[object, int, tuple[int, ...]]] = [(value, 0, ())] if isinstance(value, (dict, list)) else []
    while stack:
        at, path, place = stack.pop()
        if isinstance(at, dict):
            stack += [(v, paths.below(path, k), place) for k, v in reversed(at.items()) if isinstance(v, (dict, list)) or (v is not None and wanted(k))]
        elif isinstance(at, list):
            below = paths.below(path, REPEATED)
            stack += [(at[i], below, (*place, i)) for i in range(len(at) - 1, -1, -1) if isinstance(at[i], (dict, list))]
        else:
            before = last.get(path)
            r = next((i for i, (x, y) in enumerate(zip(before, place)) if x != y), len(place)) if before is not None else -1
            entry = (r + 1, place[r] - before[r] - 1, place[r + 1 :], _text(at)) if 0 <= r < len(place) else (0, 0, place, _text(at))
            columns.setdefault(path, []).append(entry)
            last[path] = place
    return paths, columns


def sparse_places(column: SparseColumn) -> dict[tuple[int, ...], str]:
    """Each value by its place in the lists of its path, counted from the levels."""
    at: tuple[int, ...] = ()
    found = {}
    for r, passed, below, value in column:
        at = (*at[: r - 1], at[r - 1] + 1 + passed, *below) if r else below
        found[at] = value
    return found


def places(path: Path, column: Column_) -> dict[tuple[int, ...], str]:
    """Each value by its place in the lists of its path, counted from the levels."""
    repeats, depth = sum(s is REPEATED for s in path), len(path)
    at, found = [0] * repeats, {}
    for i, (r, d, value) in enumerate(column):
        if i and r:
            at[r - 1] += 1
            at[r:] = [0] * (repeats - r)
        if d == depth and value is not None:
            found[tuple(at)] = value
    return found


def same_key(name: str) -> Callable[[str], bool]:
    """Compares keys without case and underscores."""
    return lambda key: key.replace("_", "").lower() == name


def nested_rows(value: object, code_key: str = "itemcode", group_key: str = "groupid") -> list[tuple[str, str, str]]:
    """(group, parent code, code) of each object with a code, in no fixed order.

    The group is that of the object itself or of the nearest object around it,
    the parent the nearest object with a code around it; '' where there is none.
    Codes and groups are trimmed; null and blank ones don't count.
    """
    is_code, is_group = same_key(code_key), same_key(group_key)
    paths, columns = sparse_columns(value, lambda k: is_code(k) or is_group(k))
    tables: tuple[dict[int, dict], dict[int, dict]] = {}, {}
    for path, column in columns.items():
        owner = tables[is_group(paths.step[path])].setdefault(paths.above[path], {})
        for place, v in sparse_places(column).items():
            if t := v.strip():
                owner.setdefault(place, t)
    codes, groups = tables

    def holders(table: dict[int, dict]) -> list[int]:
        """The nearest path from each upwards that has a table, or -1."""
        found: list[int] = []
        for path, above in enumerate(paths.above):
            found.append(path if path in table else found[above] if above >= 0 else -1)
        return found

    with_code, with_group = holders(codes), holders(groups)

    def nearest(table: dict[int, dict], holder: list[int], path: int, place: tuple[int, ...]) -> str:
        path = holder[path] if path >= 0 else -1
        while path >= 0:
            if hit := table[path].get(place[: paths.repeats[path]]):
                return hit
            path = holder[paths.above[path]] if paths.above[path] >= 0 else -1
        return ""

    return [(nearest(groups, with_group, owner, place), nearest(codes, with_code, paths.above[owner], place), code) for owner, rows in codes.items() for place, code in rows.items()]


def _records(batches: Iterator[pd.DataFrame], ids: Sequence[str], json_column: str) -> Iterator[tuple[tuple, str]]:
    for batch in batches:
        yield from zip(batch[list(ids)].itertuples(index=False, name=None), batch[json_column])


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows in frames of bounded length, so one batch of large records needs little memory."""
    while chunk := list(islice(rows, ROWS_PER_FRAME)):
        yield pd.DataFrame(chunk, columns=columns)


def shred_items(rows: DataFrame, ids: Sequence[str], json_column: str) -> DataFrame:
    """ids, group_no, parent_code, child_key of each nested object with an item code.

    Text that is null, blank or no JSON gives nothing; one row per occurrence.
    Each record is read whole, in the task that holds it; nothing is shuffled.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows_of = ((*k, *row) for k, text in _records(batches, ids, json_column) for row in nested_rows(parse_json(text)))
        yield from _frames(rows_of, [*ids, "group_no", "parent_code", "child_key"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ids)
    held = rows.select(*ids, json_column).filter(F.col(json_column).rlike(r"[\[{]"))
    return held.mapInPandas(read, f"{schema}, group_no string, parent_code string, child_key string")


def level_columns(rows: DataFrame, ids: Sequence[str], json_column: str) -> DataFrame:
    """All leaf columns of each record: ids, leaf_path, entry_no, repetition, definition, leaf_value.

    Paths are written with dots and ``[]`` for repeated steps. Entries without a
    value have a null ``leaf_value`` and the definition level reached.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def entries() -> Iterator[tuple]:
            for key, text in _records(batches, ids, json_column):
                value = parse_json(text)
                for path, column in shred(value, leaf_paths(value, lambda _: True)).items():
                    name = "".join("[]" if s is REPEATED else f".{s}" for s in path)
                    yield from ((*key, name, i, r, d, v) for i, (r, d, v) in enumerate(column))

        yield from _frames(entries(), [*ids, "leaf_path", "entry_no", "repetition", "definition", "leaf_value"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ids)
    return rows.select(*ids, json_column).mapInPandas(read, f"{schema}, leaf_path string, entry_no long, repetition int, definition int, leaf_value string")


def child_rows(promotions: DataFrame) -> DataFrame:
    """Items and stores of all rows of each promotion, each once: see ``shred_items``.

    A null list of stores has no stores; null and blank ids don't count.
    """
    ids = ["chain_id", "promotion_id"]
    items = shred_items(promotions, ids, "items").withColumn("child_kind", F.lit("item"))
    stores = promotions.select(*ids, F.explode("available_in_store_ids").alias("store"))
    stores = stores.select(*ids, F.regexp_replace("store", r"(?U)^\s+|\s+$", "").alias("child_key")).filter(F.length("child_key") > 0)
    stores = stores.withColumns({"child_kind": F.lit("store"), "group_no": F.lit(""), "parent_code": F.lit("")})
    columns = [*ids, "child_kind", "group_no", "parent_code", "child_key"]
    return items.select(*columns).unionByName(stores.select(*columns)).dropDuplicates(columns)
