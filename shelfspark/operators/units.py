"""Quantities in different units and notations, converted to grams, millilitres or units."""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unit, its base unit, thousandths of the base unit, its spellings
# (lower case, with plain quotes). A spelling's longest match wins, so "fl oz"
# is not "oz" and מ"ג is not ג.
UNITS: list[tuple[str, str, str, list[str]]] = [
    ("mg", "g", "1", ["mg", 'מ"ג', "מג", "מיליגרם"]),
    ("g", "g", "1000", ["g", "g.", "gr", "gr.", "gram", "grams", "גרם", "גרמים", "גר'", "גר", "ג'", "ג"]),
    ("kg", "g", "1000000", ["kg", "kg.", "kgs", "kilo", "kilogram", 'ק"ג', "קג", "קילו", "קילוגרם", "ק'ג"]),
    ("oz", "g", "28349.523125", ["oz", "oz.", "ounce", "ounces", "אונקיה", "אונקיות"]),
    ("lb", "g", "453592.37", ["lb", "lb.", "lbs", "lbs.", "pound", "pounds", "ליברה", "ליברות"]),
    ("ml", "ml", "1000", ["ml", "ml.", 'מ"ל', "מל", "מל'", "מיליליטר", "cc", 'סמ"ק', "סמק"]),
    ("cl", "ml", "10000", ["cl", "cl.", "סנטיליטר"]),
    ("dl", "ml", "100000", ["dl", "dl.", "דציליטר"]),
    ("l", "ml", "1000000", ["l", "l.", "lt", "ltr", "ltr.", "liter", "liters", "litre", "litres", "ליטר", "ליטרים", "לי'", "לי", "ל'", "ל"]),
    ("fl_oz", "ml", "29573.5295625", ["fl oz", "fl. oz", "fl.oz", "fl. oz.", "floz", "fl oz."]),
    ("unit", "unit", "1000", ["unit", "units", "pc", "pcs", "pcs.", "pieces", "ct", "יח", "יח'", "יחידה", "יחידות", "יחי'"]),
    ("dozen", "unit", "12000", ["dozen", "תריסר"]),
]
# Words and signs that state an amount.
AMOUNT_WORDS = {"חצי": "0.5", "רבע": "0.25", "שלושת רבעי": "0.75", "half": "0.5", "quarter": "0.25"}
AMOUNT_SIGNS = {"½": "1/2", "¼": "1/4", "¾": "3/4", "⅓": "1/3", "⅔": "2/3", "⅛": "1/8"}
# Units in which the amounts of the table are already canonical.
CANONICAL = ("גרם", 'מ"ל', "יחידה")

_MARKS = "\u200e\u200f\u202a\u202b\u202c\u200b\u2066\u2067\u2068\u2069\ufeff"
_SPELLING = str.maketrans({"\u05f4": '"', "\u201d": '"', "\u201c": '"', "\u05f3": "'", "\u2019": "'", "\u2018": "'", "`": "'"} | dict.fromkeys(_MARKS))
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*|[.,]\d+")
_TIMES = re.compile(r"\s*[x×*✕хX]\s*")


def _plain(text: str) -> str:
    text = text.translate(_SPELLING).lower().replace("''", '"')
    return re.sub(r"\s+", " ", text).strip()


def _number(text: str) -> Fraction:
    """A comma before exactly three digits groups thousands, any other is a decimal mark."""
    if re.fullmatch(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?", text):
        return Fraction(text.replace(",", ""))
    head, *tail = re.split(r"[.,]", text)
    return Fraction(f"{head or 0}.{''.join(tail) or 0}")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for name, _, _, spellings in UNITS:
        for s in spellings:
            machine.add_word(s, ("unit", name, s))
    for word, value in AMOUNT_WORDS.items():
        machine.add_word(word, ("amount", value, word))
    machine.make_automaton()
    return machine


def _spans(text: str) -> list[tuple[int, int, str, str]]:
    """Longest matches at word borders, from left to right, none over another."""
    found = []
    for end, (kind, value, word) in _automaton().iter(text):
        start, stop = end - len(word) + 1, end + 1
        before, after = text[start - 1 : start], text[stop : stop + 1]
        if (before.isalpha() and word[0].isalpha()) or (after.isalpha() and word[-1].isalpha()) or after in ("'", '"') and word[-1].isalpha() and text[stop + 1 : stop + 2].isalpha():
            continue
        found.append((start, stop, kind, value))
    taken, last = [], -1
    for span in sorted(found, key=lambda s: (s[0], -s[1])):
        if span[0] >= last:
            taken.append(span)
            last = span[1]
    return taken


def read_quantity(unit_qty: str | None, unit_of_measure: str | None, weighted: bool | None) -> tuple[str, Fraction] | None:
    """(unit, amount) of a quantity, or None where it can't be read.

    The amount stands in ``unit_qty``: numbers, fractions, words and factors
    (packs count in total). The unit is the one nearest after the amount, else
    the nearest before, else the one that ``unit_of_measure`` names, else
    kilograms for a weighted row.
    """
    text = _plain(unit_qty or "")
    if not text:
        return None
    spans = _spans(text)
    units = [(a, b, v) for a, b, k, v in spans if k == "unit"]
    pieces: list[tuple[int, int, Fraction]] = [(a, b, Fraction(v)) for a, b, k, v in spans if k == "amount"]
    pieces += [(i, i + 1, Fraction(AMOUNT_SIGNS[c])) for i, c in enumerate(text) if c in AMOUNT_SIGNS]
    numbers = [(m.start(), m.end(), m.group()) for m in _NUMBER.finditer(text)]
    i = 0
    while i < len(numbers):
        start, end, number = numbers[i]
        if i + 1 < len(numbers) and re.fullmatch(r"\s*[/⁄]\s*", text[end : numbers[i + 1][0]]):
            below = _number(numbers[i + 1][2])
            if not below:
                return None
            pieces.append((start, numbers[i + 1][1], _number(number) / below))
            i += 2
        else:
            pieces.append((start, end, _number(number)))
            i += 1
    pieces.sort()
    if any(c == "-" and text[k + 1 : k + 2].isdigit() and (k == 0 or text[k - 1] == " ") for k, c in enumerate(text)):
        return None  # below zero
    total, at = None, None
    for start, end, value in pieces:
        if total is None:
            total, at = value, (start, end)
        else:
            between = text[at[1] : start]
            if _TIMES.fullmatch(between):
                total *= value
            elif between.strip() == "" and value < 1:  # 1 1/2
                total += value
            else:
                break
            at = (at[0], end)
    if total is None:
        dozen = [u for u in units if u[2] == "dozen"]
        return ("dozen", Fraction(1)) if dozen else None
    after = [u for u in units if u[0] >= at[1]]
    before = [u for u in units if u[1] <= at[0]]
    if after:
        return after[0][2], total
    if before:
        return before[-1][2], total
    named = [v for _, _, k, v in _spans(_plain(unit_of_measure or "")) if k == "unit"]
    if named:
        return named[0], total
    return ("kg", total) if weighted else None


def _read(qty: pd.Series, measure: pd.Series, weighted: pd.Series) -> pd.DataFrame:
    """Reads each distinct combination of the batch once."""
    rows = pd.Series(list(zip(qty.where(qty.notna(), None), measure.where(measure.notna(), None), weighted.eq(True).fillna(False))), dtype=object)
    codes, distinct = pd.factorize(rows)
    read = [_cached(q, m, bool(w)) for q, m, w in distinct]
    return pd.DataFrame({name: pd.Series([r[i] for r in read], dtype=object).take(codes).values for i, name in enumerate(("unit", "whole", "part", "reason"))})


@lru_cache(maxsize=200_000)
def _cached(qty: str | None, measure: str | None, weighted: bool) -> tuple[str | None, str | None, str | None, str | None]:
    """(unit, whole amount, 18 digits of the rest, rounded up, reason if it can't be read)."""
    try:
        found = read_quantity(qty, measure, weighted)
    except ValueError:  # more digits than Python reads at once
        return None, None, None, "too large"
    if found is None:
        return None, None, None, "no unit" if read_quantity(qty, measure, True) else "no amount"
    unit, amount = found
    if not amount:
        return None, None, None, "zero"
    whole, rest = divmod(amount, 1)
    if whole >= 10**20:
        return None, None, None, "too large"
    return unit, str(whole), str(-int(-rest * 10**18 // 1)), None


def conversion_factors(spark: SparkSession) -> DataFrame:
    """unit, base_unit and factor_e6 (millionths of a thousandth of the base unit); one row per unit."""
    rows = [(name, base, Decimal(factor) * 10**6) for name, base, factor, _ in UNITS]
    return spark.createDataFrame(rows, "unit string, base_unit string, factor_e6 decimal(14,0)")


def normalise_quantities(rows: DataFrame, keys: list[str], qty: str = "unit_qty", measure: str = "unit_of_measure", weighted: str = "b_is_weighted") -> DataFrame:
    """One row per key whose quantity is readable, not zero and not canonical yet.

    ``keys`` are columns of ``rows``. Result: keys, base_unit, amount_milli
    (thousandths of the base unit, rounded to the nearest, halves up; exact for
    fractions with up to 18 decimal places or a denominator under 80,000). A
    null flag counts as not weighted. Null, blank and wordless quantities, and
    amounts that no BIGINT holds, give no row here: ``quantity_misses`` tells
    why. Of differing quantities of one key the smallest (base unit, amount)
    stays.

    Rows already canonical are dropped before Python sees them; the factors, one
    row per unit, are broadcast; only converted rows are shuffled.
    """
    done = _converted(rows, keys, qty, measure, weighted).filter(F.col("milli_").isNotNull())
    return done.groupBy(*keys).agg(F.min(F.struct("base_", "milli_")).alias("least_")).select(*keys, F.col("least_.base_").alias("base_unit"), F.col("least_.milli_").alias("amount_milli"))


def quantity_misses(rows: DataFrame, keys: list[str], qty: str = "unit_qty", measure: str = "unit_of_measure", weighted: str = "b_is_weighted") -> DataFrame:
    """keys, the quantity as written and the reason, of each quantity that ``normalise_quantities`` gives no amount for.

    Reasons: 'no amount', 'no unit', 'zero', 'too large' (no BIGINT holds it). A
    null quantity has no amount; canonical rows are no misses. Repeats come once.
    """
    missed = _converted(rows, keys, qty, measure, weighted).filter(F.col("milli_").isNull())
    nothing = rows.filter(F.col(qty).isNull()).select(*keys, qty, measure, F.lit("no amount").alias("reason"))
    return missed.select(*keys, qty, measure, F.coalesce("read_.reason", F.lit("too large")).alias("reason")).unionByName(nothing).distinct()


def _converted(rows: DataFrame, keys: list[str], qty: str, measure: str, weighted: str) -> DataFrame:
    """keys, the quantity, ``read_``, base_ and milli_ (null where unreadable) of all rows that are not canonical yet."""
    canonical = F.col(qty).rlike("^[0-9]+$") & F.col(measure).isin(*CANONICAL)
    dirty = rows.select(*keys, qty, measure, weighted).filter(F.col(qty).isNotNull() & ~F.coalesce(canonical, F.lit(False)))
    read = F.pandas_udf(_read_udf, "unit string, whole string, part string, reason string").asNondeterministic()  # else the filters above would run it again
    parsed = dirty.select(*keys, qty, measure, read(qty, measure, weighted).alias("read_"))
    factors = F.broadcast(conversion_factors(rows.sparkSession).select(F.col("unit").alias("unit_"), F.col("base_unit").alias("base_"), F.col("factor_e6").alias("factor_")))
    joined = parsed.join(factors, F.col("read_.unit") == F.col("unit_"), "left")
    # Whole and rest are multiplied apart, so that no product has more than 38 digits.
    whole = "cast(read_.whole as decimal(20,0)) * factor_"
    rest = f"(({whole}) % 1000000BD) * 1000000000000000000BD + cast(read_.part as decimal(19,0)) * factor_ + 500000000000000000000000BD"
    milli = F.expr(f"try_cast(cast(({whole} - ({whole}) % 1000000BD) / 1000000BD as decimal(30,0)) + cast(({rest}) div 1000000000000000000000000BD as decimal(20,0)) as bigint)")
    return joined.select(*keys, qty, measure, "read_", "base_", milli.alias("milli_"))


def _read_udf(qty: pd.Series, measure: pd.Series, weighted: pd.Series) -> pd.DataFrame:
    return _read(qty, measure, weighted)
