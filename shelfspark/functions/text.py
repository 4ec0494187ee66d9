"""Text search: tokens, matching, ranking and similarity."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the limit of the sum of 1 / i², as ranks by frequency are scaled by it.
FREQUENCY_LIMIT = 1.64493406685


def tokens(column: str | Column) -> Column:
    """Lower-case words in their order; an empty array for null."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def query_terms(query: str) -> list[str]:
    """The words that a plain query asks for, each once."""
    return list(dict.fromkeys(t for t in re.split(r"[^\w]+|_+", query.lower()) if t))


def matches_all(token_array: Column, query: str) -> Column:
    """Whether all words of a plain query occur; a query without words matches nothing."""
    terms = query_terms(query)
    return reduce(lambda a, b: a & b, [F.array_contains(token_array, t) for t in terms]) if terms else F.lit(False)


def matches_web(token_array: Column, query: str) -> Column:
    """Web-style queries: words are all needed, OR between words, - before unwanted ones, quotes around phrases."""
    parts = re.findall(r'-?"[^"]*"|\S+', query)
    groups: list[list[Column]] = []
    joining = False
    for part in parts:
        if part.lower() == "or" and groups:
            joining = True
            continue
        unwanted, words = part.startswith("-"), query_terms(part.lstrip("-"))
        if not words:
            continue
        if len(words) > 1:
            hit = F.contains(F.concat(F.lit(" "), F.array_join(token_array, " "), F.lit(" ")), F.lit(f" {' '.join(words)} "))
        else:
            hit = F.array_contains(token_array, words[0])
        hit = ~hit if unwanted else hit
        if joining:
            groups[-1].append(hit)
            joining = False
        else:
            groups.append([hit])
    if not groups:
        return F.lit(False)
    return reduce(lambda a, b: a & b, [reduce(lambda x, y: x | y, g) for g in groups])


def cover_density_of(words: Sequence[str], terms: Sequence[str]) -> float:
    """Sum over minimal covers of the terms of 0.1 / (1 + other words inside); 0.1 a time for one term."""
    if not terms:
        return 0.0
    places = [(i, w) for i, w in enumerate(words) if w in set(terms)]
    if len(terms) == 1:
        return 0.1 * len(places)
    total, last, start = 0.0, {}, -1
    for i, w in places:
        last[w] = i
        if len(last) == len(terms) and (low := min(last.values())) > start:
            total += 0.1 / (1 + (i - low + 1 - len(terms)))
            start = low
    return total


def cover_density(token_array: Column, query: str) -> Column:
    """Cover density rank of a plain query as a float; 0 where a word is missing."""
    terms = query_terms(query)

    def rank(batch: pd.Series) -> pd.Series:
        return batch.map(lambda ws: cover_density_of(list(ws) if ws is not None else [], terms)).astype("float32")

    return F.pandas_udf(rank, "float")(token_array)


def frequency_rank(token_array: Column, query: str, weight: float = 0.1) -> Column:
    """Rank of a plain query by frequency: for each term the sum of weight / i² over its occurrences i, scaled by that sum's limit, averaged over the terms."""
    terms = query_terms(query)
    if not terms:
        return F.lit(0.0)

    def score(term: str) -> Column:
        times = F.size(F.filter(token_array, lambda t: t == term))
        return F.when(times > 0, F.aggregate(F.sequence(F.lit(1), times), F.lit(0.0), lambda a, i: a + F.lit(1.0) / (i * i))).otherwise(0.0)

    return reduce(lambda a, b: a + b, map(score, terms)) * weight / FREQUENCY_LIMIT / len(terms)


def word_similarity_of(query: str, text: str | None) -> float:
    """The greatest similarity of the query's trigrams to those of any stretch of the text's trigrams in their order.

    A stretch of best similarity begins and ends at a shared trigram, so only
    these are tried: the distinct trigrams inside are counted as it grows.
    """
    wanted = set(_trigrams_in_order(query))
    grams = _trigrams_in_order(text or "")
    shared = [i for i, g in enumerate(grams) if g in wanted]
    best = 0.0
    for n, start in enumerate(shared):
        inside: set[str] = set()
        common, at = 0, start
        for stop in shared[n:]:
            for g in grams[at : stop + 1]:
                if g not in inside:
                    inside.add(g)
                    common += g in wanted
            at = stop + 1
            best = max(best, common / (len(wanted) + len(inside) - common))
            if len(inside) > len(wanted) / max(best, 1e-9):
                break  # longer ones can't be more alike
    return best


def _trigrams_in_order(text: str) -> list[str]:
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [p[i : i + 3] for p in (f"  {w} " for w in words) for i in range(len(p) - 2)]


def word_similarity(column: str, query: str) -> Column:
    """``word_similarity_of`` a query for a text column; 0 for null."""

    def score(batch: pd.Series) -> pd.Series:
        known: dict[str | None, float] = {}
        return batch.map(lambda t: known[t] if t in known else known.setdefault(t, word_similarity_of(query, t))).astype("float64")

    return F.pandas_udf(score, "double")(column)


def trigrams(column: str | Column) -> Column:
    """Distinct letter trigrams of all words, each word with two blanks before and one after."""
    padded = F.transform(tokens(column), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: str | Column, b: str | Column) -> Column:
    """Shared trigrams among all; 0 where neither side has any."""
    x, y = trigrams(a), trigrams(b)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(0.0)


def contains_text(column: str | Column, part: str) -> Column:
    """Whether a text contains ``part`` in any case; wildcards in ``part`` are plain characters."""
    return F.contains(F.lower(F.col(column) if isinstance(column, str) else column), F.lit(part.lower()))
