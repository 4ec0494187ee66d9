"""Evaluation texts leaking into training text."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import materialise

MIN_WORDS = 12
ALTERED = 0.1
ITEMS_PER_BLOCK = 5_000
MOST_BITS = 1 << 29


@lru_cache(maxsize=500_000)
def plain_word(word: str) -> str:
    """Letters and digits of a word without case and accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", word).casefold() if c.isalnum())


def plain_words(text: str | None) -> list[str]:
    """The words of a text, by white space; those without letters and digits are dropped."""
    return [p for w in (text or "").split() if (p := plain_word(w))]


def least_distance(pattern: Sequence[object], text: Sequence[object]) -> int:
    """Least edit distance of ``pattern`` to any stretch of ``text``, by Myers' bit-parallel columns."""
    m = len(pattern)
    if not m:
        return 0
    masks: dict[object, int] = {}
    for i, symbol in enumerate(pattern):
        masks[symbol] = masks.get(symbol, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for symbol in text:
        eq = masks.get(symbol, 0)
        across = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | ~(across | up) & full, up & across
        best = min(best, score)
    return best


def window_sizes(min_words: int, altered: float, longest: int) -> list[tuple[int, int]]:
    """(words, altered words allowed) of the windows that decide whether a passage of any length is held.

    The shortest passages with k altered words come down to windows of
    ``min_words`` where these cut the passage into so many parts that one must
    be within its own budget; otherwise they are windows of their own.
    """
    budget = int(min_words * altered + 1e-9)
    sizes = [(min_words, budget)]
    if altered > 0:
        for k in range(budget + 1, int(longest * altered + 1e-9) + 1):
            size = math.ceil(k / altered - 1e-9)
            if (budget + 1) * (size // min_words) <= k:
                sizes.append((size, k))
    return sizes


class Items:
    """Windows of words of each test item (see ``window_sizes``), indexed by their pieces.

    With at most k altered words in a window of n, one of k + 1 equal pieces is
    unaltered; all windows' pieces are the item's runs of n // (k + 1) words, or
    of fewer where another window needs shorter ones.
    """

    def __init__(self, items: Sequence[tuple[int, str]], min_words: int = MIN_WORDS, altered: float = ALTERED):
        told = [(i, w) for i, t in items if len(w := plain_words(t)) >= min_words]
        self.ids = [i for i, _ in told]  # rows of one id are texts of their own
        self.words = {n: w for n, (_, w) in enumerate(told)}
        self.windows = window_sizes(min_words, altered, max(map(len, self.words.values()), default=0))
        self.piece = min(size // (budget + 1) for size, budget in self.windows)
        self.numbers: dict[str, int] = {}
        self.index: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.coded: dict[int, list[int]] = {}
        for i, words in self.words.items():
            coded = self.coded[i] = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            for p in range(len(coded) - self.piece + 1):
                self.index.setdefault(tuple(coded[p : p + self.piece]), []).append((i, p))

    def leaked(self, text: str | None) -> set[int]:
        """Items of which the text holds a window with no more altered words than allowed."""
        coded = [self.numbers.get(w, -1) for w in plain_words(text)]
        found: set[int] = set()
        failed: set[tuple[int, int, int, tuple[int, ...]]] = set()
        run = 0
        for j, c in enumerate(coded):
            run = run + 1 if c >= 0 else 0
            if run < self.piece:
                continue
            start = j - self.piece + 1
            for item, p in self.index.get(tuple(coded[start : j + 1]), ()):
                if self.ids[item] not in found and any(self._verified(item, p, coded, start, size, budget, failed) for size, budget in self.windows):
                    found.add(self.ids[item])
        return found

    def _verified(self, item: int, p: int, coded: list[int], start: int, size: int, budget: int, failed: set) -> bool:
        words = self.coded[item]
        for k in range(budget + 1):
            a = p - k * self.piece
            if a < 0 or a + size > len(words):
                continue
            low = max(0, start - k * self.piece - budget)
            around = tuple(coded[low : max(0, start - k * self.piece + size + budget)])
            if (item, a, size, around) in failed:
                continue
            if least_distance(words[a : a + size], around) <= budget:
                return True
            failed.add((item, a, size, around))
        return False


def leaked_items(documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, min_words: int = MIN_WORDS, altered: float = ALTERED, block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """``key`` and ``item_key`` of each document that holds a passage of an item.

    A passage is at least ``min_words`` successive words of the item with at
    most the share ``altered`` of them replaced, added or left out, whatever its
    length (see ``window_sizes``). Words are compared by their letters and
    digits. Null and short items and null texts leak nothing; rows of one
    ``item_key`` are texts of one item; a pair comes once. Documents are read
    once and whole, where they are, whatever the number of items: up to
    ``block`` items are broadcast with their pieces, and nothing is shuffled;
    more are joined with the documents' pieces (see ``_by_join``).
    """
    known = items.filter(F.col(item_text).isNotNull() & F.col(item_key).isNotNull()).select(F.col(item_key).alias("i"), F.col(item_text).alias("t"))
    name = f"`{key}` {documents.schema[key].dataType.simpleString()}, `{item_key}` {items.schema[item_key].dataType.simpleString()}"
    texts = documents.select(key, text).filter(F.col(text).isNotNull())
    rows = known.limit(block + 1).collect()
    if len(rows) > block:
        return _by_join(texts, key, text, known, item_key, min_words, altered)
    shared = documents.sparkSession.sparkContext.broadcast([(r["i"], r["t"]) for r in rows])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Items(shared.value, min_words, altered)
        for batch in batches:
            pairs = [(k, i) for k, t in zip(batch[key], batch[text]) for i in sorted(held.leaked(t))]
            yield pd.DataFrame(pairs, columns=[key, item_key])

    return texts.mapInPandas(find, name)


class Filter:
    """A Bloom filter over 64-bit hashes: sixteen bits for each, but at most ``MOST_BITS``; beyond, it lets more through."""

    def __init__(self, expected: int):
        self.bits = min(MOST_BITS, 1 << max(10, math.ceil(math.log2(16 * max(1, expected)))))
        self.held = np.zeros(self.bits // 8, np.uint8)

    def _places(self, hashes: np.ndarray) -> list[np.ndarray]:
        low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
        return [(low + np.uint64(k) * high) % np.uint64(self.bits) for k in range(4)]

    def add(self, hashes: np.ndarray) -> None:
        for place in self._places(hashes):
            np.bitwise_or.at(self.held, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self._places(hashes):
            found &= (self.held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return found


def _piece_hashes(words: Sequence[str], piece: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(" ".join(words[p : p + piece])) for p in range(len(words) - piece + 1)], np.uint64)


def _by_join(texts: DataFrame, key: str, text: str, known: DataFrame, item_key: str, min_words: int, altered: float) -> DataFrame:
    """The same for any number of items.

    Pieces of items are rows with the words around them. A Bloom filter of at
    most 64 MB over their hashes is broadcast; the driver fills it from a stream
    of hashes and never holds them. A document's pieces that pass it meet the
    items' by a join on the hash, and only these hits, with the words around
    them, are shuffled and verified.
    """
    sizes = window_sizes(min_words, altered, 100 * min_words)
    piece = min(size // (budget + 1) for size, budget in sizes)
    before, after, slack = max(b for _, b in sizes) * piece, max(s for s, _ in sizes), max(b for _, b in sizes)
    spark = texts.sparkSession

    def item_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, t in zip(batch["i"], batch["t"]):
                if len(words := plain_words(t)) >= min_words:
                    for p, h in enumerate(_piece_hashes(words, piece).view(np.int64)):
                        low = max(0, p - before)
                        out.append((h, i, words[low : p + after], p - low))
            yield pd.DataFrame(out, columns=["hash", item_key, "item_words", "item_at"])

    item_type = known.schema["i"].dataType.simpleString()
    pieces = materialise(known.mapInPandas(item_pieces, f"hash long, `{item_key}` {item_type}, item_words array<string>, item_at int"), "pieces")
    bloom = Filter(pieces.count())
    hashes = pieces.select("hash").toLocalIterator(prefetchPartitions=True)
    while chunk := [r[0] for r in islice(hashes, 100_000)]:
        bloom.add(np.array(chunk, np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(bloom)

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t in zip(batch[key], batch[text]):
                words = plain_words(t)
                hashed = _piece_hashes(words, piece)
                for p in np.flatnonzero(shared.value.may_hold(hashed)) if len(hashed) else ():
                    low = max(0, p - before - slack)
                    out.append((hashed[p].view(np.int64), k, words[low : p + after + slack], p - low))
            yield pd.DataFrame(out, columns=["hash", key, "words", "at"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for k, i, item, p, words, at in zip(batch[key], batch[item_key], batch["item_words"], batch["item_at"], batch["words"], batch["at"]):
                if (k, i) not in found and _holds(list(item), p, list(words), at, sizes, piece):
                    found.add((k, i))
            yield pd.DataFrame(list(found), columns=[key, item_key])

    key_type = texts.schema[key].dataType.simpleString()
    met = texts.mapInPandas(hits, f"hash long, `{key}` {key_type}, words array<string>, at int").join(pieces, "hash")
    return met.mapInPandas(verify, f"`{key}` {key_type}, `{item_key}` {item_type}").distinct()


def _holds(item: list[str], p: int, words: list[str], at: int, sizes: Sequence[tuple[int, int]], piece: int) -> bool:
    """Whether the words around a shared piece hold a window of the item with no more altered words than allowed."""
    for size, budget in sizes:
        for k in range(budget + 1):
            a, low = p - k * piece, at - k * piece
            if a >= 0 and a + size <= len(item) and least_distance(item[a : a + size], words[max(0, low - budget) : max(0, low + size + budget)]) <= budget:
                return True
    return False
