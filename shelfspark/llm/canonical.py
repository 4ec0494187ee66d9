"""Mapping freely typed values to the entries of a reference list."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ENTRY = -1
SHORT_FORM = 0.25
MAX_BROADCAST_ENTRIES = 5_000

# Words that are no part of a name, for places and companies.
NOISE = frozenset(
    "עיר העיר יישוב ישוב עיריית מועצה צפון דרום מזרח מערב מרכז אזור תעשייה city of the town "
    "רשת שיווק קבוצת קבוצה חב חברת חברה בעמ ישראל ltd inc israel".split()
)
# Words that begin an address or branch, which ends the name.
TAIL = frozenset("רח רחוב שד סניף branch street st".split())
# Letters that are often typed for each other, and letters often left out or doubled.
ALIKE = ["אעה", "טת", "כקח", "וב", "סשצ", "qkc", "fp", "yi", "ou", "vbw", "sz", "ae", "td"]
LIGHT = frozenset("ויאהhe")
_FINALS = str.maketrans("ךםןףץ", "כמנפצ")
_NOISE, _TAIL = ({w.translate(_FINALS) for w in words} for words in (NOISE, TAIL))
_ALIKE = {frozenset((a, b)) for group in ALIKE for a in group for b in group if a != b}


def plain_words(text: str) -> list[str]:
    """Words without case, accents, vowel points, direction marks, quotes and final letter forms."""
    text = unicodedata.normalize("NFKD", text).casefold()
    text = "".join(c for c in text if unicodedata.category(c) not in ("Mn", "Cf"))
    text = re.sub("['\"`´׳״‘’“”]", "", text).translate(_FINALS)
    return re.sub(r"[\W_]+", " ", text).split()


def _without_noise(words: list[str]) -> list[str]:
    for i, w in enumerate(words):
        if i and w in _TAIL:
            words = words[:i]
            break
    kept = [w for w in words if w not in _NOISE and not w.isdigit()]
    return kept or words


def deletions(key: str, most: int) -> set[str]:
    """``key`` and all that is left of it after up to ``most`` deletions."""
    found = level = {key}
    for _ in range(most):
        level = {k[:i] + k[i + 1 :] for k in level for i in range(len(k))}
        found = found | level
    return found


def edits_allowed(key: str) -> int:
    """One edit from 4 characters on, two from 9 on."""
    return 0 if len(key) < 4 else 1 if len(key) < 9 else 2


@lru_cache(maxsize=100_000)
def damerau(a: str, b: str, weighted: bool = True) -> float:
    """Damerau-Levenshtein distance (optimal alignment); weighted, likely slips cost half."""
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]

    def lone(s: str, i: int) -> float:
        c = s[i]
        return 0.5 if weighted and (c in LIGHT or (i and s[i - 1] == c)) else 1.0

    for i in range(1, len(a) + 1):
        rows[i][0] = rows[i - 1][0] + lone(a, i - 1)
    for j in range(1, len(b) + 1):
        rows[0][j] = rows[0][j - 1] + lone(b, j - 1)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            swap = 0.0 if x == y else 0.5 if weighted and frozenset((x, y)) in _ALIKE else 1.0
            best = min(rows[i - 1][j - 1] + swap, rows[i - 1][j] + lone(a, i - 1), rows[i][j - 1] + lone(b, j - 1))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                best = min(best, rows[i - 2][j - 2] + (0.5 if weighted else 1.0))
            rows[i][j] = best
    return rows[-1][-1]


@dataclass
class Entry:
    """A reference entry: its names in each script, and how often its canonical name occurs."""

    ref_id: int
    names: list[str]
    frequency: int


@dataclass
class Dictionary:
    """Look-up tables over a bounded reference list.

    ``keys``: full names, without spaces. ``short``: first letter and the other
    words, and the name without its first or last word, where that belongs to
    one entry alone. ``deleted``: symmetric deletions of the full names.
    """

    entries: dict[int, Entry] = field(default_factory=dict)
    keys: dict[str, set[int]] = field(default_factory=dict)
    short: dict[str, set[int]] = field(default_factory=dict)
    deleted: dict[str, set[tuple[int, str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, entries: Iterable[Entry]) -> Dictionary:
        d = cls()
        for e in entries:
            d.entries[e.ref_id] = e
            for key in {"".join(plain_words(n)) for n in e.names} - {""}:
                d.keys.setdefault(key, set()).add(e.ref_id)
                for k in deletions(key, edits_allowed(key)):
                    d.deleted.setdefault(k, set()).add((e.ref_id, key))
            for key in {k for n in e.names for k in short_forms(plain_words(n))}:
                d.short.setdefault(key, set()).add(e.ref_id)
        return d

    def _most_frequent(self, ids: Iterable[int]) -> int:
        return min(ids, key=lambda i: (-self.entries[i].frequency, i))

    def find(self, value: str) -> int:
        """The entry closest to ``value``, or -1.

        All candidates are ranked by weighted distance, the entry's frequency
        and its number. A full name in any order of words, or written backwards,
        has distance 0; a short form that belongs to one entry alone
        ``SHORT_FORM``, less than any edit; other names the distance of their
        edits, within those allowed. Where a distance is reached that no later
        candidate can fall below, these are not looked up.
        """
        forms = full_forms(value)
        if exact := {ref for form in forms for ref in self.keys.get(form, ())}:
            return self._most_frequent(exact)
        words = _without_noise(plain_words(value))
        short = (" ".join(words), " ".join(w[::-1].translate(_FINALS) for w in words[::-1]))
        ranked = [(SHORT_FORM, -self.entries[ref].frequency, ref) for key in short if len(hit := self.short.get(key, set())) == 1 for ref in hit]
        if ranked:
            return min(ranked)[2]
        for form in forms:
            most = edits_allowed(form)
            for k in deletions(form, most):
                for ref, key in self.deleted.get(k, ()):
                    if damerau(form, key, False) <= min(most, edits_allowed(key)):
                        ranked.append((damerau(form, key), -self.entries[ref].frequency, ref))
        return min(ranked)[2] if ranked else NO_ENTRY


def short_forms(words: list[str]) -> list[str]:
    """Initial and the rest, and names of two words without the word that many names share."""
    if len(words) < 2:
        return []
    return [" ".join([words[0][0], *words[1:]]), words[0][0] + "".join(words[1:]), " ".join(words[1:]), *([words[0]] if len(words) == 2 else [])]


def full_forms(value: str) -> list[str]:
    """Spellings without spaces under which a full name may be listed, likeliest first."""
    words = plain_words(value)
    cut = _without_noise(words)
    orders = [words, cut, *(list(p) for p in (permutations(cut) if len(cut) <= 3 else [tuple(cut[::-1])]))]
    forward = list(dict.fromkeys("".join(o) for o in orders))
    return [f for f in dict.fromkeys([*forward, *("".join(o)[::-1].translate(_FINALS) for o in (words, cut))]) if f]


def reference_entries(refs: DataFrame, ref_id: str, names: Sequence[str], values: DataFrame, column: str) -> DataFrame:
    """ref_id, names and frequency: rows of ``values`` whose value is exactly the first name."""
    counts = values.groupBy(F.col(column).alias("canonical_")).agg(F.count(F.lit(1)).alias("frequency"))
    listed = refs.filter(F.col(ref_id).isNotNull() & F.col(names[0]).isNotNull()).select(F.col(ref_id).alias("ref_id"), F.array_compact(F.array(*names)).alias("names"), F.col(names[0]).alias("canonical_"))
    return listed.join(counts, "canonical_", "left").select("ref_id", "names", F.coalesce("frequency", F.lit(0)).alias("frequency"), "canonical_")


def map_to_reference(values: DataFrame, key: str, column: str, refs: DataFrame, ref_id: str, names: Sequence[str], max_broadcast: int = MAX_BROADCAST_ENTRIES) -> DataFrame:
    """``key``, ``column``, ``ref_id`` of each row whose value is neither null, blank nor canonical.

    ``names`` are the columns of ``refs`` with an entry's names, the canonical
    one first. ``ref_id`` is -1 where no entry fits. Values are looked up in a
    dictionary of symmetric deletions that every task holds; it is broadcast
    only up to ``max_broadcast`` entries. A longer list stays distributed: its
    deletions and those of the distinct values are joined, and each value's
    candidates ranked alike. An empty list leaves all values without an entry.
    """
    entries = reference_entries(refs, ref_id, names, values, column)
    canonical = refs.select(F.col(names[0]).alias(column)).filter(F.col(column).isNotNull()).distinct()
    rows = values.select(key, column).filter(F.col(column).isNotNull() & F.col(column).rlike(r"(?U)\S"))
    free = rows.join(canonical, column, "left_anti")
    if refs.count() > max_broadcast:
        return _by_join(free, key, column, entries)
    held = [Entry(r["ref_id"], list(r["names"]), r["frequency"]) for r in entries.select("ref_id", "names", "frequency").collect()]
    shared = values.sparkSession.sparkContext.broadcast(held)

    def look_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dictionary = Dictionary.of(shared.value)
        known: dict[str, int] = {}
        for batch in batches:
            for v in set(batch) - known.keys():
                known[v] = dictionary.find(v)
            yield batch.map(known)
            if len(known) > 500_000:
                known.clear()

    find = F.pandas_udf(look_up, "long")
    return free.select(key, column, find(column).alias("ref_id"))


def _by_join(free: DataFrame, key: str, column: str, entries: DataFrame) -> DataFrame:
    """The same for a list too long to broadcast."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                keys = {k for n in r.names for w in [plain_words(n)] for full in ["".join(w)] for k in (*deletions(full, edits_allowed(full)), *short_forms(w))}
                out += [(k, r.ref_id, list(r.names), r.frequency) for k in keys]
            yield pd.DataFrame(out, columns=["form", "ref_id", "names", "frequency"])

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for v in batch[column]:
                words = _without_noise(plain_words(v))
                forms = {k for f in full_forms(v) for k in deletions(f, edits_allowed(f))}
                out += [(v, k) for k in forms | {" ".join(words), " ".join(w[::-1].translate(_FINALS) for w in words[::-1])}]
            yield pd.DataFrame(out, columns=[column, "form"])

    def ranked(batch: pd.DataFrame) -> pd.DataFrame:
        held = {r.ref_id: Entry(r.ref_id, list(r.names), r.frequency) for r in batch.itertuples(index=False)}
        v = batch[column].iloc[0]
        return pd.DataFrame({column: [v], "ref_id": [Dictionary.of(held.values()).find(v)]})

    forms = entries.select("ref_id", "names", "frequency").mapInPandas(listed, "form string, ref_id long, names array<string>, frequency long")
    asks = free.select(column).distinct().mapInPandas(asked, f"`{column}` string, form string")
    found = asks.join(forms, "form").dropDuplicates([column, "ref_id"]).groupBy(column).applyInPandas(ranked, f"`{column}` string, ref_id long")
    return free.join(found, column, "left").select(key, column, F.coalesce("ref_id", F.lit(NO_ENTRY)).alias("ref_id"))
