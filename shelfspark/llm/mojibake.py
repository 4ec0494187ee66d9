"""Text read in a wrong character encoding: finding it and restoring the original.

Two stages, both on whole texts. UTF-8 read as another encoding leaves
sequences of two to four characters: their beginnings (lead and next character)
are precomputed for all encodings and found by one multi-pattern automaton; the
rest of a sequence is read by the encoding's own table, so every character of
Unicode is covered. A stretch in which all characters beyond ASCII belong to
such sequences, two of them or more, is replaced on that evidence alone, over
and over while it gives new ones (text garbled several times). Only a lone
sequence is weighed by how natural it is. One-byte encodings read as one another
leave single characters, which may be right elsewhere: these are weighed by how
natural they and their replacements are beside their neighbours, and only
stretches that gain clearly are replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import spread

LOST = "�"
# Encodings in which texts of these languages are stored or wrongly read.
READ_AS = ["cp1252", "latin-1", "cp1255", "cp1251", "mac_roman", "cp437", "cp850", "cp862", "cp866", "koi8_r"]
ONE_BYTE = ["cp1255", "cp862", "cp1251", "koi8_r", "cp866", "cp1252", "mac_roman"]
# Letter statistics come from these plain sentences.
HEBREW = """
היום הלכנו אל השוק כדי לקנות ירקות ופירות טריים לשבת. המחיר של העגבניות עלה מאוד בשבוע האחרון, אבל המוכר נתן לנו הנחה קטנה.
בבית הספר לומדים הילדים קריאה וכתיבה, ובצהריים הם חוזרים הביתה עם החברים שלהם. מישהו יודע אם החנות ליד תחנת הרכבת פתוחה גם בערב?
השכנים שלנו קיבלו חבילה גדולה מן הדואר ולא הצליחו לפתוח אותה. לקראת החג מציגה הרשת מבצעים רבים, ואחר כך המוצרים חוזרים למחיר הרגיל.
אני חושב שהשירות כאן טוב יותר מאשר במקום האחר, אף על פי שהקופאית הייתה עייפה. נא להוסיף את המספר שלך לרשימה ולשלוח תשובה עד סוף החודש.
בסניף החדש ראיתי חלב, גבינה, לחם, סוכר, קמח, שמן, אורז ותה במקום אחד. תודה רבה לצוות על היחס והעזרה, חבל שלא באנו קודם לכן.
סך הכול שילמנו סכום של מאה שקלים ללא החזר, ולכן נמשיך לחכות לתשובה מן ההנהלה. הסוף היה ארוך ונמוך מן הצפוי, אך כך נהוג בקיץ ובחורף.
מוכרן חרוץ מעמיס עץ על המדף בתוך המחסן, ואף לקוח לא הסביר למה צריך להצטרף אל מועדון החברים. הכסף נשאר בכיס, הדרך ארוכה והחוף קרוב מאוד.
"""
RUSSIAN = """
Сегодня мы пошли на рынок, чтобы купить свежие овощи и фрукты. Цена на помидоры сильно выросла за последнюю неделю, но продавец сделал нам небольшую скидку.
В школе дети учатся читать и писать, а днём возвращаются домой вместе с друзьями. Кто знает, работает ли магазин возле вокзала вечером?
Наши соседи получили большую посылку с почты и не смогли её открыть. К празднику сеть предлагает много акций, потом товары снова стоят по обычной цене.
Я думаю, что обслуживание здесь лучше, чем в другом месте, хотя кассир была уставшей. Пожалуйста, добавьте свой номер в список и отправьте ответ до конца месяца.
В новом филиале я увидел молоко, сыр, хлеб, сахар, муку, масло, рис и чай. Спасибо за внимание и помощь, жаль, что мы не пришли раньше. Уважаемые покупатели, объясните это.
В чеке указано сорок шекелей (40 шек.), хотя на ценнике было меньше, и мне это странно. Доставка пришла поздно, часть упаковок уже открыта.
"""
_FRENCH = set("éèàçêîôûâùœëï")
_OTHER_LOWER = set("áíóúñäöüßãõåøæìòýÿšžčřěłńśźżğışțăđµªº")
_UPPER = set("ÉÈÀÇÊÎÔÛÂÙŒËÏÁÍÓÚÑÄÖÜÃÕÅØÆÌÒÝŸŠŽ")
_QUOTES = set("’‘“”„«»…–—−‑•·")
_SIGNS = set("₪€£°½¼¾×±№©®™§")


def _read(code: bytes, encoding: str) -> str:
    """Decodes byte by byte; bytes that the encoding leaves undefined keep their number."""
    out = []
    for b in code:
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@lru_cache(maxsize=len(READ_AS))
def _bytes_of(encoding: str) -> dict[str, int]:
    """The byte that each character beyond ASCII was read from."""
    return {_read(bytes([b]), encoding): b for b in range(0x80, 0x100)}


# Lead bytes of sequences of two, three and four bytes in UTF-8.
LEADS = {2: range(0xC2, 0xE0), 3: range(0xE0, 0xF0), 4: range(0xF0, 0xF5)}


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """The first two characters of the garbled sequences of all encodings in one automaton."""
    machine, readings = ahocorasick.Automaton(), {}
    for encoding in READ_AS:
        for length, leads in LEADS.items():
            for lead in leads:
                for following in range(0x80, 0xC0):
                    readings.setdefault(_read(bytes([lead, following]), encoding), []).append((encoding, length))
    for beginning, held in readings.items():
        machine.add_word(beginning, held)
    machine.make_automaton()
    return machine


def _sequence(word: str, start: int, length: int, encoding: str) -> str | None:
    """The character that a garbled sequence stands for; None if it isn't one, or none that texts hold."""
    held = _bytes_of(encoding)
    try:
        char = bytes(held[c] for c in word[start : start + length]).decode("utf-8")
    except (KeyError, UnicodeDecodeError):
        return None
    return char if len(char) == 1 and char > "\x7f" and unicodedata.category(char) not in ("Cn", "Co", "Cs") else None


@lru_cache(maxsize=1)
def _bigrams() -> dict[str, dict[tuple[str, str], float]]:
    """For Hebrew and Russian: log of a letter's chance after another against an even one."""
    tables = {}
    for name, sample, letters in (("he", HEBREW, "אבגדהוזחטיךכלםמןנסעףפץצקרשת"), ("ru", RUSSIAN.lower(), "абвгдежзийклмнопрстуфхцчшщъыьэюяё")):
        pairs, singles, before = Counter(), Counter(), Counter()
        for word in re.findall(rf"[{letters}]+", sample):
            for a, b in zip(f"^{word}", word):
                pairs[a, b] += 1
                singles[b] += 1
                before[a] += 1
        total, k = sum(singles.values()), len(letters)
        table = {}
        for a in f"^{letters}":
            for b in letters:
                single = (singles[b] + 0.5) / (total + 0.5 * k)
                chance = (pairs[a, b] + 6 * single) / (before[a] + 6)
                table[a, b] = max(-1.5, min(1.2, math.log(chance * k)))
        tables[name] = table
    return tables


def _kind(c: str) -> str:
    """Script of a letter, 'd' for a digit, ' ' for space, '.' for the rest."""
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return "l"
    if "א" <= c <= "ת":
        return "h"
    if "Ѐ" <= c <= "ӿ":
        return "c"
    if c in _FRENCH or c in _OTHER_LOWER or c in _UPPER:
        return "l"
    if c.isdigit() and c < "\x80":
        return "d"
    if c.isalpha():
        return "g"
    return " " if c.isspace() or not c else "."


@lru_cache(maxsize=300_000)
def natural(word: str) -> float:
    """How natural the characters of a word are beside each other; ASCII counts nothing."""
    total, text = 0.0, f" {word} "
    tables = _bigrams()
    for i in range(1, len(text) - 1):
        c = text[i]
        if c < "\x80":
            continue
        a, b = text[i - 1], text[i + 1]
        ka, kb = _kind(a), _kind(b)
        if "א" <= c <= "ת":
            if kb == "l" and ka in " ." and c in "ובלמהשכ":
                total -= 0.2  # a prefix before a Latin name
            elif ka in "lcg" or kb in "lcg":
                total -= 3
            elif c in "ךםןףץ" and kb == "h":
                total -= 3
            else:
                total += tables["he"][a if ka == "h" else "^", c]
        elif "֑" <= c <= "ׇ":
            total += -0.2 if ka == "h" or "֑" <= a <= "ׇ" else -3
        elif c in "׳״":
            total += 0.3 if ka == "h" else -3
        elif (x := c.lower()) in "абвгдежзийклмнопрстуфхцчшщъыьэюяё":
            if ka in "lhg" or kb in "lhg":
                total -= 3
            else:
                score = tables["ru"].get((a.lower(), x)) if ka == "c" else tables["ru"]["^", x]
                total += -2 if score is None else score
                if c.isupper() and ka == "c":
                    total -= 2.5 if a.islower() else 0.6
        elif c in _FRENCH or c in _OTHER_LOWER:
            alone = ka != "l" and kb != "l"
            crowd = (ka == "l" and a >= "\x80") + (kb == "l" and b >= "\x80")
            total += (0.6 if c in _FRENCH else -0.8) - (2.0 * crowd) - (1.5 if alone and c not in "àµ" else 0) - (2 if ka in "hcg" or kb in "hcg" else 0) - (1.0 if ka == "l" and a.isupper() and a >= "\x80" and i > 2 else 0)
        elif c in _UPPER:
            inside = ka == "l" and a.islower()
            crowd = (ka == "l" and a >= "\x80") + (kb == "l" and b >= "\x80" and b.islower())
            total += (0.0 if c in "ÉÈÀÇÊÎÔÛÂÙŒËÏ" else -0.8) - (3 if inside else 0) - 2.0 * crowd - (2 if ka in "hcgd" or kb in "hcgd" else 0)
        elif c in _QUOTES:
            if c == "«" and kb == "l" and b.islower():
                total -= 1.2  # French sets it apart
            elif c in "’‑":
                total += 0.6
            else:
                crowd = (a >= "\x80" and ka == ".") + (b >= "\x80" and kb == ".")
                total += (0.3 if ka in " ." or kb in " ." else -1.5) - 1.5 * crowd
        elif c in _SIGNS:
            total += 0.4 if (c in "₪€£½¼¾№" and ka in " .d" and kb in " .d") or (c == "×" and ka in " d" and kb in " d") or (c == "°" and ka in "d ") or (c in "±©®™§" and ka in " ." and kb in " .") else -1.5
        elif "！" <= c <= "～":
            total += 0
        elif c in "​‎‏  ﻿":
            total += 0 if c != " " else -0.1
        elif _kind(c) == "g":
            total += -3 if (ka in "lhc" or kb in "lhc") else -3 if 0x370 <= ord(c) < 0x400 and ka not in "g" and kb not in "g" else 0.2
        elif c in "¤ª":
            total -= 2
        elif ord(c) < 0xA0:
            total -= 3
        elif ord(c) >= 0x1F000:
            total += 0
        else:
            total -= 2
    return total


@lru_cache(maxsize=1)
def _pairs() -> list[tuple[str, str, dict[int, str], frozenset[int]]]:
    """(true, wrong, table from garbled characters to true ones, these characters) of all one-byte pairs."""
    found, wanted = [], lambda c: c.isprintable() or c in " ‎‏­"
    for true in ONE_BYTE:
        for wrong in READ_AS:
            if true == wrong:
                continue
            table = {}
            for b in range(0x80, 0x100):
                try:
                    char = bytes([b]).decode(true)
                except UnicodeDecodeError:
                    continue
                seen = _read(bytes([b]), wrong)
                if wanted(char) and char >= "\x80":
                    table[ord(seen)] = char
            found.append((true, wrong, table, frozenset(table)))
    return found


_WORD = re.compile(r"[^ \t\r\n]+")
LEAST_GAIN = 5.0
LEAST_GAIN_AMONG_LETTERS = 8.0
LEAST_GAIN_FROM_NONSENSE = 2.2
LEAST_LETTERS = 6
LEAST_WORDS_AMONG_LETTERS = 3
SEQUENCE_BONUS = 3.0
COVERED_BONUS = 6.0
CERTAIN_GAIN = 4.0
LEAST_SEQUENCE_GAIN = 1.2
LEAST_GAIN_PER_CHARACTER = 0.45


def _plain_hebrew(c: str) -> bool:
    """A Hebrew letter or a mark of direction."""
    return "א" <= c <= "ת" or c in "‎‏"


_BESIDE_LATIN = re.compile("[A-Za-z][א-ת]|[א-ת][A-Za-z]")
_AMID_LATIN = re.compile("[A-Za-z][א-ת]+[A-Za-z]")
# How usual the accented letters of French are; they only choose between readings of the same letters.
_USUAL = {"é": 1.0, "è": 0.5, "à": 0.5, "ê": 0.4, "ç": 0.3, "ù": 0.2, "ô": 0.2, "û": 0.1, "î": 0.1, "â": 0.1}


@lru_cache(maxsize=300_000)
def _suspect(word: str) -> float:
    """How unnatural a word is; Hebrew words don't count, as no stretch of them alone is replaced."""
    if all(c < "\x80" or _plain_hebrew(c) for c in word) and not _BESIDE_LATIN.search(word):
        return 0.0
    score = natural(word)
    return score if score < -0.4 * sum(c >= "\x80" for c in word) else 0.0


def _latin_seen_as_hebrew(changed: set[str], pairs: list[tuple[str, str]], held: list[str]) -> bool:
    """Whether Hebrew letters in these words can only be accented ones of Latin words.

    Where the text has Hebrew words too, Hebrew endings may be put to Latin
    names: there, two words are asked for, one with Hebrew amid Latin letters.
    """
    if any(_kind(y) != "l" for x, y in pairs if "א" <= x <= "ת") or not any(_BESIDE_LATIN.search(w) for w in changed):
        return False
    if any(re.search("[א-ת]{2}", w) and not _BESIDE_LATIN.search(w) for w in held):
        return len(changed) >= 2 and any(_AMID_LATIN.search(w) for w in changed)
    return True


def _apply(text: str, words: list[tuple[int, int]], options: list[tuple[float, int, int, list[str]]]) -> str:
    """Replaces the stretches of words that gain most, none over another."""
    taken: list[tuple[int, int, list[str]]] = []
    for _, a, b, new in sorted(options, key=lambda s: (-s[0], s[1])):
        at = bisect_left(taken, a, key=lambda t: t[0])
        if (at == 0 or taken[at - 1][1] < a) and (at == len(taken) or taken[at][0] > b):
            taken.insert(at, (a, b, new))
    out, end = [], 0
    for a, b, new in taken:
        for k in range(a, b + 1):
            out += [text[end : words[k][0]], new[k]]
            end = words[k][1]
    return "".join([*out, text[end:]])


@lru_cache(maxsize=200_000)
def _decoded(word: str) -> dict[str, tuple[str, int, bool]]:
    """Readings of a word with garbled UTF-8 sequences, by encoding: the word, the number of its sequences that are no plain letters, and whether all of it beyond ASCII is in sequences.

    Letters alone can be a word: in one encoding Russian words are sequences.
    """
    found: dict[str, list] = {}
    for end, held in _automaton().iter(word):
        start = end - 1
        for encoding, length in held:
            reading = found.setdefault(encoding, [[], 0, 0, 0])  # parts, place reached, sequences, their characters
            if start >= reading[1] and (char := _sequence(word, start, length, encoding)) is not None:
                reading[0] += [word[reading[1] : start], char]
                reading[1:] = [start + length, reading[2] + (not word[start : start + length].isalpha()), reading[3] + length]
    high = sum(c >= "\x80" for c in word)
    return {e: ("".join([*parts, word[at:]]), n, covered == high) for e, (parts, at, n, covered) in found.items() if parts}


def _sequence_options(held: list[str]) -> list[tuple[float, int, int, list[str]]]:
    """Stretches with garbled UTF-8 sequences, garbled any number of times over."""
    options = []
    found = {e for w in held if not w.isascii() for e in _decoded(w)}
    for encoding in (e for e in READ_AS if e in found):
        new = held
        while True:  # each layer makes the text shorter, so this ends
            layer = [None if w.isascii() else _decoded(w).get(encoding) for w in new]
            if not any(layer):
                break
            options += _covered(new, layer) if new is held else []
            new = [w if x is None else x[0] for w, x in zip(new, layer)]
            gain = [0.0 if x == y else natural(x) - natural(y) for x, y in zip(new, held)]
            segments = _segments(gain)
            if any(s >= CERTAIN_GAIN for s, _, _ in segments):  # then all its other sequences are garbled too
                segments += [(g, i, i) for i, g in enumerate(gain) if g > -1.0 and new[i] != held[i]]
                options += [(s + SEQUENCE_BONUS, a, b, new) for s, a, b in segments if _in_order(new[a : b + 1])]
            else:
                options += [(s + SEQUENCE_BONUS, a, b, new) for s, a, b in segments if s >= LEAST_SEQUENCE_GAIN and _in_order(new[a : b + 1])]
    return options


def _covered(held: list[str], layer: list[tuple[str, int, bool] | None]) -> list[tuple[float, int, int, list[str]]]:
    """Stretches of words of which all that is beyond ASCII is in sequences, with two of them or more that are no plain letters: different ones, or longer than two characters."""
    new = [w if x is None else x[0] for w, x in zip(held, layer)]
    options, first, last, sequences, kinds = [], None, None, 0, set()
    for i, (w, x) in enumerate([*zip(held, layer), ("\x80", None)]):
        if x is not None and x[2] and (x[1] or {_kind(c) for c in w if c.isalpha()} not in ({"c"}, {"h"})):  # else it may be a word
            first, last = i if first is None else first, i
            sequences += x[1]
            kinds.add(w)
        elif not w.isascii():
            if first is not None and sequences >= 2 and (len(kinds) > 1 or sequences > 2 or any(len(k) - len(_stated(k, layer, held)) > 1 for k in kinds)):
                options.append((COVERED_BONUS + 2.0 * sequences + 0.01 * sum(natural(v) - 5 * _rises(v) for v in new[first : last + 1]), first, last, new))
            first, last, sequences, kinds = None, None, 0, set()
    return options


@lru_cache(maxsize=100_000)
def _rises(word: str) -> int:
    """Capitals after small letters: of readings that cover as much, the one with fewer is right."""
    return sum(a.islower() and b.isupper() for a, b in zip(word, word[1:]))


def _stated(word: str, layer: list[tuple[str, int, bool] | None], held: list[str]) -> str:
    return next(x[0] for w, x in zip(held, layer) if w == word and x is not None)


def _in_order(words: list[str]) -> bool:
    return sum(map(natural, words)) >= -0.5 * sum(c >= "\x80" for w in words for c in w)


@lru_cache(maxsize=300_000)
def _high(word: str) -> frozenset[int]:
    """Code points beyond ASCII."""
    return frozenset(ord(c) for c in word if c >= "\x80")


@lru_cache(maxsize=500_000)
def _read_as(pair: int, word: str) -> tuple[str, float] | None:
    """A word as a pair reads it and what it gains; None if the pair doesn't have all its characters."""
    _, _, table, keys = _pairs()[pair]
    if not _high(word) <= keys:
        return None
    new = word.translate(table)
    return new, natural(new) - natural(word)


@lru_cache(maxsize=300_000)
def _scripts(word: str) -> dict[str, int]:
    """How many letters beyond ASCII are Hebrew and Cyrillic."""
    return dict(Counter(k for c in word if c >= "\x80" and (k := _kind(c)) in "hc"))


def _byte_options(held: list[str], ends: list[bool]) -> list[tuple[float, int, int, list[str]]]:
    """Stretches that gain by another one-byte encoding."""
    suspects = {w: x for w in held if not w.isascii() and (x := _suspect(w)) < 0}
    if sum(suspects.get(w, 0.0) for w in held) > -1.9:
        return []
    odd = [(i, w) for i, w in enumerate(held) if not w.isascii()]
    chars = sorted(frozenset().union(*(_high(w) for _, w in odd)))
    times = Counter(w for _, w in odd)
    scripts: Counter = Counter()
    for w, n in times.items():
        for k, c in _scripts(w).items():
            scripts[k] += n * c
    main = max(scripts, key=scripts.get) if scripts and max(scripts.values()) >= 0.6 * scripts.total() else None
    options, seen = [], set()
    for pair, (_, _, table, _) in enumerate(_pairs()):
        here = tuple(map(table.get, chars))
        if here in seen:
            continue  # as another pair reads this text
        seen.add(here)
        readings = {w: _read_as(pair, w) for w in times}
        rises = sum(n * r[1] for w, n in times.items() if (r := readings[w]) is not None and r[1] > 0)
        if rises < (LEAST_GAIN_FROM_NONSENSE if len(scripts) < 2 else 1e-9):
            continue  # no stretch can gain enough; only beside letters of two scripts less than the least gain may do
        new, gain = list(held), [0.0] * len(held)
        for i, w in odd:
            if (reading := readings[w]) is None:
                gain[i] = None
            else:
                new[i], gain[i] = reading
        for s, a, b in _widened(gain, _segments(gain, 8.0), new, ends):
            pairs = [(x, y) for k in range(a, b + 1) for x, y in zip(held[k], new[k]) if x != y]
            if len(pairs) < LEAST_LETTERS and any(_kind(y) in "hc" for _, y in pairs):
                continue
            letters = all("֐" < x < "׿" or _kind(x) == "c" for x, _ in pairs)
            changed = {held[k] for k in range(a, b + 1) if held[k] != new[k]}
            latin = all(_plain_hebrew(x) for x, _ in pairs)
            if latin and not _latin_seen_as_hebrew(changed, pairs, held):
                continue  # words of Hebrew letters alone are Hebrew
            was = sum(natural(held[k]) for k in range(a, b + 1) if held[k] != new[k])
            if letters and not latin and len(changed) < (2 if was <= -1.0 * len(pairs) else LEAST_WORDS_AMONG_LETTERS):
                continue
            if was <= -1.8 * len(pairs) and s >= 2.2 * len(pairs):
                least = LEAST_GAIN_FROM_NONSENSE
            else:
                least = LEAST_GAIN_AMONG_LETTERS if letters else LEAST_GAIN
            support = 0.0  # a stretch in another script than all the rest of its text is the likelier to be garbled
            if letters and main and _kind(pairs[0][0]) != _kind(pairs[0][1]) and scripts[main] > 2 * len(pairs):
                support = min(4.0, 0.25 * len(pairs)) * (1 if _kind(pairs[0][1]) == main else -1)
            if s + support >= max(least, LEAST_GAIN_PER_CHARACTER * len(pairs)) and was - support < -0.1 * len(pairs) and _in_order(new[a : b + 1]):
                usual = sum(_USUAL.get(y, 0.0) for _, y in pairs) if latin else 0.0
                options.append((s + support + usual, a, b, _without_harm(gain, a, b, held, new, ends, 6.0 if letters else 2.0)))
    return options


def _segments(gain: list[float | None], fall: float = 4.0) -> list[tuple[float, int, int]]:
    """Stretches of greatest sum, cut where the sum has fallen by ``fall`` or a word can't be read."""
    found, total, start, top, stop = [], 0.0, None, 0.0, None
    for i, g in enumerate([*gain, None]):
        if g is not None and start is not None:
            total += g
            if g > 0 and total >= top:
                top, stop = total, i
        elif g is not None and g > 0:
            start, total, top, stop = i, g, g, i
        if start is not None and (g is None or total <= 0 or total < top - fall):
            found.append((top, start, stop))
            start = None
    return found


def _widened(gain: list[float | None], segments: list[tuple[float, int, int]], new: list[str], ends: list[bool]) -> list[tuple[float, int, int]]:
    """Stretches widened to words that belong to them although they gain nothing.

    Stretches of Hebrew or Cyrillic text take in all words around that can be
    read, where that loses little. Others take in words of the same sentence
    that lose nothing; ``ends`` tells after which words a sentence or line ends.
    """
    begun, upto = 0, [0.0]  # sums of the gains before each word
    run_start = []
    for i, g in enumerate(gain):
        begun = i + 1 if g is None else begun
        run_start.append(begun)
        upto.append(upto[-1] + (g or 0.0))
    stop, run_stop = len(gain) - 1, [0] * len(gain)
    for i in range(len(gain) - 1, -1, -1):
        stop = i - 1 if gain[i] is None else stop
        run_stop[i] = stop
    wide = []
    for s, a, b in segments:
        if any(_kind(c) in "hc" for w in new[a : b + 1] for c in w):
            first, last = run_start[a], run_stop[b]
            while first < a and gain[first] < 0 and sum(c >= "\x80" for c in new[first]) < 2:
                first += 1
            while last > b and gain[last] < 0 and sum(c >= "\x80" for c in new[last]) < 2:
                last -= 1
            total = upto[last + 1] - upto[first]
            wide.append((total, first, last) if total > max(0.75 * s, s - 6) else (s, a, b))
        else:
            first, last = a, b
            while first > 0 and not ends[first - 1] and (gain[first - 1] or 0) > -0.3 and gain[first - 1] is not None:
                first -= 1
            while last + 1 < len(gain) and not ends[last] and (gain[last + 1] or 0) > -0.3 and gain[last + 1] is not None:
                last += 1
            wide.append((upto[last + 1] - upto[first], first, last))
    return list({(a, b): (s, a, b) for s, a, b in wide}.values())


def _without_harm(gain: list[float | None], a: int, b: int, held: list[str], new: list[str], ends: list[bool], most: float) -> list[str]:
    """``new`` with the words of sentences between ``a`` and ``b`` that lose more than ``most`` left as they are."""
    kept, start = new, a
    for k in range(a, b + 1):
        if ends[k] or k == b:
            if sum(gain[start : k + 1]) < -most:
                kept = list(new) if kept is new else kept
                kept[start : k + 1] = held[start : k + 1]
            start = k + 1
    return kept


def restore(text: str | None) -> str | None:
    """The text as it was written: None for a text that is in order or null, '' if characters are lost.

    U+FFFD is left by a reader that met bytes its encoding doesn't have, so any
    text that holds it was read wrongly.
    """
    if not text or text.isascii():
        return None
    if LOST in text:
        return ""
    done, seen = text, set()
    while done not in seen:  # until nothing changes any more
        seen.add(done)
        words = [m.span() for m in _WORD.finditer(done)]
        held = [done[a:b] for a, b in words]
        ends = [done[b - 1] in ".!?" or "\n" in done[b:c] for (_, b), (c, _) in zip(words, words[1:])] + [True]
        done = _apply(done, words, _sequence_options(held) + _byte_options(held, ends))
    return None if done == text else done


def garbled_documents(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and restored_md5 of each document read in a wrong encoding (see ``restore``).

    Lower-case hex MD5 of the restored text's UTF-8 bytes, '' where characters
    are lost. Null, blank and plain ASCII texts are in order. Each text is read
    whole by one task; texts are shuffled only where there are fewer splits than
    cores.
    """

    def md5(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: None if (r := restore(t)) is None else r and hashlib.md5(r.encode("utf-8", "surrogatepass")).hexdigest())

    restored = F.pandas_udf(md5, "string").asNondeterministic()  # else the filter below would run it again
    odd = spread(documents.select(key, text).filter(F.col(text).rlike(r"[^\x00-\x7f]")))
    return odd.select(key, restored(text).alias("restored_md5")).filter(F.col("restored_md5").isNotNull())
