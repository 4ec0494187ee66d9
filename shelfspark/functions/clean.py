"""Cleaning of feed values: column expressions that never fail on bad text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for true and false, placeholders for nothing, and date and time patterns, in the order tried.
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")
NOTHING = ("", "nan", "none", "null")
DATE_PATTERNS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
)
CLOCK_PATTERNS = ((r" \d{1,2}:\d{1,2}$", " H:m"), (r" \d{1,2}:\d{1,2}:\d{1,2}$", " H:m:s"))
DIGIT_PATTERNS = ((r"^\d{14}$", "yyyyMMddHHmmss"), (r"^\d{8} \d{6}$", "yyyyMMdd HHmmss"), (r"^\d{8} \d{4}$", "yyyyMMdd HHmm"))
TIME_PATTERNS = tuple((day[:-1] + clock, pattern + times) for day, pattern in DATE_PATTERNS for clock, times in CLOCK_PATTERNS if pattern != "yyyyMMdd") + DIGIT_PATTERNS
ISO_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def trimmed(column: str | Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(_c(column), r"(?U)^\s+|\s+$", "")


def not_blank(column: str | Column) -> Column:
    """Trimmed, null where nothing is left."""
    return F.nullif(trimmed(column), F.lit(""))


def clean_id(column: str | Column) -> Column:
    """Trimmed, without a final ``.0``; '' for null."""
    return F.regexp_replace(trimmed(F.coalesce(_c(column), F.lit(""))), r"\.0$", "")


def plain_digits(column: str | Column) -> Column:
    """An id of digits without leading zeros (one digit stays); other text as it is."""
    c = trimmed(column)
    return F.when(c.rlike(r"^[0-9]+$"), F.regexp_replace(c, r"^0+(?=[0-9])", "")).otherwise(c)


def parse_number(column: str | Column, precision: int = 18, scale: int = 4) -> Column:
    """A decimal; a comma is a decimal mark. Null for placeholders, words, infinities and what doesn't fit."""
    text = F.replace(trimmed(column), F.lit(","), F.lit("."))
    valid = text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return F.when(valid, text.try_cast(f"decimal({precision},{scale})"))


def guarded_number(column: str | Column, precision: int = 18, scale: int = 4) -> Column:
    """A decimal where the text is a plain number, else null."""
    text = _c(column)
    return F.when(text.rlike(r"^\s*-?[0-9]+(\.[0-9]+)?\s*$"), F.trim(text).try_cast(f"decimal({precision},{scale})"))


def parse_bool(column: str | Column, default: bool | None = None) -> Column:
    """True and false words in any case; ``default`` for all else."""
    text = F.lower(trimmed(column))
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False).otherwise(F.lit(default).cast("boolean"))


def _day(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(regex), F.try_to_timestamp(text, F.lit(pattern)).cast("date")) for regex, pattern in DATE_PATTERNS])


def _moment(text: Column) -> Column:
    """A timestamp by the first pattern of day and time that fits, then ISO with a fraction or zone."""
    times = [F.when(text.rlike(regex), F.try_to_timestamp(text, F.lit(pattern))) for regex, pattern in TIME_PATTERNS]
    iso = F.replace(text, F.lit(","), F.lit("."))
    iso = F.regexp_replace(F.regexp_replace(iso, r"(:\d{2}(?:\.\d+)?|\d)([+-]\d{2}):?(\d{2})$", "$1$2:$3"), r"( \d{2}(?::\d{2})*(?:\.\d+)?)([+-]\d{2})$", "$1$2:00")
    iso = F.regexp_replace(F.regexp_replace(iso, r"^(\S+ \d{2})(?=$|[Z+-])", "$1:00"), r"^(\S+ \d{2}:\d{2})(?=$|[Z+-])", "$1:00")
    iso = F.regexp_replace(iso, r"(\.\d{6})\d+", "$1")
    return F.coalesce(*times, F.when(text.rlike(ISO_TIME), iso.try_cast("timestamp")))


def _plain_time(column: str | Column) -> Column:
    """Trimmed, with one space between day and time."""
    return F.regexp_replace(F.regexp_replace(trimmed(column), r"(?<=\d)T(?=\d)", " "), r"\s+", " ")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def parse_date(column: str | Column) -> Column:
    """The first pattern that fits and names a real day, a time after it being dropped; null otherwise.

    Of a time with a zone, it is the day as written.
    """

    def read(text: Column) -> Column:
        written = F.when(text.rlike(ISO_TIME) & _moment(text).isNotNull(), _day(F.substring(text, 1, 10)))
        return F.coalesce(_day(text), written, _moment(text).cast("date"))

    return _once(_plain_time(column), read)


def parse_time(column: str | Column) -> Column:
    """A timestamp by the first pattern that fits, else a date's midnight; null otherwise."""
    return _once(_plain_time(column), lambda text: F.coalesce(_moment(text), _day(text).cast("timestamp")))


def first_filled(*columns: str | Column) -> Column:
    """The first value that is neither null, blank nor a placeholder."""
    kept = [F.when(~F.lower(trimmed(c)).isin(*NOTHING), trimmed(c)) for c in columns]
    return F.coalesce(*kept)


def upper_snake(column: str | Column) -> Column:
    """CamelCase to UPPER_SNAKE_CASE."""
    parted = F.regexp_replace(_c(column), r"(.)([A-Z][a-z]+)", "$1_$2")
    return F.upper(F.regexp_replace(parted, r"([a-z0-9])([A-Z])", "$1_$2"))


def without_endings(column: str | Column, endings: Sequence[str] = (".gz", ".xml", ".aspx")) -> Column:
    """A file name without these endings, taken off one after another."""
    result = _c(column)
    for e in endings:
        result = F.regexp_replace(result, "\\Q" + e + "\\E$", "")
    return result


def letters_and_digits(column: str | Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(_c(column)), r"[^\p{L}\p{N}]", "")


def half_up(column: str | Column, digits: int = 2) -> Column:
    """A double rounded with halves up, the same on every engine."""
    return F.floor(_c(column).cast("double") * 10**digits + 0.5) / 10**digits


def html_escaped(column: str | Column, most: int = 80) -> Column:
    """At most ``most`` characters, with the five special characters escaped."""
    text = F.substring(_c(column), 1, most)
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def ci_element(payload: str | Column, name: str) -> Column:
    """The value of a map's key in any case, null for 'nan'; of several, the first."""
    entries = F.filter(F.map_entries(_c(payload)), lambda e: F.lower(e["key"]) == name.lower())
    value = F.try_element_at(entries, F.lit(1))["value"]
    return F.when(F.lower(trimmed(value)) != "nan", value)


def json_kind(column: str | Column) -> Column:
    """array, object, string, number, boolean or null: what a JSON text holds; null where it is no JSON."""
    kind = F.schema_of_variant(F.try_parse_json(_c(column)))
    rules = [(kind.startswith("ARRAY"), "array"), (kind.startswith("OBJECT"), "object"), (kind == "STRING", "string"), (kind == "BOOLEAN", "boolean"), (kind == "VOID", "null")]
    return first_rule(rules, F.when(kind.isNotNull(), F.lit("number")))


def index_of(kind: str | Column, owner: str | Column) -> Column:
    """The name of an index: kind and owner joined by @, in lower case."""
    return F.lower(F.concat_ws("@", _c(kind), _c(owner)))


def index_parts(name: str | Column) -> tuple[Column, Column]:
    """Kind and owner of an index name; the owner is null where there is none."""
    parts = F.split(_c(name), "@", 2)
    return parts[0], F.try_element_at(parts, F.lit(2))


def first_rule(rules: Sequence[tuple[Column, str | Column]], otherwise: str | Column) -> Column:
    """The value of the first rule whose condition holds; a null condition doesn't hold."""
    result = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    rest = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return rest if result is None else result.otherwise(rest)
