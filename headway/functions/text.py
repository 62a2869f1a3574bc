"""Text predicates and keys used by rules and by identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that may not occur in note text.
PROHIBITED_CHARACTERS = r",[]{}^=@:;#$£?%+<>«»\/|~_¬"

# Words read as a date or a time. A documented pattern list stands in for a
# lenient date parser: numeric dates, clock times, month and weekday names,
# ordinals, and digit groups joined to a month name.
_MONTH = (
    "jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?"
    "|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?"
)
_WEEKDAY = "mon(day)?|tues?(day)?|wed(nesday)?|thu(rs|rsday)?|fri(day)?|sat(urday)?|sun(day)?"
DATE_WORD = (
    r"(?i)^("
    r"\d{1,4}[-/.]\d{1,2}([-/.]\d{1,4})?"
    r"|\d{1,2}:\d{2}(:\d{2})?([ap]m)?"
    r"|\d{1,2}[ap]m"
    rf"|({_MONTH})\.?,?"
    rf"|({_WEEKDAY})\.?,?"
    rf"|\d{{1,2}}(st|nd|rd|th)?[-/.]?({_MONTH})([-/.]?\d{{2,4}})?"
    rf"|({_MONTH})[-/.]?\d{{1,4}}"
    r")$"
)


def _character_class(characters: str) -> str:
    return "[" + "".join("\\" + c if c in r"[]^\-/{}|$?+." else c for c in characters) + "]"


def has_prohibited_characters(text: Column) -> Column:
    return F.coalesce(text.rlike(_character_class(PROHIBITED_CHARACTERS)), F.lit(False))


def contains_date(text: Column) -> Column:
    """Whether any blank-separated word reads as a date; pure digits do not."""
    return F.coalesce(
        F.exists(
            F.split(text, r"\s+"), lambda w: w.rlike(DATE_WORD) & ~w.rlike(r"^\d+$")
        ),
        F.lit(False),
    )


def matches_at_start(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"^({pattern})"), F.lit(False))


def all_in(names: Column, *allowed: str) -> Column:
    """Whether every name of an array is one of the allowed ones."""
    return F.coalesce(F.forall(names, lambda n: n.isin(*allowed)), F.lit(True))


def is_true(text: Column) -> Column:
    return F.coalesce(text == "true", F.lit(False))


def has_path_separator(name: Column) -> Column:
    return F.coalesce(name.rlike(r"[\\/]"), F.lit(False))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def xml_name(name: Column) -> Column:
    return F.when(F.lower(name).endswith(".xml"), name).otherwise(F.concat(name, F.lit(".xml")))


def sequence_key(owner: Column, values: Column) -> Column:
    """Repeatable key of an owner's ordered list of text values."""
    return F.sha2(F.concat(owner.cast("string"), F.lit("\x1f"), F.concat_ws("\x1f", values)), 256)


def area_codes(stop_ids: Column) -> Column:
    """Distinct numeric area codes: the three digits after ``atco:``."""
    code = F.transform(
        F.filter(stop_ids, lambda s: s.contains("atco:")),
        lambda s: F.substring(F.substring_index(s, "atco:", -1), 1, 3),
    )
    numeric = F.filter(code, lambda c: c.rlike(r"^\d{3}$"))
    return F.array_sort(F.array_distinct(F.transform(numeric, lambda c: c.cast("int"))))


def document_type(text: Column) -> Column:
    """Name of the root element of a document, without its prefix."""
    return F.regexp_extract(text, r"<(?:\w+:)?([A-Za-z]\w*)[\s>/]", 1)


def document_version(text: Column) -> Column:
    """Version attribute of the root element (timetable or fares)."""
    timetable = F.regexp_extract(text, r'<(?:\w+:)?TransXChange[^>]*\bSchemaVersion="([^"]*)"', 1)
    fares = F.regexp_extract(text, r'<(?:\w+:)?PublicationDelivery[^>]*\bversion="([^"]*)"', 1)
    return F.coalesce(F.nullif(timetable, F.lit("")), F.nullif(fares, F.lit("")))


def is_unsafe_xml(text: Column) -> Column:
    """Document type or entity declarations are not admitted."""
    return F.coalesce(text.rlike(r"<!(DOCTYPE|ENTITY)"), F.lit(False))
