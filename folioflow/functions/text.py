"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of numbers, money, dates and references.
KEY_VALUE = r"^([A-Za-z][A-Za-z0-9 /&()%-]{1,60}):\s*(.+)$"
MONEY = r"(?:USD|EUR|KES|GBP|\$|€|£)?\s*-?\d[\d,]*(?:\.\d+)?"
PERCENT = r"-?\d+(?:\.\d+)?%"
DATE = r"\b(?:\d{4}-\d{2}-\d{2}|[A-Z][a-z]{2,9}\s+\d{1,2},\s+\d{4})\b"
SECTION_NUMBER = r"^\s*((?:\d+\.)*\d+)\b"
NUMBERED = r"^\s*(?:\d+|[a-zA-Z])[\.\)]\s+"
REFERENCES = {
    "table": r"(?i)\b(?:see|refer to)?\s*Table\s+(\d+)\b",
    "figure": r"(?i)\b(?:see|refer to)?\s*Figure\s+(\d+)\b",
    "section": r"(?i)\b(?:see|refer to)?\s*Section\s+((?:\d+\.)*\d+)\b",
}


def collapse(text: Column) -> Column:
    """White-space runs become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{3000}]+", " "))


def count_tokens(text: Column) -> Column:
    """Words of letters, digits and underscores, and single other marks."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"))


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def short_hash(size: int, *parts: Column) -> Column:
    """The first digits of the SHA-256 of the parts, joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, size)


def nothing_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def section_number(title: Column) -> Column:
    return nothing_if_empty(F.regexp_extract(title, SECTION_NUMBER, 1))


def parent_number(number: Column) -> Column:
    return nothing_if_empty(F.regexp_extract(number, r"^(.*)\.\d+$", 1))


def lower_terms(text: Column) -> Column:
    """Lower-case terms of ASCII letters and digits, in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def terms(text: Column) -> Column:
    """Distinct lower-case terms of ASCII letters and digits."""
    return F.array_distinct(lower_terms(text))


def number_or(value: Column, other: float) -> Column:
    """A number, or ``other`` where there is none."""
    return F.coalesce(value.try_cast("double"), F.lit(float(other)))


def letters(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))


def first_match(text: Column, pattern: str) -> Column:
    return nothing_if_empty(F.trim(F.regexp_extract(text, pattern, 0)))


def first_value(text: Column) -> Column:
    return F.coalesce(first_match(text, MONEY), first_match(text, PERCENT), first_match(text, DATE))


def normal_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), r"\s+", " ")


def value_type(value: Column) -> Column:
    """struct(value_type, unit, numeric_value) of a fact's value; numbers that do not parse are null."""
    cleaned = F.trim(F.regexp_replace(value, ",", ""))
    digits = F.regexp_replace(cleaned, "[^0-9.-]", "")
    number = nothing_if_empty(digits).try_cast("double")
    whole = lambda p: cleaned.rlike(f"^(?:{p})$")
    unit = F.when(cleaned.startswith("USD") | cleaned.startswith("$"), "USD").when(cleaned.startswith("KES"), "KES")
    none, text = F.lit(None).cast("string"), F.lit(None).cast("double")
    made = lambda t, u, n: F.struct(F.lit(t).alias("value_type"), u.alias("unit"), n.alias("numeric_value"))
    return (
        F.when(whole(PERCENT), made("percentage", F.lit("%"), number))
        .when(whole(MONEY), made("currency", unit, number))
        .when(F.trim(value).rlike(f"^(?:{DATE})$"), made("date", none, text))
        .when(digits.rlike("[0-9]"), made("number", none, number))
        .otherwise(made("text", none, text))
    )
