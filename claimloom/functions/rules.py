"""Cleaning rules as Column -> Column functions.

Only built-in expressions: every rule stays inside generated code, and none can fail a job on a
dirty cell, with ANSI mode on or off.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import vocabulary as V

_BLANK = f"[{V.BLANKS}]*"

# The text of a number, digits optionally grouped by single underscores.
_DIGITS = r"\d++(?:_\d++)*+"
_NUMBER = rf"[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?\d++)?"

# The shapes of a date text and how their parts line up as year, month, day.
_DATE_SHAPES = "|".join(
    (
        r"(\d{4})-(\d{1,2})-(\d{1,2})",
        r"(\d{1,2})([-/])(\d{1,2})\5(\d{4})",
        r"(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])",
        r"(\d{4})([/.])(\d{1,2})\12(\d{1,2})",
    )
)
_YEAR_MONTH_DAY = "$1$7$8$11-$2$4$9$13-$3$6$10$14"
_DAY_FIRST = r"(\d{1,2})([-/])(\d{1,2})\2(\d{4})"
_DAY_FIRST_PARTS = "$4-$3-$1"
_WITH_TIME = r"(\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}.*?)"
# Patterns with a month name, tried last and only for texts that hold a letter.
_NAMED_MONTH = "[MMMM d[,] yyyy][MMM d[,] yyyy][d MMM yyyy][d MMMM yyyy][d-MMM-yyyy][ H:mm[:ss]]"


def strip(text: Column) -> Column:
    """Remove blanks of every kind, tabs and line ends too (SQL trim removes spaces only)."""
    return F.btrim(text.cast("string"), F.lit(V.BLANKS))


def _matched(text: Column, shape: str) -> Column:
    """The one group of ``shape`` when the text is that and blanks around it, else an empty text."""
    return F.regexp_extract(text, f"^{_BLANK}{shape}{_BLANK}$", 1)


def _rewritten(text: Column, shape: str, form: str) -> Column:
    """The text in another form when it has the shape; otherwise the form with nothing filled in."""
    return F.regexp_replace(text, f"(?s)^(?:{_BLANK}(?:{shape}){_BLANK}|.*)$", form)


def clean_amount(raw: Column) -> Column:
    """Money text to double: no currency sign or commas; anything unreadable becomes 0.0.

    The pattern also bars what a cast would take for a number (infinity, nan, type suffixes), and a number
    beyond the range of a double reads as 0.0 too.
    """
    number = _matched(F.translate(raw.cast("string"), "$,", ""), f"({_NUMBER})")
    grouped = F.translate(number, "_", "")
    value = F.coalesce(number.try_cast("double"), grouped.try_cast("double"))
    # A finite number is its own remainder by infinity, and infinity's is nan: one use of the long expression.
    return F.coalesce(F.nanvl(value % F.lit(float("inf")), F.lit(0.0)), F.lit(0.0))


def clean_date(raw: Column) -> Column:
    """Date text to date; null when no known form fits.

    A pattern puts the parts in ISO order, whatever their order was, and a cast reads them: it
    answers null for a bad date, where a date parser throws and catches for every row. Where the
    year comes last, the month is tried before the day. The later forms are only tried when those
    before gave null. One pattern for all shapes keeps the generated method small enough for the
    JIT compiler.
    """
    text = raw.cast("string")
    named = F.try_to_timestamp(strip(text), F.lit(_NAMED_MONTH)).cast("date")
    return F.coalesce(
        _rewritten(text, _DATE_SHAPES, _YEAR_MONTH_DAY).try_cast("date"),
        _rewritten(text, _DAY_FIRST, _DAY_FIRST_PARTS).try_cast("date"),
        _matched(text, _WITH_TIME).try_cast("timestamp_ntz").cast("date"),
        F.when(text.rlike("[A-Za-z]"), named),
    )


def _look_up(raw: Column, words: Mapping[str, str]) -> Column:
    pairs = [F.lit(part) for pair in words.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[F.lower(strip(raw))], F.lit(V.UNKNOWN))


def clean_status(raw: Column) -> Column:
    return _look_up(raw, V.STATUS_WORDS)


def clean_claim_type(raw: Column) -> Column:
    return _look_up(raw, V.CLAIM_TYPE_WORDS)


def amount_category(amount: Column) -> Column:
    """First category whose upper bound is above the amount."""
    *bounded, (_, rest) = V.AMOUNT_CATEGORIES
    label = F.lit(rest)
    for bound, name in reversed(bounded):
        label = F.when(amount < F.lit(bound), F.lit(name)).otherwise(label)
    return label


def days_to_resolution(submitted: Column, resolved: Column) -> Column:
    """Whole days between the dates: null if either is missing, may be zero or negative."""
    return F.datediff(resolved, submitted)


def date_parts(date: Column, prefix: str = "") -> dict[str, Column]:
    """Calendar parts by output name; the week starts on Monday = 0."""
    parts = {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "quarter": F.quarter(date),
        "day_of_week": F.weekday(date),
    }
    return {prefix + name: column.cast("int") for name, column in parts.items()}


def mask_ssn(raw: Column) -> Column:
    text = strip(raw)
    shown = F.concat(F.lit("XXX-XX-"), F.right(text, F.lit(4)))
    return F.when(F.length(text) >= 4, shown).otherwise(F.lit(V.MASKED))


def mask_address(raw: Column) -> Column:
    """Keep only the last word, which is often the postal code."""
    text = F.translate(strip(raw), V.BLANKS, " " * len(V.BLANKS))
    last_word = F.substring_index(text, " ", -1)
    return F.when(F.length(text) > 0, F.concat(F.lit(V.MASKED + "_"), last_word)).otherwise(
        F.lit(V.MASKED)
    )


def clean_email(raw: Column) -> Column:
    text = F.lower(strip(raw))
    return F.when(F.contains(text, F.lit("@")) & F.contains(text, F.lit(".")), text)


def clean_phone(raw: Column) -> Column:
    """Digits and plus signs only; null when fewer than ten characters are left."""
    kept = F.regexp_replace(raw.cast("string"), r"[^\p{Nd}+]", "")
    return F.when(F.length(kept) >= 10, kept)
