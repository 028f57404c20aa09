"""Text predicates and parsers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits that count as digits in a market symbol.
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
SUPERSCRIPT_DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹"
ASCII_DIGITS = "0123456789"

def is_symbol(name: str | Column, limit: int = 20) -> Column:
    """Keep a listing when the digits in its name form a number below ``limit``, or there are none.

    The digit run is compared as text, so its length does not matter.
    """
    c = F.col(name) if isinstance(name, str) else name
    folded = F.translate(c, PERSIAN_DIGITS + ARABIC_DIGITS, ASCII_DIGITS * 2)
    digits = F.regexp_replace(folded, "[^0-9]", "")
    number = F.ltrim(digits, F.lit("0"))
    width = len(str(limit))
    small = (F.length(number) < width) | (
        (F.length(number) == width) & (number < F.lit(str(limit))))
    return F.coalesce((digits == "") | small | c.rlike(f"[{SUPERSCRIPT_DIGITS}]"), F.lit(True))


def parse_event_time(text: str | Column) -> Column:
    """Timestamp without zone (UTC) from mixed ISO spellings; NULL when the text is not a time.

    A cast reads every ISO form with or without fraction and offset. It also reads bare years and
    times of day, which are no event times, so a full date is asked for first.
    """
    c = F.trim(F.col(text) if isinstance(text, str) else text)
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), c).try_cast("timestamp")
    slashed = F.try_to_timestamp(c, F.lit("yyyy/MM/dd HH:mm:ss"))
    return F.coalesce(iso, slashed).cast("timestamp_ntz")


def to_number(text: Column) -> Column:
    """Number with optional thousands separators."""
    return F.regexp_replace(text, ",", "").try_cast("double")
