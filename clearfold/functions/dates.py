"""Date parsing, Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearfold.functions.text import strip_blanks

# Accepted shapes with their Spark pattern, first match wins. There is no year 0.
DATE_SHAPES = [
    (r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}\z", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{2}\z", "d/M/yy"),
    (r"^(?!0000)\d{4}/\d{1,2}/\d{1,2}\z", "yyyy/M/d"),
]
# Two-digit years 69-99 mean 19xx; Spark reads them all as 20xx.
TWO_DIGIT_PIVOT = 2069


def parse_date(raw: Column) -> Column:
    """DATE of a raw text in any accepted shape, null when none fits or the day does not exist."""
    text = strip_blanks(raw)
    branches = []
    for shape, pattern in DATE_SHAPES:
        parsed = F.try_to_date(text, pattern)
        if pattern.endswith("/yy"):
            parsed = F.when(F.year(parsed) >= TWO_DIGIT_PIVOT, F.add_months(parsed, -1200)).otherwise(
                parsed
            )
        branches.append(F.when(text.rlike(shape), parsed))
    return F.coalesce(*branches)


def date_status(raw: Column, parsed: Column) -> Column:
    blank = raw.isNull() | (strip_blanks(raw) == "")
    return (
        F.when(blank, F.lit("missing")).when(parsed.isNotNull(), F.lit("ok")).otherwise(F.lit("invalid"))
    )


def normalised_date(raw: Column, parsed: Column) -> Column:
    """ISO text for a parsed date, null for a blank one; an unreadable value is kept, stripped."""
    text = strip_blanks(raw)
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.nullif(text, F.lit("")))


def is_calendar_date(c: Column) -> Column:
    """True for a real day written year-month-day; never null."""
    return F.coalesce(
        c.rlike(DATE_SHAPES[0][0]) & F.try_to_date(c, DATE_SHAPES[0][1]).isNotNull(), F.lit(False)
    )
