"""Dates written in several ways."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tablewright.functions.text import replace_first, trimmed

# The day from which spreadsheet serial numbers count, and the formats tried in order.
SERIAL_ORIGIN = "1899-12-30"
DAY_FIRST_FORMATS = ("d-M-yyyy", "d-MMM-yyyy", "d-MMMM-yyyy")
YEAR_FIRST_FORMATS = ("yyyy-M-d", "yyyy-MMM-d", "yyyy-MMMM-d")


def _dashed(col: Column) -> Column:
    return F.regexp_replace(col, r"[\s/.,_-]+", "-")


def first_parsed(col: Column, formats: Sequence[str]) -> Column:
    """The date by the first format that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)).cast("date") for f in formats])


def parse_mixed_date(col: Column, only_length: int | None = None) -> Column:
    """A date from a spreadsheet serial number, a bare year (1 January) or year-day-month text.

    A ".0" left by number formatting is dropped first, from every value or, with ``only_length``,
    from values of that length.
    """
    shortened = replace_first(col, r"\.0", "")
    text = shortened if only_length is None else F.when(F.length(col) == only_length, shortened).otherwise(col)
    serial = F.when(text.rlike(r"^\d{5}(\.\d*)?$"), F.left(text, F.lit(5)).cast("int"))
    year = F.when(text.rlike(r"^\d{4}$"), text)
    return F.coalesce(
        F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), serial),
        F.try_to_timestamp(F.concat(year, F.lit("-01-01")), F.lit("yyyy-MM-dd")).cast("date"),
        first_parsed(_dashed(text), ("yyyy-d-M",)),
    )


def _spelt_out(text: Column, year_first: bool) -> Column:
    """Digits run together cut into parts, and a two-digit year given its century (69 to 99 are in the 1900s)."""
    year, two = (r"(\d{4})", r"(\d{2})")
    # Run together, a year after the day and month must be a plausible one, or the run starts with the year.
    runs = [f"^{two}{two}{two}$", f"^{year}{two}{two}$" if year_first else f"^{two}{two}((?:19|20)\\d{{2}})$"]
    for run in runs:
        text = F.regexp_replace(text, run, "$1-$2-$3")
    parts = F.split(text, "-")
    at = F.lit(0) if year_first else F.lit(2)
    short = F.get(parts, at)
    century = F.when(short.cast("int") >= 69, "19").otherwise("20")
    full = F.transform(parts, lambda p, i: F.when((i == at) & short.rlike(r"^\d{2}$"), F.concat(century, p)).otherwise(p))
    return F.when(F.size(parts) == 3, F.array_join(full, "-")).otherwise(text)


def fix_date(col: Column) -> Column:
    """A date from day-month-year text, or else year-month-day; spaces and brackets are ignored.

    Parts may be run together (20170213) and years may have two digits.
    """
    text = _dashed(trimmed(F.regexp_replace(trimmed(col.cast("string")), r"\(|\)", "")))
    return F.coalesce(
        first_parsed(_spelt_out(text, False), DAY_FIRST_FORMATS), first_parsed(_spelt_out(text, True), YEAR_FIRST_FORMATS)
    )


def date_text(col: Column) -> Column:
    """A time stamp or date as yyyy-MM-dd text."""
    return F.date_format(col.cast("date"), "yyyy-MM-dd")
