"""Scalar functions: coercion, cleaning, rounding, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """A text as a number: blank is 0, blanks around are ignored, junk is NaN, null is NaN."""
    return F.when(F.trim(c) == "", 0.0).otherwise(F.coalesce(F.trim(c).try_cast("double"), F.lit(float("nan"))))


def clean_cell(c: Column) -> Column:
    """Trimmed, inner white space collapsed; ``NA`` and blank are null."""
    text = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when((text != "NA") & (text != ""), text)


def day_first_date(c: Column) -> Column:
    """dd/MM/yyyy as a date; null where there is no such day."""
    return F.try_to_date(F.trim(c), "dd/MM/yyyy")


def event_name(c: Column) -> Column:
    """The event without its round."""
    found = F.regexp_extract(c, r"^(.*?)\s*-?\s*Rd\s*(\d+)$", 1)
    return F.when(F.regexp_like(c, F.lit(r"^(.*?)\s*-?\s*Rd\s*(\d+)$")), found).otherwise(c)


def event_round(c: Column) -> Column:
    return F.regexp_extract(c, r"^(.*?)\s*-?\s*Rd\s*(\d+)$", 2).try_cast("int")


def period_label(c: Column) -> Column:
    """``2022 - Part 1`` and ``2022 Part 1`` as ``2022P1``."""
    return F.regexp_replace(F.trim(c), r"^(\d{4})\s*-?\s*Part\s*(\d+)$", "$1P$2")


def round_half_up(c: Column, places: int) -> Column:
    """Rounded with ties toward plus infinity, which ``round`` does not do."""
    f = float(10**places)
    return F.floor(c * f + 0.5) / F.lit(f)


def round_half_away(c: Column) -> Column:
    """A whole number with ties away from zero, as SQL's ``round`` has it; ``rint`` takes ties to the even one."""
    near = F.rint(c)
    return F.when(F.abs(c - near) == 0.5, c + F.signum(c) * 0.5).otherwise(near)


def utc_day(millis: Column) -> Column:
    """yyyy-MM-dd of epoch milliseconds; the session's zone has to be UTC."""
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd")


def millis_to_seconds(millis: Column) -> Column:
    return millis / 1000


def zero_pad(c: Column, width: int) -> Column:
    """Left-padded with zeros, never cut."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def time_label(ts: Column, zone: str, pattern: str) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, zone), pattern)


def hover_label(name: Column, value: Column) -> Column:
    """``name: value`` without decimals or grouping."""
    return F.concat(name, F.lit(": "), F.format_string("%.0f", value))


def first_non_empty(*columns: Column) -> Column:
    """The first that is neither null nor empty; the last one as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns[:-1]], columns[-1])


def opacity(c: Column) -> Column:
    """0 stays 0, missing is 1."""
    return F.coalesce(c, F.lit(1.0))


def fingerprint(*columns: str) -> Column:
    """Equality of records by their JSON text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
