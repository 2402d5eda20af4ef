"""Calendar expressions.  All of them ignore the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrina.functions.measures import col

# Season names by month.
SEASONS = {
    "Invierno": (12, 1, 2),
    "Primavera": (3, 4, 5),
    "Verano": (6, 7, 8),
    "Otoño": (9, 10, 11),
}

MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (not calendar days)."""
    return F.date_part(F.lit("DAY"), col(end).cast("timestamp_ntz") - col(start).cast("timestamp_ntz")).cast("long")


def weekday(day: Column | str) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(col(day))


def week_ending(day: Column | str) -> Column:
    """The Sunday that closes the week of ``day``."""
    return F.date_add(F.to_date(col(day)), F.lit(6) - F.weekday(col(day)))


def season(month: Column | str) -> Column:
    chain = None
    for name, months in SEASONS.items():
        hit = col(month).isin(*months)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain


def period_label(year: Column | str, month: Column | str) -> Column:
    """``yyyy-MM``."""
    return F.concat_ws("-", col(year).cast("string"), F.lpad(col(month).cast("string"), 2, "0"))


def parse_timestamp(text: Column | str) -> Column:
    """Timestamp without zone; text that is no date becomes null."""
    return col(text).try_cast("timestamp_ntz")


def plus_days(moment: Column | str, days: Column | str) -> Column:
    return col(moment) + F.expr("INTERVAL '1' DAY") * col(days)


def plus_hours(moment: Column | str, hours: Column | str) -> Column:
    return col(moment) + F.expr("INTERVAL '1' HOUR") * col(hours)
