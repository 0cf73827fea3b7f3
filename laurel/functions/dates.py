"""Date expressions: weeks, seasons, lenient parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# English month names in calendar order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Timestamp spellings of the feeds. Day-first spellings come before month-first ones.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "dd-MM-yyyy",
    "MM/dd/yyyy",
)


def week_start(date: Column) -> Column:
    """Monday of the ISO week of `date`."""
    return F.trunc(date, "week")


def week_end(date: Column) -> Column:
    """Sunday of the ISO week of `date`."""
    return F.date_add(week_start(date), 6)


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date)


def award_week_start(award_date: Column) -> Column:
    """Week that an award dated the Monday after it belongs to."""
    return week_start(F.date_sub(award_date, 1))


def season_of(date: Column, first_month: int = 7) -> Column:
    """Calendar rule: the season that starts in `first_month` carries the year of its start."""
    year = F.year(date)
    return F.when(F.month(date) >= first_month, year).otherwise(year - 1)


def season_of_text(text: Column) -> Column:
    """Start year of a season written like `2024-25`."""
    return F.substring(text, 1, 4).try_cast("int")


def season_by_rules(date: Column, rules: Sequence[tuple[int, str, str]]) -> Column:
    """Season of the first `(season, first day, last day)` rule that holds, else NULL.

    A `CASE` chain: no join, and the first match wins where ranges overlap.
    """
    result = F.lit(None).cast("int")
    for season, first, last in reversed(list(rules)):
        inside = date.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        result = F.when(inside, F.lit(season)).otherwise(result)
    return result


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First format that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def month_number(name: Column) -> Column:
    """Number of an English month name, NULL when it is none."""
    pairs = [F.lit(x) for i, m in enumerate(MONTHS, start=1) for x in (m, i)]
    return F.create_map(*pairs)[name]


def award_year(season_text: Column, month: Column) -> Column:
    """Calendar year of an award: the start year of the season after June, else the next one."""
    first = season_of_text(season_text)
    return F.when(month > 6, first).otherwise(first + 1)


def weeks_between(first: Column, last: Column) -> Column:
    """Whole weeks needed to cover the days from `first` to `last`, at least one."""
    return F.greatest(F.ceil(F.datediff(last, first) / 7), F.lit(1)).cast("int")
