"""Calendar attributes as pure functions of a date column, and the date dimension."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names and dates the calendar must show exactly.
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
MONTHS_IT = [
    "Gennaio", "Febbraio", "Marzo", "Aprile", "Maggio", "Giugno",
    "Luglio", "Agosto", "Settembre", "Ottobre", "Novembre", "Dicembre",
]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# month * 100 + day of the fixed Italian public holidays
HOLIDAYS = [101, 106, 425, 501, 602, 815, 1101, 1208, 1225, 1226]
# meteorological quarter starting in December
SEASONS = ["Inverno", "Primavera", "Estate", "Autunno"]


def _pick(labels: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), position)


def date_key(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def date_of_key(key: Column) -> Column:
    whole = key.cast("int")
    return F.make_date(
        F.floor(whole / 10000).cast("int"),
        F.floor(whole % 10000 / 100).cast("int"),
        whole % 100,
    )


def month_index(date: Column) -> Column:
    """Consecutive month number, so that month arithmetic is plain integer arithmetic."""
    return F.year(date) * 12 + F.month(date)


def year_month(date: Column) -> Column:
    return F.format_string("%d-%02d", F.year(date), F.month(date))


# Every column of the date dimension, and the month grain keys, as functions of a date.
CALENDAR = {
    "date_key": date_key,
    "date": lambda d: d,
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "month_name": lambda d: _pick(MONTHS, F.month(d)),
    "month_name_it": lambda d: _pick(MONTHS_IT, F.month(d)),
    "week": F.weekofyear,
    "day_of_week": lambda d: F.weekday(d) + 1,
    "day_name": lambda d: _pick(DAYS, F.weekday(d) + 1),
    "is_weekend": lambda d: (F.weekday(d) >= 5).cast("int"),
    "is_holiday": lambda d: (F.month(d) * 100 + F.day(d)).isin(HOLIDAYS).cast("int"),
    "season": lambda d: _pick(SEASONS, F.floor(F.month(d) % 12 / 3).cast("int") + 1),
    "month_idx": month_index,
    "year_month": year_month,
}


DIM_DATE_COLUMNS = [
    "date_key", "date", "year", "quarter", "month", "month_name", "month_name_it", "week",
    "day_of_week", "day_name", "is_weekend", "is_holiday", "season",
]


@dataclass(frozen=True)
class Period:
    """A range of days, both ends included."""

    first: datetime.date
    last: datetime.date

    def covers(self, day: Column) -> Column:
        return day.between(F.lit(self.first), F.lit(self.last))

    def keys(self) -> tuple[int, int]:
        return tuple(int(d.strftime("%Y%m%d")) for d in (self.first, self.last))


def build_dim_date(span: DataFrame, horizon_days: int) -> DataFrame:
    """One row per day from ``first_date`` to ``last_date`` plus the horizon (a one-row frame)."""
    days = span.select(
        F.explode(
            F.sequence("first_date", F.date_add("last_date", horizon_days))
        ).alias("date")
    )
    return days.select(*[CALENDAR[c](F.col("date")).alias(c) for c in DIM_DATE_COLUMNS])
