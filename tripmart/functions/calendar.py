"""Calendar and date-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import config as C


def plausible(ts_col: str = "pickup_datetime") -> Column:
    """Does a timestamp lie within the calendar's span? NULL if there is none."""
    first, last = F.to_timestamp_ntz(F.lit(f"{C.CALENDAR_FIRST} 00:00:00")), F.to_timestamp_ntz(F.lit(f"{C.CALENDAR_LAST} 23:59:59.999999"))
    return F.col(ts_col).between(first, last)


def calendar_date(ts_col: str = "pickup_datetime") -> Column:
    """A timestamp's date; NULL for a broken one."""
    return F.when(plausible(ts_col), F.to_date(ts_col))


def date_key(ts_col: str = "pickup_datetime") -> Column:
    """Integer yyyyMMdd key of a timestamp's date (F10); NULL for a broken one, which has no day in the calendar."""
    day = F.to_date(ts_col)
    return F.when(plausible(ts_col), F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day))


def calendar_attributes(date_col: str = "date") -> dict[str, Column]:
    """The eleven dim_date attributes; Sunday = 1, ISO week, weekend = {1, 7}."""
    d = F.col(date_col)
    return {
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


def month_range(date_col: str, month: str) -> Column:
    """date in calendar month 'yyyy-MM' as a pushable range predicate (replaces startswith/date_format)."""
    first = F.to_date(F.lit(f"{month}-01"))
    return (F.col(date_col) >= first) & (F.col(date_col) < F.add_months(first, 1))
