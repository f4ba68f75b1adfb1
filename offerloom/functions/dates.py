"""Calendar expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar(ts: Column) -> dict[str, Column]:
    """Date, hour, day name and month name of a timestamp."""
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "day_name": F.date_format(ts, "EEEE"),
        "month_name": F.date_format(ts, "MMMM"),
    }


def parse_timestamp(text: Column) -> Column:
    """Typed timestamp of mixed date text; unreadable text gives NULL."""
    return F.try_to_timestamp(text)


def year_month(text: Column) -> Column:
    return F.date_trunc("month", parse_timestamp(text))


def within_last_days(ts: Column, as_of: Column, days: int) -> Column:
    return (F.to_date(ts) > F.date_sub(as_of, days)) & (F.to_date(ts) <= as_of)
