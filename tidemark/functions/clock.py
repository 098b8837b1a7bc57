"""Time columns.  "Now" is always a parameter; left out, it is the live clock."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def now(as_of=None) -> Column:
    """``as_of`` as timestamp text in the session zone, a Column, or None."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def today(as_of=None) -> Column:
    return F.current_date() if as_of is None else F.to_date(now(as_of))


def ago(as_of=None, days=0, hours=0) -> Column:
    return now(as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def yesterday_text(as_of=None) -> str:
    """The default processing date, resolved on the driver as plain text."""
    moment = datetime.fromisoformat(as_of) if as_of else datetime.now(timezone.utc)
    return (moment - timedelta(days=1)).strftime("%Y-%m-%d")


def iso_timestamp(col) -> Column:
    """ISO-8601 text to an instant; unreadable text is NULL, not an error."""
    return F.try_to_timestamp(F.col(col))


def iso_date(col) -> Column:
    return F.try_to_date(F.col(col))


def within(at, day, as_of=None, days=0, hours=0) -> Column:
    """Predicate: ``at`` lies in the last days / hours, prunable by ``day``.

    ``day`` is the partition column, text or DATE.  Its date ignores the zone
    offset of the event time, so it is only asked to be within one day.  An
    explicit ``as_of`` also hides what came later; the live clock does not.
    """
    cutoff, until = ago(as_of, days=days, hours=hours), now(as_of)
    recent = (day >= day_text(F.date_sub(F.to_date(cutoff), 1))) & (at > cutoff)
    if as_of is None:
        return recent
    return recent & (day <= day_text(F.date_add(F.to_date(until), 1))) & (at <= until)
