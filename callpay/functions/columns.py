"""Column expressions shared by the models. All run inside the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: str | Column, chars: str | None = None) -> Column:
    """Blank to NULL. Only spaces count as blank unless ``chars`` names more."""
    trimmed = F.trim(_c(c)) if chars is None else F.btrim(_c(c), F.lit(chars))
    return F.nullif(trimmed, F.lit(""))


def try_long(c: str | Column) -> Column:
    return _c(c).try_cast("bigint")


def try_double(c: str | Column) -> Column:
    return _c(c).try_cast("double")


def try_ts(c: str | Column) -> Column:
    """Text to a timestamp without zone, so results never depend on the session zone."""
    return _c(c).try_cast("timestamp_ntz")


def hours(n: str | Column) -> Column:
    return F.make_dt_interval(hours=_c(n).cast("int"))


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def local_to_utc(ts: str | Column, offset_hours: str | Column) -> Column:
    """Local wall clock minus a fixed offset; an unknown offset gives NULL."""
    return _c(ts) - hours(offset_hours)


def clock(as_of: datetime | None) -> Column:
    """The run's clock in UTC: a fixed instant, or the time the query runs."""
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def window_closes_at(ts: str | Column, window_days: int) -> Column:
    return _c(ts) + days(window_days)


def is_window_closed(ts: str | Column, window_days: int, as_of: datetime | None) -> Column:
    return clock(as_of) >= window_closes_at(ts, window_days)


def safe_divide(n: str | Column, d: str | Column) -> Column:
    """A ratio that is NULL, not an error, when the denominator is 0."""
    return F.try_divide(_c(n), _c(d))


def convert_amount(amount: str | Column, rate: str | Column) -> Column:
    """Local amount in USD; NULL when there is no usable rate."""
    return F.try_divide(_c(amount), _c(rate))


def coalesce_label(c: str | Column, label: str) -> Column:
    return F.coalesce(_c(c), F.lit(label))


def digit_runs(c: str | Column) -> Column:
    """Each distinct run of digits in a text, as BIGINT; runs too long for one are NULL."""
    return F.transform(
        F.array_distinct(F.regexp_extract_all(_c(c), F.lit("[0-9]+"), F.lit(0))),
        lambda run: run.try_cast("bigint"),
    )


def minute_number(ts: str | Column) -> Column:
    """Minutes since 1970 of a zone-less timestamp; grows with ``ts`` in any session zone."""
    ts = _c(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
