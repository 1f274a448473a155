"""Date helpers.  Every time-dependent operator takes an ``as_of`` date so a
run is reproducible; ``None`` means the current date of the session."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of a month and a year in the relative date window.
DAYS_PER_UNIT = {"day": 1, "week": 7, "month": 30, "year": 365}


def as_of_date(as_of=None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(as_of)))


def days_since(ts, as_of=None) -> Column:
    """Whole days from ``ts`` to ``as_of`` (``datediff(as_of, ts)``)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(as_of_date(as_of), F.to_date(ts))


def epoch_to_ts_string(epoch, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds (number or numeric string) -> formatted string in the session zone."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.from_unixtime(epoch.try_cast("long"), fmt)


SECONDS_PER_DAY = 86400


def epoch_to_date(epoch, tz: str | None = None) -> Column:
    """Epoch seconds -> calendar date.

    ``tz=None`` reads the epoch in the session zone (``from_unixtime``);
    ``tz="UTC"`` is plain day arithmetic and does not depend on the session.
    """
    epoch = (F.col(epoch) if isinstance(epoch, str) else epoch).try_cast("long")
    if tz is None:
        return F.to_date(F.from_unixtime(epoch))
    if tz.upper() != "UTC":
        return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), _utc_wall_clock(epoch)))
    return F.date_from_unix_date(F.floor(epoch / SECONDS_PER_DAY).cast("int"))


def _utc_wall_clock(epoch: Column) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` holding the UTC wall clock (no session zone)."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(days=F.floor(epoch / SECONDS_PER_DAY).cast("int"),
                                      secs=F.pmod(epoch, F.lit(SECONDS_PER_DAY)).cast("decimal(18,6)"))


def shift_epoch_days_midnight(epoch, days: int, tz: str | None = None) -> Column:
    """Epoch seconds + ``days`` days, truncated to midnight, as epoch seconds
    (midnight of the session zone, or of ``tz``; see :func:`epoch_to_date`)."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    if tz is not None and tz.upper() == "UTC":
        day = F.floor(epoch.try_cast("long") / SECONDS_PER_DAY) + days
        return (day * SECONDS_PER_DAY).cast("long")
    d = F.date_add(epoch_to_date(epoch, tz), days)
    if tz is None:
        return F.unix_timestamp(d.cast("timestamp"))
    # midnight in ``tz`` as a UTC wall clock; unix_timestamp reads timestamp_ntz as UTC
    return F.unix_timestamp(F.convert_timezone(F.lit(tz), F.lit("UTC"), d.cast("timestamp_ntz")))


def ntz_epoch_micros(ts) -> Column:
    """Microseconds since the epoch of a wall-clock (``timestamp_ntz``) value
    read as UTC, independent of the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    frac = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long") % 1_000_000
    return F.unix_timestamp(ts) * 1_000_000 + frac


def days_for(unit: str, n: int) -> int:
    try:
        return DAYS_PER_UNIT[unit.strip().lower()] * int(n)
    except KeyError as e:
        raise ValueError(f"unknown date unit {unit!r}") from e


def relative_window(field, unit: str, n: int, as_of=None, field_type: str | None = None) -> Column:
    """``field#unit#n``: ``as_of - n units <= field <= as_of - 1 day`` (on dates).

    ``field`` may be a date, a timestamp or a ``yyyy-MM-dd`` string.  When the
    column's type is given (``date``, ``timestamp``, ``timestamp_ntz``), the
    window is written as plain comparisons on the column itself
    (``field >= first day, field < as_of``) so the scan can push it down and
    skip row groups; otherwise the column is converted with ``to_date``.
    """
    field = F.col(field) if isinstance(field, str) else field
    ref = as_of_date(as_of)
    lower = F.date_sub(ref, days_for(unit, n))
    if field_type == "date":
        return (field >= lower) & (field < ref)
    if field_type in ("timestamp", "timestamp_ntz"):
        return (field >= lower.cast(field_type)) & (field < ref.cast(field_type))
    return F.to_date(field).between(lower, F.date_sub(ref, 1))


def window_on(df, text_field: str, unit: str, n: int, as_of=None) -> Column:
    """:func:`relative_window` for a column of ``df`` (its type picks the form)."""
    name = text_field.strip()
    types = dict(df.dtypes)
    return relative_window(F.col(name), unit, n, as_of, types.get(name))


def shift_date_string(value, days: int, fmt: str = "yyyy-MM-dd") -> Column:
    """Date string ``days`` days later (earlier when negative), same format."""
    value = F.col(value) if isinstance(value, str) else value
    return F.date_format(F.date_add(F.to_date(value, fmt), days), fmt)


def today_string(fmt: str = "yyyy-MM-dd", as_of=None) -> Column:
    """The evaluation date (default: today) as a string."""
    return F.date_format(as_of_date(as_of), fmt)
