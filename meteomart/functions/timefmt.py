"""Time-of-day text, local time from UTC, calendar names, exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteomart.functions.classify import uf_timezone

# 'HH:mm:ss' with HH 00-23, or the end-of-day value 24:00:00 that SQL TIME accepts.
_TIME_PATTERN = r"^(([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]|24:00:00)$"


def validated_time(c: Column, on_bad: str = "error") -> Column:
    """Keep a valid 'HH:mm:ss' text; bad text fails the query (or NULL)."""
    ok = c.rlike(_TIME_PATTERN)
    if on_bad == "null":
        return F.when(ok, c)
    return F.when(c.isNull() | ok, c).otherwise(
        F.raise_error(F.concat(F.lit("invalid time of day: "), c)))


def hour_of(time_text: Column) -> Column:
    return F.substring(time_text, 1, 2).cast("int")


def local_time(day: Column, time_text: Column, uf: Column) -> Column:
    """UTC date + 'HH:mm:ss' -> local wall-clock TIMESTAMP_NTZ of the state.

    Built as date + interval so '24:00:00' rolls to the next day; NULL in any
    input gives NULL.  convert_timezone does not depend on the session zone.
    """
    utc = day.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), hour_of(time_text), F.substring(time_text, 4, 2).cast("int"),
        F.substring(time_text, 7, 2).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), uf_timezone(uf), utc)


def weekday_name_padded(day: Column) -> Column:
    """English day name blank-padded to 9 characters ('Monday   ')."""
    return F.rpad(F.date_format(day, "EEEE"), 9, " ")


def exact_avg_round(total: Column, count: Column, scale: int = 2) -> Column:
    """ROUND(total / count, scale) half away from zero, computed exactly.

    ``total`` is a decimal sum with at most ``scale`` fraction digits and
    ``count`` the number of non-NULL inputs.  Integer arithmetic on decimal(38,0)
    avoids the double rounding of decimal division at any group size.  Groups
    without values (count 0) give NULL, like AVG.
    """
    unit = 10 ** scale
    units = (total * unit).cast("decimal(38,0)")
    mag = F.abs(units)
    n = F.nullif(count, F.lit(0)).cast("decimal(38,0)")  # empty group -> NULL, no /0
    rem = mag % n
    quotient = ((mag - rem) / n).cast("decimal(38,0)")
    rounded = quotient + F.when(rem * 2 >= n, 1).otherwise(0)
    signed = F.when(units < 0, -rounded).otherwise(rounded)
    return (signed / unit).cast(f"decimal(38,{scale})")
