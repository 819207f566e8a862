"""Calendar and clock column functions.

All are ``Column -> Column`` and stay inside whole-stage codegen.  Timestamps
are ``timestamp_ntz``: session times carry no zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions._util import as_col

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def date_key(ts) -> Column:
    """``yyyymmdd`` as int (H6); null in, null out, no text round trip."""
    c = as_col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def date_key_or_unknown(ts) -> Column:
    """Date key with the unknown member ``-1`` for a missing date."""
    return F.coalesce(date_key(ts), F.lit(-1))


def semester(month) -> Column:
    return F.when(as_col(month) <= 6, F.lit(1)).otherwise(F.lit(2))


def bimester(month) -> Column:
    # ceil returns bigint; the dimension column is int
    return F.ceil(as_col(month) / 2).cast("int")


def is_leap_year(year) -> Column:
    y = as_col(year)
    return F.when((y % 400 == 0) | ((y % 4 == 0) & (y % 100 != 0)), F.lit(1)).otherwise(F.lit(0))


def calendar_columns(day) -> dict[str, Column]:
    """Attributes of ``dim_date`` for a date/timestamp column (H1-H6).

    ``week_day`` counts Monday as 0; ``week_of_year`` is the ISO week.
    """
    d = as_col(day)
    month = F.month(d)
    year = F.year(d)
    return {
        "pk_date": date_key(d),
        "year": year,
        "month_name": F.monthname(d),
        "month": month,
        "day": F.dayofmonth(d),
        "week_day": F.weekday(d),
        "week_of_year": F.weekofyear(d),
        "day_of_year": F.dayofyear(d),
        "semester": semester(month),
        "trimester": F.quarter(d),
        "bimester": bimester(month),
        "is_leap_year": is_leap_year(year),
    }


def clock_text(hour, minute=None, second=None) -> Column:
    """``HH:MM:SS`` with zero padding (H7); ``HH:00:00`` when only the hour is given."""
    def two(c):
        return F.lpad(as_col(c).cast("string"), 2, "0")
    if minute is None and second is None:
        return F.concat(two(hour), F.lit(":00:00"))
    return F.concat(two(hour), F.lit(":"), two(minute), F.lit(":"), two(second))


def second_of_day(hour, minute, second) -> Column:
    """A clock time as one number; null where a part is."""
    return as_col(hour) * 3600 + as_col(minute) * 60 + as_col(second)


def strip_quotes(text) -> Column:
    """Remove every double quote."""
    return F.translate(as_col(text), '"', "")


def parse_timestamp(text, fmt: str = DEFAULT_TS_FORMAT) -> Column:
    """Text to ``timestamp_ntz``; null (not an error) on bad input.

    The default pattern goes through a zone-free cast; other patterns parse
    with ``try_to_timestamp`` and drop the zone afterwards.
    """
    t = F.trim(strip_quotes(text))
    if fmt == DEFAULT_TS_FORMAT:
        ok = t.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
        return F.when(ok, t.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(t, F.lit(fmt)).cast("timestamp_ntz")


def session_clock(day, seconds) -> Column:
    """A date plus a number of seconds as ``timestamp_ntz``."""
    return as_col(day).cast("timestamp_ntz") + F.expr("INTERVAL '1' SECOND") * as_col(seconds)


# ---- slices on the integer date key (B7, B8, H18) -------------------------------

def key_matches(key, pattern: str) -> Column:
    """Regex on the key written as text (the reference's form; not pushable)."""
    return F.regexp_like(as_col(key).cast("string"), F.lit(pattern))


def key_in_month(key, month: int) -> Column:
    """Month ``mm`` of any year on a ``yyyymmdd`` key, as arithmetic."""
    k = as_col(key)
    return (k >= 10000000) & (k <= 99999999) & (F.floor(k / 100) % 100 == month)


def key_in_month_of_years(key, month: int, years) -> Column:
    """Month ``mm`` of the listed years as an OR of closed key ranges.

    Same rows as ``key_in_month`` when ``years`` covers the data, but each
    range reaches the Parquet reader, so row groups of other months are
    skipped on date-sorted files.
    """
    k = as_col(key)
    ranges = [k.between(y * 10000 + month * 100 + 1, y * 10000 + month * 100 + 31) for y in sorted(set(years))]
    if not ranges:
        return F.lit(False)
    out = ranges[0]
    for r in ranges[1:]:
        out = out | r
    return out


def key_in_year(key, year: int) -> Column:
    """Closed range on the key: pushable to Parquet and to partition filters."""
    return as_col(key).between(year * 10000 + 101, year * 10000 + 1231)


def ts_in_year(ts, year: int) -> Column:
    """Half-open timestamp range for one calendar year (pushable)."""
    c = as_col(ts)
    return (c >= F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")) & \
           (c < F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz"))
