"""Clock and calendar columns.

Instants are UTC: a ``timestamp`` column in a UTC session, or a ``timestamp_ntz``
holding the UTC wall clock. Local times are always ``timestamp_ntz``.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOUNTAIN = "America/Denver"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")


def ntz_literal(moment: date | datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def to_local(instant: Column | str, zone: str = MOUNTAIN) -> Column:
    """UTC instant to the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz(instant))


def to_instant(wall: Column | str, zone: str = MOUNTAIN) -> Column:
    """Wall clock of ``zone`` to the UTC instant."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ntz(wall)).cast("timestamp")


def trunc_hour(c: Column | str) -> Column:
    return F.date_trunc("hour", ntz(c)).cast("timestamp_ntz")


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Hour boundaries crossed from ``earlier`` to ``later`` (00:59 to 02:01 is 2)."""
    return F.timestamp_diff("HOUR", trunc_hour(earlier), trunc_hour(later))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(1e6)


def epoch_micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def parse_compact_hour(text: Column | str) -> Column:
    """``20220705T06Z`` to an instant; null where it does not parse."""
    return F.try_to_timestamp(_col(text), F.lit("yyyyMMdd'T'HHX"))


def parse_iso(text: Column | str) -> Column:
    """ISO time with offset to an instant; null where it does not parse."""
    return F.try_to_timestamp(_col(text))


def parse_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def add_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Calendar features of one time column; weekends start on Saturday, summer is May to September."""
    t, month = F.col(ts), F.month(ts)
    return df.withColumns(
        {
            "year": F.year(t),
            "day_of_year": F.dayofyear(t),
            "hour": F.hour(t),
            "month": month,
            "is_weekend": F.weekday(t) >= 5,
            "is_summer": month.between(5, 9),
        }
    )


def is_weekday(ts: Column | str) -> Column:
    return F.weekday(_col(ts)) < 5


def in_dates(ts: Column | str, start: date | str, end: date | str, ends: str = "day") -> Column:
    """Date-range test on a raw column, so that it reaches the Parquet scan.

    ``ends="day"`` keeps the whole last day; ``ends="midnight"`` stops at its first instant.
    """
    start, end = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    c = _col(ts)
    if ends == "day":
        return (c >= ntz_literal(start)) & (c < ntz_literal(end + timedelta(days=1)))
    if ends == "midnight":
        return c.between(ntz_literal(start), ntz_literal(end))
    raise ValueError(f"ends must be 'day' or 'midnight', not {ends!r}")


def in_window(ts: Column | str, start: datetime | str, end: datetime | str, inclusive: bool) -> Column:
    """Time window, closed (a data pull) or open (training and validation splits)."""
    c, lo, hi = _col(ts), ntz_literal(start), ntz_literal(end)
    return c.between(lo, hi) if inclusive else (c > lo) & (c < hi)


def instants_of(start: date | datetime | str, end: date | datetime | str, zone: str = MOUNTAIN) -> tuple[datetime, datetime]:
    """The least range of UTC instants that holds all with a wall clock from ``start`` to ``end``.

    A wall clock that occurs twice begins the range with its first and ends it with its last
    instant. One that a clock change skips is read with the offset before and after the change,
    which lie on either side of it.
    """
    return min(_readings(start, zone)), max(_readings(end, zone))


def _readings(wall: date | datetime | str, zone: str) -> list[datetime]:
    moment = datetime.fromisoformat(str(wall))
    read = (moment.replace(tzinfo=ZoneInfo(zone), fold=fold) for fold in (0, 1))
    return [r.astimezone(timezone.utc).replace(tzinfo=None) for r in read]


def bound_instants(
    df: DataFrame, instant: str, start: date | datetime | str, end: date | datetime | str, zone: str = MOUNTAIN
) -> DataFrame:
    """Rows whose instant may show a wall clock from ``start`` to ``end``: a test on the raw column.

    A test on the converted wall clock does not reach a scan; this one does, and drops nothing
    that the exact test would keep.
    """
    low, high = instants_of(start, end, zone)
    kind = df.schema[instant].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return df
    bound = [F.lit(f"{m.isoformat(' ')}{'Z' if isinstance(kind, T.TimestampType) else ''}").cast(kind) for m in (low, high)]
    return df.filter(F.col(instant).between(*bound))


def last_moment(end: date | str, ends: str = "day") -> datetime:
    """The last wall clock that ``in_dates`` keeps."""
    last = datetime.fromisoformat(str(date.fromisoformat(str(end))))
    return last + timedelta(days=1, microseconds=-1) if ends == "day" else last
