"""Date expressions.

Spark 4 runs with ANSI mode on, so a plain ``cast``/``to_timestamp`` of bad text throws (T4).
Text dates therefore only go through ``try_*`` parsers with the three accepted formats, and
the result is a naive ``timestamp_ntz`` that does not depend on the session time zone (T5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: accepted text formats of event dates, in the order they are tried; between
# separators one digit is enough (2015-1-5)
EVENT_DATE_FORMATS = ("yyyyMMdd", "yyyy-M-d", "yyyy-M-d H:m:s")
# FIXED VALUES: text format of a date of birth once ".0" is removed
BIRTH_DATE_FORMAT = "yyyyMMdd"
DAYS_PER_YEAR = 365


def _text_to_ts(s: Column) -> Column:
    """The three formats, each tried only on text with its separators.

    Text without ``-`` can match the first format only, text with ``-`` and without a colon the
    second, text with both the third, so the test loses nothing; it keeps well-formed data away
    from the parser's failure path (a failed ``try_`` parse costs an exception inside the JVM).
    """
    dash, colon = s.contains("-"), s.contains(":")
    ymd = F.when(~dash, F.try_to_date(s, EVENT_DATE_FORMATS[0]))
    iso = F.when(dash & ~colon, F.try_to_date(s, EVENT_DATE_FORMATS[1]))
    # The datetime pattern validates the text; the value itself comes from the zone-free
    # timestamp_ntz cast, so a DST gap of the session zone cannot move it.
    with_time = F.when(dash & colon
                       & F.try_to_timestamp(s, F.lit(EVENT_DATE_FORMATS[2])).isNotNull(),
                       s.try_cast("timestamp_ntz"))
    return F.coalesce(ymd.cast("timestamp_ntz"), iso.cast("timestamp_ntz"), with_time)


def parse_event_ts(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Lenient event-date parse to ``timestamp_ntz``; anything unparsable is null.

    * date / timestamp columns are cast (no text round trip),
    * integers go through text and ``yyyyMMdd`` (T3: ``20150101`` is a date, not an epoch),
    * text tries ``yyyyMMdd``, ``yyyy-MM-dd``, ``yyyy-MM-dd HH:mm:ss`` in that order.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.TimestampNTZType,)):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return _text_to_ts(c.cast("string"))


def parse_birth_date(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Date of birth as text, every ".0" deleted, parsed ``yyyyMMdd``; bad -> null.

    A double ``19500101.0`` would print as ``1.9500101E7`` in Spark, so floating and integral
    columns go through ``bigint`` first.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, (T.DateType,)):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        c = c.try_cast("bigint")
    text = F.replace(c.cast("string"), F.lit(".0"), F.lit(""))
    return F.try_to_date(text, BIRTH_DATE_FORMAT)


def age_in_years(index_ts: Column | str, birth: Column | str) -> Column:
    """Whole days between birth and index divided by 365 (not 365.25), as double."""
    i = F.col(index_ts) if isinstance(index_ts, str) else index_ts
    b = F.col(birth) if isinstance(birth, str) else birth
    return F.datediff(F.to_date(i), F.to_date(b)) / F.lit(float(DAYS_PER_YEAR))


def days_between(index_ts: Column | str, birth: Column | str) -> Column:
    i = F.col(index_ts) if isinstance(index_ts, str) else index_ts
    b = F.col(birth) if isinstance(birth, str) else birth
    return F.datediff(F.to_date(i), F.to_date(b))
