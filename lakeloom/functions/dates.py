"""Date/time parsing that never throws under ANSI mode.

Source timestamps arrive as text in several shapes (``2017-10-02``,
``2017-10-02 10:56:33``, ISO ``2017-10-02T10:56:33+00:00``) and sometimes as
junk. Everything is parsed to a real timestamp before it is compared or
ordered, so text order never decides recency.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts used when timestamps are rendered as text.
TS_TEXT = "yyyy-MM-dd HH:mm:ss"
TS_TEXT_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MONTH_TEXT = "yyyy-MM"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col) -> Column:
    """Text or timestamp -> timestamp; unparseable or blank -> NULL."""
    c = _c(col)
    return F.try_to_timestamp(F.nullif(F.trim(c.cast("string")), F.lit("")))


def parse_date(col, fmt: str | None = None) -> Column:
    """Text -> date with an optional pattern; bad text -> NULL (no exception)."""
    c = F.nullif(F.trim(_c(col).cast("string")), F.lit(""))
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def month_bucket(col) -> Column:
    return F.date_format(_c(col), MONTH_TEXT)


def ts_text(col, micros: bool = False) -> Column:
    return F.date_format(_c(col), TS_TEXT_MICROS if micros else TS_TEXT)
