"""Small column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_as_utc(c: str | Column) -> Column:
    """A TIMESTAMP_NTZ wall-clock value read as UTC, as a TIMESTAMP instant.
    Independent of the session time zone (a plain cast is not)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, col(c)))


def epoch_ms(c: str | Column) -> Column:
    """Epoch milliseconds (floor) of a TIMESTAMP column."""
    return F.floor(F.unix_micros(col(c)) / F.lit(1000)).cast("long")


def ms_to_ts(c: str | Column) -> Column:
    return F.timestamp_millis(col(c).cast("long"))


def text_bytes(c: str | Column) -> Column:
    """UTF-8 bytes of a string column."""
    return F.encode(col(c), "UTF-8")


def bytes_text(c: str | Column) -> Column:
    """Decode UTF-8 bytes back to a string."""
    return F.decode(col(c), "UTF-8")
