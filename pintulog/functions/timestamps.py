"""Wall-clock time handling: zones are dropped, never converted."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(text: str | Column) -> Column:
    """Timestamp as written, zone ignored, cut to microseconds; null when unreadable."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("timestamp_ntz")


def date_part(text: str | Column) -> Column:
    """The text before the first space of a trimmed timestamp text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substring_index(F.btrim(text), " ", 1)


def second_text(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``. date_format and date_trunc would take a zone-less time
    through the session zone, where some wall-clock times do not exist."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.substring(ts.cast("string"), 1, 19)
