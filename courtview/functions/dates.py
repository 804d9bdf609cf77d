"""Date and time helpers.  The session zone is UTC (see ``courtview.session``)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: "Column | str") -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_ts(col: "Column | str") -> Column:
    """ISO-8601 text -> UTC wall-clock timestamp (``TIMESTAMP_NTZ``); bad text -> NULL.

    Offsets such as ``Z`` are honoured while parsing; the result carries no zone,
    so hours, dates and collected values do not depend on any session or client zone.
    """
    return F.try_to_timestamp(_c(col)).cast("timestamp_ntz")


def iso_text(col: "Column | str") -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ssZ`` (the payload form)."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_parts(ts: "Column | str", as_of: date) -> dict[str, Column]:
    """published_date, published_hour, published_month and age in days."""
    t = _c(ts)
    d = F.to_date(t)
    return {
        "published_date": d,
        "published_hour": F.hour(t),
        "published_month": F.trunc(d, "MM"),
        "days_since_published": F.datediff(F.lit(as_of), d),
    }


def day_trunc(col: "Column | str") -> Column:
    return F.to_date(_c(col))


def iso_bound(d: date) -> Column:
    """A date as ``yyyy-MM-ddT00:00:00Z``."""
    return F.concat(F.date_format(F.lit(d), "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def date_to_text(col: "Column | str") -> Column:
    return _c(col).cast("string")
