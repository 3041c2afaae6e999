"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` (``end - start``) as ``bigint``.

    SQL ``DATE_DIFF('day', a, b)`` is ``b - a``; Spark's ``datediff`` takes
    its arguments the other way round and returns ``int``.
    """
    return F.datediff(F.col(end) if isinstance(end, str) else end,
                      F.col(start) if isinstance(start, str) else start).cast("bigint")


def month_start(d: Column | str) -> Column:
    """``DATE_TRUNC('month', d)`` for a date, as a zone-free timestamp.

    ``timestamp_ntz`` keeps midnight of the first day whatever the session
    time zone is.
    """
    c = F.col(d) if isinstance(d, str) else d
    return F.trunc(c, "month").cast("timestamp_ntz")
