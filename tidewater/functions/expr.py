"""Small column helpers shared by the operators. All JVM-side expressions."""

from __future__ import annotations

import datetime as _dt
import re
from typing import Optional

from pyspark.sql import Column
from pyspark.sql import functions as F


def audit_time(clock: Optional[_dt.datetime] = None) -> Column:
    """Audit timestamp; injected literal for reproducible runs."""
    if clock is None:
        return F.current_timestamp()
    return F.lit(clock).cast("timestamp")


def round_avg(col, scale: int = 1) -> Column:
    """P10: ROUND(AVG(x), scale), half-up, as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c), scale)


def contains_ci(col, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive regex match, NULL counts as no match.

    ``literal=True`` escapes the text so that ``u.1`` matches only ``u.1``.
    """
    c = F.col(col) if isinstance(col, str) else col
    pat = re.escape(pattern) if literal else pattern
    return F.coalesce(c.rlike("(?iu)" + pat), F.lit(False))


def to_ntz(col) -> Column:
    """Zoned timestamp -> timestamp_ntz (UTC wall clock) for oracle outputs."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")
