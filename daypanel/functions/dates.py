"""Date parsing helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts accepted in batch upload files, tried in this order.
BATCH_DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "M/d/yy"]


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """String / timestamp -> date."""
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def parse_multi_format_date(c: Column, formats: list[str] | None = None) -> Column:
    """First format that parses wins; unparseable text gives NULL.

    Two-digit and four-digit years do not collide: 'M/d/yyyy' needs four year
    digits and 'M/d/yy' exactly two.  Two-digit years follow the POSIX pivot
    (69-99 -> 1969-1999, 00-68 -> 2000-2068) instead of the parser's 2000-2099.
    """
    formats = formats or BATCH_DATE_FORMATS
    s = F.trim(c.cast("string"))
    parsed = []
    for f in formats:
        d = F.try_to_date(s, f)
        if "yy" in f and "yyyy" not in f:
            d = F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
        parsed.append(d)
    return F.coalesce(*parsed)
