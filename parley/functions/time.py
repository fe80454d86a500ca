"""Run timestamps.

Audit columns (processing, ingestion, enrichment time) are UTC wall-clock
values stored as TIMESTAMP_NTZ, so they read the same in every session
time zone.  A run passes its own timestamp in; re-running with the same
value reproduces the same rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_timestamp(ts: datetime | str | Column | None = None) -> Column:
    """``ts`` as a TIMESTAMP_NTZ literal; ``None`` means now (UTC)."""
    if isinstance(ts, Column):
        return ts
    if ts is None:
        ts = datetime.now(tz=timezone.utc).replace(tzinfo=None)
    if isinstance(ts, datetime):
        if ts.tzinfo is not None:
            ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
        ts = ts.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(ts))
