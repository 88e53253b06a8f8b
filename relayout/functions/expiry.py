"""Expiry of keyed entries (L6): an entry exists while ``expires_at`` is unset or after ``as_of``.

``as_of`` is always an explicit instant, never the wall clock, so every result is reproducible.
Timestamps are zone-less (``timestamp_ntz``), like the driver's tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Instant = str | dt.datetime


def instant(as_of: Instant) -> Column:
    text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of
    return F.lit(text).cast("timestamp_ntz")


def live(expires_at: Column, as_of: Instant) -> Column:
    """The entry still exists at ``as_of``; one expiring exactly then is gone."""
    return expires_at.isNull() | (expires_at > instant(as_of))


def expiry(as_of: Instant, ttl_seconds: int | None) -> Column:
    """``as_of`` plus the time to live; a TTL of zero or less (or None) never expires."""
    if ttl_seconds is None or ttl_seconds <= 0:
        return F.lit(None).cast("timestamp_ntz")
    return instant(as_of) + F.make_dt_interval(secs=F.lit(ttl_seconds))
