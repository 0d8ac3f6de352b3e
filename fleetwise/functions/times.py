"""UTC times whatever the session's time zone.

The domain's clock is UTC.  Casts between ``timestamp`` and text or
``timestamp_ntz`` go by the session's zone; these expressions go by the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def from_utc_clock(ntz: Column) -> Column:
    """The instant at which a UTC clock shows a ``timestamp_ntz``."""
    since = ntz - F.lit(_EPOCH).cast("timestamp_ntz")  # an interval; adding it to a timestamp would add days of the session's zone
    days, hours, minutes, seconds = (F.extract(F.lit(part), since) for part in ("DAY", "HOUR", "MINUTE", "SECOND"))
    whole = ((days * 24 + hours) * 60 + minutes).cast("bigint") * 60_000_000
    return F.timestamp_micros(whole + (seconds * 1_000_000).cast("bigint"))


def utc_clock(ts: Column) -> Column:
    """What a UTC clock shows at an instant, as ``yyyy-MM-dd HH:mm:ss`` text (whole seconds, rounded down)."""
    seconds = F.unix_seconds(ts).cast("decimal(18,6)")
    zero = F.lit(0)
    return (F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)).cast("string")


def utc_day(ts: Column) -> Column:
    """Days since 1970-01-01 UTC."""
    return F.floor(F.unix_micros(ts) / F.lit(86_400_000_000))
