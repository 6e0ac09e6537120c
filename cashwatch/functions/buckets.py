"""Start of the intraday bucket an event falls in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bucket length in seconds.
GRANULARITIES = {"hour": 3600, "30min": 1800, "minute": 60}


def bucket_start(event_ts: Column, granularity: str = "hour", timezone: str | None = None) -> Column:
    """Bucket start, aligned to local wall-clock time.

    Without `timezone` the session time zone decides. With it, the event is shifted by
    the zone's offset at that instant, cut, and shifted back. The repeated hours of a
    daylight-saving change stay apart, which a cut of the local time alone would merge.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {sorted(GRANULARITIES)}, not {granularity!r}")
    if timezone is None:
        if granularity == "30min":
            half = F.when(F.minute(event_ts) >= 30, F.expr("INTERVAL 30 MINUTES")).otherwise(
                F.expr("INTERVAL 0 MINUTES")
            )
            return F.date_trunc("hour", event_ts) + half
        return F.date_trunc(granularity, event_ts)

    length = F.lit(GRANULARITIES[granularity])
    instant = event_ts.cast("timestamp")
    seconds = F.unix_seconds(instant)
    offset = F.unix_seconds(F.from_utc_timestamp(instant, timezone)) - seconds
    return F.timestamp_seconds(F.floor((seconds + offset) / length) * length - offset)
