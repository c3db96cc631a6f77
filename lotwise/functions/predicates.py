"""Row predicates. All give true or false, never null, unless they say so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a new vehicle, which answers are tried again, and when batches run.
ZERO_KM = r"(?iU)^0[.,]?0*\s*km$"
RETRY_STATUS = (403, 429, 503)
MAX_RETRIES = 3
BATCH_ZONE = "America/Argentina/Buenos_Aires"
BATCH_FROM, BATCH_UNTIL = 2, 7


def strip(text: Column) -> Column:
    """Without white space at the ends, Unicode's included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_ad(flag: Column) -> Column:
    """true or 'true' in any case; a missing flag is no ad."""
    return F.lower(flag).eqNullSafe("true")


def is_zero_km(attributes: Column) -> Column:
    """Whether an attribute says that the vehicle is new; no list, no."""
    return F.coalesce(F.exists(attributes, lambda a: strip(a).rlike(ZERO_KM)), F.lit(False))


def is_success(status: Column) -> Column:
    return F.coalesce(status < 400, F.lit(False))


def is_parseable(status: Column) -> Column:
    """Only 2xx pages are parsed, though all are landed."""
    return F.coalesce(status.between(200, 299), F.lit(False))


def is_retryable(status: Column, attempt: Column) -> Column:
    return F.coalesce(status.isin(*RETRY_STATUS) & (attempt < MAX_RETRIES), F.lit(False))


def in_batch_window(ts: Column, zone: str = BATCH_ZONE, start: int = BATCH_FROM, end: int = BATCH_UNTIL) -> Column:
    """Whether the local hour of a UTC time is from start on and before end; null stays null."""
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))).between(start, end - 1)


def allowed_domain(domain: Column, *allowed: str) -> Column:
    """Whether a domain is one of those allowed or below it. A port or user info doesn't count."""
    host = F.lower(F.regexp_replace(domain, r"^.*@|:\d*$", ""))
    found = F.lit(False)
    for name in allowed:
        found = found | (host == name.lower()) | host.endswith("." + name.lower())
    return F.coalesce(found, F.lit(False))
