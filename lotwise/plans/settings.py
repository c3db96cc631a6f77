"""Settings of a session: spark.conf's lotwise.<name>, else the default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import health
from ..sinks import outbox
from ..sources import landing

DEFAULTS = {
    "breaker.window_us": health.WINDOW_US, "breaker.min_samples": health.MIN_SAMPLES, "breaker.threshold": health.THRESHOLD, "breaker.pause_us": health.PAUSE_US,
    "bucket.capacity": health.CAPACITY, "bucket.refill_per_s": health.REFILL_PER_S, "bucket.idle_s": health.IDLE_S,
    "backoff.base_s": health.BACKOFF_BASE_S, "backoff.max_s": health.BACKOFF_MAX_S, "backoff.sigma": health.SIGMA,
    "outbox.exchange": outbox.EXCHANGE, "outbox.routing_key": outbox.ROUTING_KEY, "parser_version": landing.PARSER_VERSION,
}


def setting(spark: SparkSession, name: str):
    """The value, of its default's type; a name without a default is an error."""
    default = DEFAULTS[name]
    return type(default)(spark.conf.get(f"lotwise.{name}", str(default)))


def settings(spark: SparkSession) -> DataFrame:
    """name, value (as text) of all settings."""
    return spark.createDataFrame([(name, str(setting(spark, name))) for name in DEFAULTS], "name string, value string")


def breaker_settings(spark: SparkSession) -> dict:
    """Arguments of breaker_openings() and its stream."""
    return {name: setting(spark, f"breaker.{name}") for name in ("window_us", "min_samples", "threshold", "pause_us")}
