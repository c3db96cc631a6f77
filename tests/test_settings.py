import pytest

from lotwise.operators import health
from lotwise.plans import settings


def test_settings_of_a_session(spark):
    session = spark.newSession()
    assert settings.breaker_settings(session) == {"window_us": health.WINDOW_US, "min_samples": 10, "threshold": 0.3, "pause_us": health.PAUSE_US}
    session.conf.set("lotwise.breaker.threshold", "0.5")
    assert settings.setting(session, "breaker.threshold") == 0.5 and settings.setting(spark, "breaker.threshold") == 0.3
    with pytest.raises(KeyError):
        settings.setting(session, "no.such")
