"""Reports and retention don't depend on the driver's time zone."""

import os
import time

import pytest
from pyspark.sql import functions as F

from webmetrics.functions.timefn import utc_lit
from webmetrics.sources import sinks


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_literals(spark, zone):
    old = os.environ.get("TZ")
    os.environ["TZ"] = zone
    time.tzset()
    try:
        got = spark.range(1).select(F.unix_micros(utc_lit("2024-01-15T06:30:00.000001")).alias("t")).first()[0]
        df = spark.sql("SELECT timestamp_seconds(1705300200) AS ts UNION ALL SELECT timestamp_seconds(1705300199)")
        assert got == 1705300200000001
        assert sinks.retained(df, "2024-01-22 06:29:59").count() == 1
    finally:
        os.environ.pop("TZ") if old is None else os.environ.__setitem__("TZ", old)
        time.tzset()
