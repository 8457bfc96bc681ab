"""A key holding a third of all rows: results stay whole, AQE splits the hot partition."""

import datetime as dt

from pyspark.sql import functions as F

from webmetrics.operators import report, rollup

T0 = dt.datetime(2024, 1, 1)


def test_hot_session_join_is_split(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        sec = spark.range(n).select(
            F.lit("k").alias("api_key"), F.lit("s").alias("site"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string"))).alias("parent"),
            (F.lit(T0) + F.make_dt_interval(secs=F.col("id") % 86400)).alias("ts"),
            F.concat(F.lit("/p"), (F.col("id") % 7).cast("string")).alias("path"))
        ses = spark.range(5000).select(
            F.lit("k").alias("api_key"), F.lit("s").alias("site"),
            F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"), F.lit("v").alias("parent"),
            F.lit("os").alias("os"), F.lit("b").alias("browser"), F.lit("c").alias("country_code"),
            F.lit("x").alias("city")).unionByName(spark.createDataFrame(
                [("k", "s", "hot", "vh", "os", "b", "c", "x")],
                "api_key string, site string, id string, parent string, os string, browser string, "
                "country_code string, city string"))
        fact = rollup.section_combined(sec, ses)
        assert len(fact.collect()) == n  # whole: nothing dropped or capped
        plan = fact._jdf.queryExecution().executedPlan().toString()  # final AQE plan of that run
        assert "skew=true" in plan and "AQEShuffleRead skewed" in plan
        r = report.by_country(fact, ["k"], ["s"]).first()
        assert (r.page_views, r.visitors) == (n, 2)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
