"""What the stored layout gives: skipped row groups (I2), bloom filter (A7), a forced join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from webmetrics.operators import rollup
from webmetrics.plans import facts
from webmetrics.sources import sinks

from .conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def rows_scanned(df):
    """Rows of the result, and rows that the scans of the executed plan gave."""
    rows = df.collect()

    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(node.plan())
        files = node.metrics().get("numFiles")
        n = node.metrics().get("numOutputRows").get().value() if files.isDefined() else 0
        return n + sum(scans(node.children().apply(i)) for i in range(node.children().size()))

    return rows, scans(df._jdf.queryExecution().executedPlan())


@pytest.fixture()
def small_row_groups(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = {"parquet.block.size": "65536", "parquet.page.size": "4096"}
    for k, v in names.items():
        conf.set(k, v)
    yield
    for k in names:
        conf.unset(k)


def test_a_parent_reads_few_row_groups(spark, tmp_path, small_row_groups):
    n = 40_000
    sec = spark.range(n).select(F.lit("k").alias("api_key"), F.lit("s").alias("site"), F.sha1(F.col("id").cast("string")).alias("id"),
                                F.lit(T0).alias("ts"), F.sha1((F.col("id") % 4000).cast("string")).alias("parent"), F.sha2(F.col("id").cast("string"), 256).alias("path"))
    path = str(tmp_path / "section_event")
    sinks.write_table(sec.repartition(7), path, "section_event", "overwrite")
    one = spark.range(1).select(F.sha1(F.lit("77"))).first()[0]
    rows, scanned = rows_scanned(spark.read.parquet(path).where(F.col("parent") == one))
    assert len(rows) == 10 and 10 <= scanned <= n // 4


def test_a_city_that_no_file_has_reads_nothing(spark, tmp_path):
    fact = spark.range(5000).select(F.lit("k").alias("api_key"), F.lit("s").alias("site"), F.lit(T0).alias("ts"), F.lit("/p").alias("path"),
                                    F.lit("os").alias("os"), F.lit("b").alias("browser"), F.lit("c").alias("country_code"),
                                    F.concat(F.lit("city"), F.col("id") % 50).alias("city"), F.col("id").cast("string").alias("visitor"))
    path = str(tmp_path / "section_combined")
    sinks.write_table(fact, path, "section_combined", "overwrite")
    rows, scanned = rows_scanned(spark.read.parquet(path).where("city = 'city25x'"))       # between the least and the largest city
    assert rows == [] and scanned == 0
    assert len(rows_scanned(spark.read.parquet(path).where("city = 'city25'"))[0]) == 100


def test_the_join_that_is_asked_for(spark):
    m = facts.driver_model(spark, SF_SMALL)
    forced = rollup.section_combined(m.section, m.session, "merge")
    assert "SortMergeJoin" in forced._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, forced.collect())) == sorted(map(tuple, rollup.section_combined(m.section, m.session).collect()))
