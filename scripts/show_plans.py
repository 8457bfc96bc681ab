"""Print formatted physical plans of the key queries.

usage: python scripts/show_plans.py [sf_dir]
A report over the *stored* fact (pruning and pushdown visible in the scan),
the E1 join from raw tables, and the ingest check.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from webmetrics.operators import report
    from webmetrics.plans import catalog
    from webmetrics.plans.facts import driver_model
    from webmetrics.session import checkpoint_dir, get_spark
    from webmetrics.sources import sinks

    spark = get_spark("local[8]", shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="plans-", dir=checkpoint_dir(spark))
    sinks.write_model(driver_model(spark, sf_dir), root, mode="overwrite")
    fact = spark.read.parquet(f"{root}/section_combined")
    kw = catalog.REPORT_CASES["report_day_truncated"][1]
    print("=== G1 by_country over the stored fact (day-truncated range) ===")
    report.by_country(fact, catalog.KEYS, catalog.SITES, **kw).explain("formatted")
    print("=== E1 section_combined from raw tables ===")
    catalog.SPARK["section_combined"](spark, sf_dir).explain("formatted")
    print("=== B ingest: request summary ===")
    catalog.SPARK["request_summary"](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
