"""Driver contract: entry() smoke, queries() / oracle_sql() consistency."""

import __spark_entry__ as E


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.columns == ["time", "page_views", "visitors"]
    assert df.count() >= 0


def test_registry_consistency():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_works_without_the_optional_operators(tmp_path):
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/webmetrics", tmp_path / "webmetrics", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 60 and 'pipeline' not in q, len(q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_some_oracles_small(spark):
    import duckdb

    from scripts.oracle_check import TABLES, rows_of
    from tests.conftest import SF_SMALL
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    for name in ["section_combined", "report_by_country", "request_summary", "action_hierarchy",
                 "geo_ip_range", "report_timeseries_day"]:
        df = qs[name](spark, SF_SMALL)
        cur = con.execute(sql[name])
        ocols = [d[0] for d in cur.description]
        a = sorted(rows_of(df.columns, [tuple(r) for r in df.collect()]), key=repr)
        b = sorted(rows_of(ocols, cur.fetchall()), key=repr)
        assert sorted(df.columns) == sorted(ocols), name
        assert a == b, name
