"""Tables by joining id: batches equal one join, no exchange under E1 and E3, hot parents, other sessions."""

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.operators import rollup
from webmetrics.sources import colocated, sinks

from . import test_incremental
from .test_incremental import COLS, DAY, T0, at, files_read, model, rows, uid

CHAIN = S.HIERARCHY_EVENT.names


@pytest.fixture(autouse=True)
def short_days(monkeypatch):
    """The model's forty days within two, so fewer folders are written."""
    monkeypatch.setattr(test_incremental, "DAY", DAY // 24)


def frames(spark, data):
    """Typed tables with the columns that the short literals leave out."""
    out = []
    for name, schema in (("visitor_event", S.VISITOR_EVENT), ("session_event", S.SESSION_EVENT), ("section_event", S.SECTION_EVENT)):
        df = spark.createDataFrame(data[name], COLS[name])
        out.append(df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
    return SimpleNamespace(visitor=out[0], session=out[1], section=out[2])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batches_with_hot_parents_equal_one_join(spark, tmp_path):
    r = random.Random(2)
    data = dict(zip(COLS, model(2), strict=True))
    parts = [{n: [] for n in COLS} for _ in range(2)]
    for name, rs in data.items():
        for x in rs:
            parts[r.randrange(2)][name].append(x)
    store = colocated.open_store(spark, str(tmp_path / "t"), 2)
    for b in (0, 1, 0):      # the first batch once more
        colocated.write_model(frames(spark, parts[b]), store, b, hot_rows=3)
    whole = frames(spark, data)
    fact = rows(rollup.section_combined(whole.section, whole.session), rollup.FACT_COLS)
    chain = rows(rollup.hierarchy(whole.section, whole.session, whole.visitor), CHAIN)
    assert len(fact) > 100 and len(chain) > 50
    read = lambda n: sinks.read_table(spark, f"{store.root}/{n}", n, ("batch",))
    assert rows(read("section_combined"), rollup.FACT_COLS) == fact
    assert rows(read("hierarchy_event"), CHAIN) == chain
    assert rows(colocated.section_combined(store), rollup.FACT_COLS) == fact
    assert rows(colocated.hierarchy(store), CHAIN) == chain
    want = rollup.merge_timeseries(rollup.visitor_timeseries(whole.visitor))
    assert rows(rollup.merge_timeseries(read("visitor_timeseries")), want.columns) == rows(want, want.columns)
    assert spark.read.parquet(store.path("section_event_hot")).count() > 0


def test_no_exchange_and_a_store_opens_again_with_its_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    data = dict(zip(COLS, model(3), strict=True))
    store = colocated.open_store(spark, root, 2)
    colocated.write_typed(frames(spark, data), store, 0)
    for df in (colocated.section_combined(store), colocated.hierarchy(store),
               colocated.section_combined(store, 0), colocated.hierarchy(store, 0), colocated.known(store, 0)):
        assert "SortMergeJoin" in plan(df) and "Exchange" not in plan(df)
    want = rows(colocated.hierarchy(store), CHAIN)
    for table in colocated.TABLES:
        spark.sql(f"DROP TABLE {store.name(table)}")      # the entries of the catalog, not the files
    again = colocated.open_store(spark, root)
    assert again.buckets == 2 and rows(colocated.hierarchy(again), CHAIN) == want and len(want) > 50
    with pytest.raises(ValueError, match="2 buckets"):
        colocated.open_store(spark, root, 8)
    with pytest.raises(ValueError, match="no store"):
        colocated.open_store(spark, str(tmp_path / "none"))


def test_empty_batch(spark, tmp_path):
    store = colocated.open_store(spark, str(tmp_path / "t"), 2)
    colocated.write_model(frames(spark, {n: [] for n in COLS}), store, 0)
    assert colocated.section_combined(store).isEmpty() and colocated.hierarchy(store).isEmpty()


def test_a_batch_reads_only_the_days_it_names(spark, tmp_path):
    found = []
    for days in (3, 9):
        store = colocated.open_store(spark, str(tmp_path / str(days)), 2)
        v = uid(T0, 1)
        day = lambda d: (uid(T0 + d * DAY, 100 + d), at(T0 + d * DAY))
        past = {"visitor_event": [("k", "s", v, at(T0))],
                "session_event": [("k", "s", *day(d), v, "os", "br", "cc", "city") for d in range(days)],
                "section_event": [("k", "s", uid(T0 + d * DAY, 500 + d), day(d)[1], day(d)[0], "/old") for d in range(days)]}
        colocated.write_typed(frames(spark, past), store, 0)
        last = days - 1
        new = {"visitor_event": [], "session_event": [],
               "section_event": [("k", "s", uid(T0 + last * DAY, 900), day(last)[1], day(last)[0], "/new")]}
        colocated.write_typed(frames(spark, new), store, 1)
        got, n = files_read(colocated.section_combined(store, 1))
        found.append((sorted(x["path"] for x in got), n))
    assert found[0] == found[1] == (["/new"], found[0][1]) and 0 < found[0][1] <= 4, found
