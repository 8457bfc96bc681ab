"""The pipeline: stage by stage against brute force, edge cases, registration."""

import re

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm.fixtures import SEP, frame
from tests.llm.test_maps import brute_leaks
from tests.llm.test_minhash import brute
from tests.llm.test_substrings import brute_windows
from webmetrics.llm import registry


def test_stages_on_the_small_table(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "benchmark_leaks", "mix"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, held = docs.columns, {}
    for name, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL).cache()
        held[name] = docs.collect()
        if name != "mix":
            assert docs.columns == cols
    before = [(r["doc_id"], r["text"]) for r in held["quality_rules"]]
    assert 100 < len(before) < 200
    assert sorted(r["doc_id"] for r in held["near_duplicates"]) == [x[0] for x in brute(before) if x[3]]
    rows = [(r["doc_id"], r["text"]) for r in held["near_duplicates"]]
    cut = {x[0]: x for x in brute_windows(rows, 13)}
    after = {r["doc_id"]: r for r in held["repeated_passages"]}
    assert set(after) == {i for i, x in cut.items() if x[2] < x[1] or not x[1]}
    for i, r in after.items():
        assert len(SEP.findall(r["text"])) == cut[i][1] - cut[i][2] and r["n_chars"] == len(r["text"])
    rows = [(r["doc_id"], r["text"]) for r in held["repeated_passages"]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {x[0]: x for x in brute_leaks(rows, items)}
    clean = {r["doc_id"]: r["text"] for r in held["benchmark_leaks"]}
    assert set(clean) == {i for i, x in hit.items() if 2 * x[2] <= x[1]}
    assert all(clean[i] == t for i, t in rows if i in clean and not hit[i][2])
    taken = {r["doc_id"]: r for r in held["mix"]}
    assert set(taken) == set(clean) and all(r["text"] == clean[i] for i, r in taken.items())


def test_run_with_odd_rows(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(1, long), (2, long), (3, None), (4, ""), (None, long + " and more"), (7, " ".join(f"other{i}" for i in range(60))),
            (7, " ".join(f"other{i}" for i in range(60)))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "unrelated words")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = P.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {None, 7}
    frame(spark, []).limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none/benchmark.parquet"))
    assert P.run(spark, str(tmp_path / "none")).count() == 0


def test_registry():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in registry.SPARK) == list(range(1, 14))
    assert set(registry.SQL) <= set(registry.SPARK)
