"""Corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept.
All but the last return the columns of ``documents``: stages that cut text also set
n_chars. Null or empty texts fail the quality rules; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics.llm import decontaminate, minhash, mixing, quality, window_dedup
from webmetrics.llm.blocks import scratch, step
from webmetrics.session import configure

ID, TEXT, CHARS = "doc_id", "text", "n_chars"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    configure(spark)
    inner, names = _renamed(docs, ID)
    judged = quality.judged(inner, ID, names[TEXT], names["lang"], carry=list(names.values()))
    return _restored(docs, judged.where("kept"), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id."""
    configure(spark)
    rows = minhash.keyed(docs, ID)
    if rows is not None:
        stay = minhash.by_row(rows, ID, TEXT).where("kept").select(minhash.KEY)
        return rows.join(stay, minhash.KEY, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    stay = minhash.near_duplicates(docs, ID, TEXT).where("kept").select(F.col(ID).alias("~id"))
    return docs.join(stay, F.col(ID) == F.col("~id"), "left_semi")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that an earlier document has go; a document left without words goes."""
    configure(spark)
    inner, names = _renamed(docs, ID, CHARS)
    text = names.pop(TEXT)
    cut = window_dedup.remove_repeats(inner, ID, text, carry=list(names.values()))
    return _restored(docs, cut.where("n_removed < n_words or n_words = 0"), names, "kept_text")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in benchmark passages go; documents that mostly consist of them go whole."""
    configure(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    inner, names = _renamed(docs, ID, CHARS)
    text = names.pop(TEXT)
    clean = decontaminate.decontaminate(inner, benchmark, ID, text, carry=list(names.values()))
    return _restored(docs, clean.where("kept"), names, "clean_text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix: _slot, _place, and _epoch of each."""
    configure(spark)
    return mixing.mixed(docs, ident=ID, max_epochs=None)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("mix", mix),
]

#: SQL can't express the divergence of the quality stage; tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        out = stage(spark, docs, sf_dir)
        with step(spark):
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs


def _renamed(docs: DataFrame, *but: str) -> tuple[DataFrame, dict[str, str]]:
    """The id and, under names that can't clash with an operator's, the other columns."""
    names = {c: f"~{i}" for i, c in enumerate(docs.columns) if c not in but}
    return docs.select(ID, *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _restored(docs: DataFrame, rows: DataFrame, names: dict[str, str], text: str | None = None) -> DataFrame:
    """The columns of docs again; with a new text, n_chars is its length."""
    cols = {c: F.col(f"`{n}`") for c, n in names.items()} | {ID: F.col(ID)}
    if text:
        cols |= {TEXT: F.col(text), CHARS: F.length(text).cast(docs.schema[CHARS].dataType)}
    return rows.select(*[cols[c].alias(c) for c in docs.columns])
