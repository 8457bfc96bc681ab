"""Counting fingerprints of document blocks in hash buckets.

``Blocks`` writes the documents once, packed into *blocks* of a few megabytes
of text, as a table in the shared folder. In each step a block sends its
sorted distinct fingerprints to *buckets* (ranges of the fingerprint), one
compressed row for each bucket; a bucket sorts what it got and answers every
block with one bit per fingerprint, in the order in which it was sent. A
fingerprint that a third of all documents share so arrives once per block,
and no group of equal texts meets in one task. The numbers of blocks and
buckets grow with the input; each holds a bounded amount of it. Answers are
written as a table, so a lost executor costs its own tasks only, and a step's
shuffle files can go when the step is done.
"""

from __future__ import annotations

import contextlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webmetrics.llm import words
from webmetrics.llm.frames import narrowed
from webmetrics.session import checkpoint_dir

BLOCK_BYTES = 6 << 20
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def step(spark: SparkSession):
    """An eager step whose shuffle files are not needed once it has ended."""
    old = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, old)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for eager steps, put back afterwards."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows as a table in the shared folder; cuts the lineage."""
    spark, path = df.sparkSession, scratch(df.sparkSession, what)
    with step(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that no result reads any more."""
    for df in tables:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Blocks:
    """Documents (id, text and carried columns) packed into a table of blocks."""

    def __init__(self, docs: DataFrame, ident: str, text: str, carry=(), block_bytes: int = BLOCK_BYTES):
        self.spark = docs.sparkSession
        flat = narrowed(docs, ident, text, carry)
        self.fields = {f.name: f.dataType for f in flat.schema.fields}

        def run(batches):
            from pyspark import TaskContext
            part, n, held, size = TaskContext.get().partitionId(), 0, [], 0
            for batch in batches:
                for piece in words.slices(batch, "text"):
                    held.append(piece)
                    size += piece.nbytes
                    if size >= block_bytes:
                        yield _packed(held, (part << 32) + n)
                        n, held, size = n + 1, [], 0
            if held:
                yield _packed(held, (part << 32) + n)

        self.table = written(flat.mapInArrow(run, "block long, text_bytes long, docs binary"), "blocks")
        total = self.table.select(F.sum("text_bytes")).first()[0] or 0
        self.text_bytes = int(total)
        self.n_buckets = max(1, -(-self.text_bytes // (2 * block_bytes)))

    def sent(self, what, answers: DataFrame | None = None) -> DataFrame:
        """what(block, documents, {step: {bucket: body}}) -> rows for buckets."""
        def run(batches):
            for block, docs, got in _blocks(batches):
                yield from _table(what(block, docs, got)).to_batches()

        return self._with(answers).mapInArrow(run, "bucket long, block long, body binary")

    def finished(self, what, schema: str, answers: DataFrame) -> DataFrame:
        """what(documents, {step: {bucket: body}}) -> Arrow table of result rows."""
        def run(batches):
            for _, docs, got in _blocks(batches):
                yield from what(docs, got).to_batches()

        return self._with(answers).mapInArrow(run, schema)

    def answered(self, sent: DataFrame, answer, number: int) -> DataFrame:
        """Each bucket's rows through answer(bodies) -> bit arrays, as a written table."""
        def run(t: pa.Table) -> pa.Table:
            bits = answer([unpack(b) for b in t["body"].to_pylist()])
            return pa.table({"step": pa.array([number] * t.num_rows, pa.int32()), "bucket": t["bucket"],
                             "block": t["block"], "body": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())})

        return written(sent.groupBy("bucket").applyInArrow(run, "step int, bucket long, block long, body binary"), "answers")

    def _with(self, answers: DataFrame | None) -> DataFrame:
        if answers is None:
            return self.table.select("block", "docs")
        own = answers.groupBy("block").agg(F.collect_list(F.struct("step", "bucket", "body")).alias("answers"))
        return self.table.select("block", "docs").join(own, "block", "left")


def _packed(held: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        for x in held:
            w.write_batch(x)
    size = sum(x.column("text").nbytes for x in held)
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "text_bytes": pa.array([size], pa.int64()),
                                       "docs": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            pa.default_memory_pool().release_unused()
            docs = pa.ipc.open_stream(batch.column("docs")[i].as_buffer()).read_all().combine_chunks()
            got: dict[int, dict[int, bytes]] = {}
            if "answers" in batch.schema.names:
                for a in batch.column("answers")[i].as_py() or ():
                    got.setdefault(a["step"], {})[a["bucket"]] = a["body"]
            yield batch.column("block")[i].as_py(), docs, got


def squeeze(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(b, dtype) -> np.ndarray:
    b = bytes(b)
    return np.frombuffer(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True), dtype)


def _planes(a: np.ndarray) -> np.ndarray:
    """Integers as byte planes, which compress far better."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T)


def _unplanes(raw: np.ndarray, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def pack(keys: np.ndarray, twice: np.ndarray | None = None, values: np.ndarray | None = None) -> bytes:
    """Ascending uint64 keys, with a flag or an int64 value each."""
    gaps = np.diff(keys, prepend=keys[:0].dtype.type(0)) if len(keys) else keys
    parts = [squeeze(_planes(gaps))]
    parts.append(squeeze(np.packbits(twice)) if twice is not None else b"")
    parts.append(squeeze(_planes(values)) if values is not None else b"")
    head = np.array([len(keys), *map(len, parts)], np.int64).tobytes()
    return head + b"".join(parts)


def unpack(body) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    body = bytes(body)
    n, a, b, c = np.frombuffer(body[:32], np.int64)
    keys = np.cumsum(_unplanes(expand(body[32:32 + a], np.uint8), np.uint64), dtype=np.uint64)
    twice = np.unpackbits(expand(body[32 + a:32 + a + b], np.uint8), count=n).astype(bool) if b else None
    values = _unplanes(expand(body[32 + a + b:32 + a + b + c], np.uint8), np.int64) if c else None
    return keys, twice, values


def bucket_cuts(keys: np.ndarray, n_buckets: int, top: int = 1 << 64) -> np.ndarray:
    """Where each bucket's share of the ascending keys (below top) starts and ends."""
    edges = np.array([top * k // n_buckets for k in range(1, n_buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    b, k, v = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"bucket": pa.array(b, pa.int64()), "block": pa.array(k, pa.int64()),
                     "body": pa.array(v, pa.binary())})


def repeated(bodies) -> list[np.ndarray]:
    """Which keys came from two blocks, or twice from one."""
    keys = np.concatenate([b[0] for b in bodies])
    flag = np.concatenate([b[1] for b in bodies])
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s), bool)
    eq = s[1:] == s[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    flag[order] |= same
    return np.split(flag, np.cumsum([len(b[0]) for b in bodies])[:-1])


def gathered(bits: dict[int, bytes], cuts: np.ndarray) -> np.ndarray:
    """A block's answer for all its keys, from the answers of the buckets."""
    out = np.zeros(cuts[-1], bool)
    for k in range(len(cuts) - 1):
        n = cuts[k + 1] - cuts[k]
        if n:
            out[cuts[k]:cuts[k + 1]] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=n)
    return out
