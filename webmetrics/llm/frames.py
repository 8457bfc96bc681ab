"""Narrow inputs for map tasks: fixed internal names, so columns can't clash."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch on its way to a task's Python, which holds it whole.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once per application, and bounds its batches."""
    spark.conf.set(*BATCH)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="webmetrics-py-"), "webmetrics.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def inner(carry, text: str) -> list[str]:
    """Internal names of the carried columns; the text itself is not carried twice."""
    return ["text" if c == text else f"c{i}" for i, c in enumerate(carry)]


def narrowed(docs: DataFrame, ident: str, text: str, carry=(), **more) -> DataFrame:
    """id, text, the carried columns and further columns given by name."""
    ship(docs.sparkSession)
    cols = [F.col(f"`{ident}`").alias("id"), F.col(f"`{text}`").alias("text")]
    cols += [F.col(f"`{c}`").alias(n) for c, n in zip(carry, inner(carry, text), strict=True) if n != "text"]
    return docs.select(*cols, *[e.alias(n) for n, e in more.items()])


def mapped(flat: DataFrame, fn, extra: str, ident: str, carry=(), text: str = "text") -> DataFrame:
    """mapInArrow over slices of bounded text: fn(record batch) -> {column: array};
    the id and the carried columns come back under their own names."""
    names = ["id", *inner(carry, text)]
    new = [x.split()[0] for x in extra.split(", ")]
    kinds = [f"{n} {flat.schema[n].dataType.simpleString()}" for n in names]

    def run(batches):
        import pyarrow as pa

        from webmetrics.llm.words import slices
        for batch in batches:
            for piece in slices(batch, "text"):
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_pydict({n: piece.column(n) for n in names} | fn(piece))

    out = flat.mapInArrow(run, ", ".join([*kinds, extra]))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, [ident, *carry], strict=True)], *new)
