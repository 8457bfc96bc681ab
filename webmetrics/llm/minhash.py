"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch. A set is thrown, round after round, into ``coords`` bins, each element by a
fresh hash; a bin keeps its smallest (round, hash). From round ``coords`` on, round
coords + k sends all elements to bin k. So after 2 * coords rounds at most every bin is
full, and one or two rounds do for a set larger than coords * ln(coords). Two sets agree
in a bin with probability equal to their similarity, with the concentration of
independent minima.

Bands of ``rows`` bins are the join keys. A pair of similarity 0.75 misses all 48 bands
of four with probability (1 - 0.75^4)^48 = 1.2e-8.

Whole groups are handled without emitting their pairs:

* Documents with equal sets form one class; only its smallest id goes on.
* First, each class is compared with one other: of all classes that share a band with it,
  that with the most band mates (an original has more of them than its edited copies).
  Pairs are confirmed on the full sets; classes with one leader are connected.
* Then only bands that still hold classes with different leaders are left. Of their pairs those go
  on that can be links: with e(x) the shingles of x that any other class left has too,
  |x & y| <= min(e(x), e(y)), so a link needs 7 min(e(x), e(y)) >= 3 (|x| + |y|), which
  drops classes edited on their own for good. The others compare, inside the join, finer
  sketches of one bit in 2048 bins; 4.5 standard deviations of slack lose a pair of
  similarity 0.75 with probability 3e-6. A pair is emitted once, for its first shared
  band, and confirmed on the full sets.

Every other pair is already connected or no link.

Full sets are read again for the ids in question only.

Defined results: a null or wordless text has no shingles, is a component of its own and
kept; with fewer words than a shingle the whole sequence is the one shingle; each row is
a document of its own: where ids are null or repeat, the rows are written with numbers and
compared by those; a component is reported by its smallest id, null before all others, and
keeps one row of it; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webmetrics.llm.blocks import discard, setting, written
from webmetrics.llm.components import components
from webmetrics.llm.frames import mapped, narrowed
from webmetrics.llm.words import SPACES, Texts, Words, mix

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
NONE = np.iinfo(np.int64).min + 1     # has a negative
FINE = 2048
KEY = "~row"


def shingles(t: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of all texts, ascending in each, with offsets."""
    w = Words(t, SPACES, lower=True)
    n = np.diff(w.offsets)
    s = w.window_starts(k)
    h, doc = [w.windows(s, k)], [w.doc[s]]
    for size in range(1, k):
        d = np.flatnonzero(n == size)
        h.append(w.windows(w.offsets[d], size))
        doc.append(d)
    h, doc = np.concatenate(h), np.concatenate(doc)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(t) + 1))


def sketches(h: np.ndarray, offsets: np.ndarray, coords: int) -> np.ndarray:
    """Fast similarity sketches of the sets: (texts, coords); empty sets stay unfilled."""
    n = len(offsets) - 1
    out = np.full(n * coords, _FULL, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    for r in range(2 * coords):
        if not len(h):
            break
        x = mix(h ^ np.uint64((r + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        if r < coords:
            slot = ((x >> np.uint64(32)) * np.uint64(coords) >> np.uint64(32)).astype(np.int64)
        else:
            slot = np.full(len(h), r - coords)
        np.minimum.at(out, doc * coords + slot, (np.uint64(r) << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF)))
        todo = (out.reshape(n, coords) == _FULL).any(axis=1)[doc]
        h, doc = h[todo], doc[todo]
    return out.reshape(n, coords)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands) join keys; a band's number is part of its key."""
    n, coords = sketch.shape
    part = sketch.reshape(n, coords // rows, rows)
    key = np.broadcast_to(np.arange(1, coords // rows + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03), part.shape[:2])
    for j in range(rows):
        key = mix(key ^ part[:, :, j]) + np.uint64(j)
    return key


def signed(docs: DataFrame, ident: str, text: str, k: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, s1, s2, bands): size, 128-bit set fingerprint, band keys."""
    def run(batch):
        h, off = shingles(Texts(batch.column("text")), k)
        keys = band_keys(sketches(h, off, bands * rows), rows).view(np.int64)
        size = np.diff(off)
        total = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(c)), dtype=np.uint64)]) for c in (0x51ED2701, 0xABCD0132)]
        s1, s2 = [(c[off[1:]] - c[off[:-1]]).view(np.int64) for c in total]
        flat = pa.array(keys.ravel(), pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * keys.shape[1], pa.int32()), flat)
        return {"n_shingles": pa.array(size, pa.int64()), "s1": pa.array(s1), "s2": pa.array(s2), "bands": lists}

    flat = narrowed(docs, ident, text)
    flat = flat.withColumn("id", F.coalesce(F.col("id").cast("long"), F.lit(int(NONE))))
    return mapped(flat, run, "n_shingles long, s1 long, s2 long, bands array<long>", "id")


def sets(docs: DataFrame, ids: DataFrame, ident: str, text: str, k: int) -> DataFrame:
    """(id, n, body): full sets of the wanted ids (distinct column ``id``)."""
    def run(batch):
        h, off = shingles(Texts(batch.column("text")), k)
        return {"n": pa.array(np.diff(off), pa.int64()),
                "body": pa.array([h[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)], pa.binary())}

    return mapped(_of(docs, ids, ident, text), run, "n long, body binary", "id")


def confirmed(pairs: DataFrame, docs: DataFrame, ident: str, text: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids with 100 * |A & B| >= percent * |A | B|, on the full sets."""
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    full = written(one_each(sets(docs, ids, ident, text, k), ("n", "body")), "sets")
    b = full.select(F.col("id").alias("b"), F.col("body").alias("y"))
    a = full.select(F.col("id").alias("a"), F.col("body").alias("x"))

    def run(batches):
        for t in batches:
            ok = []
            for x, y in zip(t.column("x"), t.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_pydict({"a": t.column("a"), "b": t.column("b")}).filter(pa.array(ok, pa.bool_()))

    links = written(pairs.join(b, "b").join(a, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")
    discard(pairs, full)
    return links


def one_each(rows: DataFrame, order) -> DataFrame:
    """One row per id; more than one only where ids repeat."""
    from pyspark.sql import Window
    w = Window.partitionBy("id").orderBy(*order)
    return rows.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", k: int = 5, percent: int = 75,
                    bands: int = 48, rows: int = 4) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept. Worked out when called."""
    rows_of = keyed(docs.select(F.col(f"`{ident}`"), F.col(f"`{text}`")), ident)
    if rows_of is None:
        return _quietly(docs, ident, text, k, percent, bands, rows)
    found = by_row(rows_of, ident, text, k, percent, bands, rows)
    out = written(found.drop(KEY), "components")
    discard(rows_of)
    return out


def keyed(docs: DataFrame, ident: str) -> DataFrame | None:
    """The documents with a number for each row, written, if the ids don't tell them apart."""
    ids = docs.select(F.col(f"`{ident}`").try_cast("long").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 or i is null").isEmpty():
        return None
    return written(docs.withColumn(KEY, F.monotonically_increasing_id()), "rows")


def by_row(rows_of: DataFrame, ident: str, text: str, k: int = 5, percent: int = 75, bands: int = 48, rows: int = 4) -> DataFrame:
    """Of numbered rows: the number, id, n_shingles, component_id, kept."""
    found = _quietly(rows_of, KEY, text, k, percent, bands, rows).select(KEY, "n_shingles", F.col("component_id").alias("c"))
    i = F.col(f"`{ident}`")
    i = i.cast("long") if rows_of.schema[ident].dataType.typeName() in ("byte", "short", "integer") else i
    named = found.join(rows_of.select(KEY, F.col(f"`{ident}`"), i.alias("i")), KEY)
    first = named.groupBy("c").agg(F.min(F.struct(F.col("i").isNotNull(), "i", F.col(KEY))).alias("f")).select("c", F.col("f.i").alias("component_id"), F.col(f"f.`{KEY}`").alias("r"))
    return named.join(first, "c").select(KEY, F.col(f"`{ident}`"), "n_shingles", "component_id", (F.col(KEY) == F.col("r")).alias("kept"))


def _quietly(docs: DataFrame, *how) -> DataFrame:
    # many joins follow each other: what is broadcast stays small for the driver's sake
    with setting(docs.sparkSession, "spark.sql.adaptive.autoBroadcastJoinThreshold", "8MB"):
        return _near_duplicates(docs, *how)


def _near_duplicates(docs: DataFrame, ident: str, text: str, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    every = written(signed(docs, ident, text, k, bands, rows), "signed")
    narrow = every.select("id", "n_shingles", "s1", "s2")
    unique = narrow.groupBy("id").agg(F.min(F.struct("n_shingles", "s1", "s2")).alias("s")).select("id", "s.*")
    classes = unique.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min("id").alias("rep"))
    reps = classes.select(F.col("rep").alias("id"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    keyed = (every.join(reps, "id").where("s1 = t1 and s2 = t2")
             .select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")))
    keyed = written(_shared(keyed), "bands")
    star = _leaders(keyed)
    links = confirmed(star, docs, ident, text, k, percent)
    # a class's leader, or its leader's: leaders have more mates than those they lead
    lead = links.select(F.col("b").alias("id"), "a").join(links.select(F.col("b").alias("a"), F.col("a").alias("aa")), "a", "left")
    lead = lead.select("id", F.coalesce("aa", "a").alias("lead"))

    left = keyed.join(lead, "id", "left").select("key", "id", "n", F.coalesce("lead", "id").alias("lead"))
    left = mixed = written(_mixed(left), "left")
    fine = written(one_each(_fine(docs, left.select("id").distinct(), ident, text, k), ("n", "bits")), "fine")
    lone = (fine.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("c"))
            .where("c = 1").groupBy("id").agg(F.count(F.lit(1)).alias("lone")))
    able = fine.select("id", "bits", "n").join(lone, "id", "left").select("id", "bits", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("e"))
    bands_of = every.select("id", "bands").join(reps.select("id"), "id", "left_semi")
    able = written(one_each(able.join(bands_of, "id"), ("bands",)), "able")
    left = mixed.join(able, "id").where(f"100 * e >= {percent} * n")
    x, y = left.alias("x"), left.alias("y")
    # |x & y| >= percent (|x| + |y|) / (100 + percent) for links
    enough = f"{100 + percent} * least(x.e, y.e) >= {percent} * (x.n + y.n)"
    same = "aggregate(zip_with(x.bits, y.bits, (a, b) -> bit_count(a ^ b)), 0, (s, c) -> s + c)"
    once = "x.key = element_at(array_intersect(x.bands, y.bands), 1)"
    rest = x.join(y, F.expr(f"x.key = y.key and x.lead < y.lead and {enough} and {same} <= {_differ(percent)} and {once}"))
    more = confirmed(rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), docs, ident, text, k, percent)
    discard(fine, able, mixed, keyed)
    comp = components(links.unionByName(more))

    member = unique.join(classes.select("s1", "s2", "n_shingles", "rep"), ["s1", "s2", "n_shingles"], "left")
    member = member.select("id", "n_shingles", F.coalesce("rep", "id").alias("rep"))
    out = member.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
    out = out.select("id", "n_shingles", F.coalesce("component", "rep").alias("component"))
    ids = every.select("id")
    out = ids.join(out, "id")
    back = lambda c: F.when(F.col(c) != F.lit(int(NONE)), F.col(c))
    out = written(out.select(back("id").alias(ident), "n_shingles", back("component").alias("component_id"),
                             (F.col("id") == F.col("component")).alias("kept")), "components")
    discard(every, links, more)
    return out


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows of keys that two ids or more share."""
    keys = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    return keyed.join(keys, "key", "left_semi")


def _leaders(keyed: DataFrame) -> DataFrame:
    """(a, b): each id b with the id a that, of its band mates, has the most band mates."""
    size = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    mates = keyed.select("key", "id").join(size, "key").groupBy("id").agg(F.sum("c").alias("mates"))
    lead = F.max(F.struct("mates", (-F.col("id")).alias("o"))).alias("lead")
    rows = keyed.select("key", "id").join(mates, "id")
    best = rows.join(rows.groupBy("key").agg(lead), "key").groupBy("id").agg(F.max("lead").alias("lead"))
    return best.select((-F.col("lead.o")).alias("a"), F.col("id").alias("b")).where("a <> b")


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of keys whose classes have different leaders."""
    keys = rows.groupBy("key").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi")).where("lo < hi").select("key")
    return rows.join(keys, "key", "left_semi")


def _fine(docs: DataFrame, ids: DataFrame, ident: str, text: str, k: int) -> DataFrame:
    """(id, n, shingles, bits): full sets and one-bit sketches of the wanted ids."""
    def run(batch):
        h, off = shingles(Texts(batch.column("text")), k)
        bits = np.packbits((mix(sketches(h, off, FINE)) & np.uint64(1)).astype(bool), axis=1).view(np.int64)
        lists = lambda o, v: pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int64()))
        return {"n": pa.array(np.diff(off), pa.int64()), "shingles": lists(off, h.view(np.int64)),
                "bits": lists(np.arange(len(off)) * bits.shape[1], bits.ravel())}

    return mapped(_of(docs, ids, ident, text), run, "n long, shingles array<long>, bits array<long>", "id")


def _differ(percent: int) -> int:
    """Bits that a link's fine sketches differ in at most (4.5 standard deviations)."""
    p = (1 - percent / 100) / 2
    return int(FINE * p + 4.5 * (FINE * p * (1 - p)) ** 0.5)


def _of(docs: DataFrame, ids: DataFrame, ident: str, text: str) -> DataFrame:
    """id and text of the wanted ids; a null id is NONE."""
    flat = narrowed(docs, ident, text)
    return flat.withColumn("id", F.coalesce(F.col("id").cast("long"), F.lit(int(NONE)))).join(ids, "id", "left_semi")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: near duplicates of ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
