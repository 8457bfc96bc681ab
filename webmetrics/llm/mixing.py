"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Each source's documents are numbered and cut into blocks. Weights are whole shares of a
period of slots, one block a slot. The k-th block of a source with weight
w is released at floor(k / w) and due at ceil((k + 1) / w); in every slot the released
block with the earliest deadline runs (ties: smaller source number). Earliest deadline
first meets all deadlines, so after t slots each source has had w * t blocks, give or take
less than one. At the end of a period all deviations are zero, so the pattern of one
period is computed once, by a fold, and repeats.

The period follows the weights: whole numbers and decimals (up to six places) whose sum in
units of the last place is at most ``MAX_PERIOD`` are taken as they are, the sum being the
period. Others, as the default weights, are rounded by largest remainder to shares of
``PERIOD`` slots, or of twice as many slots as there are sources if those are more; then
the shares are the target, less than a slot in a period off the weight.

A source that has too few blocks for its share starts again from its first (epoch 1, 2,
...). A caller may bound the mix: with ``max_epochs`` it has as many slots as there are
blocks (of a source that has too many, the last stay out) and ends before the slot in which
a source would need another pass. With None, as the query and the pipeline have it, it ends
with the slot in which the source furthest behind has given its last block: each document
of a source with a weight comes at least once, the others repeat as their shares ask.

Numbering within a source is done in salted parts: counts of (source, part), their
running sums, and a row number within each part, so that a source with a third of all
rows is numbered by many tasks. The pattern and tables with a row per source, at most a period
long, are broadcast where they are proven small, and else joined.

Defined results: a null source is a source of its own; a source without weight takes no
part; a weight without documents is left out and the others fill the period; weights
must be positive; equal rows are different documents; texts are not looked at; an empty
table or no weights give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webmetrics.llm.blocks import written
from webmetrics.plans.strategy import checked_broadcast

BLOCK_DOCS = 16
PERIOD, MAX_PERIOD = 1000, 16384
PART_ROWS = 4096
ADDED = ("_slot", "_place", "_epoch")     # replace columns of these names


def weights_by_size(docs: DataFrame, source: str = "source", power: float = 0.7) -> DataFrame:
    """(key, weight): target weights in proportion to the documents^power of each source."""
    n = docs.groupBy(_key(source).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("key", F.pow("n", F.lit(power)).alias("weight"))


def _key(source: str):
    """A source's name; null is told apart from every text."""
    c = F.col(f"`{source}`").cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), c))


def period_for(sources: DataFrame) -> int:
    """The period of (key, blocks, weight): the sum of weights that are whole, or decimals."""
    per = [10 ** k for k in range(7)]
    off = [F.max(F.abs(F.col("weight") * p - F.round(F.col("weight") * p)) / (F.col("weight") * p)) for p in per]
    total = [F.sum(F.round(F.col("weight") * p)).cast("double") for p in per]
    n, *found = sources.agg(F.count(F.lit(1)), *off, *total).first()
    for e, t in zip(found[:len(per)], found[len(per):], strict=True):
        if n and e < 1e-12 and n <= t <= min(MAX_PERIOD, 20_000_000 // n):
            return int(t)
    return max(PERIOD, 2 * n)


def shares(sources: DataFrame, period: int = PERIOD) -> DataFrame:
    """(key, blocks, weight) -> (key, blocks, number, share): whole slots of the period by
    largest remainder, one at least. A row per source, so one task holds them."""
    every = Window.partitionBy()
    s = sources.withColumn("x", F.col("weight") / F.sum("weight").over(every) * F.lit(period))
    s = s.withColumn("share", F.greatest(F.floor("x"), F.lit(1)).cast("long"))
    s = s.withColumn("left", F.lit(period) - F.sum("share").over(every))
    nth = F.row_number().over(Window.partitionBy().orderBy((F.col("share") - F.col("x")).asc(), "key"))
    more = F.when(nth <= F.col("left"), 1).otherwise(0)
    # shares raised to one may fill more than the period: the largest give way
    largest = Window.partitionBy().orderBy(F.col("share").desc(), "key").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.col("share") - 1).over(largest), F.lit(0))
    less = F.greatest(F.lit(0), F.least(F.col("share") - 1, -F.col("left") - taken))
    s = s.withColumn("more", more).withColumn("less", less)
    s = s.withColumn("share", (F.col("share") + F.col("more") - F.col("less")).cast("long"))
    return s.withColumn("number", F.row_number().over(Window.partitionBy().orderBy("key"))).select("key", "blocks", "number", "share")


def pattern(sources: DataFrame, period: int = PERIOD) -> DataFrame:
    """(number, nth, slot): earliest deadline first over one period, as a fold over its slots.

    The fold's state is the blocks each source has run and the list of what ran. In slot t
    the released blocks (k * period div share <= t) of sources with blocks left in the
    period are ordered by (deadline, source)."""
    one = sources.agg(F.sort_array(F.collect_list(F.struct("number", "share"))).alias("s")).where(F.size("s") > 0)
    first = f"""array_min(transform(
        filter(transform(s, (x, i) -> named_struct('i', i, 'share', x.share, 'k', a.k[i])),
               y -> y.k < y.share and (y.k * {period}L) div y.share <= t),
        y -> named_struct('due', ((y.k + 1L) * {period}L + y.share - 1L) div y.share, 'i', y.i))).i"""
    after = f"""transform(array({first}), p -> named_struct(
        'k', transform(a.k, (c, i) -> if(i = p, c + 1L, c)),
        'run', concat(a.run, array(named_struct('i', p, 'nth', a.k[p], 't', t)))))[0]"""
    start = "named_struct('k', transform(s, x -> 0L), 'run', cast(array() as array<struct<i:int,nth:bigint,t:int>>))"
    run = one.select("s", F.expr(f"aggregate(sequence(0, {period - 1}), {start}, (a, t) -> {after}).run").alias("run"))
    flat = run.select("s", F.explode("run").alias("r"))
    return flat.select(F.expr("s[r.i].number").alias("number"), F.col("r.nth").alias("nth"), F.col("r.t").cast("long").alias("slot"))


def mixed(docs: DataFrame, weights: DataFrame | dict | None = None, ident: str = "doc_id", source: str = "source",
          block_docs: int = BLOCK_DOCS, period: int | None = None, max_epochs: int | None = 4) -> DataFrame:
    """All columns of the documents that the mix takes, a row per time taken, with _slot,
    _place (in the block) and _epoch."""
    spark = docs.sparkSession
    given = weights is not None
    if weights is None:
        weights = weights_by_size(docs, source)
    elif isinstance(weights, dict):
        weights = spark.createDataFrame([("n" if k is None else f"s{k}", float(v)) for k, v in weights.items()], "key string, weight double")
    n_docs = docs.agg(F.count(F.lit(1))).first()[0]
    parts = max(1, -(-n_docs // PART_ROWS))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED]).alias("row")
    d = docs.select(row, _key(source).alias("key"), F.md5(F.col(f"`{ident}`").cast("string").cast("binary")).alias("h"), F.col(f"`{ident}`").alias("i"))
    d = d.withColumn("part", F.coalesce(F.pmod(F.conv(F.substring("h", 1, 8), 16, 10).cast("long"), F.lit(parts)), F.lit(0)))
    counts = d.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    known = counts.groupBy("key").agg(F.sum("n").alias("docs")).join(weights.where("weight > 0"), "key")
    known = known.select("key", F.ceil(F.col("docs") / F.lit(block_docs)).cast("long").alias("blocks"), "weight")
    known = written(known, "sources")
    if period is None:
        period = period_for(known) if given else max(PERIOD, 2 * known.count())
    elif (n := known.count()) > period:
        raise ValueError(f"{n} sources need a period of as many slots at least; it is {period}")
    src = written(shares(known, period), "shares")
    slots = written(pattern(src, period), "pattern")

    # a bounded mix ends before the slot of the first block that a source can't give,
    # a whole one after the slot of the last block that has not been given yet
    every = Window.partitionBy()
    k = F.col("blocks") - 1 if max_epochs is None else F.col("blocks") * max_epochs
    at = src.withColumn("k", k).withColumn("nth", F.expr("k % share")).join(slots, ["number", "nth"])
    at = at.withColumn("end", F.expr(f"(k div share) * {period} + slot"))
    n_slots = F.max("end").over(every) + 1 if max_epochs is None else F.least(F.sum("blocks").over(every), F.min("end").over(every))
    src = at.select("key", "blocks", "number", "share", n_slots.alias("slots"))

    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("key", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    d = d.withColumn("in", F.row_number().over(Window.partitionBy("key", "part").orderBy("h", "i", F.xxhash64("row"))))
    d = d.join(before, ["key", "part"]).withColumn("rank", F.col("before") + F.col("in") - 1)
    d = d.join(checked_broadcast(src), "key")
    d = d.withColumn("block", F.expr(f"rank div {block_docs}")).withColumn("place", F.expr(f"rank % {block_docs}"))
    # times that the block runs in full periods that cover the mix; cut to its slots below
    times = F.expr(f"((slots div {period} + 1) * share + blocks - 1) div blocks")
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    d = d.withColumn("k", F.expr("epoch * blocks + block")).withColumn("nth", F.expr("k % share"))
    d = d.join(checked_broadcast(slots), ["number", "nth"])
    d = d.withColumn("at", F.expr(f"(k div share) * {period} + slot")).where("at < slots")
    return d.select("row.*", F.col("at").alias("_slot"), F.col("place").alias("_place"), F.col("epoch").alias("_epoch"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: sources of ``documents`` mixed to weights in proportion to size^0.7."""
    m = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"), max_epochs=None)
    return m.select("doc_id", "source", F.col("_slot").alias("slot"), F.col("_place").alias("place"), F.col("_epoch").alias("epoch"))
