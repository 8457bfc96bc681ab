"""Client state re-aimed as a table job.

The browser client keeps the current (visitor, session, section) and
creates missing ancestors on demand. Here an *action log*
(api_key, client, seq, ts, action, location, title) is turned into event
rows with parents, relationally:

* resets: a new or removed visitor resets session and section, a new or
  removed session resets the section, a new or removed section resets the
  section (O2);
* after a reset the first *creating* action creates the entity (a register of
  it or of a descendant), and all later actions up to the next reset refer to
  it (O1); deregistering emits nothing (O3).

This is a segmented prefix scan whose carry is the current entity of each kind. The
log is read once and exchanged once, by (client, seq div chunk): within a chunk windows
of one order give each row the entity that the chunk itself has made current, if any. What a
chunk does to the carry is one row (has it a reset, what is current at its end), and
these combine: the entity carried into a chunk is the first one made current since the last
chunk with a reset. A client with a very long log is so spread over many tasks, and the
parents' ids are at hand on each row, without a join of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webmetrics.functions.ids import is_uuid, uuid7, uuid_version

REG_V, DEREG_V = "registerVisitor", "deregisterVisitor"
REG_S, DEREG_S = "registerSession", "deregisterSession"
REG_X, DEREG_X = "registerSection", "deregisterSection"
REG_C = "registerClick"
ACTIONS = (REG_V, DEREG_V, REG_S, DEREG_S, REG_X, DEREG_X, REG_C)
CHUNK = 1_000_000
KEYS = ("api_key", "client")
TYPE_CODE = {"Visitor": 1, "Session": 2, "Section": 3, "Click": 4}
#: By entity: the actions that end the current one, and those that need one and so create it.
RESETS = {"Visitor": (REG_V, DEREG_V), "Session": (REG_V, DEREG_V, REG_S, DEREG_S),
          "Section": (REG_V, DEREG_V, REG_S, DEREG_S, REG_X, DEREG_X)}
CREATES = {"Visitor": (REG_V, REG_S, REG_X, REG_C), "Session": (REG_S, REG_X, REG_C), "Section": (REG_X, REG_C)}


def _in(acts) -> Column:
    return F.coalesce(F.col("action").isin(*acts), F.lit(False))


def _id(kind: str, ts, seq) -> Column:
    return uuid7(F.unix_millis(ts), F.lit(TYPE_CODE[kind]), F.pmod(seq, F.lit(1 << 48)))


def _local(actions: DataFrame, chunk: int) -> DataFrame:
    """Per row and kind: ``_r`` position of the last reset in the chunk, ``_c`` the entity that
    the chunk has created last (position, seq, ts), ``_n`` whether this row creates it."""
    df = actions.withColumn("_chunk", F.floor(F.col("seq") / F.lit(chunk)))
    here = Window.partitionBy(*KEYS, "_chunk").orderBy("seq", "ts", "action", "location", "title")
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_pos", F.row_number().over(here))
    df = df.select("*", *[x for k in RESETS for x in (
        F.max(F.when(_in(RESETS[k]), F.col("_pos"))).over(upto).alias(f"_r_{k}"),
        F.max(F.when(_in(CREATES[k]), F.col("_pos"))).over(before).alias(f"_p_{k}"))])
    # a creating action creates if none has since the last reset (its own included)
    df = df.select("*", *[(_in(CREATES[k]) & F.coalesce(F.col(f"_p_{k}") < F.col(f"_r_{k}"), F.col(f"_p_{k}").isNull())).alias(f"_n_{k}")
                          for k in RESETS])
    return df.select("*", *[F.max(F.when(F.col(f"_n_{k}"), F.struct("_pos", "seq", "ts"))).over(upto).alias(f"_c_{k}") for k in RESETS])


def _current(k: str) -> Column:
    """What the chunk itself has made current: its last creation, unless a reset came later."""
    return F.when(F.col(f"_r_{k}").isNull() | (F.col(f"_c_{k}._pos") >= F.col(f"_r_{k}")), F.col(f"_c_{k}"))


def _carried(local: DataFrame) -> DataFrame:
    """(client, chunk) -> the entity of each kind that is current when the chunk starts."""
    ends = local.groupBy(*KEYS, "_chunk").agg(*[x for k in RESETS for x in (
        F.max(F.col(f"_r_{k}").isNotNull()).alias(f"_h_{k}"), F.max_by(F.struct(_current(k).alias("e")), "_pos").alias(f"_e_{k}"))])
    order = Window.partitionBy(*KEYS).orderBy("_chunk")
    ends = ends.select(*KEYS, "_chunk", *[x for k in RESETS for x in (
        F.sum(F.col(f"_h_{k}").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"_g_{k}"), F.col(f"_e_{k}.e").alias(f"_e_{k}"))])
    for k in RESETS:
        since = Window.partitionBy(*KEYS, f"_g_{k}").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ends = ends.withColumn(f"_e_{k}", F.first(f"_e_{k}", ignorenulls=True).over(since))
    return ends.select(*KEYS, "_chunk", *[F.lag(f"_e_{k}").over(order).alias(f"_b_{k}") for k in RESETS])


def from_actions(actions: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Action log -> events (api_key, client, seq, sub, event_type, id,
    ts, parent, location, title); ``sub`` orders the events one action emits
    (visitor, session, section, click). Actions of one seq follow each other by ts,
    then action."""
    local = _local(actions, chunk)
    rows = local.join(_carried(local), [*KEYS, "_chunk"])
    for k in RESETS:
        carried = F.col(f"_r_{k}").isNull() & F.col(f"_b_{k}").isNotNull()
        at = F.when(carried, F.col(f"_b_{k}")).otherwise(_current(k))
        rows = rows.withColumn(f"_id_{k}", F.when(at.isNotNull(), _id(k, at["ts"], at["seq"]))).withColumn(f"_n_{k}", F.col(f"_n_{k}") & ~carried)
    nul = F.lit(None).cast("string")

    def event(sub: int, kind: str, own: Column, parent: Column, *text) -> Column:
        location, title = text or (nul, nul)
        return F.struct(F.lit(sub).alias("sub"), F.lit(kind).alias("event_type"), own.alias("id"), parent.alias("parent"),
                        location.alias("location"), title.alias("title"))

    v, s, x = [F.col(f"_id_{k}") for k in RESETS]
    made = F.array(
        F.when(F.col("_n_Visitor"), event(0, "Visitor", v, nul)), F.when(F.col("_n_Session"), event(1, "Session", s, v)),
        F.when(F.col("_n_Section"), event(2, "Section", x, s, F.col("location"), F.col("title"))),
        F.when(_in((REG_C,)), event(3, "Click", _id("Click", F.col("ts"), F.col("seq")), x)))
    flat = rows.select(*KEYS, "seq", "ts", F.explode(F.filter(made, lambda e: e.isNotNull())).alias("e"))
    return flat.select(*KEYS, "seq", "e.sub", "e.event_type", "e.id", "ts", "e.parent", "e.location", "e.title")


def to_wire(events: DataFrame) -> DataFrame:
    """Event rows -> wire bodies {t, i, a}: visitor no attrs, session and
    click ``p``, section ``p``, ``l``, ``t`` (absent values left out)."""
    t = F.create_map(*[x for k, v in TYPE_CODE.items() for x in (F.lit(k), F.lit(v))])
    a = F.map_filter(F.create_map(F.lit("p"), F.col("parent"), F.lit("l"), F.col("location"),
                                  F.lit("t"), F.col("title")), lambda _k, v: v.isNotNull())
    return events.select(*KEYS, "seq", "sub", F.try_element_at(t, F.col("event_type")).alias("t"),
                         F.col("id").alias("i"), a.alias("a"))


def valid_reference(c) -> Column:
    """A stored reference is usable only if it is a UUID of version 7."""
    return is_uuid(c) & F.coalesce(uuid_version(c) == 7, F.lit(False))
