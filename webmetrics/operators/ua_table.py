"""User-agent rules as a table (D2-D5), for rule sets too large for one generated expression.

Every match of most regexes contains some fixed text. A rule is listed under that text; the
first ``GRAM`` characters of all texts, with the lengths of the texts that begin so, are a
short table. An agent looks up its pieces of ``GRAM`` characters there, cuts the texts of these
lengths out of itself and is joined with the rules on them, so it meets only rules whose
whole text it contains, however many there are. Rules without a text of ``GRAM`` characters are
tried on all agents. What is met is checked by the regex; the first rule of each kind wins.

The index is made by built-in functions over the rule table, wherever its rows are: neither rules
nor texts pass through the driver. It is broadcast where it is proven small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webmetrics import schema as S
from webmetrics.plans.strategy import checked_broadcast

GRAM = 4
_KINDS = {"os": S.OS_DEFAULTS, "browser": S.BROWSER_DEFAULTS, "device": S.DEVICE_DEFAULTS}
_RULE = ("kind", "priority", "regex")
_END = "\ue0ff"                         # stands for whatever ends a run of fixed text
_SPECIAL = ".()[]{}+*?^$|"
_PLAIN = "".join(chr(0xE000 + i) for i in range(len(_SPECIAL)))      # the same, escaped
_NESTED = 8                             # depth of groups that is looked through
_PLAIN_GROUP = r"\((?:\?:|\?<[A-Za-z][A-Za-z0-9]*>)?([^()\[\]{}+*?^$|.]+)\)(?![?*+{])"


def required_text(regex: Column, groups: bool = False) -> Column:
    """The longest run of characters that every match contains; '' where none is certain. With
    ``groups`` a run goes on through groups of plain text, which occur once."""
    t = F.regexp_replace(regex, r"\\\\", _END)                       # an escaped backslash
    t = F.regexp_replace(t, r"\\[A-Za-z]", _END)                     # classes and anchors
    for c, p in zip(_SPECIAL, _PLAIN, strict=True):
        t = F.replace(t, F.lit("\\" + c), F.lit(p))
    t = F.regexp_replace(t, r"\\(.)", "$1")
    t = F.regexp_replace(t, r"\[\^?\]?[^\[\]]*\]", _END)
    for _ in range(_NESTED if groups else 0):
        t = F.regexp_replace(t, _PLAIN_GROUP, "$1")
    for _ in range(_NESTED):
        t = F.regexp_replace(t, r"\([^()]*\)", _END)
    t = F.regexp_replace(t, r"(?s).\{[^}]*\}", _END)                  # what may come no time at all
    t = F.regexp_replace(t, r"(?s).[?*]", _END)
    unsure = (regex.rlike(r"\(\?(?!:|<[A-Za-z])") | regex.rlike(r"\\([xucpPkQE0-9]|$)") | regex.rlike("[\ue000-\ue0ff]")
              | t.rlike(r"[|()\[\]{}]"))                             # flags, look-around, codes, alternatives
    runs = F.split(F.regexp_replace(t, r"[+.^$?*]", _END), _END)
    longest = F.array_max(F.transform(runs, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    return F.when(unsure, F.lit("")).otherwise(F.translate(longest, _PLAIN, _SPECIAL))


def group_count(regex: Column) -> Column:
    """Capturing groups: unescaped ( outside of a class, not followed by ? unless it names a group."""
    plain = F.regexp_replace(regex, r"\\Q.*?(?:\\E|$)|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "")
    return F.size(F.regexp_extract_all(plain, F.lit(r"\((?!\?)|\(\?<[A-Za-z]"), F.lit(0)))


def _parts(template: Column, groups: Column) -> Column:
    """Text (t) and group (g) parts of a replacement; groups that the regex lacks go."""
    tokens = F.regexp_extract_all(template, F.lit(r"\$\d|[^$]+|\$"), F.lit(0))
    group = lambda x: F.when(x.rlike(r"^\$\d$"), F.substring(x, 2, 1).cast("int"))
    parts = F.transform(tokens, lambda x: F.struct(F.when(group(x).isNull(), x).alias("t"), group(x).alias("g")))
    return F.filter(parts, lambda p: p["g"].isNull() | (p["g"] <= groups))


def rule_table(rules: DataFrame) -> DataFrame:
    """(kind, priority, regex, text, parts) of rules (kind, priority, regex, repl), text '' if it is
    shorter than GRAM; of rules that are alike but for their replacement the least one (as JSON) stays."""
    repl = F.coalesce("repl", F.create_map().cast("map<string,string>"))
    one = rules.where("regex is not null").groupBy(*_RULE).agg(F.min_by(repl, F.to_json(repl)).alias("repl"))
    text = required_text(F.col("regex"), groups=True)
    parts = F.transform_values("repl", lambda _, t: _parts(t, group_count(F.col("regex"))))
    return one.select(*_RULE, text.alias("text"), parts.alias("parts")).withColumn("text", F.when(F.length("text") >= GRAM, F.col("text")).otherwise(F.lit("")))


def parse(agents: DataFrame, table: DataFrame, ua: str) -> DataFrame:
    """The agents (distinct column ``ua``) with their device, os and browser columns."""
    c = F.col(ua)
    texts = table.where("text <> ''")
    begins = texts.groupBy(F.substring("text", 1, GRAM).alias("gram")).agg(F.collect_set(F.length("text")).alias("lengths"))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.length(c) - (GRAM - 1), F.lit(1)))).alias("at")
    places = agents.select(ua, at).withColumn("gram", c.substr(F.col("at"), F.lit(GRAM)))
    cut = places.join(checked_broadcast(begins), "gram").select(ua, "at", F.explode("lengths").alias("n"))
    cut = cut.where(F.col("at") + F.col("n") - 1 <= F.length(c)).select(ua, c.substr(F.col("at"), F.col("n")).alias("text"))
    met = cut.join(checked_broadcast(texts), "text").unionByName(
        agents.select(ua, F.lit("").alias("text")).join(checked_broadcast(table.where("text = ''")), "text"))
    won = met.where(F.rlike(c, F.col("regex")))
    filled = F.transform_values("parts", lambda _, parts: F.array_join(F.transform(
        parts, lambda p: F.coalesce(p["t"], F.call_function("regexp_extract", c, F.col("regex"), p["g"]))), ""))
    tried = won.select(ua, "kind", F.struct("priority", "regex").alias("rank"), filled.alias("a"))
    none = agents.select(ua, *[F.lit(None).cast(tried.schema[x].dataType).alias(x) for x in ("kind", "rank", "a")])      # an agent that no rule fits
    of = lambda k, x: F.when(F.col("kind") == k, F.col(x))
    wide = tried.unionByName(none).groupBy(ua).agg(*[F.min_by(of(k, "a"), of(k, "rank")).alias(f"_{k}") for k in _KINDS])

    def v(kind, attr):
        return F.coalesce(F.col(f"_{kind}")[attr], F.lit(_KINDS[kind].get(attr, "")))

    return wide.select(
        ua, v("device", "brand").alias("device_brand"), v("device", "device").alias("device_model"),
        v("os", "os").alias("os"), F.concat_ws(".", *[v("os", x) for x in ("v1", "v2", "v3")]).alias("os_version"),
        v("browser", "family").alias("browser"),
        F.concat_ws(".", *[v("browser", x) for x in ("v1", "v2")]).alias("browser_version"))
