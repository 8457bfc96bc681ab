"""FIXTURES 2.3: lookups."""

import pytest

from webmetrics.operators import enrich, ua_table
from webmetrics.sources import dims


@pytest.fixture(scope="module")
def rules(spark):
    return dims.ua_rules_df(spark)


def parse(spark, rules, ua):
    df = spark.createDataFrame([(ua,)], "user_agent string")
    return enrich.user_agents(df, rules).first()


def test_no_rule_defaults(spark, rules):
    r = parse(spark, rules, "nothing-matches-this")
    assert (r.os, r.os_version, r.browser, r.browser_version, r.device_model, r.device_brand) == \
        ("Other", "0.0.0", "Other", "0.0", "Other", "")


def test_null_agent_defaults(spark, rules):
    r = parse(spark, rules, None)
    assert (r.os, r.browser) == ("Other", "Other")


def test_lowest_priority_wins(spark):
    rules = dims.ua_rules_df(spark, [
        ("browser", 20, r"Foo/(\d+)", {"family": "Second", "v1": "$1"}),
        ("browser", 10, r"Foo", {"family": "First"}),
    ])
    r = parse(spark, rules, "Foo/12")
    assert (r.browser, r.browser_version) == ("First", "0.0")


def test_group_templates(spark, rules):
    r = parse(spark, rules, "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 "
                            "(KHTML, like Gecko) Chrome/120.0.6099.43 Mobile Safari/537.36")
    assert (r.os, r.os_version, r.browser, r.browser_version, r.device_brand, r.device_model) == \
        ("Android", "14..0", "Chrome Mobile", "120.0", "Google", "Pixel 8")  # unmatched optional group -> ""
    r = parse(spark, rules, "curl/8.4.0")
    assert (r.browser, r.browser_version) == ("curl", "8.4")


def test_rules_from_json_lines(spark, tmp_path):
    p = tmp_path / "rules.json"
    p.write_text('{"kind": "os", "priority": 1, "regex": "Plan9", "repl": {"os": "Plan 9"}}\n')
    r = parse(spark, dims.read_ua_rules(spark, str(p)), "Plan9 box")
    assert (r.os, r.os_version) == ("Plan 9", "0.0.0")


def _blocks(spark, ranges, iso=(("NA", "NAA"),), mode="range"):
    from webmetrics import schema as S
    rows = [(s, e, cc, st, None, city, None, 0.0, 0.0, None) for s, e, cc, st, city in ranges]
    r = spark.createDataFrame(rows, S.IP_RANGE)
    iso_df = spark.createDataFrame([(None, a, b) + (None,) * 8 for a, b in iso], S.ISO_COUNTRY)
    return enrich.blocks_from_ranges(r, iso_df, mode)


@pytest.mark.parametrize("mode", ["range", "cidr"])
def test_longest_prefix_wins(spark, mode):
    b = _blocks(spark, [("10.1.0.0", "10.1.255.255", "NA", "S16", "C16"),
                        ("10.1.2.0", "10.1.2.255", "NA", "S24", "C24")], mode=mode)
    df = spark.createDataFrame([("10.1.2.3",), ("10.1.3.3",), ("10.9.9.9",), (None,)], "ipv4 string")
    got = {r.ipv4: (r.country_code, r.state, r.city) for r in enrich.geo_ip(df, b, "ipv4", mode).collect()}
    assert got["10.1.2.3"] == ("NAA", "S24", "C24")
    assert got["10.1.3.3"] == ("NAA", "S16", "C16")
    assert got["10.9.9.9"] == ("unknown",) * 3
    assert got[None] == ("unknown",) * 3


def test_blank_state_and_unknown_country(spark):
    b = _blocks(spark, [("10.0.0.0", "10.0.0.255", "ZZ", None, "X")])
    df = spark.createDataFrame([("10.0.0.7",)], "ipv4 string")
    r = enrich.geo_ip(df, b, "ipv4").first()
    assert (r.country_code, r.state, r.city) == ("", "", "X")


def test_two_address_range_modes(spark):
    rng = [("10.0.0.0", "10.0.0.1", "NA", "S", "C")]
    df = spark.createDataFrame([("10.0.0.0",), ("10.0.0.1",)], "ipv4 string")
    exact = {r.ipv4: r.city for r in enrich.geo_ip(df, _blocks(spark, rng), "ipv4", "range").collect()}
    cidr = {r.ipv4: r.city for r in
            enrich.geo_ip(df, _blocks(spark, rng, mode="cidr"), "ipv4", "cidr").collect()}
    assert exact == {"10.0.0.0": "C", "10.0.0.1": "C"}
    assert cidr == {"10.0.0.0": "C", "10.0.0.1": "unknown"}  # quirk Q4


def test_missing_regex_group_expands_to_nothing(spark):
    from webmetrics.operators import enrich, ua_table
    for regex, groups in [("a(b)c", 1), (r"a\(b(?:x)", 0), ("[(](x)(?<n>y)", 2), (r"\Q(\E(x)", 1)]:
        assert enrich._groups(regex) == groups
    sql = enrich.template_sql("ua", "A/(\\d+)", "v$1-$2")
    assert spark.sql(f"SELECT {sql} AS v FROM (SELECT 'A/12' AS ua)").first()[0] == "v12-"


def test_required_text(spark):
    want = {
        r"Edg/(\d+)\.(\d+)": "Edg/", r"Chrome/(\d+)\.(\d+).*Mobile": "Chrome/", r"^(curl)/(\d+)": "/", r"(?i)bot|crawler": "", r"a|bcd": "",
        r"colou?rs": "colo", r"Windows NT 10\.0": "Windows NT 10.0", r"x[a-f]{2}yz+": "yz", r"SM-([A-Z0-9]+)": "SM-", r"\x41bcd": "",
        r"(?:long group)?ab": "ab", r"a\\dbc": "dbc", r"((a|b)(c))?xyz*": "xy", r"ab{0,2}?cde??": "cd", r"[]x]qq[^]]": "qq", r"\(a\|b\)": "(a|b)",
        r"(?=x)abc": "", r"un(closed": "", "": "", r"a-\-b\/": "a--b/"}
    df = spark.createDataFrame([(r,) for r in want], "r string")
    assert {x.r: x.t for x in df.select("r", ua_table.required_text(df.r).alias("t")).collect()} == want


def test_required_text_is_in_every_match(spark):
    import random
    import re
    r = random.Random(5)
    atoms = ["a", "b", "C", " ", "/", r"\.", r"\(", r"\d", "[ab]", "[^b]", "(a)", "(?:b|Ca)", ".", r"\b", r"\\"]
    rules = {"".join(r.choice(atoms) + r.choice(["", "", "", "?", "*", "+", "{0,1}", "{2}", "+?"]) for _ in range(r.randint(1, 7))) for _ in range(400)}
    rules = {x for x in rules if r"\b?" not in x and r"\b*" not in x and r"\b+" not in x and r"\b{" not in x}
    df = spark.createDataFrame([(x,) for x in rules], "r string")
    text = {x.r: (x.t, x.n) for x in df.select("r", ua_table.required_text(df.r).alias("t"), ua_table.group_count(df.r).alias("n")).collect()}
    words = ["".join(r.choice("abC /.(1\\") for _ in range(r.randint(1, 9))) for _ in range(1500)]
    met = 0
    for rule, (need, n) in text.items():
        assert re.compile(rule).groups == n == enrich._groups(rule)
        for w in words:
            if re.search(rule, w):
                assert need in w, (rule, need, w)
                met += 1
    assert met > 1000 and sum(len(t) > 1 for t, _ in text.values()) > 20


def test_rule_table_equals_expression(spark, rules, monkeypatch):
    from webmetrics.sources.catalogue import USER_AGENTS
    agents = [*USER_AGENTS, None, "", "x", "nothing", "GoogleBOT/2", "Foo 1 Foo 2", "Edg/1.2 Edg/3.4", "Android 9"]
    df = spark.createDataFrame([(a,) for a in agents * 2], "user_agent string")
    more = dims.ua_rules_df(spark, [tuple(r) for r in rules.collect()] + [
        ("device", 5, r"Foo (\d)", {"device": "F$1$9-$2", "brand": ""}), ("device", 5, r"Foo", {"device": "G"}),
        ("os", 70, "", {"os": "any"})])
    want = sorted(map(tuple, enrich.user_agents(df, more).collect()), key=repr)
    monkeypatch.setattr(enrich, "CASE_RULES", 0)
    assert sorted(map(tuple, enrich.user_agents(df, more).collect()), key=repr) == want


def test_rules_stay_off_the_driver(spark, monkeypatch):
    kind, most = type(spark.range(1)), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: most.append(len(r := collect(self))) or r)
    rules = spark.range(20_000).selectExpr("'device' AS kind", "cast(id % 50 AS int) AS priority", r"concat('Unit', id, r'y/(\d+)') AS regex",
                                           "map('device', concat('U', id, ' v$1$2')) AS repl")
    df = spark.range(20_000).selectExpr("concat('Agent (Unit', id * 3 % 30000, 'y/', id % 9, ')') AS user_agent")
    out = enrich.user_agents(df, rules)
    assert max(most) <= enrich.CASE_RULES + 1
    hit = out.where("device_model = concat('U', regexp_extract(user_agent, 'Unit([0-9]+)', 1), ' v', regexp_extract(user_agent, 'y/([0-9])', 1))").count()
    assert hit == df.where("cast(regexp_extract(user_agent, 'Unit([0-9]+)', 1) AS int) < 20000").count() > 10_000


def test_large_rule_table(spark):
    rules = dims.ua_rules_df(spark, [("device", i, rf"Model{i}x/(\d+)", {"device": f"M{i} v$1"}) for i in range(2000)])
    df = spark.range(10000).selectExpr("concat('Mozilla/5.0 (Linux) Model', id % 2500, 'x/', id % 7, ' AppleWebKit/', id) AS user_agent")
    got = enrich.user_agents(df, rules).groupBy().agg({"*": "count"}).first()[0]
    hit = enrich.user_agents(df, rules).where("device_model = concat('M', regexp_extract(user_agent, 'Model([0-9]+)', 1), ' v', "
                                              "regexp_extract(user_agent, 'x/([0-9])', 1))").count()
    assert (got, hit) == (10000, 8000)


def test_rules_that_differ_in_a_group_meet_their_own_agents_only(spark):
    rules = spark.range(500).selectExpr("'device' AS kind", "10 AS priority", "concat('Unit-(', id, ')[);]') AS regex",
                                        "map('device', concat('U$1 ', id)) AS repl")
    table = ua_table.rule_table(rules)
    assert table.select("text").distinct().count() == 500
    df = spark.range(600).selectExpr("concat('Mozilla (Unit-', id, ') x') AS user_agent").union(spark.createDataFrame([("",), (None,), ("Uni",), ("Unit-3",)], "user_agent string"))
    got = {r.user_agent: r.device_model for r in enrich.user_agents(df, rules).collect()}
    assert got == {f"Mozilla (Unit-{i}) x": f"U{i} {i}" if i < 500 else "Other" for i in range(600)} | dict.fromkeys(["", None, "Uni", "Unit-3"], "Other")


def test_text_through_plain_groups(spark):
    want = {"Unit-(12)[);]": "Unit-12", "a(?:bc)(?<n>d)e": "abcde", "a((bc)d)e?f": "abcd", "ab(cd)?efg(gh)*": "efg", "ab(c|d)efg": "efg",
            "ab(cd)+e": "ab", r"x\(a(b)\)y": "x(ab)y", "(?i)ab(c)": "", r"[(]ab(c)[)]": "abc", r"a(b\d)cde": "cde"}
    df = spark.createDataFrame([(r,) for r in want], "r string")
    assert {x.r: x.t for x in df.select("r", ua_table.required_text(df.r, groups=True).alias("t")).collect()} == want


def test_range_pieces(spark):
    ranges = [(0, 0), (5, 5), (1, 14), (0, 15), (7, 9), (2 ** 32 - 3, 2 ** 32 - 1), (0, 2 ** 32 - 1), (10, 3000), (9, 8)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "i int, s long, e long")
    for row in df.select("i", "s", "e", enrich.range_pieces("s", "e").alias("p")).collect():
        blocks = sorted((p.n << p.k, (p.n + 1 << p.k) - 1) for p in row.p)
        assert all(a[1] + 1 == b[0] for a, b in zip(blocks, blocks[1:]))
        assert (blocks[0][0], blocks[-1][1]) == (row.s, row.e) if row.s <= row.e else not blocks
