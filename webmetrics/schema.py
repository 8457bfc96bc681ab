"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the wire / storage contract)
# Event type numbers on the wire: 1 Visitor, 2 Session, 3 Section, 4 Click.
TYPE_MAP = {1: "Visitor", 2: "Session", 3: "Section", 4: "Click"}
# Acceptance window around the receive time, both bounds exclusive.
MAX_BEFORE_SECONDS = 3600
MAX_AFTER_SECONDS = 300
# Fact grain and raw page-view retention.
BUCKET_SECONDS = 300
SECTION_RETENTION = "7 days"
UNKNOWN = "unknown"
# Lookup defaults when no rule matches.
OS_DEFAULTS = {"os": "Other", "v1": "0", "v2": "0", "v3": "0", "v4": "0"}
BROWSER_DEFAULTS = {"family": "Other", "v1": "0", "v2": "0"}
DEVICE_DEFAULTS = {"device": "Other", "brand": "", "model": ""}
# ---------------------------------------------------------------------------

# Report dimensions of the page-view fact.
DIMENSIONS = ("browser", "city", "country_code", "os", "path")

# Per report: dimension filters it emits, and the filters that force raw
# (not day-truncated) time filtering when the range exceeds 10 days.
# Kept asymmetric on purpose: by_path / by_city list their own dimension
# and leave out os (quirk Q8).
REPORT_FILTERS = {
    "by_country": ("browser", "city", "os", "path"),
    "timeseries": ("browser", "city", "country_code", "os", "path"),
    "total_visitors": ("browser", "city", "country_code", "os", "path"),
    "by_browser": ("city", "country_code", "os", "path"),
    "by_os": ("browser", "city", "country_code", "path"),
    "by_path": ("browser", "city", "country_code", "os"),
    "by_city": ("browser", "country_code", "os", "path"),
}
FORCE_RAW = {
    "by_country": ("browser", "city", "os", "path"),
    "by_browser": ("city", "country_code", "os", "path"),
    "by_os": ("browser", "city", "country_code", "path"),
    "by_path": ("browser", "city", "country_code", "path"),
    "by_city": ("browser", "city", "country_code", "path"),
    "total_visitors": (),
}

STR = T.StringType()
TS = T.TimestampType()
ATTRS = T.MapType(STR, STR)


def _s(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


BODY = _s(("t", T.IntegerType()), ("i", STR), ("a", ATTRS),
          ("event_type", T.IntegerType()), ("id", STR), ("attrs", ATTRS))
REQUEST = _s(("request_id", T.LongType()), ("received_at", TS), ("origin", STR),
             ("api_key", STR), ("user_agent", STR), ("ip", STR),
             ("events", T.ArrayType(BODY)))
EVENT = _s(("api_key", STR), ("site", STR), ("event_type", STR), ("id", STR),
           ("ts", TS), ("attrs", ATTRS))
VISITOR_EVENT = _s(("api_key", STR), ("site", STR), ("id", STR), ("ts", TS),
                   ("attrs", ATTRS))
SESSION_EVENT = _s(("api_key", STR), ("site", STR), ("id", STR), ("ts", TS),
                   ("parent", STR), ("device_brand", STR), ("device_model", STR),
                   ("os", STR), ("os_version", STR), ("browser", STR),
                   ("browser_version", STR), ("user_agent", STR), ("ipv4", STR),
                   ("ipv6", STR), ("country_code", STR), ("state", STR),
                   ("city", STR), ("attrs", ATTRS))
SECTION_EVENT = _s(("api_key", STR), ("site", STR), ("id", STR), ("ts", TS),
                   ("parent", STR), ("path", STR), ("query", STR),
                   ("fragment", STR), ("title", STR), ("attrs", ATTRS))
HIERARCHY_EVENT = _s(("api_key", STR), ("site", STR), ("visitor", STR),
                     ("session", STR), ("section", STR), ("ts", TS))
SECTION_COMBINED = _s(("api_key", STR), ("site", STR), ("ts", TS), ("path", STR),
                      ("os", STR), ("browser", STR), ("country_code", STR),
                      ("city", STR), ("visitor", STR))
VISITOR_TIMESERIES = _s(("api_key", STR), ("site", STR), ("ts", TS),
                        ("visitors", T.LongType()))
API_KEY = _s(("api_key", STR), ("site", STR), ("customer", STR),
             ("seq", T.LongType()))
ISO_COUNTRY = _s(("name", STR), ("cca2", STR), ("cca3", STR), ("ccn", STR),
                 ("iso_3166_2", STR), ("region", STR), ("sub_region", STR),
                 ("intermediate_region", STR), ("region_code", STR),
                 ("sub_region_code", STR), ("intermediate_region_code", STR))
IP_RANGE = _s(("ip_range_start", STR), ("ip_range_end", STR),
              ("country_code", STR), ("state1", STR), ("state2", STR),
              ("city", STR), ("postcode", STR), ("latitude", T.DoubleType()),
              ("longitude", T.DoubleType()), ("timezone", STR))
UA_RULE = _s(("kind", STR), ("priority", T.IntegerType()), ("regex", STR),
             ("repl", ATTRS))
ACTION = _s(("api_key", STR), ("client", STR), ("seq", T.LongType()),
            ("ts", TS), ("action", STR), ("location", STR), ("title", STR))
