"""Column -> Column helpers (pure Spark expressions, no UDFs)."""

from webmetrics.functions.ids import (  # noqa: F401
    is_uuid, uuid7, uuid7_millis, uuid7_ts, uuid_norm, uuid_version,
)
from webmetrics.functions.net import (  # noqa: F401
    ipv4_to_long, is_ipv4, long_to_ipv4, range_to_cidr,
)
from webmetrics.functions.timefn import (  # noqa: F401
    bucket, bucket5, granularity, range_days, start_of_day, start_of_hour,
)
from webmetrics.functions.url import url_host, url_part  # noqa: F401
