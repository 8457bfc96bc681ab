"""URL decomposition (B1, D10, J7) on Spark's built-in ``try_parse_url``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_part(c, part: str) -> Column:
    """PATH / QUERY / REF of a URL; '' when absent or unparsable."""
    return F.coalesce(F.call_function("try_parse_url", _c(c), F.lit(part)), F.lit(""))


def url_host(c) -> Column:
    """Host of an Origin-style URL; NULL when missing, unparsable or host-less.

    A value without a scheme is read as ``host[/path]``.
    """
    c = _c(c)
    h = F.call_function("try_parse_url", c, F.lit("HOST"))
    h2 = F.when(~c.contains("://"),
                F.call_function("try_parse_url", F.concat(F.lit("http://"), c), F.lit("HOST")))
    h = F.coalesce(h, h2)
    return F.when(F.length(h) > 0, h)
