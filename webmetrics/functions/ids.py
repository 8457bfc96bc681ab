"""UUID helpers.

UUIDs are kept as canonical lower-case strings; Spark has no UUID type and
equality joins on the string are all the model needs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX = "[0-9a-fA-F]"
# Hyphenated (8-4-4-4-12), also in braces or as a URN, or simple (32 hex digits).
_HYPHENATED = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
UUID_RE = f"^({_HYPHENATED}|\\{{{_HYPHENATED}\\}}|urn:uuid:{_HYPHENATED}|{_HEX}{{32}})$"

# What uuid_norm returns; to the very end (\\z), as $ would let a line feed pass.
_CANONICAL = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _digits(c) -> Column:
    return F.regexp_replace(_c(c), "^urn:uuid:|[-{}]", "")


def is_uuid(c) -> Column:
    """True when ``c`` parses as a UUID (any version); NULL input -> False."""
    c = _c(c)
    return F.coalesce(c.rlike(UUID_RE), F.lit(False))


def uuid_norm(c) -> Column:
    """Canonical lower-case hyphenated form of a parsable UUID, else NULL."""
    c = _c(c)
    h = F.lower(_digits(c))
    canon = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                        F.substring(h, 13, 4), F.substring(h, 17, 4),
                        F.substring(h, 21, 12))
    return F.when(c.rlike(_CANONICAL), c).when(is_uuid(c), canon)


def uuid_version(c) -> Column:
    """Version nibble (0..15) of a parsable UUID, else NULL."""
    h = _digits(c)
    return F.when(is_uuid(c), F.conv(F.substring(h, 13, 1), 16, 10).cast("int"))


def uuid7_millis(c) -> Column:
    """Unix milliseconds held in the first 48 bits of a UUIDv7."""
    h = _digits(c)
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("long")


def uuid7_ts(c) -> Column:
    """Event time of a UUIDv7, truncated to whole seconds (sub-second dropped)."""
    return F.timestamp_seconds(F.floor(uuid7_millis(c) / F.lit(1000)))


def _hex(c, width: int) -> Column:
    return F.lpad(F.lower(F.hex(_c(c).cast("long"))), width, "0")


def uuid7(ms, a, b) -> Column:
    """Deterministic version-7 UUID text from milliseconds and two integers.

    Layout: 48-bit time | '7' + 12 bits of ``a`` | variant '8000' | 48 bits of ``b``.
    """
    h = _hex(ms, 12)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4),
                    F.lit("-7"), _hex(a, 3), F.lit("-8000-"), _hex(b, 12))


def uuid_halves(c) -> tuple[Column, Column]:
    """The first and last 8 bytes of a canonical UUID text; NULL for any other text."""
    c = _c(c)
    bytes_at = lambda *at: F.when(c.rlike(_CANONICAL), F.unhex(F.concat(*[F.substring(c, i, n) for i, n in at])))
    return bytes_at((1, 8), (10, 4), (15, 4)), bytes_at((20, 4), (25, 12))


def uuid_of_halves(a, b) -> Column:
    """Canonical text of two halves; NULL when one is."""
    a, b = F.lower(F.hex(_c(a))), F.lower(F.hex(_c(b)))
    return F.concat(F.substring(a, 1, 8), F.lit("-"), F.substring(a, 9, 4), F.lit("-"), F.substring(a, 13, 4),
                    F.lit("-"), F.substring(b, 1, 4), F.lit("-"), F.substring(b, 5, 12))


def half_millis(a) -> Column:
    """Unix milliseconds held in the first half of a UUIDv7."""
    return F.conv(F.hex(F.substring(_c(a), 1, 6)), 16, 10).cast("long")


def with_version(c, version: str) -> Column:
    """Replace the version nibble of a hyphenated UUID (test-data helper)."""
    c = _c(c)
    return F.concat(F.substring(c, 1, 14), F.lit(version), F.substring(c, 16, 21))
