"""Hashes and identifiers derived from row content."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character that Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: namespace of the operational-store record ids.
RECORD_NAMESPACE = "6097dbcca8375a4da63e2668d5045ade"


def pii_hash(text: Column) -> Column:
    """SHA-256 hex digest of the stripped, lower-cased text; NULL stays NULL."""
    return F.sha2(F.lower(F.btrim(text, F.lit(WHITE_SPACE))), 256)


def record_id(system: Column, key: Column) -> Column:
    """Version-5 UUID of ``system:key``."""
    name = F.encode(F.concat(system, F.lit(":"), key), "UTF-8")
    digest = F.sha1(F.concat(F.unhex(F.lit(RECORD_NAMESPACE)), name))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def json_payload(*columns: str) -> Column:
    """The row as JSON text, NULL fields included."""
    return F.to_json(F.struct(*(columns or ("*",))), {"ignoreNullFields": "false"})
