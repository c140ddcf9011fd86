"""Display masks for personal data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mask_string(text: Column) -> Column:
    """Keep the first and last character; two characters or fewer become all stars."""
    size = F.length(text)
    starred = F.concat(F.left(text, F.lit(1)), F.repeat(F.lit("*"), size - 2), F.right(text, F.lit(1)))
    return F.when(size <= 2, F.repeat(F.lit("*"), size)).when(size > 2, starred)


def mask_email(address: Column) -> Column:
    """Mask the local part. Text without ``@`` is returned as it is."""
    at = F.lit("@")
    local = F.split_part(address, at, F.lit(1))
    domain = F.split_part(address, at, F.lit(2))
    return F.when(~F.contains(address, at), address).otherwise(F.concat(mask_string(local), at, domain))
