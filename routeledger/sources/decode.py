"""Strict UTF-8 decoding of file bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOM = b"\xef\xbb\xbf"


def strict_utf8(raw: Column) -> Column:
    """Struct (text, had_bom, decode_error): a byte-order mark is dropped and noted; bytes that
    are not UTF-8 give no text, whatever other encoding they might be."""
    had_bom = F.startswith(raw, F.lit(BOM))
    body = F.when(had_bom, F.substring(raw, 4, 2_147_483_647)).otherwise(raw)
    text = F.try_validate_utf8(body.cast("string"))
    return F.struct(
        text.alias("text"), had_bom.alias("had_bom"),
        (body.isNotNull() & text.isNull()).alias("decode_error"))
