"""Row hashes for comparing two copies of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F



def row_hash(columns: Sequence[str | Column]) -> Column:
    """64-bit row hash in which a null's position counts."""
    parts: list[Column] = []
    for column in columns:
        value = F.col(column) if isinstance(column, str) else column
        parts += [value, value.isNull()]
    return F.xxhash64(*parts)


def portable_hash(columns: Sequence[str | Column]) -> Column:
    """60-bit row hash that any engine with md5 can recompute.

    Each field stands behind its length, a null as a bare sign, so different rows
    have different texts. Slower than ``row_hash``; for comparing against a copy
    outside Spark.
    """
    texts = []
    for column in columns:
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        texts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    digest = F.md5(F.concat(*texts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
