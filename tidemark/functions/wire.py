"""The five-byte header that registry-framed messages carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAGIC = 0


def frame(body: Column, schema_id: int | Column) -> Column:
    """A binary message body behind the header: magic byte, four-byte schema id."""
    number = schema_id if isinstance(schema_id, Column) else F.lit(schema_id)
    return F.concat(F.unhex(F.lpad(F.lit(format(MAGIC, "x")), 2, "0")), F.unhex(F.lpad(F.hex(number), 8, "0")), body)


def confluent_header(value: Column) -> list[Column]:
    """``magic``, ``schema_id`` and ``body`` of a framed binary message.

    ``schema_id`` is null where the frame is shorter than five bytes or the
    magic byte is not zero.
    """
    magic = F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int")
    schema_id = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    framed = (F.length(value) >= 5) & (magic == MAGIC)
    return [
        F.when(F.length(value) >= 1, magic).alias("magic"),
        F.when(framed, schema_id).alias("schema_id"),
        F.when(framed, F.substring(value, F.lit(6), F.length(value))).alias("body"),
    ]
