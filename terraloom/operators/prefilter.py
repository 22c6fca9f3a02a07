"""Rows that may have a partner in another table, told by a bitmap of fixed size before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the map: 16 MiB in all, however many keys it is made of.
BITS = 1 << 27
#: Bits of one row of the map, which is what ``bitmap_construct_agg`` builds.
_ROW_BITS = 1 << 15


def _position(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITS))


def may_match(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without most of those whose ``on`` columns occur in no row of ``keys``; none with a partner is lost.

    The hashed keys set bits of a map of at most ``BITS`` bits, which is broadcast. Rows are
    tested where they are scanned. Rows of many keys fill the map, and then more rows pass
    for nothing; an exact join must follow. Both tables need equal types in ``on``.
    """
    place = keys.select(_position(on).alias("_at")).select(
        F.floor(F.col("_at") / _ROW_BITS).cast("int").alias("_row"), F.pmod("_at", F.lit(_ROW_BITS)).alias("_bit")
    )
    bits = place.groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    at = _position(on)
    tested = rows.withColumns({"_row": F.floor(at / _ROW_BITS).cast("int"), "_bit": F.pmod(at, F.lit(_ROW_BITS)).cast("int")})
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = tested.join(F.broadcast(bits), "_row")
    return found.where(F.getbit(byte, F.pmod("_bit", F.lit(8))) == 1).select(*rows.columns)
