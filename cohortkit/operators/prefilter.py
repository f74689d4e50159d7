"""A Bloom filter of the cohort in front of the demographic aggregate.

The filter is a small table of bitmaps, made and tested by Spark's bitmap functions: each id sets ``BITS`` bits of one
bitmap of 32,768 bits. It is broadcast, and its size follows the counted ids up to ``MAX_BITMAPS`` (16 MB); a cohort too large for
that is not filtered. Rows that pass are the cohort's and a few others, so an exact join has to follow; none of the cohort's is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP, BITS, PER_ID, MAX_BITMAPS = 32_768, 3, 12, 4_096


def _bitmap(key: str, bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bitmaps))


def _bits(key: str) -> list[Column]:
    """Places in the bitmap: 15 bits each of a second hash."""
    h = F.xxhash64(F.lit("bits"), key)
    return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BITMAP - 1)) for i in range(BITS)]


def possible_rows(rows: DataFrame, ids: DataFrame, key: str = "ENC_HN") -> DataFrame:
    """The rows whose ``key`` may be among those of ``ids`` (a stored table: it is counted first); null keys go."""
    n = ids.count()
    if n * PER_ID > MAX_BITMAPS * BITMAP:
        return rows
    bitmaps = max(1, -(-n * PER_ID // BITMAP))
    table = ids.filter(F.col(key).isNotNull()).select(_bitmap(key, bitmaps).alias("__bitmap"), F.explode(F.array(*_bits(key))).alias("bit")) \
        .groupBy("__bitmap").agg(F.bitmap_construct_agg("bit").alias("__set"))
    found = rows.filter(F.col(key).isNotNull()).withColumn("__bitmap", _bitmap(key, bitmaps)).join(F.broadcast(table), "__bitmap")
    for bit in _bits(key):
        byte = F.conv(F.hex(F.substring("__set", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        found = found.filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
    return found.select(*rows.columns)
