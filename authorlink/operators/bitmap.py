"""A bitmap of hashed keys: of fixed size, merged like a sum, and sure about keys that are not there.

Large tables pass a bitmap of the keys that are asked for before anything of them moves. Bits of
different keys may coincide, so what passes still has to be compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 8 MB, in rows of 4 KB.
BITS = 1 << 26


def _bit(on: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1


def bitmap_of(keys: DataFrame, on: Sequence[str], bits: int = BITS) -> DataFrame:
    """``(_bucket, _bitmap)`` of the keys: at most ``bits / 32768`` rows, whatever the number of keys."""
    bit = _bit(on, bits)
    placed = keys.select(F.bitmap_bucket_number(bit).alias("_bucket"), F.bitmap_bit_position(bit).alias("_position"))
    return placed.groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bitmap"))


def may_hold(rows: DataFrame, bitmap: DataFrame, on: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows whose key may be one of those of ``bitmap``; all others certainly are not."""
    bit = _bit(on, bits)
    met = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(bit) == F.col("_bucket"))  # of fixed size
    position = F.bitmap_bit_position(bit)
    byte = F.substring("_bitmap", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1
    return met.filter(is_set).select(*rows.columns)
