"""A bit map of ids, of fixed size, that drops other rows where they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_BITS = 1 << 23


def _slot(key: Column) -> Column:
    """An id's place in the map, from 1 on; ids of different types that are equal share it."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(MAP_BITS)) + 1


def maybe_among(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be among the only column of ``ids``; all others are certainly not.

    The map is broadcast as ``MAP_BITS / 32768`` rows of 4 KiB at most, 1 MiB in all, whatever
    the number of ids; with very many of them it only lets more rows pass. Null keys go.
    """
    place = _slot(ids[ids.columns[0]])
    bits = (
        ids.select(
            F.bitmap_bucket_number(place).alias("__part"), F.bitmap_bit_position(place).alias("bit")
        )
        .groupBy("__part")
        .agg(F.bitmap_construct_agg("bit").alias("__bits"))
    )
    slot = _slot(F.col(key))
    marked = df.join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col("__part"))
    at = F.bitmap_bit_position(slot).cast("int")
    byte = F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return marked.filter(F.getbit(value, at % 8) == 1).select(*df.columns)
