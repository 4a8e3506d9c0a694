"""Uniqueness of an arriving batch against stored keys, without reading the stored keys again.

Each stored partition keeps a Bloom filter, as rows of 4 KB bitmaps (``bitmap_construct_agg``), so filters are
built, stored, added to and probed with ordinary aggregates and joins.  Arriving keys are reduced to distinct ones
and probed; only partitions whose filter may hold a key are looked up, and only for those keys.  A filter never
misses a stored key, so the answer is exact whatever the filters' size; that only sets how many keys are looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _places(columns: Sequence[str], bits: int, hashes: int) -> Column:
    """Places 1 to ``bits`` of a key."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *columns), F.lit(bits)) + 1 for i in range(hashes)])


def key_filters(stored: DataFrame, columns: Sequence[str], partition: str, bits: int = 1 << 23, hashes: int = 4) -> DataFrame:
    """``(partition, bucket, bitmap)`` over the keys of each partition; a partition has at most ``bits`` / 32768 rows."""
    at = stored.select(F.col(partition), F.explode(_places(columns, bits, hashes)).alias("_at"))
    return (at.groupBy(partition, F.bitmap_bucket_number("_at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bitmap")))


def merge_filters(filters: DataFrame, partition: str) -> DataFrame:
    """Filters of the same partitions from several loads, put together."""
    return filters.groupBy(partition, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def maybe_stored(keys: DataFrame, columns: Sequence[str], filters: DataFrame, partition: str, bits: int = 1 << 23,
                 hashes: int = 4) -> DataFrame:
    """``(columns, partition)``: distinct ``keys`` that a partition's filter may hold."""
    at = keys.select(*columns, F.explode(_places(columns, bits, hashes)).alias("_at"))
    at = at.select(*columns, F.bitmap_bucket_number("_at").alias("bucket"), F.bitmap_bit_position("_at").alias("_bit")).distinct()
    need = at.groupBy(*columns).agg(F.count(F.lit(1)).alias("_need"))
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, F.pmod("_bit", F.lit(8)).cast("int")) == 1
    found = (at.join(filters, "bucket").where(hit).groupBy(*columns, partition).agg(F.count(F.lit(1)).alias("_got")))
    return found.join(need, list(columns)).where("_got = _need").select(*columns, partition)


def duplicates_on_arrival(arriving: DataFrame, columns: Sequence[str], stored: DataFrame, filters: DataFrame, partition: str,
                          bits: int = 1 << 23, hashes: int = 4) -> DataFrame:
    """``(columns, rows, partition)`` of arriving keys that repeat: in the batch (partition NULL), or in a stored
    partition.  Keys with a NULL are no duplicates.  ``filters`` come from ``key_filters`` with the same settings."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    keys = arriving.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    asked = maybe_stored(keys, columns, filters, partition, bits, hashes)
    again = asked.join(stored.select(*columns, partition), [*columns, partition], "left_semi")
    return (keys.where("rows > 1").withColumn(partition, F.lit(None).cast(stored.schema[partition].dataType))
            .unionByName(keys.join(again, list(columns))))
