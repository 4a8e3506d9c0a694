"""Deterministic dense surrogate keys (1..n in natural-key order) without a global sort in one task.

``monotonically_increasing_id`` alone is neither dense nor stable, and a single-partition
``row_number() OVER (ORDER BY k)`` funnels every row through one task.  Instead:

1. the keys are range-partitioned into a fixed number of buckets (Spark samples a bounded number of
   keys per bucket) and sorted within each;
2. bucket number and position in the bucket are written out with the rows, once, to the shared folder, so
   what follows does not depend on a second run of the partitioning;
3. one count per bucket gives the offsets, which are joined back (``buckets`` rows);
4. key = offset + position + 1.

``extend_key_map`` keeps such keys over many loads: old keys never change, new ones follow the last.

The buckets only decide how the work is spread, never the result: the key equals the global rank
of the natural key, NULL last.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

POSITION_BITS = 33          # monotonically_increasing_id: partition number above, position below


@dataclass(frozen=True)
class KeyedDim:
    df: DataFrame
    rows: int


def dense_key(df: DataFrame, key: str, key_name: str, buckets: int | None = None) -> KeyedDim:
    """Add ``key_name`` (LongType, 1..n) ranking the distinct values of ``key`` ascending,
    NULL last.  ``df`` must hold one row per value of ``key``.  ``buckets`` defaults to the
    session's shuffle partitions."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(key).asc_nulls_last()
    number = F.monotonically_increasing_id()
    placed = materialize(
        df.repartitionByRange(buckets, order).sortWithinPartitions(order).withColumns({
            "_bucket": F.shiftright(number, POSITION_BITS),
            "_position": number.bitwiseAND((1 << POSITION_BITS) - 1)}), f"key_{key_name}")
    counts = {r["_bucket"]: r["count"] for r in placed.groupBy("_bucket").count().collect()}
    offsets, running = [], 0
    for b in sorted(counts):
        offsets.append((b, running))
        running += counts[b]
    first = spark.createDataFrame(offsets, "_bucket long, _first long")
    keyed = (placed.join(F.broadcast(first), "_bucket")
             .withColumn(key_name, F.col("_first") + F.col("_position") + 1)
             .drop("_bucket", "_position", "_first"))
    return KeyedDim(keyed, running)


KEY_LOAD = "load"


def read_key_map(spark: SparkSession, base: str, schema: T.StructType, before: int) -> DataFrame:
    """The stored keys of the loads below ``before``, each with the ``load`` that brought it in."""
    stored = T.StructType([*schema.fields, T.StructField(KEY_LOAD, T.LongType())])
    if before <= 0:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(base).where(F.col(KEY_LOAD) < before)


def extend_key_map(arriving: DataFrame, base: str, key: str, key_name: str, load: int,
                   buckets: int | None = None) -> DataFrame:
    """Stored keys stay, natural keys not seen before get the next ones; returns the whole map.

    ``arriving`` holds one row per natural key; loads are numbered from 0 and come one at a time.  Each load stores
    only its new keys, in a folder of its own: keys of earlier loads are never written again, and a load that is
    repeated after a failure replaces its own keys by the same ones.  Within a load the new keys are dense and
    in natural-key order (``dense_key``), after the last key of the loads before."""
    spark = arriving.sparkSession
    schema = T.StructType([arriving.schema[key], T.StructField(key_name, T.LongType())])
    stored = read_key_map(spark, base, schema, load)
    last = stored.agg(F.coalesce(F.max(key_name), F.lit(0))).first()[0]
    known = stored.select(F.col(key).alias("_known"))
    new = arriving.select(key).join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    keyed = dense_key(new, key, key_name, buckets)
    (keyed.df.select(key, (F.col(key_name) + last).alias(key_name))
     .write.mode("overwrite").parquet(f"{base.rstrip('/')}/{KEY_LOAD}={load}"))
    return read_key_map(spark, base, schema, load + 1)
