"""Gold kept up as files arrive (ST4 carried on to G4): Silver, keys, dimensions, fact and monthly sums.

Every micro-batch of files is cleaned and stored, and then adds to each Gold part what it brings, in a folder of its
own named by the batch id:

* ``country_keys``, ``date_keys``: natural keys not seen before get the next surrogate keys; old keys stay;
* ``attributes``: partial dimension attributes per entity (latest value and its date), merged when read;
* ``fact``: the batch's rows with their keys;
* ``monthly``: the batch's sums per country and month, added up when read.

A batch that is repeated after a failure replaces its own folders by the same content, so nothing counts twice.
No batch reads the Silver or fact rows of earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import PanelConfig
from tidemark.operators import gold
from tidemark.operators import silver as silver_ops
from tidemark.operators.keys import extend_key_map
from tidemark.sources.files import read_panel_csv

MONTHLY = ("new_cases", "new_deaths")


def apply_batch(spark: SparkSession, raw: DataFrame, base: str, batch: int, cfg: PanelConfig) -> None:
    """One arriving batch of raw rows; repeating it changes nothing."""
    base, own = base.rstrip("/"), f"batch={batch}"
    silver_ops.transform(raw, cfg).write.mode("overwrite").parquet(f"{base}/silver/{own}")
    silver = spark.read.schema(silver_ops.transform(raw, cfg).schema).parquet(f"{base}/silver/{own}")
    countries = extend_key_map(silver.select("iso_code").distinct(), f"{base}/country_keys", "iso_code", "country_key",
                               batch, cfg.key_buckets).drop("load")
    dates = extend_key_map(silver.select("date").distinct(), f"{base}/date_keys", "date", "date_key",
                           batch, cfg.key_buckets).drop("load")
    gold.partial_attributes(silver).write.mode("overwrite").parquet(f"{base}/attributes/{own}")
    gold.fact(silver, countries, dates).write.mode("overwrite").parquet(f"{base}/fact/{own}")
    fact = spark.read.parquet(f"{base}/fact/{own}")
    (fact.join(dates.select("date_key", F.year("date").alias("year"), F.month("date").alias("month")), "date_key", "left")
     .groupBy("country_key", "year", "month").agg(*[F.sum(c).alias(c) for c in MONTHLY])
     .write.mode("overwrite").parquet(f"{base}/monthly/{own}"))


def gold_stream(spark: SparkSession, landing: str, columns: Sequence[str], base: str, checkpoint: str,
                cfg: PanelConfig, max_files_per_trigger: int = 64):
    """Drains the files in ``landing`` (``availableNow``) into the star under ``base``."""
    arrivals = (spark.readStream.format("binaryFile").option("pathGlobFilter", "*.csv")
                .schema("path string, modificationTime timestamp, length long, content binary")
                .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path"))

    def take(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.collect())      # at most max_files_per_trigger
        raw = read_panel_csv(batch.sparkSession, landing, columns, files=files)
        apply_batch(batch.sparkSession, raw, base, batch_id, cfg)

    q = (arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_star(spark: SparkSession, base: str, cfg: PanelConfig) -> gold.Star:
    """The star over all batches so far."""
    base = base.rstrip("/")
    keys = spark.read.parquet(f"{base}/country_keys").select("iso_code", "country_key")
    attributes = gold.latest_attributes(spark.read.parquet(f"{base}/attributes").drop("batch"))
    countries = (keys.withColumnRenamed("iso_code", "_iso")
                 .join(attributes, F.col("_iso").eqNullSafe(F.col("iso_code")), "left").select(*gold.DIM_COUNTRY_COLUMNS))
    dates = gold.date_attributes(spark.read.parquet(f"{base}/date_keys").select("date", "date_key"), cfg)
    fact = spark.read.parquet(f"{base}/fact").select(*gold.FACT_COLUMNS)
    return gold.Star(fact, countries, dates, gold.dim_income(countries, cfg), keys.count(), dates.count())


def read_monthly(spark: SparkSession, base: str) -> DataFrame:
    """Sums per country and month over all batches so far."""
    return (spark.read.parquet(f"{base.rstrip('/')}/monthly").groupBy("country_key", "year", "month")
            .agg(*[F.sum(c).alias(c) for c in MONTHLY]))
