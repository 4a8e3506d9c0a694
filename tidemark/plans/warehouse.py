"""Warehouse side of the star (S9-S12, S17): typed DDL, bulk load, catalog registration,
physical layout and the constraints a Parquet table does not enforce.

* ``create_star`` declares the four tables with the reference's column types
  (``VARCHAR(n)`` lengths are checked on insert by Spark's store assignment).
* ``load_star`` inserts the Gold tables *by name* (ANSI store assignment checks types).
* ``write_fact_bucketed`` is the counterpart of a distribution key plus a sort key: bucketed by
  ``country_key`` and sorted by ``date_key`` inside each bucket, so a later aggregation or join
  on ``country_key`` reads co-located buckets without an ``Exchange`` and row-group min/max
  statistics on ``date_key`` stay tight.  ``write_fact`` writes rebalanced, sorted Parquet instead,
  which also suits skewed keys.  ``write_dim_bucketed`` and ``join_colocated`` join such a fact without
  any exchange; ``write_fact_clustered`` lays it out along a curve over two keys, so that either prunes.
* ``constraint_violations`` enforces NOT NULL / PRIMARY KEY / FOREIGN KEY / VARCHAR length,
  which Parquet tables accept but do not check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import VARCHAR_LIMITS
from tidemark.operators.gold import Star

DDL = {
    "dim_country": ("country_key BIGINT NOT NULL, iso_code VARCHAR(10) NOT NULL, "
                    "country_name VARCHAR(200), continent VARCHAR(50), population FLOAT, "
                    "median_age FLOAT, gdp_per_capita FLOAT, human_development_index FLOAT"),
    "dim_date": ("date_key BIGINT NOT NULL, date DATE, year INT, month INT, quarter INT, "
                 "month_name VARCHAR(20), is_weekend BOOLEAN, covid_wave VARCHAR(50)"),
    "dim_income_group": ("income_key BIGINT NOT NULL, iso_code VARCHAR(10), "
                         "income_group VARCHAR(30)"),
    "fact_covid_cases": (
        "country_key BIGINT, date_key BIGINT, income_key BIGINT, new_cases FLOAT, "
        "new_deaths FLOAT, total_cases FLOAT, total_deaths FLOAT, new_cases_smoothed FLOAT, "
        "new_deaths_smoothed FLOAT, total_vaccinations FLOAT, people_vaccinated FLOAT, "
        "people_fully_vaccinated FLOAT, people_vaccinated_per_hundred FLOAT, "
        "people_fully_vaccinated_per_hundred FLOAT, icu_patients FLOAT, hosp_patients FLOAT, "
        "death_rate DOUBLE, vaccination_rate DOUBLE, cases_per_million_calc DOUBLE, "
        "ingested_at TIMESTAMP"),
}
STAR_TABLES = ("fact_covid_cases", "dim_country", "dim_date", "dim_income_group")


def create_star(spark: SparkSession, database: str, location: str | None = None,
                fact_buckets: int | None = 64) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for the four tables (Parquet).  With ``fact_buckets`` the
    fact is bucketed by ``country_key`` and sorted by ``date_key``; pass ``None`` when the key is
    skewed to keep a plain table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}"
              + (f" LOCATION '{location}'" if location else ""))
    for name in STAR_TABLES:
        layout = (f" CLUSTERED BY (country_key) SORTED BY (date_key) INTO {fact_buckets} BUCKETS"
                  if name == "fact_covid_cases" and fact_buckets else "")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({DDL[name]}) USING parquet"
                  + layout)


def load_star(star_tables: dict[str, DataFrame], database: str) -> dict[str, int]:
    """Bulk load (overwrite) each Gold table into its typed table by column name; returns the
    row count per table from the written data."""
    counts = {}
    for name in STAR_TABLES:
        df = star_tables[name]
        target = f"{database}.{name}"
        _insert_by_name(df, target)
        counts[name] = df.sparkSession.table(target).count()
    return counts


def copy_into(spark: SparkSession, paths: dict[str, str], database: str) -> dict[str, int]:
    """Bulk load from written Gold Parquet folders (``COPY ... FORMAT AS PARQUET``): each folder
    is read with the target table's schema and inserted by column name."""
    tables = {name: spark.read.schema(spark.table(f"{database}.{name}").schema).parquet(path)
              for name, path in paths.items()}
    return load_star(tables, database)


def _insert_by_name(df: DataFrame, target: str) -> None:
    spark = df.sparkSession
    cols = spark.table(target).columns
    view = f"_tm_load_{target.replace('.', '_')}"
    df.select(*cols).createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {target} BY NAME SELECT * FROM {view}")
    spark.catalog.dropTempView(view)


def register(spark: SparkSession, paths: dict[str, str], database: str | None = None,
             suffix: str = "") -> None:
    """Make written Gold folders queryable by name: external tables in ``database`` or, without
    one, session temp views (``suffix`` gives per-call view names)."""
    for name, path in paths.items():
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet "
                      f"LOCATION '{path}'")
        else:
            spark.read.parquet(path).createOrReplaceTempView(name + suffix)


def write_fact(fact: DataFrame, path: str, table: str | None = None) -> None:
    """The fact layout: clustered by ``country_key`` (REBALANCE: AQE sizes partitions and splits skew)
    and sorted by ``(country_key, date_key)`` in each file.  With ``table`` the folder is also
    registered as an external table, whatever the keys' distribution."""
    (fact.hint("rebalance", "country_key").sortWithinPartitions("country_key", "date_key")
     .write.mode("overwrite").parquet(path))
    if table:
        spark = fact.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")


def write_fact_bucketed(fact: DataFrame, table: str, buckets: int = 64,
                        path: str | None = None) -> None:
    """Bucketed catalog table: a later group-by / join on ``country_key`` needs no Exchange.  The rows
    are dealt to their buckets before the write, so there is one file per bucket.  A bucket is read
    by one task: for keys where one holds a large share of the rows use ``write_fact``."""
    w = (fact.repartition(buckets, "country_key").write.mode("overwrite")
         .bucketBy(buckets, "country_key").sortBy("date_key").format("parquet"))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def write_dim_bucketed(dim: DataFrame, table: str, buckets: int = 64, path: str | None = None,
                       key: str = "country_key") -> None:
    """A dimension in the buckets of ``write_fact_bucketed``, one file a bucket, sorted by its key."""
    w = (dim.repartition(buckets, key).write.mode("overwrite")
         .bucketBy(buckets, key).sortBy(key).format("parquet"))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def join_colocated(spark: SparkSession, fact_table: str, dim_table: str, key: str = "country_key") -> DataFrame:
    """Fact and dimension of equal buckets joined bucket by bucket: no row of either side is exchanged.

    Each bucket is joined by one task.  It suits a dimension that is too large to broadcast; for a small one
    the planner's own choice does as well."""
    return spark.table(fact_table).join(spark.table(dim_table).hint("merge"), key)


def curve_key(columns: Sequence[str], ranges: Sequence[tuple[int, int]], bits: int = 16) -> Column:
    """Place on a Z-order curve: each column's position in its (least, largest) range, bits interleaved.

    NULL and values below the range count as the least, values above as the largest."""
    parts = []
    for c, (low, high) in zip(columns, ranges, strict=True):
        held = F.least(F.greatest(F.coalesce(F.col(c), F.lit(low)), F.lit(low)), F.lit(high)).cast("double")
        parts.append(F.floor((held - low) * (1 << bits) / (high - low + 1)).cast("long"))
    out = F.lit(0).cast("long")
    for i, x in enumerate(parts):
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(x, b).bitwiseAND(1), b * len(parts) + len(parts) - 1 - i))
    return out


def write_fact_clustered(fact: DataFrame, path: str, columns: Sequence[str] = ("country_key", "date_key"),
                         ranges: Sequence[tuple[int, int]] | None = None, files: int | None = None) -> None:
    """The fact along a Z-order curve over ``columns``: files and row groups are narrow in each of them, so a
    predicate on any one prunes, where a sorted layout prunes on its first column alone.

    ``ranges`` of dense keys are known (1 to the dimension's rows); else one aggregate finds them.  Rows are
    range-partitioned by their place on the curve and a row hash, so a hot key spreads over many files."""
    spark = fact.sparkSession
    if ranges is None:
        one = fact.agg(*[f(c) for c in columns for f in (F.min, F.max)]).first()
        ranges = [(one[2 * i] or 0, one[2 * i + 1] or 0) for i in range(len(columns))]
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (fact.withColumn("_place", curve_key(columns, ranges))
     .repartitionByRange(files, "_place", F.xxhash64(*fact.columns)).sortWithinPartitions("_place", *columns).drop("_place")
     .write.mode("overwrite").parquet(path))


def constraint_violations(star: Star) -> DataFrame:
    """``(constraint, violations)`` for the DDL's NOT NULL / PK / FK / VARCHAR rules.

    One aggregate per dimension, and one pass over the fact: its distinct keys, tagged by the table they
    refer to, anti-joined to all dimensions' keys (violations count distinct missing keys).  Pass a star
    read from its stored tables, so that nothing is computed again."""
    spark = star.fact.sparkSession
    dims = {"dim_country": (star.dim_country, "country_key"), "dim_date": (star.dim_date, "date_key"),
            "dim_income_group": (star.dim_income, "income_key")}
    parts = []
    for table, (df, key) in dims.items():
        rules = [(f"{table}.{key} not null", F.count_if(F.col(key).isNull())),
                 (f"{table}.{key} unique", F.count(F.lit(1)) - F.count_distinct(key))]
        rules += [(f"{table}.{col} varchar({n})", F.count_if(F.length(col) > n))
                  for col, n in VARCHAR_LIMITS.get(table, {}).items()]
        one = df.agg(*[v.cast("bigint").alias(f"v{i}") for i, (_, v) in enumerate(rules)])
        parts.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("constraint"), F.col(f"v{i}").alias("violations"))
            for i, (name, _) in enumerate(rules)]))))
    tagged = star.fact.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("dim"), F.col(key).alias("k")) for t, (_, key) in dims.items()])))
    known = None
    for table, (df, key) in dims.items():
        own = df.select(F.lit(table).alias("dim"), F.col(key).alias("k"))
        known = own if known is None else known.unionByName(own)
    missing = (tagged.where(F.col("k").isNotNull()).distinct().join(known, ["dim", "k"], "left_anti")
               .groupBy("dim").agg(F.count(F.lit(1)).alias("v")))
    names = spark.createDataFrame([(t, f"fact.{key} references {t}") for t, (_, key) in dims.items()],
                                  "dim string, constraint string")
    parts.append(names.join(missing, "dim", "left").select("constraint", F.coalesce("v", F.lit(0)).alias("violations")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
