"""Loads that enforce the star's declared constraints, as a warehouse does at load time.

``load_enforced`` splits arriving rows into accepted and rejected ones in one write: a row that the table does not
take has all its reasons in ``reason``, and readers of the table leave it out (a filter on Parquet statistics).  Row rules
(NOT NULL, VARCHAR length) are checked in place.  Primary keys are checked within the load (the least row of a key
stays) and against the keys of earlier loads; foreign keys against the published parents.  Repeated keys are
reduced before they are joined, so a hot key is settled map-side.

``publish`` appends one row a table to the log of a database; readers take what the log names, so they see all of a
load's tables or none, and a load that fails before it leaves nothing behind that anyone reads.  A load that is
published twice counts once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import VARCHAR_LIMITS
from tidemark.session import materialize

PRIMARY_KEYS = {"dim_country": "country_key", "dim_date": "date_key", "dim_income_group": "income_key"}
NOT_NULL = {"dim_country": ("country_key", "iso_code"), "dim_date": ("date_key",), "dim_income_group": ("income_key",)}
FOREIGN_KEYS = {"fact_covid_cases": {"country_key": "dim_country", "date_key": "dim_date",
                                     "income_key": "dim_income_group"}}
LOG_SCHEMA = "load long, table string, path string"


def _log(base: str) -> str:
    return f"{base.rstrip('/')}/published"


def _loads(spark: SparkSession, base: str, table: str) -> dict[int, str]:
    log = spark.read.schema(LOG_SCHEMA).parquet(_log(base)).where(F.col("table") == table)
    return {r["load"]: r["path"] for r in log.select("load", "path").distinct().collect()}       # one a load


def published(spark: SparkSession, base: str, table: str, before: int | None = None) -> DataFrame | None:
    """The accepted rows of all published loads of ``table`` (below ``before``); None before the first."""
    paths = [p for n, p in sorted(_loads(spark, base, table).items()) if before is None or n < before]
    return spark.read.parquet(*paths).where("reason IS NULL").drop("reason") if paths else None


def _has_log(spark: SparkSession, base: str) -> bool:
    from pyspark.errors import AnalysisException
    try:
        spark.read.schema(LOG_SCHEMA).parquet(_log(base))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _row_reasons(table: str, columns: list[str]) -> list[Column]:
    """Rules of single rows; a column that must not be null must be there, others may be missing."""
    out = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in NOT_NULL.get(table, ())]
    return out + [F.when(F.length(c) > n, F.lit(f"{c} longer than {n}"))
                  for c, n in VARCHAR_LIMITS.get(table, {}).items() if c in columns]


def split_rows(rows: DataFrame, table: str, stored: DataFrame | None, parents: Mapping[str, DataFrame | None]) -> DataFrame:
    """``rows`` with ``reason``: NULL for rows that the table takes, else all reasons, joined by ``; ``."""
    cols = rows.columns
    out = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), f"load-{table}")
    reasons = _row_reasons(table, cols)
    pk = PRIMARY_KEYS.get(table)
    if pk:
        least = (out.where(F.col(pk).isNotNull()).groupBy(F.col(pk).alias("_pk"))
                 .agg(F.min_by("_row", F.struct(*[F.col(c).isNull() for c in cols], *cols, "_row")).alias("_least"),
                      F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
        out = out.join(least, F.col(pk) == F.col("_pk"), "left").drop("_pk")
        reasons.append(F.when(F.col("_row") != F.col("_least"), F.lit(f"{pk} repeated in the load")))
        if stored is not None:
            known = stored.select(F.col(pk).alias("_pk"), F.lit(True).alias("_stored"))
            out = out.join(known, F.col(pk) == F.col("_pk"), "left").drop("_pk")
            reasons.append(F.when(F.col("_stored"), F.lit(f"{pk} already stored")))
    for i, (fk, parent) in enumerate(FOREIGN_KEYS.get(table, {}).items()):
        if parents.get(parent) is None:
            reasons.append(F.when(F.col(fk).isNotNull(), F.lit(f"{fk} not in {parent}")))
            continue
        known = parents[parent].select(F.col(PRIMARY_KEYS[parent]).alias(f"_fk{i}"))
        out = out.join(known, F.col(fk) == F.col(f"_fk{i}"), "left")
        reasons.append(F.when(F.col(fk).isNotNull() & F.col(f"_fk{i}").isNull(), F.lit(f"{fk} not in {parent}")))
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return out.select(*cols, F.nullif(reason, F.lit("")).alias("reason"))


def load_enforced(spark: SparkSession, tables: Mapping[str, DataFrame], base: str, load: int) -> dict[str, str]:
    """Loads dimensions, then facts, into ``<base>/load=<n>/<table>``, and publishes them together.  Rows that a table
    takes have no ``reason`` there.  Loads are numbered from 0.  Returns the folder of each table."""
    seen = _has_log(spark, base)
    stored = {t: published(spark, base, t, load) if seen else None for t in PRIMARY_KEYS}
    parents, paths = dict(stored), {}
    for table in sorted(tables, key=lambda t: t in FOREIGN_KEYS):
        paths[table] = f"{base.rstrip('/')}/load={load}/{table}"
        split = split_rows(tables[table], table, stored.get(table), parents)
        split.write.mode("overwrite").parquet(paths[table])
        if table in PRIMARY_KEYS:
            taken = spark.read.schema(split.schema).parquet(paths[table]).where("reason IS NULL").drop("reason")
            parents[table] = taken if stored[table] is None else taken.unionByName(stored[table])
    publish(spark, paths, base, load)
    return paths


def publish(spark: SparkSession, paths: Mapping[str, str], base: str, load: int) -> None:
    """One file, committed at once, names all tables of the load."""
    (spark.createDataFrame([(load, t, p) for t, p in paths.items()], LOG_SCHEMA).coalesce(1)
     .write.mode("append").parquet(_log(base)))


def rejected(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rejected rows of all published loads of ``table``, with ``reason`` and ``load``."""
    parts = [spark.read.parquet(path).where("reason IS NOT NULL").withColumn("load", F.lit(n).cast("long"))
             for n, path in sorted(_loads(spark, base, table).items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
