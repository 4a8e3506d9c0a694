"""Silver -> Gold: the star schema (three dimensions and one fact).

* ``dim_country``: one row per entity.  Attributes are the latest non-null value by date
  (``max_by`` guarded by ``when(attr IS NOT NULL, date)``), so an attribute that changes over time
  cannot multiply fact rows the way a ``DISTINCT`` over all attributes would.
* ``dim_income_group``: one row per entity (the reference's grain), labelled from GDP per capita.
  Its key ranks the same natural key as ``dim_country``, so ``income_key = country_key``.
* ``dim_date``: one row per distinct date (a NULL date keeps its own row and the last key).
* ``fact_covid_cases``: Silver left-joined to the dimension keys.  No broadcast is hinted:
  the planner and AQE broadcast a dimension only when its size in bytes allows it.

Keys come from ``operators.keys.dense_key`` and are deterministic, so a plan that recomputes a
dimension gets the same keys; the pipeline still writes the dimensions first and reads them back
for the fact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import FACT_MEASURES, PanelConfig
from tidemark.functions.metrics import date_label, is_weekend, month_name, threshold_label
from tidemark.operators.keys import dense_key
from tidemark.session import materialize

DIM_COUNTRY_COLUMNS = ("country_key", "iso_code", "country_name", "continent", "population",
                       "median_age", "gdp_per_capita", "human_development_index")
DIM_DATE_COLUMNS = ("date_key", "date", "year", "month", "quarter", "month_name", "is_weekend",
                    "covid_wave")
DIM_INCOME_COLUMNS = ("income_key", "iso_code", "income_group")
FACT_COLUMNS = ("country_key", "date_key", "income_key", *FACT_MEASURES, "ingested_at")


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_country: DataFrame
    dim_date: DataFrame
    dim_income: DataFrame
    country_rows: int
    date_rows: int

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_covid_cases": self.fact, "dim_country": self.dim_country,
                "dim_date": self.dim_date, "dim_income_group": self.dim_income}


NUMERIC_ATTRIBUTES = ("population", "median_age", "gdp_per_capita", "human_development_index")


def partial_attributes(silver: DataFrame) -> DataFrame:
    """Per ``(entity, name, group)``: its last date, and per numeric attribute the value at its latest non-null
    date plus that date.  Partial rows of several loads may be put together by ``latest_attributes``.

    A hash aggregate with fixed-width buffers only: ``max_by`` over a string value would force a sort-based
    aggregate, i.e. a sort of every Silver row."""
    d = F.col("date")

    def guarded(c: str):
        return F.when(F.col(c).isNotNull(), d)

    return silver.groupBy("iso_code", "location", "continent").agg(
        F.max(d).alias("_d"),
        *[F.max_by(F.col(c), guarded(c)).alias(c) for c in NUMERIC_ATTRIBUTES],
        *[F.max(guarded(c)).alias(f"_d_{c}") for c in NUMERIC_ATTRIBUTES],
    )


def latest_attributes(partial: DataFrame) -> DataFrame:
    """One row per entity with its latest non-null attributes, from ``partial_attributes``."""
    return partial.groupBy("iso_code").agg(
        F.max_by("location", F.when(F.col("location").isNotNull(), F.col("_d"))).alias("country_name"),
        F.max_by("continent", F.when(F.col("continent").isNotNull(), F.col("_d"))).alias("continent"),
        *[F.max_by(F.col(c), F.col(f"_d_{c}")).alias(c) for c in NUMERIC_ATTRIBUTES],
    )


def country_attributes(silver: DataFrame, cfg: PanelConfig) -> DataFrame:
    """One row per entity with its latest non-null attributes (D2), in two levels (about one row per entity
    reaches the second)."""
    return latest_attributes(partial_attributes(silver))


def dim_country(silver: DataFrame, cfg: PanelConfig):
    keyed = dense_key(country_attributes(silver, cfg), "iso_code", "country_key", cfg.key_buckets)
    return keyed.df.select(*DIM_COUNTRY_COLUMNS), keyed.rows


def dim_income(dim_country_df: DataFrame, cfg: PanelConfig) -> DataFrame:
    label = threshold_label(F.col("gdp_per_capita"), cfg.income_thresholds, cfg.income_low,
                            cfg.income_unknown)
    return dim_country_df.select(F.col("country_key").alias("income_key"), "iso_code",
                                 label.alias("income_group"))


def date_attributes(dates: DataFrame, cfg: PanelConfig) -> DataFrame:
    d = F.col("date")
    return dates.select(
        "date_key", "date",
        F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        month_name(d).alias("month_name"), is_weekend(d).alias("is_weekend"),
        date_label(d, cfg.wave_dates, cfg.wave_labels, cfg.wave_null_label).alias("covid_wave"),
    )


def dim_date(silver: DataFrame, cfg: PanelConfig):
    keyed = dense_key(silver.select("date").distinct(), "date", "date_key", cfg.key_buckets)
    return date_attributes(keyed.df, cfg), keyed.rows


def fact(silver: DataFrame, dim_country_df: DataFrame, dim_date_df: DataFrame) -> DataFrame:
    """Silver left-joined to the keys; NULL natural keys get NULL foreign keys."""
    ckeys = dim_country_df.select("iso_code", "country_key", F.col("country_key").alias("income_key"))
    dkeys = dim_date_df.select("date", "date_key")
    joined = silver.join(ckeys, on="iso_code", how="left").join(dkeys, on="date", how="left")
    return joined.select(*FACT_COLUMNS)


def build_star(silver: DataFrame, cfg: PanelConfig) -> Star:
    """All four Gold tables.  Silver should already be materialised (written or checkpointed): it is
    scanned once per keyed dimension and once by the fact.  The keyed dimensions are stored once, so
    plans that use one several times read the small copy."""
    dc, crows = dim_country(silver, cfg)
    dd, drows = dim_date(silver, cfg)
    dc, dd = materialize(dc, "dim_country"), materialize(dd, "dim_date")
    return Star(fact(silver, dc, dd), dc, dd, dim_income(dc, cfg), crows, drows)
