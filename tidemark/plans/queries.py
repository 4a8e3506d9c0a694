"""The reference's analytic queries (Q1-Q9) and the per-country best month (W2) over a star.

Every query joins the fact, or the fact reduced to one row per key, to dimensions (which the planner
broadcasts when their bytes allow it) and aggregates with partial + final hash aggregation.  Ordered results put NULLs last and break ties
on the entity name so ``LIMIT`` is deterministic; ``orderBy(...).limit(k)`` plans as
``TakeOrderedAndProject`` (per-partition top-k, no full sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.gold import Star


def _country(star: Star, *cols: str) -> DataFrame:
    return star.dim_country.select("country_key", *cols)


def _date(star: Star, *cols: str) -> DataFrame:
    return star.dim_date.select("date_key", *cols)


def _income(star: Star) -> DataFrame:
    return star.dim_income.select("income_key", "income_group")


def _entity_maxima(star: Star, figures: dict[str, tuple[str, int | None]], lead: str, k: int | None,
                   present: str | None = None) -> DataFrame:
    """Largest values per entity name: ``figures`` maps an output to (measure, digits or None).

    The fact is reduced to one row per key first (partial aggregation, one number as the group),
    so names are joined to and grouped over one row per entity, not over every fact row."""
    fact = star.fact.where(F.col(present).isNotNull()) if present else star.fact
    per_key = fact.groupBy("country_key").agg(*[F.max(m).alias(out) for out, (m, _) in figures.items()])
    named = per_key.join(_country(star, "country_name", "continent"), "country_key")
    tops = [(F.max(out) if digits is None else F.round(F.max(out), digits)).alias(out)
            for out, (_, digits) in figures.items()]
    ranked = (named.groupBy("country_name", "continent").agg(*tops)
              .orderBy(F.col(lead).desc_nulls_last(), "country_name", "continent"))
    return ranked if k is None else ranked.limit(k)


def q1_top_countries(star: Star, k: int = 20) -> DataFrame:
    return _entity_maxima(star, {"total_cases": ("total_cases", None), "total_deaths": ("total_deaths", None),
                                 "cases_per_million": ("cases_per_million_calc", 0)}, "total_cases", k)


def q2_monthly_continent(star: Star) -> DataFrame:
    f = (star.fact.join(_country(star, "continent"), "country_key")
         .join(_date(star, "year", "month"), "date_key"))
    agg = f.groupBy("year", "month", "continent").agg(
        F.sum("new_cases").alias("monthly_new_cases"),
        F.sum("new_deaths").alias("monthly_new_deaths"),
    )
    return agg.orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last(),
                       F.col("monthly_new_cases").desc_nulls_last(),
                       F.col("continent").asc_nulls_last())


def q3_vax_vs_death(star: Star, k: int | None = 20) -> DataFrame:
    return _entity_maxima(star, {"max_vax_rate_pct": ("vaccination_rate", 2), "peak_death_rate_pct": ("death_rate", 4),
                                 "total_cases": ("total_cases", None)}, "max_vax_rate_pct", k, "vaccination_rate")


def q4_by_wave(star: Star) -> DataFrame:
    f = (star.fact.where(F.col("new_cases").isNotNull())
         .join(_date(star, "covid_wave"), "date_key"))
    agg = f.groupBy("covid_wave").agg(
        F.sum("new_cases").alias("total_new_cases"),
        F.sum("new_deaths").alias("total_new_deaths"),
        F.count_distinct("country_key").alias("countries_reporting"),
    )
    return agg.orderBy(F.col("total_new_cases").desc_nulls_last(), "covid_wave")


def q5_peak_icu(star: Star, k: int = 15) -> DataFrame:
    return _entity_maxima(star, {"peak_icu_patients": ("icu_patients", 0), "peak_hosp_patients": ("hosp_patients", 0),
                                 "total_cases": ("total_cases", None)}, "peak_icu_patients", k, "icu_patients")


def q6_by_income(star: Star) -> DataFrame:
    f = star.fact.where(F.col("new_cases").isNotNull()).join(_income(star), "income_key")
    agg = f.groupBy("income_group").agg(
        F.count_distinct("country_key").alias("countries"),
        F.sum("new_cases").alias("total_cases"),
        F.sum("new_deaths").alias("total_deaths"),
        F.round(F.avg("vaccination_rate"), 2).alias("avg_vax_rate_pct"),
    )
    return agg.orderBy(F.col("total_cases").desc_nulls_last(), "income_group")


def _country_month(star: Star) -> DataFrame:
    f = (star.fact.where(F.col("new_cases").isNotNull())
         .join(_country(star, "country_name"), "country_key")
         .join(_date(star, "year", "month", "month_name"), "date_key"))
    return f.groupBy("country_name", "year", "month_name").agg(
        F.sum("new_cases").alias("monthly_cases"))


def q7_top_months(star: Star, k: int = 20) -> DataFrame:
    return _country_month(star).orderBy(
        F.col("monthly_cases").desc_nulls_last(), "country_name", F.col("year").asc_nulls_last(),
        "month_name").limit(k)


def q7b_best_month(star: Star) -> DataFrame:
    """Per-country best month (the title of Q7): one row per country; ties -> earliest."""
    cm = _country_month(star)
    w = Window.partitionBy("country_name").orderBy(
        F.col("monthly_cases").desc_nulls_last(), F.col("year").asc_nulls_last(), "month_name")
    return (cm.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn")
            .orderBy(F.col("monthly_cases").desc_nulls_last(), "country_name"))


def q8_row_counts(star: Star) -> DataFrame:
    parts = [star.fact.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit("fact_covid_cases").alias("table_name"), "row_count")]
    for name, df in (("dim_country", star.dim_country), ("dim_date", star.dim_date),
                     ("dim_income_group", star.dim_income)):
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.col("row_count").desc(), "table_name")


def q9_top10(star: Star, k: int = 10) -> DataFrame:
    return _entity_maxima(star, {"total_cases": ("total_cases", None), "total_deaths": ("total_deaths", None),
                                 "peak_death_rate_pct": ("death_rate", None)}, "total_cases", k)
