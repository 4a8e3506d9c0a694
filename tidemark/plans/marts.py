"""Dashboard and insight marts (M1-M9): the data behind the reference's dashboard panels.

The reference names the panels only; the formulas here are fixed so the oracle can check them.
Each mart first reduces the fact to one row per country (or per group) with partial + final
aggregation, then joins broadcast dimension attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.gold import Star
from tidemark.plans.queries import _country, _date, _income, q3_vax_vs_death


def _per_country(star: Star) -> DataFrame:
    return star.fact.groupBy("country_key").agg(
        F.max("total_cases").alias("max_cases"),
        F.max("total_deaths").alias("max_deaths"),
        F.max("vaccination_rate").alias("max_vax"),
        F.max("cases_per_million_calc").alias("max_cpm"),
    )


def m1_kpis(star: Star) -> DataFrame:
    pc = _per_country(star)
    tc, td = F.sum("max_cases"), F.sum("max_deaths")
    return pc.agg(
        tc.alias("total_cases"),
        td.alias("total_deaths"),
        F.when(tc > 0, F.round(td / tc * 100, 4)).alias("global_death_rate_pct"),
        F.round(F.avg("max_vax"), 2).alias("avg_vaccination_rate_pct"),
        F.count(F.lit(1)).alias("countries"),
    )


def m2_map(star: Star) -> DataFrame:
    pc = _per_country(star).join(_country(star, "iso_code", "country_name"), "country_key")
    return pc.select("iso_code", "country_name",
                     F.round("max_cpm", 2).alias("cases_per_million")) \
        .orderBy(F.col("cases_per_million").desc_nulls_last(), "iso_code")


def m3_daily_trend(star: Star, country: str | None = None) -> DataFrame:
    f = star.fact.join(_country(star, "country_name", "continent"), "country_key")
    if country is not None:
        f = f.where(F.col("country_name") == country)
    f = f.join(_date(star, "date"), "date_key")
    return f.groupBy("date", "continent").agg(F.sum("new_cases").alias("daily_new_cases")) \
        .orderBy("date", "continent")


def m5_scatter(star: Star) -> DataFrame:
    return q3_vax_vs_death(star, k=None)


def m6_vax_death_corr(star: Star) -> DataFrame:
    s = m5_scatter(star)
    return s.agg(F.round(F.corr("max_vax_rate_pct", "peak_death_rate_pct"), 6)
                 .alias("vax_death_corr"), F.count(F.lit(1)).alias("countries"))


def m7_income_vax_ratio(star: Star, low_label: str = "Low Income") -> DataFrame:
    pc = (star.fact.groupBy("income_key").agg(F.max("vaccination_rate").alias("max_vax"))
          .join(_income(star), "income_key"))
    g = pc.groupBy("income_group").agg(
        F.count(F.lit(1)).alias("countries"),
        F.round(F.avg("max_vax"), 2).alias("avg_peak_vax_rate_pct"))
    # the window runs over the grouped rows only (one per income label)
    low = F.max(F.when(F.col("income_group") == low_label, F.col("avg_peak_vax_rate_pct"))) \
        .over(Window.partitionBy())
    return g.withColumn("ratio_to_low", F.round(F.try_divide("avg_peak_vax_rate_pct", low), 2)) \
        .orderBy(F.col("avg_peak_vax_rate_pct").desc_nulls_last(), "income_group")


def m8_wave_death_rate(star: Star) -> DataFrame:
    f = star.fact.join(_date(star, "covid_wave"), "date_key")
    nc, nd = F.sum("new_cases"), F.sum("new_deaths")
    return f.groupBy("covid_wave").agg(
        nc.alias("new_cases"), nd.alias("new_deaths"),
        F.when(nc > 0, F.round(nd / nc * 100, 4)).alias("death_rate_pct"),
    ).orderBy("covid_wave")


def m9_icu_coverage(star: Star) -> DataFrame:
    """Countries with any ICU figure, by continent: reduce to one row per country first (one
    shuffle on the key, partial-aggregated), instead of two distinct counts (an Expand)."""
    per = star.fact.groupBy("country_key").agg(
        F.max(F.col("icu_patients").isNotNull().cast("int")).alias("has_icu"))
    f = per.join(_country(star, "continent"), "country_key")
    return f.groupBy("continent").agg(
        F.count(F.lit(1)).alias("countries"),
        F.sum("has_icu").cast("bigint").alias("countries_with_icu"),
    ).withColumn("icu_coverage_pct",
                 F.round(F.col("countries_with_icu") / F.col("countries") * 100, 2)) \
        .orderBy("continent")
