"""The analytic queries as SQL over registered Gold tables, for users who work in ``spark.sql``.

``register_star`` makes the four Gold tables queryable by name (temp views over a ``Star``, or
external tables over written folders, see ``warehouse.register``).  The statements are built here
from the queries' definitions: each first reduces the fact to one row per key (and month), and only
then brings in names, which is also how ``queries`` plans them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.gold import Star

TABLES = ("fact_covid_cases", "dim_country", "dim_date", "dim_income_group")


def _maxima(figures: dict[str, tuple[str, int | None]], lead: str, k: int, present: str | None = None) -> str:
    """Largest values per entity name; ``figures`` maps an output to (measure, digits or None)."""
    inner = ", ".join(f"max({m}) AS {out}" for out, (m, _) in figures.items())
    outer = ", ".join(f"max({out}) AS {out}" if d is None else f"round(max({out}), {d}) AS {out}"
                      for out, (_, d) in figures.items())
    return (f"WITH per_key AS (SELECT country_key, {inner} FROM {{fact_covid_cases}} "
            + (f"WHERE {present} IS NOT NULL " if present else "") + "GROUP BY country_key) "
            f"SELECT country_name, continent, {outer} FROM per_key JOIN {{dim_country}} USING (country_key) "
            f"GROUP BY ALL ORDER BY {lead} DESC NULLS LAST, country_name, continent LIMIT {k}")


def _sums(by: str, dims: dict[str, str], figures: str, order: str, present: bool = True) -> str:
    """Sums of a fact with the needed dimension columns at hand; ``dims``: table -> key."""
    joins = " ".join(f"JOIN {{{table}}} USING ({key})" for table, key in dims.items())
    return (f"SELECT {by}, {figures} FROM {{fact_covid_cases}} {joins} "
            + ("WHERE new_cases IS NOT NULL " if present else "") + f"GROUP BY ALL ORDER BY {order}")


def _counts() -> str:
    one = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {{{t}}}" for t in TABLES)
    return f"FROM ({one}) SELECT table_name, row_count ORDER BY row_count DESC, table_name"


_COUNTRY, _DATE = {"dim_country": "country_key"}, {"dim_date": "date_key"}
STATEMENTS = {
    "q1_top_countries": _maxima({"total_cases": ("total_cases", None), "total_deaths": ("total_deaths", None),
                                 "cases_per_million": ("cases_per_million_calc", 0)}, "total_cases", 20),
    "q2_monthly_continent": _sums(
        "year, month, continent", _COUNTRY | _DATE,
        "sum(new_cases) AS monthly_new_cases, sum(new_deaths) AS monthly_new_deaths",
        "year NULLS LAST, month NULLS LAST, monthly_new_cases DESC NULLS LAST, continent", present=False),
    "q3_vax_vs_death": _maxima({"max_vax_rate_pct": ("vaccination_rate", 2), "peak_death_rate_pct": ("death_rate", 4),
                                "total_cases": ("total_cases", None)}, "max_vax_rate_pct", 20, "vaccination_rate"),
    "q4_by_wave": _sums(
        "covid_wave", _DATE, "sum(new_cases) AS total_new_cases, sum(new_deaths) AS total_new_deaths, "
        "count(DISTINCT country_key) AS countries_reporting", "total_new_cases DESC NULLS LAST, covid_wave"),
    "q5_peak_icu": _maxima({"peak_icu_patients": ("icu_patients", 0), "peak_hosp_patients": ("hosp_patients", 0),
                            "total_cases": ("total_cases", None)}, "peak_icu_patients", 15, "icu_patients"),
    "q6_by_income": _sums(
        "income_group", {"dim_income_group": "income_key"},
        "count(DISTINCT country_key) AS countries, sum(new_cases) AS total_cases, sum(new_deaths) AS total_deaths, "
        "round(avg(vaccination_rate), 2) AS avg_vax_rate_pct", "total_cases DESC NULLS LAST, income_group"),
    "q7_top_months": _sums(
        "country_name, year, month_name", _COUNTRY | _DATE, "sum(new_cases) AS monthly_cases",
        "monthly_cases DESC NULLS LAST, country_name, year NULLS LAST, month_name LIMIT 20"),
    "q8_row_counts": _counts(),
    "q9_top10": _maxima({"total_cases": ("total_cases", None), "total_deaths": ("total_deaths", None),
                         "peak_death_rate_pct": ("death_rate", None)}, "total_cases", 10),
}


def register_star(star: Star, suffix: str = "") -> None:
    """Session temp views of the star's tables (plus ``suffix``)."""
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name + suffix)


def text(name: str, suffix: str = "") -> str:
    """The statement with its table names (``suffix`` appended, for per-call view names)."""
    return STATEMENTS[name].format(**{t: t + suffix for t in TABLES})


def run(spark: SparkSession, name: str, suffix: str = "") -> DataFrame:
    """Analyse the statement now (views are resolved at this point)."""
    return spark.sql(text(name, suffix))
