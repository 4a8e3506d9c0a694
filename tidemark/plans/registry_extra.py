"""Registry entries for Silver/Gold stages, marts, data quality and profiling."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from tidemark.config import FACT_MEASURES, default_rules
from tidemark.operators import profile, quality
from tidemark.operators import silver as silver_ops
from tidemark.operators.keys import dense_key
from tidemark.plans import marts, oracle, stages
from tidemark.plans.catalog import REGISTRY
from tidemark.plans.oracle import sround, with_panel, with_star
from tidemark.sources.tables import read_table

CFG = stages.TABLE_CONFIG
SILVER_NO_STAMP = [c for c in oracle.SILVER_COLUMNS if c != "ingested_at"]


def reg(name, sql=None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _cols(cols):
    return ", ".join(cols)


# ---------------------------------------------------------------- Silver
@reg("silver_filter", with_panel(
    "SELECT iso_code, location, continent, date FROM panel "
    "WHERE continent IS NOT NULL AND NOT starts_with(iso_code, 'OWID_')"))
def silver_filter(spark, sf_dir):
    return silver_ops.drop_aggregates(stages.bronze(spark, sf_dir), CFG) \
        .select("iso_code", "location", "continent", "date")


@reg("silver_full", with_panel(f"SELECT {_cols(SILVER_NO_STAMP)} FROM silver"))
def silver_full(spark, sf_dir):
    return silver_ops.stamp_free(stages.silver(spark, sf_dir))


@reg("silver_floor", with_panel(
    "SELECT iso_code, date, new_cases, new_deaths, new_cases_smoothed, new_deaths_smoothed "
    "FROM silver"))
def silver_floor(spark, sf_dir):
    return stages.silver(spark, sf_dir).select(
        "iso_code", "date", "new_cases", "new_deaths", "new_cases_smoothed", "new_deaths_smoothed")


@reg("silver_rates", with_panel(
    "SELECT iso_code, date, death_rate, vaccination_rate, cases_per_million_calc FROM silver"))
def silver_rates(spark, sf_dir):
    return stages.silver(spark, sf_dir).select(
        "iso_code", "date", "death_rate", "vaccination_rate", "cases_per_million_calc")


@reg("silver_year_month", with_panel(
    "SELECT record_year, record_month, CAST(count(*) AS BIGINT) AS row_count FROM silver "
    "GROUP BY record_year, record_month"))
def silver_year_month(spark, sf_dir):
    return stages.silver(spark, sf_dir).groupBy("record_year", "record_month") \
        .agg(F.count(F.lit(1)).alias("row_count"))


# ---------------------------------------------------------------- Gold
@reg("gold_dim_country", with_star("SELECT * FROM dim_country"))
def gold_dim_country(spark, sf_dir):
    return stages.star(spark, sf_dir).dim_country


@reg("gold_dim_income", with_star("SELECT * FROM dim_income_group"))
def gold_dim_income(spark, sf_dir):
    return stages.star(spark, sf_dir).dim_income


@reg("gold_dim_date", with_star("SELECT * FROM dim_date"))
def gold_dim_date(spark, sf_dir):
    return stages.star(spark, sf_dir).dim_date


@reg("gold_fact", with_star(
    f"SELECT country_key, date_key, income_key, {_cols(FACT_MEASURES)} FROM fact_covid_cases"))
def gold_fact(spark, sf_dir):
    return stages.star(spark, sf_dir).fact.drop("ingested_at")


@reg("gold_surrogate_key", with_panel(
    "SELECT nk, CAST(row_number() OVER (ORDER BY nk NULLS LAST) AS BIGINT) AS row_key FROM "
    "(SELECT DISTINCT iso_code || '|' || CAST(date AS VARCHAR) AS nk FROM silver) k"))
def gold_surrogate_key(spark, sf_dir):
    """Dense key over the (entity, date) grain, in many range buckets; rows without a date share the last key."""
    nk = stages.materialize(
        stages.silver(spark, sf_dir)
        .select(F.concat("iso_code", F.lit("|"), F.col("date").cast("string")).alias("nk"))
        .distinct(), "nk")
    return dense_key(nk, "nk", "row_key", buckets=64).df


# ---------------------------------------------------------------- marts (M1-M9)
def _star(fn):
    return lambda spark, sf_dir: fn(stages.star(spark, sf_dir))


PER_COUNTRY = """per_country AS (
  SELECT country_key, MAX(total_cases) AS max_cases, MAX(total_deaths) AS max_deaths,
         MAX(vaccination_rate) AS max_vax, MAX(cases_per_million_calc) AS max_cpm
  FROM fact_covid_cases GROUP BY country_key)"""


def _with_star_extra(extra: str, body: str) -> str:
    return f"WITH {oracle.star_ctes()},\n{extra}\n{body}"


M_SQL = {
    "m1_kpis": _with_star_extra(PER_COUNTRY, f"""
SELECT SUM(max_cases) AS total_cases, SUM(max_deaths) AS total_deaths,
       CASE WHEN SUM(max_cases) > 0 THEN {sround('SUM(max_deaths) / SUM(max_cases) * 100', 4)} END
         AS global_death_rate_pct,
       {sround('AVG(max_vax)', 2)} AS avg_vaccination_rate_pct, CAST(count(*) AS BIGINT) AS countries
FROM per_country"""),
    "m2_map": _with_star_extra(PER_COUNTRY, f"""
SELECT c.iso_code, c.country_name, {sround('p.max_cpm', 2)} AS cases_per_million
FROM per_country p JOIN dim_country c ON p.country_key = c.country_key
ORDER BY cases_per_million DESC NULLS LAST, c.iso_code"""),
    "m3_daily_trend": oracle.with_names(
        "SELECT date, area AS continent, sum(new_cases) AS daily_new_cases FROM named WHERE date IS NOT NULL GROUP BY ALL"),
    "m5_scatter": oracle.VAX_BY_ENTITY,
    "m6_vax_death_corr": (f"SELECT {sround('corr(max_vax_rate_pct, peak_death_rate_pct)', 6)} AS vax_death_corr, "
                          f"count(*) AS countries FROM ({oracle.VAX_BY_ENTITY}) s"),
    "m7_income_vax_ratio": with_star(f"""
SELECT income_group, countries, avg_peak_vax_rate_pct,
       {sround("avg_peak_vax_rate_pct / NULLIF(MAX(CASE WHEN income_group = 'Low Income' THEN avg_peak_vax_rate_pct END) OVER (), 0)", 2)} AS ratio_to_low
FROM (
  SELECT i.income_group, CAST(count(*) AS BIGINT) AS countries,
         {sround('AVG(p.max_vax)', 2)} AS avg_peak_vax_rate_pct
  FROM (SELECT income_key, MAX(vaccination_rate) AS max_vax FROM fact_covid_cases
        GROUP BY income_key) p
  JOIN dim_income_group i ON p.income_key = i.income_key
  GROUP BY i.income_group) g
ORDER BY avg_peak_vax_rate_pct DESC NULLS LAST, income_group"""),
    "m8_wave_death_rate": with_star(f"""
SELECT d.covid_wave, SUM(f.new_cases) AS new_cases, SUM(f.new_deaths) AS new_deaths,
       CASE WHEN SUM(f.new_cases) > 0 THEN
         {sround('SUM(f.new_deaths) / SUM(f.new_cases) * 100', 4)} END AS death_rate_pct
FROM fact_covid_cases f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.covid_wave ORDER BY d.covid_wave"""),
    "m9_icu_coverage": with_star(f"""
SELECT continent, countries, countries_with_icu,
       {sround('countries_with_icu / countries * 100', 2)} AS icu_coverage_pct FROM (
  SELECT c.continent, CAST(count(*) AS BIGINT) AS countries,
         CAST(SUM(p.has_icu) AS BIGINT) AS countries_with_icu
  FROM (SELECT country_key, MAX(CASE WHEN icu_patients IS NOT NULL THEN 1 ELSE 0 END) AS has_icu
        FROM fact_covid_cases GROUP BY country_key) p
  JOIN dim_country c ON p.country_key = c.country_key
  GROUP BY c.continent) t
ORDER BY continent"""),
}

for _name in M_SQL:
    REGISTRY[_name] = (_star(getattr(marts, _name)), M_SQL[_name])


# ---------------------------------------------------------------- data quality
@reg("dq_report", with_panel(oracle.dq_sql(default_rules(CFG), "silver")))
def dq_report(spark, sf_dir):
    return quality.evaluate(stages.silver(spark, sf_dir), default_rules(CFG))


@reg("dq_unique_lineitem", """
SELECT CAST(count(*) AS BIGINT) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM lineitem
      WHERE l_orderkey IS NOT NULL OR l_linenumber IS NOT NULL
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) g""")
def dq_unique_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return quality.duplicate_groups(li, ["l_orderkey", "l_linenumber"])


@reg("dq_unique_orders", """
SELECT CAST(count(*) AS BIGINT) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL
      GROUP BY o_orderkey HAVING count(*) > 1) g""")
def dq_unique_orders(spark, sf_dir):
    return quality.duplicate_groups(read_table(spark, sf_dir, "orders", "o_orderkey"),
                                    ["o_orderkey"])


@reg("dq_fk_lineitem_orders", """
SELECT CAST(count(*) AS BIGINT) AS orphan_keys FROM (
  SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL) k
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = k.l_orderkey)""")
def dq_fk_lineitem_orders(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey")
    od = read_table(spark, sf_dir, "orders", "o_orderkey")
    return quality.orphans(li, ["l_orderkey"], od, ["o_orderkey"]) \
        .agg(F.count(F.lit(1)).alias("orphan_keys"))


@reg("dq_acctbal_between", oracle.dq_sql(
    [quality.Rule("c_acctbal: >= 0", "between", ("c_acctbal",), 0, 1e12)], "customer"))
def dq_acctbal_between(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", "c_acctbal")
    return quality.evaluate(cust, [quality.Rule("c_acctbal: >= 0", "between", ("c_acctbal",),
                                                0, 1e12)])


CONSTRAINT_SQL = with_star("""
SELECT "constraint", violations FROM (
  SELECT 1 AS pos, 'dim_country.country_key not null' AS "constraint", CAST(count_if(country_key IS NULL) AS BIGINT) AS violations FROM dim_country
  UNION ALL SELECT 2, 'dim_country.country_key unique', CAST(count(*) - count(DISTINCT country_key) AS BIGINT) FROM dim_country
  UNION ALL SELECT 3, 'dim_date.date_key unique', CAST(count(*) - count(DISTINCT date_key) AS BIGINT) FROM dim_date
  UNION ALL SELECT 4, 'dim_income_group.income_key unique', CAST(count(*) - count(DISTINCT income_key) AS BIGINT) FROM dim_income_group
  UNION ALL SELECT 5, 'fact.country_key references dim_country', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT country_key FROM fact_covid_cases WHERE country_key IS NOT NULL) k WHERE country_key NOT IN (SELECT country_key FROM dim_country)
  UNION ALL SELECT 6, 'fact.date_key references dim_date', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT date_key FROM fact_covid_cases WHERE date_key IS NOT NULL) k WHERE date_key NOT IN (SELECT date_key FROM dim_date)
  UNION ALL SELECT 7, 'fact.income_key references dim_income_group', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT income_key FROM fact_covid_cases WHERE income_key IS NOT NULL) k WHERE income_key NOT IN (SELECT income_key FROM dim_income_group)
  UNION ALL SELECT 8, 'dim_country.iso_code varchar(10)', CAST(count_if(length(iso_code) > 10) AS BIGINT) FROM dim_country
  UNION ALL SELECT 9, 'dim_country.country_name varchar(200)', CAST(count_if(length(country_name) > 200) AS BIGINT) FROM dim_country
  UNION ALL SELECT 10, 'dim_country.continent varchar(50)', CAST(count_if(length(continent) > 50) AS BIGINT) FROM dim_country
  UNION ALL SELECT 11, 'dim_date.month_name varchar(20)', CAST(count_if(length(month_name) > 20) AS BIGINT) FROM dim_date
  UNION ALL SELECT 12, 'dim_date.covid_wave varchar(50)', CAST(count_if(length(covid_wave) > 50) AS BIGINT) FROM dim_date
  UNION ALL SELECT 13, 'dim_income_group.iso_code varchar(10)', CAST(count_if(length(iso_code) > 10) AS BIGINT) FROM dim_income_group
  UNION ALL SELECT 14, 'dim_income_group.income_group varchar(30)', CAST(count_if(length(income_group) > 30) AS BIGINT) FROM dim_income_group
  UNION ALL SELECT 15, 'dim_date.date_key not null', count_if(date_key IS NULL) FROM dim_date
  UNION ALL SELECT 16, 'dim_income_group.income_key not null', count_if(income_key IS NULL) FROM dim_income_group
) c ORDER BY pos""")


@reg("dq_constraints", CONSTRAINT_SQL)
def dq_constraints(spark, sf_dir):
    from tidemark.plans.warehouse import constraint_violations
    star = stages.star(spark, sf_dir)
    return constraint_violations(dataclasses.replace(star, fact=stages.materialize(star.fact, "fact")))


# ---------------------------------------------------------------- profiling
def _bronze(fn):
    return lambda spark, sf_dir: fn(stages.bronze(spark, sf_dir))


PANEL_COLS = oracle.PANEL_COLUMNS


def _bround(expr: str, digits: int) -> str:
    return (f"CAST(round_even(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) "
            f"AS DOUBLE)")


def _null_rows_sql() -> str:
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"count(*) AS n FROM panel" for c in PANEL_COLS)


def _unique_rows_sql() -> str:
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count FROM panel"
        for c in PANEL_COLS)


P_SQL = {
    "e1_shape": with_panel(
        f"SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(PANEL_COLS)} AS BIGINT) AS columns "
        "FROM panel"),
    "e4_nulls": with_panel(f"""
SELECT "column", null_count, {_bround('null_count / n * 100', 2)} AS null_pct FROM (
  {_null_rows_sql()}) t WHERE null_count > 0 ORDER BY null_pct DESC, "column" """),
    "e5_coverage": with_panel("""
SELECT CAST(count(DISTINCT location) AS BIGINT) AS unique_locations,
       CAST(count(DISTINCT CASE WHEN continent IS NOT NULL THEN location END) AS BIGINT) AS country_locations
FROM panel"""),
    "e6_date_range": with_panel("""
SELECT min(date) AS earliest, max(date) AS latest,
       CAST(date_diff('day', min(date), max(date)) AS BIGINT) AS days FROM panel"""),
    "e8_value_counts": with_panel("""
SELECT continent, CAST(count(*) AS BIGINT) AS count FROM panel WHERE continent IS NOT NULL
GROUP BY continent ORDER BY count DESC, continent"""),
    "e9_aggregate_names": with_panel("""
SELECT DISTINCT location FROM panel WHERE continent IS NULL AND location IS NOT NULL
ORDER BY location"""),
    "e11_negatives": with_panel("""
SELECT "column", negative_rows FROM (
  SELECT 1 AS pos, 'new_cases' AS "column", CAST(count_if(new_cases < 0) AS BIGINT) AS negative_rows FROM panel
  UNION ALL SELECT 2, 'new_deaths', CAST(count_if(new_deaths < 0) AS BIGINT) FROM panel) t
ORDER BY pos"""),
    "e12_column_profile": with_panel(f"""
SELECT n."column", n.null_count, {_bround('n.null_count / n.n * 100', 2)} AS null_pct,
       u.unique_count
FROM ({_null_rows_sql()}) n JOIN ({_unique_rows_sql()}) u ON n."column" = u."column"
ORDER BY n."column" """),
}


def _describe_sql() -> str:
    cols = [c for c in CFG.describe_columns if c in PANEL_COLS]
    parts = []
    for i, c in enumerate(cols):
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT {i} AS pos, '{c}' AS \"column\", CAST(count({x}) AS BIGINT) AS count, "
            f"{_bround(f'avg({x})', 2)} AS mean, {_bround(f'stddev_samp({x})', 2)} AS std, "
            f"{_bround(f'min({x})', 2)} AS min, "
            f"{_bround(f'quantile_cont({x}, 0.25)', 2)} AS p25, "
            f"{_bround(f'quantile_cont({x}, 0.5)', 2)} AS p50, "
            f"{_bround(f'quantile_cont({x}, 0.75)', 2)} AS p75, "
            f"{_bround(f'max({x})', 2)} AS max FROM panel")
    body = "\n  UNION ALL ".join(parts)
    return with_panel(f"SELECT \"column\", count, mean, std, min, p25, p50, p75, max FROM ({body}) d "
                      f"ORDER BY pos")


P_SQL["e10_describe"] = _describe_sql()

_P_FUN = {
    "e1_shape": profile.shape,
    "e4_nulls": profile.nulls_report,
    "e5_coverage": profile.coverage,
    "e6_date_range": profile.date_range,
    "e8_value_counts": lambda df: profile.value_counts(df, "continent"),
    "e9_aggregate_names": profile.aggregate_names,
    "e10_describe": lambda df: profile.describe(df, CFG.describe_columns),
    "e11_negatives": lambda df: profile.negative_counts(df, CFG.negative_check_columns),
    "e12_column_profile": profile.column_profile,
}
for _name, _fn in _P_FUN.items():
    REGISTRY[_name] = (_bronze(_fn), P_SQL[_name])

_SPARK_TYPES = " ".join(f"WHEN '{duck.upper()}' THEN '{name}'" for name, duck in oracle.DUCKDB_TYPE_NAMES.items())
REGISTRY["e2_schema"] = (_bronze(profile.schema_table), f"""
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name AS "column", CASE column_type {_SPARK_TYPES} END AS dtype
FROM (DESCRIBE {with_panel('SELECT * FROM panel')}) d""")



# ---------------------------------------------------------------- generic profile / DQ on other tables
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _doc_profile_sql() -> str:
    nulls = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
        f"count(*) AS n, CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count FROM documents"
        for c in DOC_COLUMNS)
    return (f"SELECT \"column\", null_count, {_bround('null_count / n * 100', 2)} AS null_pct, "
            f"unique_count FROM ({nulls}) t ORDER BY \"column\"")


@reg("e12_profile_documents", _doc_profile_sql())
def e12_profile_documents(spark, sf_dir):
    """Column profile of the whole ``documents`` table (exact distinct counts of full texts)."""
    return profile.column_profile(read_table(spark, sf_dir, "documents", *DOC_COLUMNS))


LABEL_RULES = (
    quality.Rule("doc_id: no nulls", "not_null", ("doc_id",)),
    quality.Rule("quality: 0 or 1", "in_set", ("quality",), values=(0, 1)),
    quality.Rule("toxic: 0 or 1", "in_set", ("toxic",), values=(0, 1)),
    quality.Rule("doc_id: unique", "unique", ("doc_id",)),
    quality.Rule("quality: int", "type", ("quality",), dtype="int"),
)


@reg("dq_labels", oracle.dq_sql(LABEL_RULES, "labels"))
def dq_labels(spark, sf_dir):
    return quality.evaluate(spark.read.parquet(f"{sf_dir}/labels.parquet"), LABEL_RULES)


@reg("dq_fk_labels_documents", """
SELECT CAST(count(*) AS BIGINT) AS orphan_keys FROM (
  SELECT DISTINCT doc_id FROM labels WHERE doc_id IS NOT NULL) k
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = k.doc_id)""")
def dq_fk_labels_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    docs = read_table(spark, sf_dir, "documents", "doc_id")
    return quality.orphans(labels, ["doc_id"], docs, ["doc_id"]) \
        .agg(F.count(F.lit(1)).alias("orphan_keys"))
