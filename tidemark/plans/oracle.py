"""Independent ANSI-SQL statements (DuckDB dialect) for the correctness gate.

Each statement starts from the fixture panel (FIXTURES.md section 4, the same SQL text that the
DataFrame code in ``sources.panel`` reproduces) and restates Silver, the star and the query in
plain SQL.  Type and rounding conventions are aligned with Spark's:

* Spark ``round(double, n)`` rounds half-up on the shortest decimal text of the double, so the
  oracle rounds ``CAST(CAST(x AS VARCHAR) AS DECIMAL(38,18))``;
* ``year``/``month``/``quarter`` are INTEGER, keys and counts BIGINT;
* DuckDB ``dayofweek`` has Sunday = 0, Saturday = 6;
* NULLs sort last everywhere.
"""

from __future__ import annotations

from tidemark.config import (FACT_MEASURES, FLOAT_METRIC_COLUMNS, NEGATIVE_FLOOR_COLUMNS,
                             SILVER_COLUMNS, PanelConfig)

CFG = PanelConfig.for_tables()

PANEL_SQL = """
SELECT iso_code, location, continent, d AS date, new_cases, new_deaths, total_cases, total_deaths,
       people_vaccinated, icu_patients, population, gdp_per_capita,
       CASE WHEN day(d) = 14 THEN -q ELSE new_cases END / 8 AS new_cases_smoothed,
       CASE WHEN day(d) = 15 THEN -q WHEN day(d) = 16 THEN NULL ELSE r END / 8 AS new_deaths_smoothed,
       total_cases * 1000000 / NULLIF(population, 0) AS total_cases_per_million,
       new_cases * 1000000 / NULLIF(population, 0) AS new_cases_per_million,
       total_deaths * 1000000 / NULLIF(population, 0) AS total_deaths_per_million,
       new_deaths * 1000000 / NULLIF(population, 0) AS new_deaths_per_million,
       people_vaccinated * 2.5e0 AS total_vaccinations, CAST(floor(people_vaccinated / 2) AS DOUBLE) AS people_fully_vaccinated,
       people_vaccinated * 100 / NULLIF(population, 0) AS people_vaccinated_per_hundred,
       CAST(floor(people_vaccinated / 2) AS DOUBLE) * 100 / NULLIF(population, 0) AS people_fully_vaccinated_per_hundred,
       CASE WHEN day(d) <= 20 THEN icu_patients * 3 END AS hosp_patients, median_age, aged_65_older, human_development_index
FROM (
  SELECT iso_code, location, continent, d, new_cases, new_deaths, icu_patients, population, gdp_per_capita,
    q, r, median_age, aged_65_older, human_development_index,
    SUM(q) OVER (PARTITION BY iso_code, d IS NULL ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_cases,
    SUM(r) OVER (PARTITION BY iso_code, d IS NULL ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_deaths,
    CASE WHEN d >= DATE '1998-01-01' THEN
      SUM(f) OVER (PARTITION BY iso_code, d IS NULL ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS people_vaccinated
  FROM (
    SELECT n_name AS iso_code, n_name AS location, r_name AS continent, d, q, r, f, new_cases,
      CASE WHEN day(d) = 13 THEN -r ELSE r END AS new_deaths,
      CASE WHEN n_nationkey % 3 = 0 THEN icu END AS icu_patients,
      CASE WHEN n_nationkey = 7 THEN NULL WHEN n_nationkey = 11 THEN 0e0
           ELSE 100000e0 * (1 + n_nationkey) + 100 * (year(d) - 2001) END AS population,
      CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 700e0 * n_nationkey + 10 * (year(d) - 2001) END AS gdp_per_capita,
      CASE WHEN n_nationkey % 4 <> 3 THEN 20e0 + n_nationkey + (year(d) - 1995) / 2e0 END AS median_age,
      5 + n_nationkey / 4e0 AS aged_65_older,
      CASE WHEN n_nationkey % 6 <> 5 THEN 5e-1 + n_nationkey / 64e0 END AS human_development_index
    FROM (
      SELECT n_name, r_name, n_nationkey, CAST(o_orderdate AS DATE) AS d,
        SUM(CASE WHEN l_returnflag = 'R' AND l_discount > 0.08 THEN -3 * l_quantity ELSE l_quantity END) AS new_cases,
        SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS icu,
        SUM(l_quantity) AS q,
        SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS r,
        SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS f
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey
      GROUP BY GROUPING SETS ((n_name, r_name, n_nationkey, CAST(o_orderdate AS DATE)), (n_name, r_name, n_nationkey))) s) a) b
UNION ALL
SELECT CASE WHEN r_regionkey <> 3 THEN 'OWID_' || r_name END, r_name, CASE WHEN r_regionkey IN (0, 3) THEN r_name END,
       CAST(o_orderdate AS DATE), SUM(l_quantity), 0.0, SUM(l_quantity), 0.0, NULL, NULL, 1.0, NULL,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, r_regionkey, CAST(o_orderdate AS DATE)
"""

PANEL_COLUMNS = ("iso_code", "location", "continent", "date", "new_cases", "new_deaths",
                 "total_cases", "total_deaths", "people_vaccinated", "icu_patients", "population",
                 "gdp_per_capita", "new_cases_smoothed", "new_deaths_smoothed",
                 "total_cases_per_million", "new_cases_per_million", "total_deaths_per_million",
                 "new_deaths_per_million", "total_vaccinations", "people_fully_vaccinated",
                 "people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
                 "hosp_patients", "median_age", "aged_65_older", "human_development_index")


def sround(expr: str, digits: int) -> str:
    """Spark-compatible half-up rounding of a DOUBLE expression, result DOUBLE."""
    return (f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) "
            f"AS DOUBLE)")


def _rate(num: str, den: str, scale: int, digits: int) -> str:
    return (f"CASE WHEN {den} IS NOT NULL AND {den} > 0 THEN "
            f"{sround(f'CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * {scale}', digits)} END")


def silver_select(cfg: PanelConfig = CFG, source: str = "panel") -> str:
    typed = []
    for c in FLOAT_METRIC_COLUMNS:
        if c in PANEL_COLUMNS:
            v = f"CAST({c} AS FLOAT)"
            if c in NEGATIVE_FLOOR_COLUMNS:
                v = f"CAST(CASE WHEN {v} < 0 THEN 0 ELSE {v} END AS FLOAT)"
        else:
            v = "CAST(NULL AS FLOAT)"
        typed.append(f"{v} AS {c}")
    stage = (f"SELECT iso_code, location, continent, TRY_CAST(date AS DATE) AS date, "
             f"{', '.join(typed)} FROM {source} "
             f"WHERE continent IS NOT NULL AND NOT starts_with(iso_code, '{cfg.aggregate_prefix}')")
    derived = {
        "record_year": "CAST(year(date) AS INTEGER)",
        "record_month": "CAST(month(date) AS INTEGER)",
        "death_rate": _rate("total_deaths", "total_cases", 100, 4),
        "vaccination_rate": _rate("people_vaccinated", "population", 100, 2),
        "cases_per_million_calc": _rate("total_cases", "population", 1000000, 2),
    }
    cols = [f"{derived[c]} AS {c}" if c in derived else c
            for c in SILVER_COLUMNS if c != "ingested_at"]
    return f"SELECT {', '.join(cols)} FROM ({stage}) s0"


def _wave_case(col: str, cfg: PanelConfig) -> str:
    parts = [f"WHEN {col} < DATE '{bp}' THEN '{lab}'"
             for bp, lab in zip(cfg.wave_breakpoints, cfg.wave_labels)]
    return f"CASE {' '.join(parts)} ELSE '{cfg.wave_labels[-1]}' END"


def _income_case(col: str, cfg: PanelConfig) -> str:
    parts = [f"WHEN {col} >= {b} THEN '{lab}'" for b, lab in cfg.income_thresholds]
    return (f"CASE {' '.join(parts)} WHEN {col} IS NOT NULL THEN '{cfg.income_low}' "
            f"ELSE '{cfg.income_unknown}' END")


def _latest(c: str) -> str:
    return f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN date END)"


def star_ctes(cfg: PanelConfig = CFG) -> str:
    measures = ", ".join(f"s.{m}" for m in FACT_MEASURES)
    return f"""
panel AS ({PANEL_SQL}),
silver AS ({silver_select(cfg)}),
dim_country AS (
  SELECT CAST(row_number() OVER (ORDER BY iso_code NULLS LAST) AS BIGINT) AS country_key, iso_code,
         {_latest('location')} AS country_name, {_latest('continent')} AS continent,
         {_latest('population')} AS population, {_latest('median_age')} AS median_age,
         {_latest('gdp_per_capita')} AS gdp_per_capita,
         {_latest('human_development_index')} AS human_development_index
  FROM silver GROUP BY iso_code),
dim_income_group AS (
  SELECT country_key AS income_key, iso_code, {_income_case('gdp_per_capita', cfg)} AS income_group
  FROM dim_country),
dim_date AS (
  SELECT CAST(row_number() OVER (ORDER BY date NULLS LAST) AS BIGINT) AS date_key, date,
         CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
         CAST(quarter(date) AS INTEGER) AS quarter, monthname(date) AS month_name,
         dayofweek(date) IN (0, 6) AS is_weekend, {_wave_case('date', cfg)} AS covid_wave
  FROM (SELECT DISTINCT date FROM silver) dd),
fact_covid_cases AS (
  SELECT c.country_key, d.date_key, c.country_key AS income_key, {measures}
  FROM silver s LEFT JOIN dim_country c ON s.iso_code = c.iso_code
                LEFT JOIN dim_date d ON s.date = d.date)
"""


def with_star(body: str, cfg: PanelConfig = CFG) -> str:
    return f"WITH {star_ctes(cfg)}\n{body}"


def with_panel(body: str, cfg: PanelConfig = CFG) -> str:
    return f"WITH panel AS ({PANEL_SQL}),\nsilver AS ({silver_select(cfg)})\n{body}"


# ----------------------------------------------------------------------------------------------
# The analytic answers, computed from Silver alone: no star, no keys, no dimension joins, so they
# are independent of the code they check.  ``names`` holds each entity's latest label and area.  Answers by a
# calendar attribute leave out rows without a date, as those meet no row of the date dimension.
# ----------------------------------------------------------------------------------------------
def with_names(body: str, cfg: PanelConfig = CFG) -> str:
    return with_panel(f"SELECT * FROM (WITH names AS (SELECT iso_code AS code, {_latest('location')} AS label, "
                      f"{_latest('continent')} AS area, {_income_case(_latest('gdp_per_capita'), cfg)} AS income "
                      f"FROM silver GROUP BY iso_code),\n"
                      f"named AS (SELECT * FROM silver INNER JOIN names ON iso_code IS NOT DISTINCT FROM code)\n"
                      f"{body}) answer", cfg)


def entity_maxima(figures: dict[str, tuple[str, int | None]], lead: str, k: int | None,
                  present: str | None = None) -> str:
    """Largest values per label and area: ``figures`` maps an output to (column, digits or None)."""
    tops = [f"{sround(f'max({col})', digits) if digits is not None else f'max({col})'} AS {out}"
            for out, (col, digits) in figures.items()]
    return with_names(
        f"SELECT label AS country_name, area AS continent, {', '.join(tops)} FROM named"
        + (f" WHERE {present} IS NOT NULL" if present else "")
        + f" GROUP BY label, area ORDER BY {lead} DESC NULLS LAST, label, area" + (f" LIMIT {k}" if k else ""))


_VAX = {"max_vax_rate_pct": ("vaccination_rate", 2), "peak_death_rate_pct": ("death_rate", 4),
        "total_cases": ("total_cases", None)}
VAX_BY_ENTITY = entity_maxima(_VAX, "max_vax_rate_pct", None, "vaccination_rate")
_MONTHS = ("SELECT label AS country_name, CAST(year(date) AS INTEGER) AS year, monthname(date) AS month_name, "
           "sum(new_cases) AS monthly_cases FROM named WHERE new_cases IS NOT NULL AND date IS NOT NULL GROUP BY ALL")


def _distinct(column: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {column} FROM silver) u)"


QUERY_SQL = {
    "q1_top_countries": entity_maxima(
        {"total_cases": ("total_cases", None), "total_deaths": ("total_deaths", None),
         "cases_per_million": ("cases_per_million_calc", 0)}, "total_cases", 20),
    "q2_monthly_continent": with_names(
        "SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, area AS continent, "
        "sum(new_cases) AS monthly_new_cases, sum(new_deaths) AS monthly_new_deaths FROM named "
        "WHERE date IS NOT NULL GROUP BY ALL"),
    "q3_vax_vs_death": entity_maxima(_VAX, "max_vax_rate_pct", 20, "vaccination_rate"),
    "q4_by_wave": with_panel(
        f"SELECT {_wave_case('date', CFG)} AS covid_wave, sum(new_cases) AS total_new_cases, "
        "sum(new_deaths) AS total_new_deaths, count(DISTINCT iso_code) AS countries_reporting "
        "FROM silver WHERE new_cases IS NOT NULL AND date IS NOT NULL GROUP BY ALL"),
    "q5_peak_icu": entity_maxima(
        {"peak_icu_patients": ("icu_patients", 0), "peak_hosp_patients": ("hosp_patients", 0),
         "total_cases": ("total_cases", None)}, "peak_icu_patients", 15, "icu_patients"),
    "q6_by_income": with_names(
        "SELECT income AS income_group, count(DISTINCT code) AS countries, sum(new_cases) AS total_cases, "
        f"sum(new_deaths) AS total_deaths, {sround('avg(vaccination_rate)', 2)} AS avg_vax_rate_pct "
        "FROM named WHERE new_cases IS NOT NULL GROUP BY ALL"),
    "q7_top_months": with_names(
        f"{_MONTHS} ORDER BY monthly_cases DESC NULLS LAST, country_name, year NULLS LAST, month_name LIMIT 20"),
    "q7b_best_month": with_names(
        f"SELECT * FROM ({_MONTHS}) m QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY "
        "monthly_cases DESC NULLS LAST, year NULLS LAST, month_name) = 1"),
    "q8_row_counts": with_panel(
        "SELECT unnest(['fact_covid_cases', 'dim_country', 'dim_date', 'dim_income_group']) AS table_name, "
        f"unnest([(SELECT count(*) FROM silver), {_distinct('iso_code')}, {_distinct('date')}, "
        f"{_distinct('iso_code')}]) AS row_count"),
    "q9_top10": entity_maxima(
        {"total_cases": ("total_cases", None), "total_deaths": ("total_deaths", None),
         "peak_death_rate_pct": ("death_rate", None)}, "total_cases", 10),
}


# ----------------------------------------------------------------------------------------------
# Data-quality report in SQL (one SELECT per rule, same columns as ``quality.evaluate``)
# ----------------------------------------------------------------------------------------------
def _q(v) -> str:
    if not isinstance(v, str):
        return str(v)
    return "'" + v.replace("'", "''") + "'"


# Spark simple type names -> DuckDB ``typeof`` names (lower case)
DUCKDB_TYPE_NAMES = {"int": "integer", "bigint": "bigint", "smallint": "smallint",
                     "float": "float", "double": "double", "string": "varchar", "date": "date",
                     "boolean": "boolean", "timestamp": "timestamp with time zone",
                     "timestamp_ntz": "timestamp"}


def dq_sql(rules, source: str) -> str:
    parts = []
    for pos, r in enumerate(rules):
        head = f"SELECT {pos} AS pos, {_q(r.name)} AS \"check\", {_q(r.kind)} AS kind"
        if r.kind == "not_null":
            c = r.columns[0]
            parts.append(f"{head}, CASE WHEN count_if({c} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END"
                         f" AS status, CAST(count_if({c} IS NULL) AS BIGINT) AS unexpected,"
                         f" CAST(count(*) AS BIGINT) AS observed FROM {source}")
        elif r.kind in ("between", "in_set"):
            c = r.columns[0]
            if r.kind == "between":
                bad = f"{c} IS NOT NULL AND NOT ({c} BETWEEN {r.low} AND {r.high})"
            else:
                vals = ", ".join(_q(v) for v in r.values)
                bad = f"{c} IS NOT NULL AND {c} NOT IN ({vals})"
            u, o = f"count_if({bad})", f"count({c})"
            ok = (f"{o} = 0 OR ({o} - {u}) / {o} >= {r.mostly}" if r.mostly < 1.0 else f"{u} = 0")
            parts.append(f"{head}, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status,"
                         f" CAST({u} AS BIGINT) AS unexpected, CAST({o} AS BIGINT) AS observed"
                         f" FROM {source}")
        elif r.kind == "row_count":
            parts.append(f"{head}, CASE WHEN count(*) BETWEEN {r.low} AND {r.high} THEN 'PASS'"
                         f" ELSE 'FAIL' END AS status, CAST(CASE WHEN count(*) BETWEEN {r.low}"
                         f" AND {r.high} THEN 0 ELSE count(*) END AS BIGINT) AS unexpected,"
                         f" CAST(count(*) AS BIGINT) AS observed FROM {source}")
        elif r.kind == "unique":
            keys = ", ".join(r.columns)
            anyk = " OR ".join(f"{k} IS NOT NULL" for k in r.columns)
            parts.append(f"{head}, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,"
                         f" CAST(count(*) AS BIGINT) AS unexpected,"
                         f" CAST(coalesce(sum(n), 0) AS BIGINT) AS observed FROM"
                         f" (SELECT count(*) AS n FROM {source} WHERE {anyk} GROUP BY {keys}"
                         f" HAVING count(*) > 1) g")
        elif r.kind == "type":
            c = r.columns[0]
            t = f"(SELECT lower(typeof({c})) FROM {source} LIMIT 1)"
            want = _q(DUCKDB_TYPE_NAMES.get(r.dtype, r.dtype))
            parts.append(f"{head}, CASE WHEN {t} = {want} THEN 'PASS' ELSE 'FAIL' END"
                         f" AS status, CAST(CASE WHEN {t} = {want} THEN 0 ELSE 1 END AS BIGINT)"
                         f" AS unexpected, CAST(1 AS BIGINT) AS observed")
    union = "\nUNION ALL ".join(parts)
    return f"SELECT \"check\", kind, status, unexpected, observed FROM ({union}) r ORDER BY pos"
