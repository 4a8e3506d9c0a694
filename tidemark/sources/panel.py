"""The raw daily panel (Bronze) derived from the TPC-H-style test tables.

One row per (nation, order date) with case-like measures taken from ``lineitem`` quantities,
plus one aggregate ``OWID_<region>`` row per (region, date) that the Silver filters must drop (one region
without a code), and one row per nation without a date.
The definition is the fixture text in FIXTURES.md section 4; this module computes the same rows
with the DataFrame API, planned for scale:

* ``lineitem`` is pre-aggregated per order *before* the join (partial + final aggregate on
  ``l_orderkey``).  The aggregate's output is already hash-partitioned on the order key, so the
  join with ``orders`` re-uses that partitioning and ``lineitem`` is shuffled once, after a
  map-side combine, with five sums instead of its raw columns.
* ``nation`` and ``region`` are tiny fixed tables and are broadcast; ``customer`` grows with the
  data, so its join strategy is left to AQE (it broadcasts only when the runtime size is below
  ``spark.sql.autoBroadcastJoinThreshold``).
* The per-nation and per-region sums come from ONE grouping-sets aggregate over the rows per nation and
  date (an ``Expand`` before the partial aggregate), so the join runs once.
* Running totals are windows partitioned by entity over the *aggregated* rows, whose size is
  bounded by the number of distinct dates, not by the number of line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table

# Fixed values of the panel fixture (FIXTURES.md section 4).
RETURN_FLAG_DEATH = "R"
RETURN_FLAG_ICU = "A"
LINE_STATUS_VACCINATED = "F"
DISCOUNT_NEGATIVE_ABOVE = 0.08
NEGATIVE_FACTOR = -3
VACCINATION_START = "1998-01-01"
POPULATION_NULL_NATION = 7
POPULATION_ZERO_NATION = 11
POPULATION_PER_NATION = 100000.0
GDP_NULL_MODULUS = 5
GDP_PER_NATION = 700.0
ATTRIBUTE_YEAR = 2001               # population and GDP change by so much a year, to their plain value then
POPULATION_PER_YEAR = 100
GDP_PER_YEAR = 10
MEDIAN_AGE_YEAR = 1995
NEGATIVE_DEATHS_DAY = 13
NEGATIVE_SMOOTHED_CASES_DAY = 14
NEGATIVE_SMOOTHED_DEATHS_DAY = 15
NO_SMOOTHED_DEATHS_DAY = 16
LAST_HOSPITAL_DAY = 20
NO_CODE_REGION = 3
ICU_MODULUS = 3
AGGREGATE_PREFIX = "OWID_"
AGGREGATE_CONTINENT_REGION = 0

PANEL_COLUMNS = ("iso_code", "location", "continent", "date", "new_cases", "new_deaths",
                 "total_cases", "total_deaths", "people_vaccinated", "icu_patients", "population",
                 "gdp_per_capita", "new_cases_smoothed", "new_deaths_smoothed",
                 "total_cases_per_million", "new_cases_per_million", "total_deaths_per_million",
                 "new_deaths_per_million", "total_vaccinations", "people_fully_vaccinated",
                 "people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
                 "hosp_patients", "median_age", "aged_65_older", "human_development_index")


def order_measures(lineitem: DataFrame) -> DataFrame:
    """Per-order sums of the five line-item measures (map-side combined)."""
    q = F.col("l_quantity")
    is_r = F.col("l_returnflag") == RETURN_FLAG_DEATH
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(is_r & (F.col("l_discount") > DISCOUNT_NEGATIVE_ABOVE), q * NEGATIVE_FACTOR)
              .otherwise(q)).alias("nc"),
        F.sum(F.when(is_r, q).otherwise(0)).alias("nd"),
        F.sum(F.when(F.col("l_returnflag") == RETURN_FLAG_ICU, q)).alias("icu"),
        F.sum(q).alias("q"),
        F.sum(F.when(F.col("l_linestatus") == LINE_STATUS_VACCINATED, q).otherwise(0)).alias("f"),
    )


def _per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_returnflag",
                    "l_discount", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    per_order = order_measures(li)
    per_nation = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date("o_orderdate").alias("d"))
        .agg(*[F.sum(c).alias(c) for c in ("nc", "nd", "icu", "q", "f")]))
    # names come in only now, over one row per nation and date
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return per_nation.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))


NATION_DATE, NATION, REGION_DATE = 0, 1, 24       # grouping ids of ``daily_sums``


def daily_sums(per_nation: DataFrame) -> DataFrame:
    """Per (nation, date), per nation and per (region, date) sums by grouping sets over the rows per nation and
    date, so neither the join nor the large aggregate sees a row twice; ``gid`` tells them apart."""
    keys = ("n_nationkey", "n_name", "r_regionkey", "r_name", "d")
    return per_nation.groupingSets(
        [list(keys), list(keys[:4]), ["r_regionkey", "r_name", "d"]], *keys,
    ).agg(
        F.sum("nc").alias("nc"), F.sum("nd").alias("nd"), F.sum("icu").alias("icu"),
        F.sum("q").alias("q"), F.sum("f").alias("f"), F.grouping_id().alias("gid"),
    )


def panel_from_daily(daily: DataFrame) -> DataFrame:
    """Entity rows (with running totals; without a date: an entity's totals) and per-region aggregate rows from
    ``daily_sums``."""
    nk, q, nd, d = F.col("n_nationkey"), F.col("q"), F.col("nd"), F.col("d")
    ent = F.col("gid") != REGION_DATE
    run = (Window.partitionBy("gid", "n_name").orderBy("d")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    null = F.lit(None).cast("double")

    def pick(entity_value, region_value):
        return F.when(ent, entity_value).otherwise(region_value)

    def day(k: int):
        return F.day(d) == k

    base = daily.select(
        pick(F.col("n_name"), F.when(F.col("r_regionkey") != NO_CODE_REGION, F.concat(F.lit(AGGREGATE_PREFIX), F.col("r_name"))))
        .alias("iso_code"),
        pick(F.col("n_name"), F.col("r_name")).alias("location"),
        pick(F.col("r_name"),
             F.when(F.col("r_regionkey").isin(AGGREGATE_CONTINENT_REGION, NO_CODE_REGION), F.col("r_name")))
        .alias("continent"),
        d.alias("date"),
        pick(F.col("nc"), q).alias("new_cases"),
        pick(F.when(day(NEGATIVE_DEATHS_DAY), -nd).otherwise(nd), F.lit(0.0)).alias("new_deaths"),
        pick(F.sum("q").over(run), q).alias("total_cases"),
        pick(F.sum("nd").over(run), F.lit(0.0)).alias("total_deaths"),
        pick(F.when(d >= F.lit(VACCINATION_START).cast("date"), F.sum("f").over(run)),
             null).alias("people_vaccinated"),
        pick(F.when(nk % ICU_MODULUS == 0, F.col("icu")), null).alias("icu_patients"),
        pick(F.when(nk == POPULATION_NULL_NATION, null)
             .when(nk == POPULATION_ZERO_NATION, F.lit(0.0))
             .otherwise(F.lit(POPULATION_PER_NATION) * (nk + 1) + POPULATION_PER_YEAR * (F.year(d) - ATTRIBUTE_YEAR)),
             F.lit(1.0)).alias("population"),
        pick(F.when(nk % GDP_NULL_MODULUS == 0, null)
             .otherwise(F.lit(GDP_PER_NATION) * nk + GDP_PER_YEAR * (F.year(d) - ATTRIBUTE_YEAR)), null).alias("gdp_per_capita"),
        pick(F.when(day(NEGATIVE_SMOOTHED_CASES_DAY), -q).otherwise(F.col("nc")) / 8, null).alias("new_cases_smoothed"),
        pick(F.when(day(NEGATIVE_SMOOTHED_DEATHS_DAY), -q).when(day(NO_SMOOTHED_DEATHS_DAY), null).otherwise(nd) / 8, null)
        .alias("new_deaths_smoothed"),
        pick(F.when(nk % 4 != 3, F.lit(20.0) + nk + (F.year(d) - MEDIAN_AGE_YEAR) / 2.0), null).alias("median_age"),
        pick(nk / 4.0 + 5, null).alias("aged_65_older"),
        pick(F.when(nk % 6 != 5, nk / 64.0 + 0.5), null).alias("human_development_index"),
        ent.alias("_entity"),
    )
    people = F.when(F.col("_entity"), F.nullif(F.col("population"), F.lit(0.0)))
    vaccinated = F.col("people_vaccinated")
    fully = F.floor(vaccinated / 2).cast("double")
    return base.withColumns({
        **{f"{c}_per_million": F.col(c) * 1_000_000 / people for c in ("total_cases", "new_cases", "total_deaths", "new_deaths")},
        "total_vaccinations": vaccinated * 2.5, "people_fully_vaccinated": fully,
        "people_vaccinated_per_hundred": vaccinated * 100 / people,
        "people_fully_vaccinated_per_hundred": fully * 100 / people,
        "hosp_patients": F.when(F.day("date") <= LAST_HOSPITAL_DAY, F.col("icu_patients") * 3),
    }).select(*PANEL_COLUMNS)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw panel (Bronze equivalent) over the tables in ``sf_dir``."""
    return panel_from_daily(daily_sums(_per_nation(spark, sf_dir)))
