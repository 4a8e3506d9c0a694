"""Registry entries for loads and layouts: co-located joins, two-key clustering, load errors with their place,
enforced loads, keys that persist, Gold on arrival, uniqueness on arrival, repeated notifications."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.config import FACT_MEASURES
from tidemark.operators import keys, profile, stored_profile, uniqueness
from tidemark.plans import enforce, registry_extra, stages, warehouse
from tidemark.plans.oracle import QUERY_SQL, with_panel, with_star
from tidemark.plans.registry_io import AUDIT_REC_SQL, CFG, _landing_csv, reg
from tidemark.sources import load_errors
from tidemark.sources.panel import PANEL_COLUMNS
from tidemark.sources.tables import read_table
from tidemark.streaming import audit, gold_stream


# ---------------------------------------------------------------- layouts
@reg("layout_colocated_join", with_star("""
SELECT country_name, continent, SUM(new_cases) AS new_cases, MAX(total_cases) AS total_cases,
       CAST(count(*) AS BIGINT) AS days
FROM fact_covid_cases f JOIN dim_country c ON f.country_key = c.country_key GROUP BY ALL"""))
def layout_colocated_join(spark, sf_dir):
    """Fact and dimension in equal buckets: joined and aggregated without an Exchange."""
    star, name = stages.star(spark, sf_dir), uuid.uuid4().hex[:12]
    warehouse.write_fact_bucketed(star.fact, f"tm_fact_{name}", 8, stages.scratch(spark, "fact_bucketed"))
    warehouse.write_dim_bucketed(star.dim_country, f"tm_dim_{name}", 8, stages.scratch(spark, "dim_bucketed"))
    joined = warehouse.join_colocated(spark, f"tm_fact_{name}", f"tm_dim_{name}")
    return joined.groupBy("country_key", "country_name", "continent").agg(
        F.sum("new_cases").alias("new_cases"), F.max("total_cases").alias("total_cases"),
        F.count(F.lit(1)).alias("days")).drop("country_key")


@reg("layout_two_keys", with_star("""
SELECT 'country' AS predicate, SUM(new_cases) AS new_cases, CAST(count(*) AS BIGINT) AS row_count
FROM fact_covid_cases WHERE country_key = 3
UNION ALL SELECT 'date', SUM(new_cases), CAST(count(*) AS BIGINT)
FROM fact_covid_cases WHERE date_key BETWEEN 100 AND 120"""))
def layout_two_keys(spark, sf_dir):
    """Two predicates over the fact along a curve: each reads the few files that its key range meets."""
    star, path = stages.star(spark, sf_dir), stages.scratch(spark, "fact_clustered")
    warehouse.write_fact_clustered(star.fact, path, ranges=[(1, star.country_rows), (1, star.date_rows)])
    fact = spark.read.parquet(path)
    one = [fact.where(cond).agg(F.sum("new_cases").alias("new_cases"), F.count(F.lit(1)).alias("row_count"))
           .select(F.lit(name).alias("predicate"), "new_cases", "row_count")
           for name, cond in (("country", F.col("country_key") == 3), ("date", F.col("date_key").between(100, 120)))]
    return one[0].unionByName(one[1])


# ---------------------------------------------------------------- load errors
def _damaged_landing(spark, sf_dir):
    """One CSV file a year, its lines in (code, date) order, some with bad dates, bad numbers or a field too many."""
    b = stages.bronze(spark, sf_dir).where("date IS NOT NULL").withColumn("year", F.year("date"))
    cell = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PANEL_COLUMNS}
    cell["date"] = F.when(F.col("new_cases") < 0, F.concat(F.lit("bad-"), cell["date"])).otherwise(cell["date"])
    cell["total_deaths"] = F.when(F.day("date") == 9, F.lit("n/a")).otherwise(cell["total_deaths"])
    line = F.concat_ws(",", *cell.values(), F.when(F.day("date") == 20, F.lit("extra")))
    rows = b.select("year", F.lit(1).alias("o"), "iso_code", "date", line.alias("value"))
    header = b.select("year").distinct().select("year", F.lit(0).alias("o"), F.lit(None).cast("string").alias("iso_code"),
                                                F.lit(None).cast("date").alias("date"), F.lit(",".join(PANEL_COLUMNS)).alias("value"))
    path = stages.scratch(spark, "landing_damaged")
    (rows.unionByName(header).repartition("year").sortWithinPartitions("year", "o", "iso_code", "date")
     .select("year", "value").write.partitionBy("year").text(path))
    return path


_ERRORS_SQL = """
lines AS (SELECT *, CAST(year(date) AS VARCHAR) AS year, 1 + row_number() OVER (PARTITION BY year(date) ORDER BY iso_code NULLS FIRST, date) AS line
          FROM panel WHERE date IS NOT NULL),
errors AS (
  SELECT year, line, '_line' AS "column", CAST(NULL AS VARCHAR) AS raw_value, 'wrong number of fields' AS reason
  FROM lines WHERE day(date) = 20
  UNION ALL SELECT year, line, 'date', 'bad-' || CAST(date AS VARCHAR), 'not a date' FROM lines
  WHERE new_cases < 0 AND day(date) <> 20
  UNION ALL SELECT year, line, 'total_deaths', 'n/a', 'not a number' FROM lines WHERE day(date) = 9),
timed AS (SELECT *, CASE WHEN year <= '1997' THEN '2024-01-01 06:00:00' ELSE '2024-01-02 06:00:00' END AS load_time FROM errors)
"""
_LOADS = ((("year=199[5-7]",), dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc)),
          (("year=199[89]", "year=20*"), dt.datetime(2024, 1, 2, 6, tzinfo=dt.timezone.utc)))


def _placed(errors):
    """The error table with the file's year for its path, and without the raw text of whole lines."""
    return errors.select(F.regexp_extract("file", r"year=(\d+)", 1).alias("year"), "line", "column",
                         F.when(F.col("column") != "_line", F.col("raw_value")).alias("raw_value"), "reason", "load_time")


def _errors_sql(body):
    return with_panel(f"SELECT * FROM (WITH {_ERRORS_SQL} {body}) answer")


def _recorded(spark, sf_dir):
    landing, base = _damaged_landing(spark, sf_dir), stages.scratch(spark, "load_errors")
    for load, (folders, when) in enumerate(_LOADS):
        load_errors.record_errors(spark, [f"{landing}/{f}" for f in folders], base, CFG, load, when)
    return load_errors.read_errors(spark, base)


@reg("load_error_table", _errors_sql('SELECT year, line, "column", raw_value, reason FROM errors'))
def load_error_table(spark, sf_dir):
    """Every bad cell or line of several files and two loads, with its exact line."""
    return _placed(_recorded(spark, sf_dir)).drop("load_time")


@reg("load_error_latest", _errors_sql('SELECT * FROM timed ORDER BY load_time DESC, year, line, "column" LIMIT 10'))
def load_error_latest(spark, sf_dir):
    """The ten latest load errors by load time (the limit is the report)."""
    utc = F.to_utc_timestamp("load_time", F.current_timezone())
    return _placed(load_errors.latest_errors(_recorded(spark, sf_dir))).withColumn(
        "load_time", F.date_format(utc, "yyyy-MM-dd HH:mm:ss"))


@reg("stream_load_errors", _errors_sql('SELECT year, line, "column", raw_value, reason FROM errors'))
def stream_load_errors(spark, sf_dir):
    """The same table from files taken two at a time as they arrive."""
    base = stages.scratch(spark, "load_errors")
    load_errors.stream_errors(spark, _damaged_landing(spark, sf_dir), base, stages.scratch(spark, "load_errors_ckpt"), CFG,
                              max_files_per_trigger=2, glob="*.txt")
    return _placed(load_errors.read_errors(spark, base)).drop("load_time")


# ---------------------------------------------------------------- enforced load
def _enforced(spark, sf_dir):
    """Two loads: a star with broken rows, then its dimensions once more with one new country."""
    star, base = stages.star(spark, sf_dir), stages.scratch(spark, "warehouse_enforced")
    country, key = stages.materialize(star.dim_country, "dim"), F.col("country_key")
    broken = (country.unionByName(country.where(key % 5 == 0))
              .unionByName(country.where(key % 7 == 0).withColumn("country_key", F.lit(None).cast("long")))
              .unionByName(country.where(key % 11 == 0).withColumns(
                  {"country_key": key + 1000, "iso_code": F.rpad("iso_code", 30, "x")})))
    fact = star.fact.withColumn("country_key", F.when(F.col("date_key") % 13 == 0, key + 100)
                                .when(F.col("date_key") % 17 != 0, key))
    enforce.load_enforced(spark, {"dim_country": broken, "dim_date": star.dim_date, "dim_income_group": star.dim_income,
                                  "fact_covid_cases": fact}, base, 0)
    again = country.unionByName(country.where(key == 1).withColumn("country_key", F.lit(500).cast("long")))
    enforce.load_enforced(spark, {"dim_country": again}, base, 1)
    return base


@reg("wh_enforced_accepted", with_star("""
SELECT 'dim_country' AS table_name, country_key, CAST(count(*) AS BIGINT) AS row_count
FROM (SELECT country_key FROM dim_country UNION ALL SELECT 500) d GROUP BY ALL
UNION ALL SELECT 'fact_covid_cases', CASE WHEN date_key % 17 <> 0 THEN country_key END, CAST(count(*) AS BIGINT)
FROM fact_covid_cases WHERE date_key % 13 <> 0 OR date_key IS NULL GROUP BY ALL
UNION ALL SELECT 'dim_date', NULL, CAST(count(*) AS BIGINT) FROM dim_date
UNION ALL SELECT 'dim_income_group', NULL, CAST(count(*) AS BIGINT) FROM dim_income_group"""))
def wh_enforced_accepted(spark, sf_dir):
    base = _enforced(spark, sf_dir)
    out = None
    for table in ("dim_country", "fact_covid_cases", "dim_date", "dim_income_group"):
        key = F.col("country_key") if table in ("dim_country", "fact_covid_cases") else F.lit(None).cast("long")
        one = (enforce.published(spark, base, table).groupBy(key.alias("country_key"))
               .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias("table_name"), "country_key", "row_count"))
        out = one if out is None else out.unionByName(one)
    return out


@reg("wh_enforced_rejected", with_star("""
SELECT 'dim_country' AS table_name, CAST(0 AS BIGINT) AS load, 'country_key repeated in the load' AS reason, country_key
FROM dim_country WHERE country_key % 5 = 0
UNION ALL SELECT 'dim_country', 0, 'country_key is null', NULL FROM dim_country WHERE country_key % 7 = 0
UNION ALL SELECT 'dim_country', 0, 'iso_code longer than 10', country_key + 1000 FROM dim_country WHERE country_key % 11 = 0
UNION ALL SELECT 'dim_country', 1, 'country_key already stored', country_key FROM dim_country
UNION ALL SELECT 'fact_covid_cases', 0, 'country_key not in dim_country', country_key + 100 FROM fact_covid_cases
WHERE date_key % 13 = 0"""))
def wh_enforced_rejected(spark, sf_dir):
    base = _enforced(spark, sf_dir)
    parts = [enforce.rejected(spark, base, t).select(F.lit(t).alias("table_name"), "load", "reason", "country_key")
             for t in ("dim_country", "fact_covid_cases")]
    return parts[0].unionByName(parts[1])


@reg("wh_load_values", with_star(
    f"SELECT country_key, date_key, income_key, {', '.join(FACT_MEASURES)} FROM fact_covid_cases"))
def wh_load_values(spark, sf_dir):
    """Typed DDL and bulk load: types and values of the loaded fact, read back."""
    db = f"tm_wh_{uuid.uuid4().hex[:12]}"
    warehouse.create_star(spark, db, stages.scratch(spark, "warehouse"), fact_buckets=8)
    warehouse.load_star(stages.star(spark, sf_dir).tables(), db)
    return spark.table(f"{db}.fact_covid_cases").drop("ingested_at")


# ---------------------------------------------------------------- keys that persist
@reg("keys_persistent", """
SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) AS BIGINT) AS customer_key, CAST(0 AS BIGINT) AS load
FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 = 0) a
UNION ALL SELECT c_name, (SELECT count(DISTINCT c_name) FROM customer WHERE c_custkey % 3 = 0) + row_number() OVER (ORDER BY c_name), 1
FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 3 <> 0
      EXCEPT SELECT c_name FROM customer WHERE c_custkey % 3 = 0) b""")
def keys_persistent(spark, sf_dir):
    """Two loads: keys of the first stay, names not seen before get the next ones."""
    names = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    base = stages.scratch(spark, "customer_keys")
    keys.extend_key_map(names.where("c_custkey % 3 = 0").select("c_name").distinct(), base, "c_name", "customer_key", 0)
    return keys.extend_key_map(names.select("c_name").distinct(), base, "c_name", "customer_key", 1)


# ---------------------------------------------------------------- Gold on arrival (ST4, G4)
def _arrived(spark, sf_dir):
    """The star over files taken three at a time; the first batch is then taken once more."""
    base = stages.scratch(spark, "gold_stream")
    landing = _landing_csv(spark, sf_dir, stages.bronze(spark, sf_dir).repartition(8, "date"))
    gold_stream.gold_stream(spark, landing, PANEL_COLUMNS, base, stages.scratch(spark, "gold_ckpt"), CFG, max_files_per_trigger=3)
    raw = spark.read.parquet(f"{base}/silver/batch=0")
    raw = stages.materialize(raw.select(*[c for c in PANEL_COLUMNS if c in raw.columns]), "replay")     # cleaning it again changes nothing
    gold_stream.apply_batch(spark, raw, base, 0, CFG)
    return base


_NAMED_FACT = ", ".join(f"f.{m}" for m in FACT_MEASURES)


@reg("stream_gold_star", with_star(f"""
SELECT c.iso_code, c.country_name, c.continent, i.income_group, d.date, d.covid_wave, {_NAMED_FACT}
FROM fact_covid_cases f LEFT JOIN dim_country c ON f.country_key = c.country_key
LEFT JOIN dim_income_group i ON f.income_key = i.income_key LEFT JOIN dim_date d ON f.date_key = d.date_key"""))
def stream_gold_star(spark, sf_dir):
    """The star kept up by the stream, by natural keys (its own follow the order of arrival)."""
    star = gold_stream.read_star(spark, _arrived(spark, sf_dir), CFG)
    return (star.fact.join(star.dim_country.select("country_key", "iso_code", "country_name", "continent"), "country_key", "left")
            .join(star.dim_income.select("income_key", "income_group"), "income_key", "left")
            .join(star.dim_date.select("date_key", "date", "covid_wave"), "date_key", "left")
            .select("iso_code", "country_name", "continent", "income_group", "date", "covid_wave", *FACT_MEASURES))


@reg("stream_gold_monthly", QUERY_SQL["q2_monthly_continent"])
def stream_gold_monthly(spark, sf_dir):
    """Q2 from the monthly sums that the stream keeps, without the fact."""
    base = _arrived(spark, sf_dir)
    star = gold_stream.read_star(spark, base, CFG)
    return (gold_stream.read_monthly(spark, base).where("year IS NOT NULL").join(star.dim_country.select("country_key", "continent"), "country_key", "left")
            .groupBy("year", "month", "continent").agg(F.sum("new_cases").alias("monthly_new_cases"),
                                                       F.sum("new_deaths").alias("monthly_new_deaths")))


# ---------------------------------------------------------------- uniqueness on arrival (Q14)
@reg("dq_unique_arriving", """
WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
arriving AS (SELECT o_orderkey FROM o WHERE year >= 2000 UNION ALL SELECT o_orderkey FROM o WHERE year < 2000 AND o_orderkey % 97 = 0
             UNION ALL SELECT o_orderkey FROM o WHERE year >= 2000 AND o_orderkey % 89 = 0),
counted AS (SELECT o_orderkey, CAST(count(*) AS BIGINT) AS rows FROM arriving GROUP BY 1)
SELECT o_orderkey, rows, CAST(NULL AS INTEGER) AS year FROM counted WHERE rows > 1
UNION ALL SELECT c.o_orderkey, c.rows, o.year FROM counted c JOIN o ON c.o_orderkey = o.o_orderkey WHERE o.year < 2000""")
def dq_unique_arriving(spark, sf_dir):
    """Arriving order keys against the Bloom filters of the stored years, then only the hits exactly."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").select("o_orderkey", F.year("o_orderdate").alias("year"))
    path = stages.scratch(spark, "stored_keys")
    o.where("year < 2000").write.partitionBy("year").parquet(path)
    stored = spark.read.parquet(path)
    filters = stages.materialize(uniqueness.key_filters(stored, ["o_orderkey"], "year", bits=1 << 20), "key_filters")
    new = o.where("year >= 2000").select("o_orderkey")
    arriving = (new.unionByName(o.where("year < 2000 AND o_orderkey % 97 = 0").select("o_orderkey"))
                .unionByName(new.where("o_orderkey % 89 = 0")))
    return uniqueness.duplicates_on_arrival(arriving, ["o_orderkey"], stored, filters, "year", bits=1 << 20)


# ---------------------------------------------------------------- repeated notifications (S14, ST1)
@reg("stream_audit_once", AUDIT_REC_SQL + "SELECT * FROM aud")
def stream_audit_once(spark, sf_dir):
    """Notifications delivered twice, some in the same file and some later, give one audit row each."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    body, landing = audit.notifications_from_events(ev), stages.scratch(spark, "notifications")
    body.unionByName(body.where(F.xxhash64("body") % 5 == 0)).write.mode("append").text(landing)
    body.where(F.xxhash64("body") % 3 == 0).write.mode("append").text(landing)
    sink = stages.scratch(spark, "audit_once")
    audit.stream_events(spark, landing, sink, stages.scratch(spark, "audit_once_ckpt"), max_files_per_trigger=1,
                        once_within="60 days")
    return spark.read.parquet(sink)


# ---------------------------------------------------------------- profiles kept per file
def _profiled(spark, sf_dir):
    """The panel by year, profiled in two loads; the second reads the files that the first has not seen."""
    path, store = stages.scratch(spark, "panel_files"), stages.scratch(spark, "profile_store")
    b = stages.bronze(spark, sf_dir)
    b.withColumn("year", F.year("date")).repartition("year").write.partitionBy("year").parquet(path)
    part = [f"{path}/year={y}" for y in (1995, 1996, 1997)]
    stored_profile.update_profile(spark.read.schema(b.schema).parquet(*part), store, 0, CFG.describe_columns)
    table = spark.read.schema(b.schema).parquet(path).select(*b.columns)
    stored_profile.update_profile(spark.read.schema(b.schema).parquet(f"{path}/*"), store, 1, CFG.describe_columns)
    return table, stored_profile.read_store(spark, store)


_EXACT = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, TRUE AS distinct_within_error FROM panel"
    for c in PANEL_COLUMNS)


@reg("e12_profile_merged", with_panel(_EXACT))
def e12_profile_merged(spark, sf_dir):
    """NULL counts and distinct estimates merged from the files' sketches; each estimate is held against the
    exact count, within three standard errors (and half a value)."""
    table, stored = _profiled(spark, sf_dir)
    error = 3 * 1.04 / 2 ** (stored_profile.LG_K / 2)
    exact = profile.distinct_counts(table).select("column", F.col("unique_count").alias("exact"))
    return (stored_profile.merged_profile(stored).join(exact, "column").select(
        "column", "null_count", (F.abs(F.col("unique_count") - F.col("exact")) <= F.col("exact") * error + 0.5)
        .alias("distinct_within_error")))


@reg("e10_describe_merged", registry_extra.P_SQL["e10_describe"])
def e10_describe_merged(spark, sf_dir):
    """Moments from the store, quartiles exact with the merged KLL sketches as brackets."""
    return stored_profile.describe_stored(*_profiled(spark, sf_dir), CFG.describe_columns)
