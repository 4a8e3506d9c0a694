"""Registry entries for sources, sinks, warehouse/layout, pipeline, audit and streaming.

Each entry derives its input from the given tables (the panel or the ``events`` table), writes
it where the feature needs files (a fresh folder under ``spark.checkpoint.dir``), and returns
what the feature reads back, so the oracle can check the round trip.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.config import AUDIT_PROJECT, FACT_MEASURES, default_rules
from tidemark.operators import profile, quality
from tidemark.operators import silver as silver_ops
from tidemark.plans import oracle, pipeline, sql_text, stages, warehouse
from tidemark.plans.catalog import REGISTRY
from tidemark.plans.oracle import QUERY_SQL, sround, with_panel, with_star
from tidemark.sources import files
from tidemark.sources.panel import PANEL_COLUMNS
from tidemark.sources.tables import read_table
from tidemark.streaming import audit
from tidemark.streaming.silver_stream import silver_stream

CFG = stages.TABLE_CONFIG
SILVER_NO_STAMP = [c for c in oracle.SILVER_COLUMNS if c != "ingested_at"]
SILVER_SQL = with_panel(f"SELECT {', '.join(SILVER_NO_STAMP)} FROM silver")


def reg(name, sql=None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _landing_csv(spark, sf_dir, df=None, partition_by=()):
    path = stages.scratch(spark, "landing")
    files.write_csv(df if df is not None else stages.bronze(spark, sf_dir), path, partition_by)
    return path


# ---------------------------------------------------------------- sources
@reg("src_csv_silver", SILVER_SQL)
def src_csv_silver(spark, sf_dir):
    """Bronze CSV landing read with the explicit text schema, then Silver."""
    raw = files.read_panel_csv(spark, _landing_csv(spark, sf_dir), PANEL_COLUMNS)
    return silver_ops.stamp_free(silver_ops.transform(raw, CFG))


def _shuffled_landing(spark, sf_dir):
    """CSV files of three layouts: the declared order, reversed, and with another column in between."""
    path = stages.scratch(spark, "landing_mixed")
    b = stages.materialize(stages.bronze(spark, sf_dir), "bronze")
    part = F.pmod(F.xxhash64("iso_code", "date"), F.lit(3))
    for k, cols in enumerate((PANEL_COLUMNS, PANEL_COLUMNS[::-1],
                              (*PANEL_COLUMNS[5:], "note", *PANEL_COLUMNS[:5]))):
        (b.where(part == k).withColumn("note", F.lit("x, \"y\"")).select(*cols).coalesce(2)
         .write.mode("append").option("header", True).csv(path))
    return path


@reg("src_csv_shuffled_header", SILVER_SQL)
def src_csv_shuffled_header(spark, sf_dir):
    """Files whose headers have the columns in different orders: bound by name, the same Silver."""
    raw = files.read_panel_csv(spark, _shuffled_landing(spark, sf_dir), PANEL_COLUMNS)
    return silver_ops.stamp_free(silver_ops.transform(raw, CFG))


@reg("stream_csv_shuffled_header", SILVER_SQL)
def stream_csv_shuffled_header(spark, sf_dir):
    sink = stages.scratch(spark, "silver_stream")
    silver_stream(spark, _shuffled_landing(spark, sf_dir), PANEL_COLUMNS, sink,
                  stages.scratch(spark, "silver_ckpt"), CFG, max_files_per_trigger=3)
    return silver_ops.stamp_free(spark.read.parquet(sink)).select(*SILVER_NO_STAMP)


@reg("src_partitioned_csv", with_panel(
    "SELECT CAST(year(date) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS row_count "
    "FROM panel GROUP BY 1"))
def src_partitioned_csv(spark, sf_dir):
    """Landing partitioned as ``year=YYYY``; reading the folder discovers the partition column."""
    bronze = stages.bronze(spark, sf_dir).withColumn("year", F.year("date"))
    path = _landing_csv(spark, sf_dir, bronze, ("year",))
    raw = files.read_panel_csv(spark, path, PANEL_COLUMNS)
    return raw.groupBy("year").agg(F.count(F.lit(1)).alias("row_count"))


def _with_bad_dates(spark, sf_dir):
    b = stages.bronze(spark, sf_dir)
    bad = F.concat(F.lit("bad-"), F.col("date").cast("string"))
    return b.withColumn("date", F.when(F.col("new_cases") < 0, bad)
                        .otherwise(F.col("date").cast("string")))


@reg("src_load_errors", with_panel("""
SELECT iso_code, 'date' AS "column", 'bad-' || CAST(date AS VARCHAR) AS raw_value FROM panel
WHERE new_cases < 0 ORDER BY iso_code DESC, raw_value DESC LIMIT 10"""))
def src_load_errors(spark, sf_dir):
    """Latest-10 view of the load-error table (the limit is the feature)."""
    raw = files.read_panel_csv(spark, _landing_csv(spark, sf_dir, _with_bad_dates(spark, sf_dir)),
                               PANEL_COLUMNS, keep_malformed=True)
    return files.load_errors(raw, CFG).orderBy(F.col("iso_code").desc(),
                                               F.col("raw_value").desc()).limit(10)


@reg("src_load_error_counts", with_panel("""
SELECT 'date' AS "column", CAST(count(*) AS BIGINT) AS errors FROM panel WHERE new_cases < 0"""))
def src_load_error_counts(spark, sf_dir):
    raw = files.read_panel_csv(spark, _landing_csv(spark, sf_dir, _with_bad_dates(spark, sf_dir)),
                               PANEL_COLUMNS, keep_malformed=True)
    return files.load_errors(raw, CFG).groupBy("column").agg(F.count(F.lit(1)).alias("errors"))


# ---------------------------------------------------------------- sinks
@reg("sink_parquet_roundtrip", SILVER_SQL)
def sink_parquet_roundtrip(spark, sf_dir):
    path = stages.scratch(spark, "silver")
    files.write_layer(stages.silver(spark, sf_dir), path, partition_by=("record_year",))
    back = files.read_layer(spark, path)
    return silver_ops.stamp_free(back).select(*SILVER_NO_STAMP)


PIPELINE_COUNTS_SQL = with_star("""
SELECT stage, row_count FROM (
  SELECT 1 AS pos, 'raw_rows' AS stage, CAST(count(*) AS BIGINT) AS row_count FROM panel
  UNION ALL SELECT 2, 'silver_rows', count(*) FROM silver
  UNION ALL SELECT 3, 'fact_rows', count(*) FROM fact_covid_cases
  UNION ALL SELECT 4, 'dim_country_rows', count(*) FROM dim_country
  UNION ALL SELECT 5, 'dim_date_rows', count(*) FROM dim_date
  UNION ALL SELECT 6, 'dim_income_rows', count(*) FROM dim_income_group) t ORDER BY pos""")


@reg("pipeline_counts", PIPELINE_COUNTS_SQL)
def pipeline_counts(spark, sf_dir):
    """Counts observed by the batch pipeline (one scan per layer, no separate count jobs)."""
    res = pipeline.run(stages.bronze(spark, sf_dir), stages.scratch(spark, "run"), CFG, gate=False)
    order = ["raw_rows", "silver_rows", "fact_rows", "dim_country_rows", "dim_date_rows",
             "dim_income_rows"]
    return spark.createDataFrame([(k, int(res.counts[k])) for k in order],
                                 "stage string, row_count bigint")


@reg("sink_star_roundtrip", with_star(
    f"SELECT country_key, date_key, income_key, {', '.join(FACT_MEASURES)} FROM fact_covid_cases"))
def sink_star_roundtrip(spark, sf_dir):
    """Pipeline Gold sink read back: the stored fact (keys from the stored dimensions)."""
    res = pipeline.run(stages.bronze(spark, sf_dir), stages.scratch(spark, "run"), CFG, gate=False)
    return spark.read.parquet(res.gold_paths["fact_covid_cases"]).drop("ingested_at")


# ---------------------------------------------------------------- warehouse, layout
@reg("wh_load_counts", QUERY_SQL["q8_row_counts"])
def wh_load_counts(spark, sf_dir):
    """Typed DDL + bulk load by name, then the validation row counts from the loaded tables."""
    db = f"tm_wh_{uuid.uuid4().hex[:12]}"
    warehouse.create_star(spark, db, stages.scratch(spark, "warehouse"), fact_buckets=8)
    res = pipeline.run(stages.bronze(spark, sf_dir), stages.scratch(spark, "run"), CFG, gate=False)
    warehouse.copy_into(spark, res.gold_paths, db)          # COPY ... FORMAT AS PARQUET
    parts = [spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in warehouse.STAR_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.col("row_count").desc(), "table_name")


@reg("layout_fact_scan", with_star("""
SELECT country_key, SUM(new_cases) AS new_cases, CAST(count(*) AS BIGINT) AS days
FROM fact_covid_cases GROUP BY country_key"""))
def layout_fact_scan(spark, sf_dir):
    """Aggregation on the bucket column of the bucketed fact: planned without an Exchange."""
    table = f"tm_fact_{uuid.uuid4().hex[:12]}"
    warehouse.write_fact_bucketed(stages.star(spark, sf_dir).fact, table, buckets=8,
                                  path=stages.scratch(spark, "fact_bucketed"))
    return spark.table(table).groupBy("country_key").agg(
        F.sum("new_cases").alias("new_cases"), F.count(F.lit(1)).alias("days"))


# ---------------------------------------------------------------- arrival audit (ST1-ST3)
def _bucket_case(col: str) -> str:
    parts = " ".join(f"WHEN '{et}' THEN '{b}'" for et, b in audit.EVENT_BUCKETS)
    return f"CASE {col} {parts} END"


AUDIT_REC_SQL = f"""
WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
rec AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_time, {_bucket_case('event_type')} AS bucket,
         CASE WHEN k % 3 = 0 THEN 'raw/' || event_type || '/' || event_id || '.parquet'
              WHEN k % 3 = 1 THEN 'raw/' || event_type || '.v' || k || '/part-' || event_id
              ELSE 'raw/' || event_type || '/' || event_id END AS file_key,
         CASE WHEN k % {audit.NO_SIZE_EVERY} <> 0 THEN CAST(trunc(value * 10000) AS BIGINT) END AS size
  FROM ev WHERE NOT (event_type = 'error' AND event_id % {audit.EMPTY_BODY_EVERY} = 0)),
aud AS (
  SELECT event_time, '{AUDIT_PROJECT}' AS project,
         CASE WHEN contains(bucket, 'bronze') THEN 'BRONZE' WHEN contains(bucket, 'silver') THEN 'SILVER'
              WHEN contains(bucket, 'gold') THEN 'GOLD' ELSE 'UNKNOWN' END AS layer,
         bucket, file_key,
         CASE WHEN contains(file_key, '.') THEN upper(regexp_extract(file_key, '[^.]*$')) ELSE 'UNKNOWN' END AS file_ext,
         CAST(round_even(CAST(CAST(coalesce(size, 0) / 1048576 AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS size_mb,
         'INGESTED' AS status
  FROM rec)
"""


def _audit_rows(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    return audit.from_events(audit.notifications_from_events(ev))


def _damaged(spark, sf_dir):
    """Notifications of which some are cut short and some have lost their storage part."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    body = F.col("body")
    number = F.floor(F.get_json_object(body, "$.Records[0].s3.object.size").cast("long") / 100)
    return audit.notifications_from_events(ev).select(
        F.when(number % 10 == 1, F.substring(body, 1, 40))
        .when(number % 10 == 2, F.lit('{"Records": [{"eventTime": "2020-01-01T00:00:00"}]}'))
        .otherwise(body).alias("body"))


@reg("audit_quarantine", AUDIT_REC_SQL + """
SELECT reason, count(*) AS bodies, CAST(sum(records) AS BIGINT) AS records FROM (
  SELECT CASE size // 100 % 10 WHEN 1 THEN 'malformed' ELSE 'no bucket' END AS reason,
         CASE size // 100 % 10 WHEN 1 THEN 0 ELSE 1 END AS records FROM rec WHERE size // 100 % 10 IN (1, 2)) q GROUP BY ALL""")
def audit_quarantine(spark, sf_dir):
    return audit.quarantine(_damaged(spark, sf_dir)).groupBy("reason").agg(
        F.count(F.lit(1)).alias("bodies"), F.sum("records").alias("records"))


@reg("audit_events_damaged", AUDIT_REC_SQL + """
SELECT layer, count(*) AS files FROM aud JOIN (SELECT file_key AS fk, size FROM rec) r ON r.fk = file_key
WHERE coalesce(size // 100 % 10, 0) NOT IN (1, 2) GROUP BY ALL""")
def audit_events_damaged(spark, sf_dir):
    """The rows that the same notifications still give."""
    return audit.from_events(_damaged(spark, sf_dir)).groupBy("layer").agg(F.count(F.lit(1)).alias("files"))


@reg("audit_events", AUDIT_REC_SQL + "SELECT * FROM aud")
def audit_events(spark, sf_dir):
    return _audit_rows(spark, sf_dir)


@reg("audit_summary", AUDIT_REC_SQL + f"""
SELECT layer, CAST(count(*) AS BIGINT) AS files, {sround('SUM(size_mb)', 2)} AS total_mb
FROM aud GROUP BY layer ORDER BY layer""")
def audit_summary(spark, sf_dir):
    return audit.summary(_audit_rows(spark, sf_dir))


@reg("stream_audit_events", AUDIT_REC_SQL + "SELECT * FROM aud")
def stream_audit_events(spark, sf_dir):
    """Notifications derived from ``events`` land as text files; the audit stream parses them."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    landing = stages.scratch(spark, "notifications")
    audit.notifications_from_events(ev).write.mode("overwrite").text(landing)
    sink = stages.scratch(spark, "audit_events_sink")
    audit.stream_events(spark, landing, sink, stages.scratch(spark, "audit_events_ckpt"))
    return spark.read.parquet(sink)


@reg("stream_audit_summary", AUDIT_REC_SQL + f"""
SELECT layer, CAST(count(*) AS BIGINT) AS files, {sround('SUM(size_mb)', 2)} AS total_mb
FROM aud GROUP BY layer ORDER BY layer""")
def stream_audit_summary(spark, sf_dir):
    """Per-micro-batch reports of the notification stream, rolled up over all batches."""
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    landing = stages.scratch(spark, "notifications")
    audit.notifications_from_events(ev).write.mode("overwrite").text(landing)
    sink, summary = stages.scratch(spark, "audit_rows"), stages.scratch(spark, "audit_summary")
    audit.stream_events(spark, landing, sink, stages.scratch(spark, "audit_ckpt"),
                        summary_sink=summary)
    per_batch = spark.read.parquet(summary)
    return per_batch.groupBy("layer").agg(
        F.sum("files").alias("files"), F.round(F.sum("size_mb_sum"), 2).alias("total_mb")) \
        .orderBy("layer")


@reg("audit_files")
def audit_files(spark, sf_dir):
    """File-driven audit of the given table files (batch listing; rows-only check)."""
    return audit.files_audit(audit.list_files(spark, sf_dir, "*.parquet"), "tm-bronze-landing") \
        .drop("event_time")


@reg("stream_audit_files")
def stream_audit_files(spark, sf_dir):
    """Streaming file audit over a landing folder of CSV parts written from the panel."""
    landing = _landing_csv(spark, sf_dir)
    sink = stages.scratch(spark, "audit_sink")
    audit.stream_files(spark, landing, "tm-bronze-landing", sink,
                       stages.scratch(spark, "audit_ckpt"), "*.csv")
    return spark.read.parquet(sink).drop("event_time")


_FILES_SQL = f"""
SELECT bucket, CASE WHEN contains(bucket, 'bronze') THEN 'BRONZE' WHEN contains(bucket, 'silver') THEN 'SILVER'
                    WHEN contains(bucket, 'gold') THEN 'GOLD' ELSE 'UNKNOWN' END AS layer, 'TXT' AS file_ext,
       CAST(round_even(CAST(bytes / 1048576 AS DECIMAL(38,18)), 2) AS DOUBLE) AS size_mb, 'INGESTED' AS status
FROM (SELECT {_bucket_case('event_type')} AS bucket,
             sum(strlen(event_type || ',' || event_id || ',' || props) + 1) AS bytes FROM events GROUP BY 1) b"""


def _event_files(spark, sf_dir):
    """One text file per bucket folder, its bytes known from the table."""
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "props")
    bucket = F.coalesce(*[F.when(F.col("event_type") == et, b) for et, b in audit.EVENT_BUCKETS])
    path = stages.scratch(spark, "event_files")
    (ev.select(bucket.alias("bucket"), F.concat_ws(",", "event_type", "event_id", "props").alias("value"))
     .repartition("bucket").write.partitionBy("bucket").text(path))
    return path


@reg("audit_files_layers", _FILES_SQL)
def audit_files_layers(spark, sf_dir):
    """Audit of files written from a table: layer from the folder, sizes in real bytes."""
    found = audit.list_files(spark, _event_files(spark, sf_dir), "*.txt")
    return audit.files_audit(found).select("bucket", "layer", "file_ext", "size_mb", "status")


@reg("stream_audit_files_layers", _FILES_SQL)
def stream_audit_files_layers(spark, sf_dir):
    sink = stages.scratch(spark, "audit_sink")
    audit.stream_files(spark, _event_files(spark, sf_dir), None, sink, stages.scratch(spark, "audit_ckpt"), "*.txt")
    return spark.read.parquet(sink).select("bucket", "layer", "file_ext", "size_mb", "status")


# ---------------------------------------------------------------- run times (P13) and the gate (Q19)
_RUN = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


@reg("silver_ingested_at", with_panel(
    "SELECT iso_code, date, '2024-01-02 03:04:05' AS ingested_at FROM silver"))
def silver_ingested_at(spark, sf_dir):
    silver = stages.silver(spark, sf_dir, CFG.with_(run_ts=_RUN))
    utc = F.to_utc_timestamp(F.col("ingested_at"), F.current_timezone())
    return silver.select("iso_code", "date", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


# the panel has rows without a date, so a gate that passes has no rule for it
_LENIENT = tuple(r for r in default_rules(CFG) if r.kind in ("not_null", "unique") and r.columns != ("date",))
_STRICT = default_rules(CFG.with_(row_count_bounds=(1, 2), valid_groups=("ASIA",)))


def _gate_sql(rules):
    return with_panel(f"""SELECT 'STOP' AS outcome, "check" FROM ({oracle.dq_sql(rules, 'silver')}) r WHERE status = 'FAIL'
UNION ALL SELECT 'PASS', NULL WHERE NOT EXISTS (SELECT 1 FROM ({oracle.dq_sql(rules, 'silver')}) r WHERE status = 'FAIL')""")


@reg("dq_gate_pass", _gate_sql(_LENIENT))
def dq_gate_pass(spark, sf_dir):
    return quality.gate_outcome(stages.materialize(stages.silver(spark, sf_dir), "silver"), _LENIENT)


@reg("dq_gate_stop", _gate_sql(_STRICT))
def dq_gate_stop(spark, sf_dir):
    return quality.gate_outcome(stages.materialize(stages.silver(spark, sf_dir), "silver"), _STRICT)


# ---------------------------------------------------------------- streaming Silver (ST4)
@reg("stream_silver", SILVER_SQL)
def stream_silver(spark, sf_dir):
    """Bronze CSV landing -> streaming Silver (availableNow) -> sink read back."""
    landing = _landing_csv(spark, sf_dir)
    sink = stages.scratch(spark, "silver_stream")
    silver_stream(spark, landing, PANEL_COLUMNS, sink, stages.scratch(spark, "silver_ckpt"), CFG)
    return silver_ops.stamp_free(spark.read.parquet(sink)).select(*SILVER_NO_STAMP)



# ---------------------------------------------------------------- SQL text over the catalog
def _sql_entry(qname):
    def run(spark, sf_dir):
        res = pipeline.run(stages.bronze(spark, sf_dir), stages.scratch(spark, "run"), CFG,
                           gate=False)
        suffix = f"_{uuid.uuid4().hex[:12]}"                 # per-call view names
        warehouse.register(spark, res.gold_paths, suffix=suffix)
        return sql_text.run(spark, qname, suffix)
    return run


for _q in ("q1_top_countries", "q2_monthly_continent", "q3_vax_vs_death", "q4_by_wave",
           "q5_peak_icu", "q6_by_income", "q7_top_months", "q8_row_counts", "q9_top10"):
    REGISTRY[f"sql_{_q}"] = (_sql_entry(_q), QUERY_SQL[_q])


# ---------------------------------------------------------------- report sink (S6), inferred read
@reg("dq_report_csv", with_panel(oracle.dq_sql(default_rules(CFG), "silver")))
def dq_report_csv(spark, sf_dir):
    path = stages.scratch(spark, "dq_report")
    rep = quality.evaluate(stages.silver(spark, sf_dir), default_rules(CFG))
    files.write_report(rep, path)
    return spark.read.schema(rep.schema).option("header", True).csv(path)


@reg("e1_shape_csv", with_panel(
    f"SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(PANEL_COLUMNS)} AS BIGINT) AS columns "
    "FROM panel"))
def e1_shape_csv(spark, sf_dir):
    """Profiling read of a raw CSV with schema inference (one extra pass), then the shape."""
    return profile.shape(files.read_any(spark, _landing_csv(spark, sf_dir), "csv", infer=True))
