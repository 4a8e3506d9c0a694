"""Arrival audit (ST1-ST3): object-arrival notifications -> audit rows, batch or streaming.

* ``from_events``: JSON notification bodies -> ``from_json`` with a fixed schema ->
  ``explode(Records)`` (a body without ``Records`` yields no rows) -> one audit row per object.
* ``summary``: files and MB per layer.
* ``stream_files``: the same audit driven by files landing in a folder, with Structured
  Streaming over the ``binaryFile`` source (one row per file; the content column is never
  selected, so it is not read).  The checkpoint records processed files, so a rerun picks up only
  new arrivals; ``availableNow`` processes the backlog and stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import AUDIT_LAYERS, AUDIT_PROJECT, AUDIT_STATUS, AUDIT_UNKNOWN

EVENT_SCHEMA = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("eventTime", T.StringType()),
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
            T.StructField("object", T.StructType([
                T.StructField("key", T.StringType()),
                T.StructField("size", T.LongType()),
            ])),
        ])),
    ]))),
])

BYTES_PER_MB = 1024 * 1024
AUDIT_COLUMNS = ("event_time", "project", "layer", "bucket", "file_key", "file_ext", "size_mb",
                 "status")


def layer_of(bucket: Column) -> Column:
    """First matching substring wins (bronze, then silver, then gold)."""
    expr = None
    for needle, label in AUDIT_LAYERS:
        cond = bucket.contains(needle)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(AUDIT_UNKNOWN)


def file_ext(key: Column) -> Column:
    """Text after the last dot, upper-cased; ``UNKNOWN`` when the key has no dot at all (a dot
    in a directory name counts, as in the reference)."""
    return F.when(key.contains("."), F.upper(F.substring_index(key, ".", -1))) \
        .otherwise(AUDIT_UNKNOWN)


def size_mb(size_bytes: Column) -> Column:
    """Bytes -> MB rounded half-even to 2 places; a missing size counts as 0."""
    return F.bround(F.coalesce(size_bytes, F.lit(0)) / BYTES_PER_MB, 2)


def quarantine(events: DataFrame, body_col: str = "body") -> DataFrame:
    """Bodies that ``from_events`` can take no row from, or not every row: ``(body, reason, records)``.

    ``malformed``: no JSON, or no object; ``no bucket``: ``records`` of its records name no bucket.
    A body without records, as a test notification, is neither."""
    body = F.col(body_col)
    records = F.from_json(body, EVENT_SCHEMA)["Records"]
    unnamed = F.size(F.filter(records, lambda r: r["s3"]["bucket"]["name"].isNull()))
    kind = F.coalesce(F.substring(F.schema_of_variant(F.try_parse_json(body)), 1, 6), F.lit(""))
    reason = F.when(kind != "OBJECT", "malformed").when(unnamed > 0, "no bucket")
    return (events.select(body.alias("body"), reason.alias("reason"),
                          F.when(reason == "no bucket", unnamed).otherwise(0).cast("long").alias("records"))
            .where(F.col("reason").isNotNull()))


def from_events(events: DataFrame, body_col: str = "body",
                with_timestamp: bool = False, project: str = AUDIT_PROJECT) -> DataFrame:
    """One audit row per record that names its bucket; see ``quarantine`` for the others."""
    parsed = events.select(F.from_json(F.col(body_col), EVENT_SCHEMA).alias("ev"))
    rec = parsed.select(F.explode("ev.Records").alias("r")).where(F.col("r.s3.bucket.name").isNotNull())
    cols = [
        F.col("r.eventTime").alias("event_time"),
        F.lit(project).alias("project"),
        layer_of(F.col("r.s3.bucket.name")).alias("layer"),
        F.col("r.s3.bucket.name").alias("bucket"),
        F.col("r.s3.object.key").alias("file_key"),
        file_ext(F.col("r.s3.object.key")).alias("file_ext"),
        size_mb(F.col("r.s3.object.size")).alias("size_mb"),
        F.lit(AUDIT_STATUS).alias("status"),
    ]
    if with_timestamp:
        cols.insert(0, F.current_timestamp().alias("timestamp"))
    return rec.select(*cols)


def summary(audit: DataFrame) -> DataFrame:
    return audit.groupBy("layer").agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.sum("size_mb"), 2).alias("total_mb"),
    ).orderBy("layer")


# ---------------------------------------------------------------------------------------------
# Notifications derived from the test ``events`` table (one notification per event row).
# ---------------------------------------------------------------------------------------------
# Fixed mapping used to turn event rows into storage notifications.
EVENT_BUCKETS = (("view", "tm-bronze-landing"), ("click", "tm-silver-lake"),
                 ("purchase", "tm-gold-marts"), ("signup", "tm-silver-gold"),
                 ("error", "tm-archive"))
EMPTY_BODY_EVERY = 10      # every 10th error event has an empty body ({})
NO_SIZE_EVERY = 7          # events with k % 7 == 0 carry no size


def notifications_from_events(events: DataFrame) -> DataFrame:
    """``body`` JSON strings shaped like storage notifications, built with ``to_json``."""
    k = F.get_json_object("props", "$.k").cast("int")
    bucket = None
    for et, name in EVENT_BUCKETS:
        bucket = (F.when(F.col("event_type") == et, name) if bucket is None
                  else bucket.when(F.col("event_type") == et, name))
    key = (F.when(k % 3 == 0, F.format_string("raw/%s/%d.parquet", "event_type", "event_id"))
           .when(k % 3 == 1, F.format_string("raw/%s.v%d/part-%d", "event_type", k, "event_id"))
           .otherwise(F.format_string("raw/%s/%d", "event_type", "event_id")))
    size = F.when(k % NO_SIZE_EVERY != 0, (F.col("value") * 10000).cast("bigint"))
    obj = F.struct(key.alias("key"), size.alias("size"))
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("eventTime"),
        F.struct(F.struct(bucket.alias("name")).alias("bucket"), obj.alias("object")).alias("s3"))
    body = F.when((F.col("event_type") == "error") & (F.col("event_id") % EMPTY_BODY_EVERY == 0),
                  F.lit("{}")).otherwise(F.to_json(F.struct(F.array(record).alias("Records"))))
    return events.select(body.alias("body"))


# ---------------------------------------------------------------------------------------------
# File-driven audit (ST3)
# ---------------------------------------------------------------------------------------------
BINARY_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def files_audit(files: DataFrame, bucket: str | None = None, project: str = AUDIT_PROJECT) -> DataFrame:
    """Audit rows for ``binaryFile`` rows (path, modificationTime, length).  Without ``bucket`` it is
    the name of the file's folder (of a partition folder ``bucket=x``: ``x``)."""
    place = F.lit(bucket) if bucket else F.regexp_extract("path", r"([^/=]+)/[^/]*$", 1)
    return files.select(
        F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("event_time"),
        F.lit(project).alias("project"),
        layer_of(place).alias("layer"),
        place.alias("bucket"),
        F.col("path").alias("file_key"),
        file_ext(F.col("path")).alias("file_ext"),
        size_mb(F.col("length")).alias("size_mb"),
        F.lit(AUDIT_STATUS).alias("status"),
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Batch listing of a folder (one row per file, content not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
            .select("path", "modificationTime", "length"))


def stream_files(spark: SparkSession, folder: str, bucket: str | None, sink: str, checkpoint: str,
                 glob: str = "*", max_files_per_trigger: int = 10_000):
    """Audit every file arriving in ``folder`` into the Parquet table ``sink``; processes the
    backlog in bounded micro-batches and stops (``availableNow``).  Returns the finished
    ``StreamingQuery``."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
             .option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_trigger)
             .load(folder)
             .select("path", "modificationTime", "length"))
    q = (files_audit(files, bucket).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_events(spark: SparkSession, folder: str, sink: str, checkpoint: str,
                  max_files_per_trigger: int = 10_000, summary_sink: str | None = None,
                  once_within: str | None = None):
    """Event-driven audit as a stream: notification bodies land as text files (one JSON body per
    line); each micro-batch parses and explodes them into audit rows appended to ``sink``.
    Stateless, so no watermark; the checkpoint makes each notification file count once.

    Stores deliver a notification at least once.  With ``once_within`` (as ``7 days``) a record that repeats one of
    the same bucket, key and event time is dropped if it comes within that span of event time; the state
    holds the records of that span only.  Records without a readable time count as of now.

    With ``summary_sink`` every micro-batch also writes its summary (files and MB per layer, the
    per-invocation report of the reference) via ``foreachBatch``.  Both outputs of a batch go to
    ``.../batch_id=<id>`` folders in overwrite mode, so a retried batch replaces its own output
    instead of appending twice."""
    bodies = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
              .load(folder).withColumnRenamed("value", "body"))
    rows = from_events(bodies)
    if once_within is not None:
        at = F.coalesce(F.try_to_timestamp("event_time", F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSS][X]")), F.current_timestamp())
        rows = (rows.withColumn("_at", at).withWatermark("_at", once_within)
                .dropDuplicatesWithinWatermark(["bucket", "file_key", "event_time"]).drop("_at"))
    if summary_sink is None:
        w = rows.writeStream.format("parquet").option("path", sink)
    else:
        def per_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
            done = batch.sparkSession.read.parquet(f"{sink}/batch_id={batch_id}")
            batch_summary(done, batch_id).write.mode("overwrite") \
                .parquet(f"{summary_sink}/batch_id={batch_id}")
        w = rows.writeStream.foreachBatch(per_batch)
    q = w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def batch_summary(audit: DataFrame, batch_id: int) -> DataFrame:
    """One micro-batch's report: files and MB per layer (MB unrounded, for re-aggregation)."""
    return audit.groupBy("layer").agg(F.count(F.lit(1)).alias("files"),
                                      F.sum("size_mb").alias("size_mb_sum")) \
        .withColumn("batch", F.lit(batch_id).cast("bigint"))
