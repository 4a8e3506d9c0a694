"""The load-error table of a CSV load: file, line, column, raw text, reason and load time of every cell or line
that a typed load cannot take.

One pass over the text: Arrow batches get each line's number within its file block (whole columns at a time,
the values are not looked at), Spark parses and checks the fields, and only what failed is written, with the number of lines of each
block.  The lines of a file's earlier blocks then give the number within the file, so the place is exact however
a file was split.  Blank lines count as lines and are no errors.

``record_errors`` writes one load's errors into ``<base>/load=<n>``; a load that is repeated replaces its own.  The
streaming twin takes arriving files in micro-batches and uses the batch id as load.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import PanelConfig
from tidemark.session import materialize
from tidemark.sources.files import CORRUPT_COLUMN, csv_headers

WRONG_FIELDS = "wrong number of fields"
NOT_A_DATE = "not a date"
NOT_A_NUMBER = "not a number"
_LINES = "file string, block long, line long, value string"
_ERRORS = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("line", T.LongType()), T.StructField("column", T.StringType()),
    T.StructField("raw_value", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("load_time", T.TimestampType()), T.StructField("load", T.LongType())])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, value) in file order -> the same with the line number within the block; after each block a
    row without value holds its number of lines."""
    names = ["file", "block", "line", "value"]
    at, lines = None, 0

    def closing() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([lines], pa.int64()),
                                           pa.array([None], pa.string())], names=names)

    for b in batches:
        if not len(b):
            continue
        file, block, value = b.column(0), b.column(1), b.column(2)
        moved = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        starts = [0, *[i + 1 for i in pc.indices_nonzero(moved).to_pylist()], len(b)]
        for a, z in zip(starts, starts[1:]):
            here = (file[a].as_py(), block[a].as_py())
            if at is not None and here != at:
                yield closing()
            if here != at:
                at, lines = here, 0
            number = pa.array(range(lines + 1, lines + z - a + 1), pa.int64())
            yield pa.RecordBatch.from_arrays([file[a:z], block[a:z], number, value[a:z]], names=names)
            lines += z - a
    if at is not None:
        yield closing()


def _checks(header: Sequence[str], cfg: PanelConfig) -> list:
    """One optional (column, raw_value, reason) per typed column of the header."""
    typed = {cfg.date_col: (T.DateType(), NOT_A_DATE)} | {c: (cfg.metric_type, NOT_A_NUMBER) for c in cfg.metric_columns}
    return [F.when(F.col("v")[c].isNotNull() & F.col("v")[c].try_cast(kind).isNull(), F.struct(
        F.lit(c).alias("column"), F.col("v")[c].alias("raw_value"), F.lit(reason).alias("reason")))
        for c, (kind, reason) in typed.items() if c in header]


def find_errors(spark: SparkSession, path: str | Sequence[str], cfg: PanelConfig) -> DataFrame:
    """``(file, line, column, raw_value, reason)`` of the CSV files in ``path``; columns are found by name in each
    file's header.  A line with a wrong number of fields is one error (column ``_line``), and its cells are none."""
    parts = []
    for header, files in sorted(csv_headers(spark, path).items()):
        text = spark.read.text(files).select("_metadata.file_path", "_metadata.file_block_start", "value")
        lines = text.mapInArrow(_number, _LINES)
        # the names of a header may hold anything; positions name the parsed fields
        fields = ", ".join(f"c{i} STRING" for i in range(len(header))) + f", {CORRUPT_COLUMN} STRING"
        parsed = F.from_csv("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
        named = F.struct(*[F.col("p")[f"c{i}"].alias(c) for i, c in enumerate(header)],
                         F.col("p")[CORRUPT_COLUMN].alias(CORRUPT_COLUMN))
        whole = F.struct(F.lit("_line").alias("column"), F.col("value").alias("raw_value"), F.lit(WRONG_FIELDS).alias("reason"))
        cells = F.filter(F.array(*_checks(header, cfg), F.lit(None).cast("struct<column:string,raw_value:string,reason:string>")),
                         lambda x: x.isNotNull())
        is_data = (F.trim("value") != "") & ~((F.col("block") == 0) & (F.col("line") == 1))
        failed = F.when(is_data, F.when(F.col("v")[CORRUPT_COLUMN].isNotNull(), F.array(whole)).otherwise(cells))
        checked = (lines.withColumn("p", parsed).withColumn("v", named)
                   .select("file", "block", "line", F.col("value").isNull().alias("closing"), failed.alias("failed")))
        parts.append(materialize(checked.where("closing OR size(failed) > 0"), "load-errors"))
    if not parts:
        return spark.createDataFrame([], T.StructType(_ERRORS.fields[:5]))
    kept = parts[0]
    for p in parts[1:]:
        kept = kept.unionByName(p)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = (kept.where("closing").groupBy("file", "block").agg(F.max("line").alias("lines"))
             .select("file", "block", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before")))
    return (kept.where("NOT closing").join(first, ["file", "block"])
            .select("file", (F.col("before") + F.col("line")).alias("line"), F.explode("failed").alias("e"))
            .select("file", "line", "e.*"))


def record_errors(spark: SparkSession, path: str | Sequence[str], base: str, cfg: PanelConfig, load: int,
                  load_time: _dt.datetime | None = None) -> None:
    """Adds one load's errors to the table under ``base``."""
    when = F.lit(load_time) if load_time is not None else F.current_timestamp()
    (find_errors(spark, path, cfg).withColumn("load_time", when.cast("timestamp"))
     .write.mode("overwrite").parquet(f"{base.rstrip('/')}/load={load}"))


def read_errors(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(_ERRORS).parquet(base)


def latest_errors(errors: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest errors by load time, then by place (the limit is the report)."""
    return errors.orderBy(F.col("load_time").desc(), "file", "line", "column").limit(n)


def stream_errors(spark: SparkSession, landing: str, base: str, checkpoint: str, cfg: PanelConfig,
                  max_files_per_trigger: int = 64, load_time: _dt.datetime | None = None, glob: str = "*.csv"):
    """Errors of arriving files: the checkpoint records which files were taken, ``availableNow`` drains the backlog
    in micro-batches of at most ``max_files_per_trigger`` files, each batch one load."""
    arrivals = (spark.readStream.format("binaryFile").option("pathGlobFilter", glob)
                .schema("path string, modificationTime timestamp, length long, content binary")
                .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path"))

    def check(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.collect())      # at most max_files_per_trigger
        if files:
            record_errors(batch.sparkSession, files, base, cfg, batch_id, load_time)

    q = (arrivals.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
