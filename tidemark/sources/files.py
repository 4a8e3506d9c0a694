"""File sources and sinks for the layers.

* Raw CSV columns are found by name in each file's header and read as text (no inference pass over
  the data; a malformed number cannot fail the read).  Typed columns are produced later by ``try_cast`` in Silver, and
  ``load_errors`` lists the cells whose text did not convert (the load-error table).
* Reading a landing *directory* enables Hive-style partition discovery (``year=2024``).
* Sinks never ``coalesce(1)`` a large table; only small dimension tables and reports are written
  as single files.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import PanelConfig, bronze_schema


CORRUPT_COLUMN = "_corrupt_record"


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that have it, or the given ``path`` itself where all files have the same header; file names
    come to the driver only where headers differ.  Only rows of each file's first block are kept, but the text is
    scanned once, and once more where headers differ."""
    lines = (spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
             .where("file_block_start = 0").withColumn("row", F.monotonically_increasing_id()))
    first = lines.groupBy("file_path").agg(F.min_by("value", "row").alias("value"))

    def names(line: str) -> tuple[str, ...]:
        return tuple(c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), []))

    headers = {names(r["value"]) for r in first.select("value").distinct().collect()}
    if len(headers) <= 1:
        return {h: [path] if isinstance(path, str) else list(path) for h in headers}
    out: dict[tuple[str, ...], list[str]] = {}
    for r in first.groupBy("value").agg(F.sort_array(F.collect_list("file_path")).alias("files")).collect():
        out.setdefault(names(r["value"]), []).extend(r["files"])
    return out


def read_panel_csv(spark: SparkSession, path: str, columns: Sequence[str],
                   keep_malformed: bool = False, files: Sequence[str] | None = None) -> DataFrame:
    """Raw panel CSV (file or directory): the given columns, found by *name* in each file's header, all
    as text.  Files may have their columns in different orders, and others besides; a file without one of
    ``columns`` is an error.  ``files`` restricts the read to some files of ``path``.

    ``keep_malformed`` adds ``_corrupt_record``: the raw text of lines whose field count does not
    match the header (PERMISSIVE mode), for ``load_errors``; it then keeps each file's other columns if
    all files have the same header, because only a parse of all columns finds such lines."""
    headers = csv_headers(spark, list(files) if files else path)
    parts = []
    for header, own in sorted(headers.items()):
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header of {own[0]}")
        schema = bronze_schema(header)
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        if keep_malformed:
            schema = schema.add(CORRUPT_COLUMN, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        reader = reader.schema(schema)
        df = reader.csv(path) if len(headers) == 1 and not files else reader.option("basePath", path).csv(own)
        partition = [c for c in df.columns if c not in header and c != CORRUPT_COLUMN]
        others = [c for c in header if c not in columns] if keep_malformed and len(headers) == 1 else []
        parts.append(df.select(*columns, *others, *[CORRUPT_COLUMN] * keep_malformed, *partition))
    if not parts:
        return spark.createDataFrame([], bronze_schema(columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_any(spark: SparkSession, path: str, fmt: str = "csv", infer: bool = True) -> DataFrame:
    """Profiling read: inference allowed (one extra pass over a CSV)."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", infer).csv(path)
    return spark.read.format(fmt).load(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer; a missing or unreadable path raises ``AnalysisException``."""
    return spark.read.parquet(path)


def load_errors(raw: DataFrame, cfg: PanelConfig, key_cols: Sequence[str] | None = None) -> DataFrame:
    """Cells whose non-empty text failed the typed cast: ``(key..., column, raw_value)``; with a
    ``_corrupt_record`` column (``read_panel_csv(keep_malformed=True)``) also malformed lines,
    as ``column = '_line'`` and the raw line.

    One pass: every check contributes an optional struct to an array that is exploded, so the
    plan stays a single narrow stage over the raw rows.  The malformed-line check references
    every data column on purpose: Spark detects a wrong field count only when all columns are
    parsed (CSV column pruning skips that check)."""
    keys = list(key_cols or [cfg.entity_col])
    typed = {cfg.date_col: T.DateType()}
    for c in cfg.metric_columns:
        typed[c] = cfg.metric_type
    present = [(c, t) for c, t in typed.items() if c in raw.columns]
    checks = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
               F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("raw_value")))
        for c, t in present]
    if CORRUPT_COLUMN in raw.columns:
        fields = F.concat_ws(",", *[F.col(c).cast("string") for c in raw.columns
                                    if c != CORRUPT_COLUMN])
        checks.append(F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.struct(
            F.lit("_line").alias("column"),
            F.coalesce(F.col(CORRUPT_COLUMN), fields).alias("raw_value"))))
    cells = F.array(*checks)
    return (raw.select(*keys, F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("e"))
            .select(*keys, "e.column", "e.raw_value"))


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                max_records_per_file: int | None = None) -> None:
    w = df.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """Small report (quality, profile) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_star(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Gold sink.  All tables are written through a ``REBALANCE`` hint, so AQE sizes the files by bytes at any
    size: small dimensions become one file, and a skewed country is split instead of funnelled into one
    task.  The fact is sorted by ``(country_key, date_key)`` inside each file, so row-group min/max
    statistics prune on both keys."""
    paths = {}
    for name, df in tables.items():
        path = f"{base.rstrip('/')}/{name}"
        if name.startswith("dim_"):
            df.hint("rebalance").write.mode("overwrite").parquet(path)
        else:
            (df.hint("rebalance", "country_key").sortWithinPartitions("country_key", "date_key")
             .write.mode("overwrite").parquet(path))
        paths[name] = path
    return paths
