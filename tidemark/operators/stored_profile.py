"""Profiles that are kept per file and merged for the table (A10, E12, A13): only new files are ever read.

``update_profile`` writes, for each file not profiled before, one row per column: rows, NULLs, count, mean, squared
deviations, least and largest value, an HLL sketch of the distinct values and a KLL sketch of the quantiles.  Each is a
fixed number of bytes, whatever the file's size.  ``merged_profile`` and ``merged_sketches`` put the files' rows
together; counts are exact, distinct counts have HLL's relative error (standard error 1.04 / sqrt(2^lg_k), 0.8 % by
default).  ``describe_stored`` takes the moments from the store, and the KLL sketches as brackets for the
exact order statistics, so it needs no sketching pass over the table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.profile import _identity, _q, _value, describe_rows
from tidemark.operators.quantiles import GRID, long_values, quantiles_of_values

LG_K = 14
KLL_K = 2000
ACCURACY = 400          # brackets are 4 / ACCURACY of the ranks wide on either side, above the KLL sketch's error
STORE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("column", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("nulls", T.LongType()), T.StructField("distinct", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()), T.StructField("least", T.DoubleType()),
    T.StructField("most", T.DoubleType()), T.StructField("quantiles", T.BinaryType()), T.StructField("load", T.LongType())])


def file_profile(df: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """One row per file and column of ``df``, a file-based read; numeric figures for the columns in ``numeric``."""
    exprs, none = [], F.lit(None).cast("double")
    for i, c in enumerate(df.columns):
        v, x = _value(df, c), _value(df, c).cast("double") if c in numeric else none
        exprs += [F.count_if(v.isNull()).alias(f"nulls{i}"), F.hll_sketch_agg(_identity(df, c), F.lit(LG_K)).alias(f"d{i}")]
        if c in numeric:
            exprs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), (F.var_pop(x) * F.count(x)).alias(f"m2{i}"),
                      F.min(x).alias(f"least{i}"), F.max(x).alias(f"most{i}"),
                      F.expr(f"kll_sketch_agg_double(CAST(nanvl(CAST({_q(c)} AS DOUBLE), NULL) AS DOUBLE), {KLL_K})").alias(f"k{i}")]
    one = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *exprs)

    def row(i: int, c: str):
        own = ([F.col(f"{k}{i}") for k in ("n", "mean", "m2", "least", "most", "k")] if c in numeric
               else [F.lit(0).cast("long"), none, none, none, none, F.lit(None).cast("binary")])
        names = ("n", "mean", "m2", "least", "most", "quantiles")
        return F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"nulls{i}").alias("nulls"), F.col(f"d{i}").alias("distinct"),
                        *[e.alias(k) for e, k in zip(own, names, strict=True)])

    return one.select("file", F.inline(F.array(*[row(i, c) for i, c in enumerate(df.columns)])))


def read_store(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    if before is not None and before <= 0:
        return spark.createDataFrame([], STORE)
    stored = spark.read.schema(STORE).parquet(store)
    return stored if before is None else stored.where(F.col("load") < before)


def _name(file: str) -> str:
    """Local files are written with one slash or three."""
    return re.sub("^file:/+", "file:/", file)


def update_profile(table: DataFrame, store: str, load: int, numeric: Sequence[str] = ()) -> int:
    """Profiles the files of ``table`` (a file-based read) that no earlier load has, into ``<store>/load=<n>``; returns
    their number.  Loads are numbered from 0; one that is repeated replaces its own rows."""
    spark = table.sparkSession
    known = {_name(r["file"]) for r in read_store(spark, store, load).select("file").distinct().collect()}     # names only
    new = [f for f in table.inputFiles() if _name(f) not in known]
    rows = (file_profile(spark.read.schema(table.schema).parquet(*new), numeric) if new
            else spark.createDataFrame([], T.StructType(STORE.fields[:-1])))
    rows.write.mode("overwrite").parquet(f"{store.rstrip('/')}/load={load}")
    return len(new)


def merged_profile(stored: DataFrame) -> DataFrame:
    """``(column, null_count, null_pct, unique_count)`` over all files; the last is an estimate."""
    one = stored.groupBy("column").agg(F.sum("rows").alias("n"), F.sum("nulls").alias("nulls"),
                                       F.hll_union_agg("distinct").alias("d"))
    return one.select("column", F.col("nulls").alias("null_count"),
                      F.bround(F.when(F.col("n") > 0, F.col("nulls") / F.col("n") * 100), 2).alias("null_pct"),
                      F.hll_sketch_estimate("d").alias("unique_count"))


def merged_sketches(stored: DataFrame) -> DataFrame:
    """``(column, n, mean, std, mn, mx, qs)`` of the numeric columns; ``qs`` is the quantile grid of the merged sketch."""
    own = stored.where("n > 0")
    mean = own.groupBy("column").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    ranks = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    merged = (own.join(mean, "column").groupBy("column").agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"),
        F.min("least").alias("mn"), F.max("most").alias("mx"), F.expr("kll_merge_agg_double(quantiles)").alias("k")))
    return merged.select("column", "n", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"),
                         "mn", "mx", F.call_function("kll_sketch_get_quantile_double", "k", ranks).alias("qs"))


def describe_stored(table: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``profile.describe`` of a table whose files are all in the store: the same rows, one scan fewer."""
    cols = [c for c in columns if c in table.columns]
    known = {r["column"]: r for r in merged_sketches(stored).where(F.col("column").isin(cols)).collect()}      # one a column
    qs = quantiles_of_values(long_values(table, cols), cols, (0.25, 0.5, 0.75), accuracy=ACCURACY,
                             sketches={c: (r["n"], r["qs"]) for c, r in known.items()}).collect()
    return describe_rows(table.sparkSession, cols, known, {(r["column"], r["prob"]): r["value"] for r in qs})
