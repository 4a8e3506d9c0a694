"""Table profiling (E1-E12), generic over any DataFrame.

Per-column statistics are computed in ONE aggregate pass and unpivoted with ``stack`` (never a
loop of per-column jobs).  Exact distinct counts over many columns share one keyed shuffle: the
columns are unpivoted to ``(column, value)`` text pairs, de-duplicated with partial aggregation,
and counted per column (one hash aggregate for all columns, whatever their types); at very large
scale ``exact=False`` switches to HyperLogLog++ sketches.  Rounding follows pandas (half-even:
``bround``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quantiles import long_values, quantiles_of_values, sketch_exprs
from tidemark.session import materialize


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(name: str) -> str:
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint"))


def schema_table(df: DataFrame) -> DataFrame:
    """Numbered column list with Spark type names (E2 + E3)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def _value(df: DataFrame, c: str):
    """The column with NaN as missing, as in the pandas profile this stands for."""
    col = F.col(_q(c))
    return F.when(~F.isnan(col), col) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else col


def _identity(df: DataFrame, c: str):
    """A short text that is equal exactly for equal values: -0.0 is 0.0, instants are compared as such and
    not by their local wording, and long values are represented by a 128-bit digest."""
    kind, v = df.schema[c].dataType, _value(df, c)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (v + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(v).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.md5(v)
    text = v.cast("string")
    return F.when(F.length(text) > 32, F.concat(F.lit("#"), F.md5(text.cast("binary")))).otherwise(text)


def _pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _identity(df, c).alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, null_count, null_pct)`` for every column, one aggregate pass."""
    cols = df.columns
    exprs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(_value(df, c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    one = df.agg(*exprs)
    stack = ", ".join(f"{_lit(c)}, n{i}" for i, c in enumerate(cols))
    return one.select("_n", F.expr(f"stack({len(cols)}, {stack}) as (column, null_count)")) \
        .select("column", F.col("null_count").cast("bigint").alias("null_count"),
                F.bround(F.when(F.col("_n") > 0, F.col("null_count") / F.col("_n") * 100), 2)
                .alias("null_pct"))


def nulls_report(df: DataFrame) -> DataFrame:
    """Columns with at least one NULL, by NULL share descending."""
    return null_counts(df).where(F.col("null_count") > 0) \
        .orderBy(F.col("null_pct").desc(), "column")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None,
                    exact: bool = True, rsd: float = 0.01) -> DataFrame:
    """Non-null distinct count per column.

    Exact: one unpivot to ``(column, value-as-text)`` and one keyed de-duplication (map-side
    partial aggregation collapses repeats before the shuffle, so a hot value costs one row per
    task).  ``exact=False``: HyperLogLog++ sketches (``approx_count_distinct``, relative error
    ``rsd``) in a single aggregate with bounded memory and no shuffle of the data."""
    cols = list(columns or df.columns)
    if not exact:
        one = df.agg(*[F.approx_count_distinct(_value(df, c), rsd).alias(f"d{i}")
                       for i, c in enumerate(cols)])
        stack = ", ".join(f"{_lit(c)}, d{i}" for i, c in enumerate(cols))
        return one.select(F.expr(f"stack({len(cols)}, {stack}) as (column, unique_count)")) \
            .withColumn("unique_count", F.col("unique_count").cast("bigint"))
    pairs = _pairs(df, cols).where(F.col("value").isNotNull())
    per_value = pairs.distinct()
    counted = per_value.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(F.broadcast(counted), "column", "left") \
        .select("column", F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"))


def date_range(df: DataFrame, date_col: str = "date") -> DataFrame:
    d = F.col(date_col).try_cast(T.DateType()) \
        if not isinstance(df.schema[date_col].dataType, T.DateType) else F.col(date_col)
    one = df.agg(F.min(d).alias("earliest"), F.max(d).alias("latest"))
    return one.withColumn("days", F.datediff("latest", "earliest").cast("bigint"))


def coverage(df: DataFrame, name_col: str = "location", group_col: str = "continent") -> DataFrame:
    """E5 + E7: distinct names overall and among rows with a group.  One keyed aggregate to one
    row per name (partial-aggregated), then a one-row count, instead of two distinct
    aggregates (an ``Expand`` that doubles every row)."""
    per_name = df.where(F.col(name_col).isNotNull()).groupBy(name_col).agg(
        F.max(F.col(group_col).isNotNull().cast("int")).alias("has_group"))
    return per_name.agg(
        F.count(F.lit(1)).alias("unique_locations"),
        F.coalesce(F.sum("has_group"), F.lit(0)).cast("bigint").alias("country_locations"))


def value_counts(df: DataFrame, col: str, where_not_null: str | None = None) -> DataFrame:
    """Counts per non-null value, descending (pandas ``value_counts``)."""
    src = df.where(F.col(where_not_null).isNotNull()) if where_not_null else df
    return src.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("count").desc(), col)


def aggregate_names(df: DataFrame, name_col: str = "location",
                    group_col: str = "continent") -> DataFrame:
    """Sorted distinct names of rows without a group (aggregate rows)."""
    return df.where(F.col(group_col).isNull()).select(name_col) \
        .where(F.col(name_col).isNotNull()).distinct().orderBy(name_col)


DESCRIBE_STATS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True,
             accuracy: int = 10000) -> DataFrame:
    """Pandas-style ``describe().round(2)`` for the present columns.

    Rows are ``(column, count, mean, std, min, p25, p50, p75, max)``.

    * ``exact`` (default): the ``(column, value)`` pairs are written once, the moments come from
      one keyed aggregate over them and the quartiles from ``operators.quantiles`` (exact order
      statistics with linear interpolation, never sending a column through one task).
    * ``exact=False``: one aggregate over ``df`` with the bounded ``percentile_approx`` sketch."""
    cols = [c for c in columns if c in df.columns]
    if exact:
        vals = materialize(long_values(df, cols), "describe_values")
        agg = vals.groupBy("column").agg(
            F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("mn"),
            F.max("x").alias("mx"), *sketch_exprs(accuracy)).collect()       # one row per column
        sketches = {r["column"]: (r["n"], r["qs"]) for r in agg}
        qs = quantiles_of_values(vals, cols, (0.25, 0.5, 0.75), accuracy=accuracy,
                                 sketches=sketches).collect()
        q = {(r["column"], r["prob"]): r["value"] for r in qs}
        return describe_rows(df.sparkSession, cols, {r["column"]: r for r in agg}, q)
    else:
        exprs = []
        for i, c in enumerate(cols):
            x = F.col(_q(c)).cast("double")
            exprs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"),
                      F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                      F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"p{i}"),
                      F.max(x).alias(f"hi{i}")]
        stack = ", ".join(f"{_lit(c)}, c{i}, m{i}, s{i}, lo{i}, p{i}, hi{i}"
                          for i, c in enumerate(cols))
        s = df.agg(*exprs).select(
            F.expr(f"stack({len(cols)}, {stack}) as (column, n, mean, std, mn, p, mx)"))
    return _rounded(s)


def describe_rows(spark: SparkSession, cols: Sequence[str], by_col: dict, quartiles: dict) -> DataFrame:
    """The ``describe`` report from one row of moments per column (n, mean, std, mn, mx; already on the driver) and
    its quartiles by (column, share); rounding stays in Spark."""
    rows = [(c, int(by_col[c]["n"]) if c in by_col else 0,
             *(by_col[c][k] if c in by_col else None for k in ("mean", "std", "mn")),
             [quartiles.get((c, p)) for p in (0.25, 0.5, 0.75)],
             by_col[c]["mx"] if c in by_col else None) for c in cols]
    return _rounded(spark.createDataFrame(
        rows, "column string, n bigint, mean double, std double, mn double, p array<double>, mx double"))


def _rounded(s: DataFrame) -> DataFrame:
    r = lambda e: F.bround(e, 2)
    return s.select(
        "column", F.col("n").cast("bigint").alias("count"), r(F.col("mean")).alias("mean"),
        r(F.col("std")).alias("std"), r(F.col("mn")).alias("min"),
        r(F.col("p")[0]).alias("p25"), r(F.col("p")[1]).alias("p50"),
        r(F.col("p")[2]).alias("p75"), r(F.col("mx")).alias("max"))


def negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a negative value, per present column (one aggregate)."""
    cols = [c for c in columns if c in df.columns]
    one = df.agg(*[F.count_if(F.col(_q(c)) < 0).alias(f"v{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"{_lit(c)}, v{i}" for i, c in enumerate(cols))
    return one.select(F.expr(f"stack({len(cols)}, {stack}) as (column, negative_rows)")) \
        .withColumn("negative_rows", F.col("negative_rows").cast("bigint"))


def column_profile(df: DataFrame) -> DataFrame:
    """``(column, null_count, null_pct, unique_count)`` per column (dtype: see
    ``schema_table``).

    One pass: every row is unpivoted to ``(column, value-as-text)`` pairs (NULLs kept), counted
    per pair with map-side partial aggregation, then reduced per column to the NULL count, the
    distinct non-null count and the row count."""
    cols = df.columns
    pairs = _pairs(df, cols)
    per_value = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
    per_col = per_value.groupBy("column").agg(
        F.sum("c").alias("n"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("uniq"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(F.broadcast(per_col), "column", "left").select(
        "column",
        F.coalesce("nulls", F.lit(0)).cast("bigint").alias("null_count"),
        F.bround(F.when(F.col("n") > 0, F.col("nulls") / F.col("n") * 100), 2).alias("null_pct"),
        F.coalesce("uniq", F.lit(0)).cast("bigint").alias("unique_count"),
    ).orderBy("column")
