"""Data-quality rules, report and gate.

All row-level rules (not-null, between, in-set, row count) are evaluated together in ONE
aggregate over the table (``count_if`` per rule, partial-aggregated per task, a single small
final row).  Uniqueness is a keyed aggregate (``groupBy(keys).count()``, the only shuffle),
reduced to the number of duplicate groups.  Type rules are plan-time schema checks.  Referential
rules are left-anti joins of the *distinct* child keys against the parent keys.

Semantics follow the validation library the reference uses: NULLs are ignored by ``between`` and
``in_set``; ``mostly`` is the minimum share of passing values among non-null values (all-NULL
passes); uniqueness ignores rows whose key columns are all NULL.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Rule

REPORT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("unexpected", T.LongType()),
    T.StructField("observed", T.LongType()),
])


class QualityError(RuntimeError):
    """Raised by ``gate`` when a check fails; carries the report rows."""

    def __init__(self, failed: list, report: DataFrame):
        super().__init__(f"{len(failed)} data-quality check(s) failed: "
                         + "; ".join(r["check"] for r in failed))
        self.failed = failed
        self.report = report


@dataclass(frozen=True)
class _Agg:
    rule: Rule
    unexpected: Column      # count of failing (non-null) values / rows
    observed: Column        # non-null values seen (or row count)


def _value(df: DataFrame, name: str) -> Column:
    """The column with NaN as missing, as the reference's pandas-based checks have it."""
    c = F.col(name)
    return F.when(~F.isnan(c), c) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c


def _row_aggs(df: DataFrame, rules: Sequence[Rule]) -> list[_Agg]:
    out = []
    for r in rules:
        if r.kind == "not_null":
            out.append(_Agg(r, F.count_if(_value(df, r.columns[0]).isNull()), F.count(F.lit(1))))
        elif r.kind == "between":
            c = _value(df, r.columns[0])
            bad = c.isNotNull() & ~c.between(F.lit(r.low), F.lit(r.high))
            out.append(_Agg(r, F.count_if(bad), F.count(c)))
        elif r.kind == "in_set":
            c = _value(df, r.columns[0])
            bad = c.isNotNull() & ~c.isin(*r.values)
            out.append(_Agg(r, F.count_if(bad), F.count(c)))
        elif r.kind == "row_count":
            n = F.count(F.lit(1))
            out.append(_Agg(r, F.when((n < r.low) | (n > r.high), n).otherwise(0), n))
    return out


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of key groups with more than one row, and rows in those groups."""
    cols = [F.col(k) for k in keys]
    any_key = cols[0].isNotNull()
    for c in cols[1:]:
        any_key = any_key | c.isNotNull()
    g = df.where(any_key).groupBy(*keys).count().where(F.col("count") > 1)
    return g.agg(F.count(F.lit(1)).alias("duplicate_groups"),
                 F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def orphans(child: DataFrame, child_keys: Sequence[str], parent: DataFrame,
            parent_keys: Sequence[str]) -> DataFrame:
    """Distinct non-null child keys with no parent row (a referential check).  The child keys
    are de-duplicated first (partial aggregation), so the anti join shuffles distinct keys."""
    ck = child.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(child_keys)])
    nonnull = None
    for i in range(len(child_keys)):
        cond = F.col(f"_k{i}").isNotNull()
        nonnull = cond if nonnull is None else nonnull & cond
    ck = ck.where(nonnull).distinct()
    pk = parent.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(parent_keys)])
    on = [F.col(f"_k{i}") == F.col(f"_p{i}") for i in range(len(child_keys))]
    return ck.join(pk, on, "left_anti").select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(child_keys)])


def _type_ok(df: DataFrame, column: str, dtype: str) -> bool:
    return column in df.columns and df.schema[column].dataType.simpleString() == dtype


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report DataFrame ``(check, kind, status, unexpected, observed)`` in rule order.

    Row rules share one aggregate (unpivoted with ``stack``; plan-time type results ride along as
    literal rows); each uniqueness rule adds one keyed aggregate.  The result is small and lazy."""
    frames: list[DataFrame] = []
    row_aggs = _row_aggs(df, rules)
    pos_of = {r.name: i for i, r in enumerate(rules)}
    type_rows = []
    for pos, r in enumerate(rules):
        if r.kind == "type":
            ok_t = _type_ok(df, r.columns[0], r.dtype)
            type_rows.append(f"{pos}, {_sql_str(r.name)}, 'type', "
                             f"'{'PASS' if ok_t else 'FAIL'}', "
                             f"CAST({0 if ok_t else 1} AS BIGINT), CAST(1 AS BIGINT)")
        elif r.kind not in ("not_null", "between", "in_set", "row_count", "unique"):
            raise ValueError(f"unknown rule kind {r.kind}")
    if row_aggs or type_rows:
        exprs = [F.count(F.lit(1)).alias("_rows")]
        for i, a in enumerate(row_aggs):
            exprs += [a.unexpected.cast("bigint").alias(f"u{i}"),
                      a.observed.cast("bigint").alias(f"o{i}")]
        one = df.agg(*exprs)
        status = []
        for i, a in enumerate(row_aggs):
            u, o, r = F.col(f"u{i}"), F.col(f"o{i}"), a.rule
            if r.kind == "row_count":
                ok = o.between(F.lit(r.low), F.lit(r.high))
            elif r.mostly < 1.0:
                ok = (o == 0) | ((o - u) / o >= F.lit(r.mostly))
            else:
                ok = u == 0
            status.append(F.when(ok, "PASS").otherwise("FAIL").alias(f"s{i}"))
        one = one.select("*", *status)
        entries = [
            f"{pos_of[a.rule.name]}, {_sql_str(a.rule.name)}, {_sql_str(a.rule.kind)}, "
            f"s{i}, u{i}, o{i}"
            for i, a in enumerate(row_aggs)] + type_rows
        frames.append(one.select(F.expr(
            f"stack({len(entries)}, {', '.join(entries)}) "
            "as (_pos, check, kind, status, unexpected, observed)")))
    for pos, r in enumerate(rules):
        if r.kind == "unique":
            d = duplicate_groups(df, r.columns)
            frames.append(d.select(
                F.lit(pos).alias("_pos"), F.lit(r.name).alias("check"), F.lit(r.kind).alias("kind"),
                F.when(F.col("duplicate_groups") == 0, "PASS").otherwise("FAIL").alias("status"),
                F.col("duplicate_groups").cast("bigint").alias("unexpected"),
                F.col("duplicate_rows").cast("bigint").alias("observed")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.orderBy("_pos").drop("_pos")


def report(df: DataFrame, rules: Sequence[Rule], run_time: _dt.datetime | None = None) -> DataFrame:
    """``evaluate`` plus the run time column of the reference's report."""
    ts = F.lit(run_time) if run_time is not None else F.current_timestamp()
    return evaluate(df, rules).withColumn("run_time", ts)


def gate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate and raise ``QualityError`` if any check failed; return the (collected, tiny)
    report as a DataFrame otherwise.  Call before publishing a layer."""
    rep = evaluate(df, rules)
    rows = rep.collect()
    failed = [r for r in rows if r["status"] != "PASS"]
    result = df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)
    if failed:
        raise QualityError(failed, result)
    return result


def gate_outcome(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """What ``gate`` decides, as rows ``(outcome, check)``: one per failed check, or a single ``PASS``."""
    try:
        gate(df, rules)
        rows = [("PASS", None)]
    except QualityError as exc:
        rows = [("STOP", r["check"]) for r in exc.failed]
    return df.sparkSession.createDataFrame(rows, "outcome string, check string")


def varchar_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows per column whose text exceeds the declared VARCHAR length (one aggregate)."""
    present = [(c, n) for c, n in limits.items() if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, max_length int, violations bigint")
    one = df.agg(*[F.count_if(F.length(c) > n).alias(f"v{i}") for i, (c, n) in enumerate(present)])
    stack = ", ".join(f"'{c}', {n}, v{i}" for i, (c, n) in enumerate(present))
    return one.select(F.expr(f"stack({len(present)}, {stack}) as (column, max_length, violations)")) \
        .withColumn("violations", F.col("violations").cast("bigint"))
