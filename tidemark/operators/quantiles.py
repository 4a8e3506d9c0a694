"""Exact quantiles (linear interpolation, as ``percentile`` / pandas) without funnelling a
column through one task.

Spark's exact ``percentile`` merges every distinct value of a column into one buffer in the final
aggregation task.  This operator selects the needed order statistics instead:

1. ``n`` per column and the needed 0-based ranks ``floor(h)``, ``ceil(h)`` with ``h = (n-1)p``;
2. a bracket ``[lo, hi]`` per rank from ``percentile_approx`` sketches (bounded memory), widened
   by a safety margin;
3. one distributed count per bracket: values before it, inside it, and equal to each end.  A rank
   on a repeated end value resolves to it at once (a hot value holding a third of the rows costs
   nothing); a missed rank continues in the part of the range beside the bracket, and a bracket
   with more than ``max_group`` values continues strictly inside it, so every round shrinks the
   range and the result never depends on the sketch's error bound;
4. the rank's value = ``row_number`` over the bracket's values only (at most ``max_group`` rows per
   window partition), then interpolation.

Brackets are a tiny broadcast table joined on the column name, so every step is a scan with
map-side partial aggregation; only a few rows per rank reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

MARGIN_STEPS = 4


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def q(c):
        return "`" + c.replace("`", "``") + "`"

    def lit(c):
        return "'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'"
    stack = ", ".join(f"{lit(c)}, CAST({q(c)} AS DOUBLE)" for c in columns)
    return df.select(F.expr(f"stack({len(columns)}, {stack}) as (column, x)")) \
        .where(F.col("x").isNotNull() & ~F.isnan("x"))


GRID = 1000


def _within(lo: str, hi: str, lo_open: str, hi_open: str):
    """Column condition: x inside the interval described by the named table columns."""
    x = F.col("x")
    lo_ok = F.col(lo).isNull() | F.when(F.col(lo_open), x > F.col(lo)).otherwise(x >= F.col(lo))
    hi_ok = F.col(hi).isNull() | F.when(F.col(hi_open), x < F.col(hi)).otherwise(x <= F.col(hi))
    return lo_ok & hi_ok


RANGE_SCHEMA = ("tid int, column string, rlo double, rhi double, rlo_open boolean, "
                "rhi_open boolean")


def _sketch(vals: DataFrame, pending: dict, ranges: dict, accuracy: int) -> dict:
    """Bracket per target from a quantile sketch over the target's current range.  Ends that fall
    on the grid's ends keep the range's own bound (and openness)."""
    spark = vals.sparkSession
    t = spark.createDataFrame([(tid, pending[tid][0], *ranges[tid][:4]) for tid in pending],
                              RANGE_SCHEMA)
    j = vals.join(F.broadcast(t), "column").where(_within("rlo", "rhi", "rlo_open", "rhi_open"))
    stats = j.groupBy("tid").agg(
        F.count(F.lit(1)).alias("m"),
        F.percentile_approx("x", [i / GRID for i in range(GRID + 1)], accuracy).alias("qs"))
    return {r["tid"]: _bracket(r["qs"], r["m"], pending[r["tid"]][1], accuracy, ranges[r["tid"]])
            for r in stats.collect()}


def _bracket(qs, m: int, rank: int, accuracy: int, rng: tuple) -> tuple:
    """Closed bracket around ``rank`` from a grid sketch of the ``m`` values of range ``rng``."""
    rlo, rhi, rlo_open, rhi_open, before = rng
    local = rank - before
    err = MARGIN_STEPS * max(1.0 / max(m, 1), 1.0 / accuracy)
    p = local / max(m - 1, 1)
    i_lo = max(0, math.floor((p - err) * GRID))
    i_hi = min(GRID, math.ceil((p + err) * GRID))
    lo = (qs[i_lo], False) if i_lo > 0 else (rlo, rlo_open)
    hi = (qs[i_hi], False) if i_hi < GRID else (rhi, rhi_open)
    return (lo[0], hi[0], lo[1], hi[1])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    max_group: int = 1_000_000, accuracy: int = 10_000,
                    materialize_input: bool = True) -> DataFrame:
    """Rows ``(column, prob, value)``; NULL/NaN values are ignored; an empty column gives NULL.

    The selection makes a few passes over the values, so by default the ``(column, value)``
    pairs are written once to the shared checkpoint folder first (the input plan runs once);
    pass ``materialize_input=False`` when ``df`` is a plain, cheap scan."""
    vals = _long(df, list(columns))
    if materialize_input:
        vals = materialize(vals, "quantile_values")
    return quantiles_of_values(vals, columns, probs, max_group, accuracy)


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, x)`` pairs of the non-null, non-NaN values of ``columns`` (as DOUBLE)."""
    return _long(df, list(columns))


def sketch_exprs(accuracy: int) -> list:
    """Per-column aggregate expressions over ``(column, x)``: count and the quantile grid."""
    return [F.count(F.lit(1)).alias("n"),
            F.percentile_approx("x", [i / GRID for i in range(GRID + 1)], accuracy).alias("qs")]


def _narrower(bracket: tuple, whole: tuple) -> tuple:
    """The bracket, or the lower half of its range by value where the sketch did not shrink that: so every
    round either answers or at least halves the range, and the search ends."""
    lo, hi, lo_open, hi_open = bracket
    if (lo, hi) != tuple(whole[:2]) or lo is None or hi is None:
        return bracket
    middle = lo + (hi - lo) / 2
    return (lo, middle, lo_open, False) if lo < middle < hi else bracket


def quantiles_of_values(vals: DataFrame, columns: Sequence[str], probs: Sequence[float],
                        max_group: int = 1_000_000, accuracy: int = 10_000,
                        sketches: dict | None = None) -> DataFrame:
    """``exact_quantiles`` over ``(column, x)`` pairs (see ``long_values``).  ``sketches``
    (column -> (n, grid)) may come from an aggregate the caller already runs (``sketch_exprs``);
    otherwise one per-column aggregate computes them."""
    spark = vals.sparkSession
    cols = list(columns)
    if sketches is None:
        sketches = {r["column"]: (r["n"], r["qs"]) for r in
                    vals.groupBy("column").agg(*sketch_exprs(accuracy)).collect()}
    counts = {c: v[0] for c, v in sketches.items()}
    targets: dict[int, tuple[str, int]] = {}
    index: dict[tuple[str, int], int] = {}
    for c in cols:
        n = counts.get(c, 0)
        for p in probs if n else ():
            h = (n - 1) * p
            for rank in {math.floor(h), math.ceil(h)}:
                if (c, rank) not in index:
                    index[(c, rank)] = len(index)
                    targets[index[(c, rank)]] = (c, rank)

    # range per target: (lo, hi, lo_open, hi_open, values before the range)
    ranges = {tid: (None, None, False, False, 0) for tid in targets}
    at: dict[int, float] = {}
    select: dict[int, tuple] = {}
    pending = dict(targets)
    first_round = True
    while pending:
        if first_round:      # unrestricted ranges: the per-column sketches are the brackets
            br = {tid: _bracket(sketches[c][1], sketches[c][0], rank, accuracy,
                                (None, None, False, False, 0))
                  for tid, (c, rank) in pending.items()}
        else:
            br = {tid: _narrower(b, ranges[tid]) for tid, b in _sketch(vals, pending, ranges, accuracy).items()}
        first_round = False
        t = spark.createDataFrame(
            [(tid, pending[tid][0], *ranges[tid][:4], *br[tid]) for tid in pending],
            RANGE_SCHEMA + ", blo double, bhi double, blo_open boolean, bhi_open boolean")
        j = vals.join(F.broadcast(t), "column").where(_within("rlo", "rhi", "rlo_open", "rhi_open"))
        inside = _within("blo", "bhi", "blo_open", "bhi_open")
        x = F.col("x")
        cnt = j.groupBy("tid").agg(
            F.count_if(F.col("blo").isNotNull() & ~inside
                       & F.when(F.col("blo_open"), x <= F.col("blo")).otherwise(x < F.col("blo")))
            .alias("below"),
            F.count_if(inside).alias("inside"),
            F.count_if(inside & ~F.col("blo_open") & (x == F.col("blo"))).alias("at_lo"),
            F.count_if(inside & ~F.col("bhi_open") & (x == F.col("bhi"))).alias("at_hi"),
        ).collect()
        nxt = {}
        for r in cnt:
            tid = r["tid"]
            rlo, rhi, rlo_open, rhi_open, before = ranges[tid]
            blo, bhi, blo_open, bhi_open = br[tid]
            first = before + r["below"]               # global rank of the bracket's first value
            local = targets[tid][1] - first
            if local < 0:                             # answer lies before the bracket
                ranges[tid] = (rlo, blo, rlo_open, not blo_open, before)
                nxt[tid] = targets[tid]
            elif local >= r["inside"]:                # answer lies after the bracket
                ranges[tid] = (bhi, rhi, not bhi_open, rhi_open, first + r["inside"])
                nxt[tid] = targets[tid]
            elif local < r["at_lo"]:
                at[tid] = blo
            elif local >= r["inside"] - r["at_hi"]:
                at[tid] = bhi
            elif r["inside"] <= max_group:
                select[tid] = (blo, bhi, blo_open, bhi_open, local)
            else:                                     # strictly inside the bracket
                ranges[tid] = (blo, bhi, True, True, first + r["at_lo"])
                nxt[tid] = targets[tid]
        pending = nxt
    if select:
        sel = spark.createDataFrame(
            [(tid, targets[tid][0], *b) for tid, b in select.items()],
            "tid int, column string, blo double, bhi double, blo_open boolean, "
            "bhi_open boolean, local_rank long")
        j = vals.join(F.broadcast(sel), "column").where(_within("blo", "bhi", "blo_open", "bhi_open"))
        w = Window.partitionBy("tid").orderBy("x")
        picked = j.withColumn("rn", F.row_number().over(w) - 1) \
            .where(F.col("rn") == F.col("local_rank")).select("tid", "x")
        at.update({r["tid"]: r["x"] for r in picked.collect()})

    out = []
    for c in cols:
        n = counts.get(c, 0)
        for p in probs:
            if n == 0:
                out.append((c, float(p), None))
                continue
            h = (n - 1) * p
            lo_v = at[index[(c, math.floor(h))]]
            hi_v = at[index[(c, math.ceil(h))]]
            out.append((c, float(p), lo_v + (hi_v - lo_v) * (h - math.floor(h))))
    return spark.createDataFrame(out, "column string, prob double, value double")
