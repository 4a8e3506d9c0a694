"""Benchmark: the medallion run and the analytic queries at one scale factor.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (warm runs per query, default 3).

Phases, as the reference runs them:
1. ETL: Bronze (panel over the test tables) -> Silver written -> quality gate -> Gold written.
2. Every query / mart / profile / quality key over the *written* layers.
Every key is the median of ``BENCH_RUNS`` warm runs (one extra warm-up run is discarded).

Prints ONE JSON line: ``{"metric", "value", "unit", "queries", "sf", ...}`` where ``value`` is
the sum of the per-key medians plus the ETL time.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import functions as F

    from tidemark.config import default_rules
    from tidemark.operators import profile, quality
    from tidemark.operators.gold import Star
    from tidemark.plans import marts, pipeline, queries, stages
    from tidemark.session import get_session

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus), app="tidemark-bench")
    cfg = stages.TABLE_CONFIG
    times: dict[str, float] = {}

    # warm-up of the JVM and file listing (not timed)
    stages.bronze(spark, sf_dir).agg(F.count(F.lit(1))).collect()

    rules = default_rules(cfg.with_(row_count_bounds=(1, 10**12)))
    etl: dict[str, list[float]] = {"etl_bronze_to_silver": [], "etl_quality_gate": [],
                                   "etl_silver_to_gold": []}
    for _ in range(runs + 1):               # first run is the warm-up, not counted
        out = stages.scratch(spark, "bench")
        t0 = time.perf_counter()
        counts = pipeline.bronze_to_silver(stages.bronze(spark, sf_dir), f"{out}/silver", cfg)
        etl["etl_bronze_to_silver"].append(time.perf_counter() - t0)
        silver = spark.read.parquet(f"{out}/silver")
        t0 = time.perf_counter()
        report = quality.evaluate(silver, rules).collect()
        etl["etl_quality_gate"].append(time.perf_counter() - t0)
        failed_checks = [r["check"] for r in report if r["status"] != "PASS"]
        t0 = time.perf_counter()
        paths, gcounts = pipeline.silver_to_gold(silver, f"{out}/gold", cfg)
        etl["etl_silver_to_gold"].append(time.perf_counter() - t0)
    for k, v in etl.items():
        times[k] = statistics.median(v[1:])
    counts.update(gcounts)

    rd = spark.read.parquet
    star = Star(rd(paths["fact_covid_cases"]), rd(paths["dim_country"]), rd(paths["dim_date"]),
                rd(paths["dim_income_group"]), gcounts["dim_country_rows"], gcounts["dim_date_rows"])
    bronze_copy = stages.materialize(stages.bronze(spark, sf_dir), "bench_bronze")

    work = {
        **{n: (lambda f=getattr(queries, n): f(star)) for n in (
            "q1_top_countries", "q2_monthly_continent", "q3_vax_vs_death", "q4_by_wave",
            "q5_peak_icu", "q6_by_income", "q7_top_months", "q7b_best_month", "q8_row_counts",
            "q9_top10")},
        **{n: (lambda f=getattr(marts, n): f(star)) for n in (
            "m1_kpis", "m2_map", "m3_daily_trend", "m5_scatter", "m6_vax_death_corr",
            "m7_income_vax_ratio", "m8_wave_death_rate", "m9_icu_coverage")},
        "dq_report": lambda: quality.evaluate(silver, default_rules(cfg)),
        "e12_column_profile": lambda: profile.column_profile(bronze_copy),
        "e10_describe": lambda: profile.describe(bronze_copy, cfg.describe_columns),
    }
    for name, build in work.items():
        samples = []
        for _ in range(runs + 1):           # first run warms the plan cache, not counted
            t0 = time.perf_counter()
            build().collect()
            samples.append(time.perf_counter() - t0)
        times[name] = statistics.median(samples[1:])

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_sec_etl_plus_query_medians",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": sf,
        "rows": counts,
        "failed_checks": failed_checks,
        "config": {"master": f"local[{cpus}]", "runs": runs, "spark": spark.version},
    }))


if __name__ == "__main__":
    main()
