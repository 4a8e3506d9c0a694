"""The batch medallion run: Bronze -> Silver (gated) -> Gold, with one scan per layer.

Counts that the reference gets from separate ``count()`` jobs (raw rows, rows after the filter,
clean rows) are taken with ``DataFrame.observe`` inside the single Silver write job.  Keys
are stored before the fact is joined to them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import PanelConfig, Rule, default_rules
from tidemark.operators import gold, quality
from tidemark.operators import silver as silver_ops
from tidemark.sources.files import write_layer, write_star


@dataclass
class RunResult:
    silver_path: str
    gold_paths: dict[str, str]
    counts: dict[str, int] = field(default_factory=dict)
    quality_report: DataFrame | None = None


def bronze_to_silver(bronze: DataFrame, path: str, cfg: PanelConfig,
                     partition_by: tuple[str, ...] = ()) -> dict[str, int]:
    """Write Silver; returns raw / filtered / clean row counts observed in the same job."""
    raw_obs, kept_obs = Observation("raw"), Observation("kept")
    observed = bronze.observe(raw_obs, F.count(F.lit(1)).alias("rows"))
    silver = silver_ops.transform(observed, cfg)
    silver = silver.observe(kept_obs, F.count(F.lit(1)).alias("rows"))
    write_layer(silver, path, partition_by)
    raw, kept = raw_obs.get["rows"], kept_obs.get["rows"]
    return {"raw_rows": int(raw), "silver_rows": int(kept)}


def silver_to_gold(silver: DataFrame, base: str, cfg: PanelConfig) -> tuple[dict[str, str], dict[str, int]]:
    """Keys are assigned and stored first; the four tables, written from those, agree."""
    star = gold.build_star(silver, cfg)
    obs = Observation("fact")
    tables = star.tables()
    tables["fact_covid_cases"] = star.fact.observe(obs, F.count(F.lit(1)).alias("rows"))
    paths = write_star(tables, base)
    counts = {"fact_rows": int(obs.get["rows"]), "dim_country_rows": star.country_rows,
              "dim_date_rows": star.date_rows, "dim_income_rows": star.country_rows}
    return paths, counts


def run(bronze: DataFrame, out_dir: str, cfg: PanelConfig, rules: tuple[Rule, ...] | None = None,
        gate: bool = True) -> RunResult:
    """Bronze -> Silver -> (quality gate) -> Gold, in a folder of this run under ``out_dir``.

    Nothing that readers use is touched before the gate has passed and all Gold tables are complete;
    then ``current`` names this run's folders.  A run that fails or is stopped at the gate leaves the
    previous run current, with its dimensions and facts in step."""
    out = out_dir.rstrip("/")
    base = f"{out}/runs/{uuid.uuid4().hex}"
    silver_path = f"{base}/silver"
    counts = bronze_to_silver(bronze, silver_path, cfg)
    spark = bronze.sparkSession
    silver = spark.read.schema(silver_ops.transform(bronze, cfg).schema).parquet(silver_path)
    rules = rules if rules is not None else default_rules(cfg)
    report = quality.gate(silver, rules) if gate else quality.evaluate(silver, rules)
    paths, gold_counts = silver_to_gold(silver, f"{base}/gold", cfg)
    counts.update(gold_counts)
    rows = [("silver", silver_path), *paths.items()]
    (spark.createDataFrame(rows, "name string, path string").coalesce(1)
     .write.mode("overwrite").parquet(f"{out}/current"))
    return RunResult(silver_path, paths, counts, report)


def current(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Folders (by table name) of the last run that was published under ``out_dir``."""
    return {r["name"]: r["path"] for r in spark.read.parquet(f"{out_dir.rstrip('/')}/current").collect()}


def main(argv: list[str] | None = None) -> int:
    """``python -m tidemark.plans.pipeline --raw <csv folder> --out <lake folder>``: read the raw
    panel CSV (header; explicit text schema from the header's column names), run Bronze ->
    Silver -> gate -> Gold, print the observed counts.  Exit code 1 when the gate fails."""
    import argparse
    import json

    from tidemark.sources.files import read_panel_csv

    ap = argparse.ArgumentParser(prog="tidemark.plans.pipeline")
    ap.add_argument("--raw", required=True, help="raw panel CSV file or folder")
    ap.add_argument("--out", required=True, help="output folder for silver/ and gold/")
    ap.add_argument("--no-gate", action="store_true", help="report quality, do not stop")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark-pipeline").getOrCreate()
    header = spark.read.option("header", True).csv(args.raw).columns   # names only
    raw = read_panel_csv(spark, args.raw, header)
    try:
        res = run(raw, args.out, PanelConfig(), gate=not args.no_gate)
    except quality.QualityError as exc:
        print(json.dumps({"failed_checks": [r["check"] for r in exc.failed]}))
        return 1
    print(json.dumps({"counts": res.counts, "gold": res.gold_paths}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
