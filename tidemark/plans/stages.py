"""Stage wiring used by queries, marts, profiling and the quality gate.

``silver`` is lazy.  ``star`` materialises Silver once (a Parquet table written under the shared
``spark.checkpoint.dir``) before key assignment runs its small actions, so the expensive
Bronze plan (the line-item join) executes once per star, not once per action, and a lost
executor re-reads the checkpoint instead of replaying the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import PanelConfig
from tidemark.operators import gold, silver as silver_ops
from tidemark.session import materialize as _materialize
from tidemark.session import scratch_path
from tidemark.sources.panel import panel

TABLE_CONFIG = PanelConfig.for_tables()


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, cfg: PanelConfig = TABLE_CONFIG) -> DataFrame:
    return silver_ops.transform(bronze(spark, sf_dir), cfg)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """See ``tidemark.session.materialize``."""
    return _materialize(df, name)


def star(spark: SparkSession, sf_dir: str, cfg: PanelConfig = TABLE_CONFIG) -> gold.Star:
    return gold.build_star(materialize(silver(spark, sf_dir, cfg), "silver"), cfg)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (for landing zones and sinks)."""
    return scratch_path(spark, name)
