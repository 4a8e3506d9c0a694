"""Registry of every query/operator exposed to ``__spark_entry__``.

Each entry is ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None)``.  All
callables read the given tables (through the panel) so their work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import oracle, queries, stages

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def _star_query(name: str, fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(stages.star(spark, sf_dir))
    run.__name__ = name
    REGISTRY[name] = (run, oracle.QUERY_SQL[name])


for _name in ("q1_top_countries", "q2_monthly_continent", "q3_vax_vs_death", "q4_by_wave",
              "q5_peak_icu", "q6_by_income", "q7_top_months", "q7b_best_month", "q8_row_counts",
              "q9_top10"):
    _star_query(_name, getattr(queries, _name))


def load_all() -> dict[str, tuple[Query, str | None]]:
    # importing the modules registers their entries
    from tidemark.plans import registry_extra, registry_io, registry_load  # noqa: F401
    return REGISTRY
