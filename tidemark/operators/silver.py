"""Bronze -> Silver: the reference's ten cleaning rules as one narrow (shuffle-free) plan.

Row filters, safe casts, negative flooring, guarded rates, year/month and the ingest stamp are
all row-local, so Silver is a single ``Filter`` + ``Project`` over the scan; Catalyst collapses
the steps and pushes the filters to the source.  Missing optional input columns become typed
NULLs so the output always has the fixed 29-column Silver schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import SILVER_COLUMNS, PanelConfig
from tidemark.functions.metrics import floor_negative, ratio

RATE_COLUMNS = ("death_rate", "vaccination_rate", "cases_per_million_calc")


def drop_aggregates(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Keep real entities: group (continent) not NULL and code not starting with the prefix.
    A NULL code is dropped as well (three-valued logic)."""
    return df.filter(F.col(cfg.group_col).isNotNull()
                     & ~F.col(cfg.entity_col).startswith(cfg.aggregate_prefix))


def _as_date(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(F.col(name))
    return F.col(name).try_cast(T.DateType())


def typed_columns(df: DataFrame, cfg: PanelConfig) -> dict[str, Column]:
    """Date and metric columns after the safe casts and the negative floor (NULLs for absent
    columns).  The float cast precedes the rates, as in the reference."""
    present = set(df.columns)
    out: dict[str, Column] = {}
    out[cfg.date_col] = (_as_date(df, cfg.date_col) if cfg.date_col in present
                         else F.lit(None).cast(T.DateType()))
    for c in cfg.metric_columns:
        if c in present:
            v = F.col(c).try_cast(cfg.metric_type)
            if c in cfg.floor_columns:
                v = floor_negative(v).cast(cfg.metric_type)
        else:
            v = F.lit(None).cast(cfg.metric_type)
        out[c] = v
    return out


def transform(df: DataFrame, cfg: PanelConfig) -> DataFrame:
    """The whole Silver chain (filters, casts, floor, rates, year/month, stamp, final schema)."""
    filtered = drop_aggregates(df, cfg)
    typed = typed_columns(filtered, cfg)
    base_cols = [F.col(c) if c in filtered.columns else F.lit(None).cast("string")
                 for c in (cfg.entity_col, cfg.name_col, cfg.group_col)]
    staged = filtered.select(
        base_cols[0].alias("iso_code"), base_cols[1].alias("location"),
        base_cols[2].alias("continent"),
        *[v.alias(k if k != cfg.date_col else "date") for k, v in typed.items()],
    )
    rates = {
        "death_rate": ratio(F.col("total_deaths"), F.col("total_cases"), 100, 4),
        "vaccination_rate": ratio(F.col("people_vaccinated"), F.col("population"), 100, 2),
        "cases_per_million_calc": ratio(F.col("total_cases"), F.col("population"), 1_000_000, 2),
    }
    stamp = (F.lit(cfg.run_ts).cast(T.TimestampType()) if cfg.run_ts is not None
             else F.current_timestamp())
    derived = {
        "record_year": F.year("date"),
        "record_month": F.month("date"),
        **rates,
        "ingested_at": stamp,
    }
    return staged.select(*[derived[c].alias(c) if c in derived else F.col(c)
                           for c in SILVER_COLUMNS])


def stamp_free(df: DataFrame) -> DataFrame:
    """Silver without the ingest time (for comparisons: the stamp differs per run)."""
    return df.drop("ingested_at")
