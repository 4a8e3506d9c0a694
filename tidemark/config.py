"""One configuration object for the whole panel pipeline.

Every column name, prefix, threshold, breakpoint, allowed set and bound lives here; the
transforms take a ``PanelConfig`` and never hard-code them.  ``PanelConfig()`` holds the
reference's own values; ``PanelConfig.for_tables()`` is the configuration for the panel that
``sources.panel`` derives from the TPC-H-style test tables (dates 1995-2001, five regions).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------------------------
AGGREGATE_CODE_PREFIX = "OWID_"
NEGATIVE_FLOOR_COLUMNS = ("new_cases", "new_deaths", "new_cases_smoothed", "new_deaths_smoothed")
FLOAT_METRIC_COLUMNS = (
    "total_cases", "new_cases", "total_deaths", "new_deaths",
    "new_cases_smoothed", "new_deaths_smoothed",
    "total_cases_per_million", "new_cases_per_million",
    "total_deaths_per_million", "new_deaths_per_million",
    "total_vaccinations", "people_vaccinated", "people_fully_vaccinated",
    "people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
    "icu_patients", "hosp_patients", "population",
    "median_age", "aged_65_older", "gdp_per_capita", "human_development_index",
)
SILVER_COLUMNS = (
    "iso_code", "location", "continent", "date",
    "record_year", "record_month",
    "total_cases", "new_cases", "total_deaths", "new_deaths",
    "new_cases_smoothed", "new_deaths_smoothed",
    "total_cases_per_million", "total_deaths_per_million",
    "total_vaccinations", "people_vaccinated", "people_fully_vaccinated",
    "people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
    "icu_patients", "hosp_patients", "population",
    "median_age", "gdp_per_capita", "human_development_index",
    "death_rate", "vaccination_rate", "cases_per_million_calc",
    "ingested_at",
)
FACT_MEASURES = (
    "new_cases", "new_deaths", "total_cases", "total_deaths",
    "new_cases_smoothed", "new_deaths_smoothed",
    "total_vaccinations", "people_vaccinated", "people_fully_vaccinated",
    "people_vaccinated_per_hundred", "people_fully_vaccinated_per_hundred",
    "icu_patients", "hosp_patients",
    "death_rate", "vaccination_rate", "cases_per_million_calc",
)
COUNTRY_ATTRIBUTES = ("location", "continent", "population", "median_age", "gdp_per_capita",
                      "human_development_index")
INCOME_THRESHOLDS = ((12000.0, "High Income"), (4000.0, "Upper-Middle Income"),
                     (1000.0, "Lower-Middle Income"))
INCOME_LOW_LABEL = "Low Income"
INCOME_UNKNOWN_LABEL = "Unknown"
WAVE_LABELS = ("Wave 1 - Initial Outbreak", "Wave 2 - Second Surge", "Wave 3 - Alpha Variant",
               "Wave 4 - Delta Variant", "Wave 5 - Omicron & Endemic")
WAVE_BREAKPOINTS = ("2020-07-01", "2021-01-01", "2021-07-01", "2022-01-01")
VALID_CONTINENTS = ("Africa", "Asia", "Europe", "North America", "Oceania", "South America")
ROW_COUNT_BOUNDS = (100_000, 400_000)
DESCRIBE_COLUMNS = ("new_cases", "new_deaths", "total_cases", "total_deaths",
                    "total_vaccinations", "people_vaccinated_per_hundred",
                    "icu_patients", "hosp_patients")
NEGATIVE_CHECK_COLUMNS = ("new_cases", "new_deaths")
# warehouse column lengths (VARCHAR(n)) of the star schema
VARCHAR_LIMITS = {
    "dim_country": {"iso_code": 10, "country_name": 200, "continent": 50},
    "dim_date": {"month_name": 20, "covid_wave": 50},
    "dim_income_group": {"iso_code": 10, "income_group": 30},
}
# arrival audit
AUDIT_STATUS = "INGESTED"
AUDIT_LAYERS = (("bronze", "BRONZE"), ("silver", "SILVER"), ("gold", "GOLD"))
AUDIT_UNKNOWN = "UNKNOWN"
# ---------------------------------------------------------------------------------------------
AUDIT_PROJECT = "Panel Analytics"       # project named in audit rows, unless the caller gives its own


@dataclass(frozen=True)
class Rule:
    """One data-quality rule; evaluated by ``operators.quality`` in a single aggregate pass."""

    name: str
    kind: str                      # not_null | between | in_set | unique | type | row_count
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    values: tuple = ()
    dtype: str | None = None


def default_rules(cfg: "PanelConfig") -> tuple[Rule, ...]:
    """The 14 Silver checks, parameterised by the configuration; each is named by its kind and columns."""
    kind = cfg.metric_type.simpleString()
    rules = [Rule("", "not_null", (c,)) for c in (cfg.entity_col, cfg.name_col, cfg.date_col, cfg.group_col)]
    rules += [Rule("", "between", (c,), low, high, mostly) for c, low, high, mostly in (
        ("new_cases", 0, 10_000_000, 1.0), ("new_deaths", 0, 100_000, 1.0),
        ("death_rate", 0, 100, 0.99), ("vaccination_rate", 0, 200, 0.99))]
    rules += [Rule("", "in_set", (cfg.group_col,), values=tuple(cfg.valid_groups)),
              Rule("", "unique", (cfg.entity_col, cfg.date_col))]
    rules += [Rule("", "type", (c,), dtype=kind) for c in ("new_cases", "new_deaths", "population")]
    rules.append(Rule("", "row_count", (), *cfg.row_count_bounds))
    return tuple(replace(r, name=rule_name(r)) for r in rules)


def rule_name(r: Rule) -> str:
    what = {"not_null": "not null", "between": f"between {r.low} and {r.high}" + f", {r.mostly:.0%} of values" * (r.mostly < 1),
            "in_set": f"one of {len(r.values)} values", "unique": "unique", "type": f"type {r.dtype}",
            "row_count": f"between {r.low} and {r.high}"}[r.kind]
    return f"{', '.join(r.columns) or 'row count'}: {what}"


@dataclass(frozen=True)
class PanelConfig:
    entity_col: str = "iso_code"
    name_col: str = "location"
    group_col: str = "continent"
    date_col: str = "date"
    aggregate_prefix: str = AGGREGATE_CODE_PREFIX
    floor_columns: tuple[str, ...] = NEGATIVE_FLOOR_COLUMNS
    metric_columns: tuple[str, ...] = FLOAT_METRIC_COLUMNS
    metric_type: T.DataType = field(default_factory=T.FloatType)
    income_thresholds: tuple = INCOME_THRESHOLDS
    income_low: str = INCOME_LOW_LABEL
    income_unknown: str = INCOME_UNKNOWN_LABEL
    wave_breakpoints: tuple[str, ...] = WAVE_BREAKPOINTS
    wave_labels: tuple[str, ...] = WAVE_LABELS
    wave_null_label: bool = False          # strict mode: NULL date -> NULL wave (D4)
    valid_groups: tuple[str, ...] = VALID_CONTINENTS
    row_count_bounds: tuple[int, int] = ROW_COUNT_BOUNDS
    describe_columns: tuple[str, ...] = DESCRIBE_COLUMNS
    negative_check_columns: tuple[str, ...] = NEGATIVE_CHECK_COLUMNS
    # range buckets for dense surrogate keys (D1); None: the session's shuffle partitions
    key_buckets: int | None = None
    run_ts: _dt.datetime | None = None     # fixed ingest time; None -> current_timestamp()

    @property
    def wave_dates(self) -> tuple[_dt.date, ...]:
        return tuple(_dt.date.fromisoformat(d) for d in self.wave_breakpoints)

    @classmethod
    def for_tables(cls, **overrides) -> "PanelConfig":
        """Configuration of the panel derived from the test tables (dates 1995-2001)."""
        base = cls(
            wave_breakpoints=("1996-07-01", "1998-01-01", "1999-07-01", "2001-01-01"),
            valid_groups=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
        )
        return replace(base, **overrides)

    def with_(self, **overrides) -> "PanelConfig":
        return replace(self, **overrides)


def silver_schema(cfg: PanelConfig) -> T.StructType:
    """Explicit Silver schema (29 columns in the reference's order)."""
    fields = []
    for c in SILVER_COLUMNS:
        if c in ("iso_code", "location", "continent"):
            t = T.StringType()
        elif c == "date":
            t = T.DateType()
        elif c in ("record_year", "record_month"):
            t = T.IntegerType()
        elif c in ("death_rate", "vaccination_rate", "cases_per_million_calc"):
            t = T.DoubleType()
        elif c == "ingested_at":
            t = T.TimestampType()
        else:
            t = cfg.metric_type
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def bronze_schema(columns: list[str] | tuple[str, ...]) -> T.StructType:
    """Schema for reading a raw panel CSV: codes and names as text, date as text (cast later
    with ``try_cast`` so bad text becomes NULL plus a load-error row), metrics as text too so a
    malformed number is caught instead of failing the whole read."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
