"""Empty inputs flow through every stage without errors."""
from tidemark.config import PanelConfig, default_rules
from tidemark.operators import gold, profile, quality, silver
from tidemark.plans import queries

CFG = PanelConfig()
COLS = "iso_code string, location string, continent string, date string, total_cases string"


def test_empty_panel_through_star_and_queries(spark):
    raw = spark.createDataFrame([], COLS)
    s = silver.transform(raw, CFG)
    star = gold.build_star(s, CFG)
    assert star.country_rows == 0 and star.date_rows == 0
    assert star.fact.count() == 0
    assert queries.q1_top_countries(star).count() == 0
    assert queries.q8_row_counts(star).collect()[0]["row_count"] == 0
    rep = {r["check"]: r["status"] for r in quality.evaluate(s, default_rules(CFG)).collect()}
    assert rep["row count: between 100000 and 400000"] == "FAIL" and rep["iso_code: not null"] == "PASS"
    d = profile.describe(s, ["total_cases"]).collect()
    assert d[0]["count"] == 0 and d[0]["p50"] is None
