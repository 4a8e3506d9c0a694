"""Golden rows for the Silver rules (FIXTURES.md section 5)."""
import datetime as dt

import pytest

from tidemark.config import PanelConfig
from tidemark.operators import silver

COLS = ["iso_code", "location", "continent", "date", "total_cases", "new_cases", "total_deaths",
        "people_vaccinated", "population"]
CFG = PanelConfig()


def _run(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))
    return {r["location"]: r for r in silver.transform(df, CFG).collect()}


def row(loc, iso="AFG", cont="Asia", date="2021-03-01", tc="10", nc="1", td="1", pv=None, pop="100"):
    return (iso, loc, cont, date, tc, nc, td, pv, pop)


def test_filters(spark):
    out = _run(spark, [row("keep", nc="-5"), row("nullcont", cont=None), row("owid", iso="OWID_X"),
                       row("nulliso", iso=None), row("literal", iso="OWIDX")])
    assert set(out) == {"keep", "literal"}
    assert out["keep"]["new_cases"] == 0.0


def test_nulls_and_rates(spark):
    out = _run(spark, [
        row("nullnew", nc=None),
        row("zero_cases", tc="0", td="1"),
        row("third", tc="3", td="1"),
        row("nullcases", tc=None),
        row("zeropop", pop="0", pv="5"),
        row("nullpop", pop=None, pv="5"),
        row("nullvax", pop="8", pv=None),
        row("cpm", pop="4000", tc="1"),
        row("bigfloat", tc="100000001"),
    ])
    assert out["nullnew"]["new_cases"] is None
    assert out["zero_cases"]["death_rate"] is None
    assert out["third"]["death_rate"] == pytest.approx(33.3333)
    assert out["nullcases"]["death_rate"] is None
    for k in ("zeropop", "nullpop"):
        assert out[k]["vaccination_rate"] is None and out[k]["cases_per_million_calc"] is None
    assert out["nullvax"]["vaccination_rate"] is None
    assert out["cpm"]["cases_per_million_calc"] == 250.0
    assert out["bigfloat"]["total_cases"] == 100000000.0


def test_bad_date(spark):
    out = _run(spark, [row("bad", date="bad"), row("good", date="2021-03-01")])
    assert out["bad"]["date"] is None and out["bad"]["record_year"] is None
    assert out["good"]["date"] == dt.date(2021, 3, 1)
    assert (out["good"]["record_year"], out["good"]["record_month"]) == (2021, 3)


def test_schema_is_fixed(spark):
    df = spark.createDataFrame([row("a")], ", ".join(f"{c} string" for c in COLS))
    s = silver.transform(df, CFG).schema
    assert len(s.fields) == 29
    types = {f.name: f.dataType.simpleString() for f in s.fields}
    assert types["new_cases"] == "float" and types["death_rate"] == "double"
    assert types["record_year"] == "int" and types["ingested_at"] == "timestamp"
    assert types["median_age"] == "float"   # absent input column -> typed NULL


def test_load_errors(spark):
    from tidemark.sources.files import load_errors
    df = spark.createDataFrame([row("bad", date="bad", nc="x1"), row("ok")],
                               ", ".join(f"{c} string" for c in COLS))
    errs = {(r["column"], r["raw_value"]) for r in load_errors(df, CFG).collect()}
    assert errs == {("date", "bad"), ("new_cases", "x1")}


def test_load_errors_malformed_lines(spark, tmp_path):
    from tidemark.sources.files import load_errors, read_panel_csv
    p = tmp_path / "raw.csv"
    p.write_text("iso_code,date,new_cases\nAAA,2021-01-01,5\nBBB,2021-01-02\n"
                 "CCC,2021-01-03,7,99\nDDD,bad,1\n")
    raw = read_panel_csv(spark, str(p), ["iso_code", "date", "new_cases"], keep_malformed=True)
    errs = sorted((r["iso_code"], r["column"], r["raw_value"])
                  for r in load_errors(raw, CFG).collect())
    assert errs == [("BBB", "_line", "BBB,2021-01-02"), ("CCC", "_line", "CCC,2021-01-03,7,99"),
                    ("DDD", "date", "bad")]
    clean = silver.transform(raw, CFG.with_(group_col="iso_code"))
    assert clean.count() == 4                      # malformed lines still load, as in PERMISSIVE


def test_csv_columns_are_found_by_name(spark, tmp_path):
    import pytest

    from tidemark.sources.files import read_panel_csv
    (tmp_path / "a.csv").write_text("iso_code,date,new_cases\nFR,2020-01-01,1\n")
    (tmp_path / "b.csv").write_text("new_cases,\"note, x\",iso_code,date\n2,\"n, m\",DE,2020-01-02\n")
    rows = read_panel_csv(spark, str(tmp_path), ["iso_code", "date", "new_cases"]).collect()
    assert sorted(map(tuple, rows)) == [("DE", "2020-01-02", "2"), ("FR", "2020-01-01", "1")]
    with pytest.raises(ValueError, match="new_deaths"):
        read_panel_csv(spark, str(tmp_path), ["iso_code", "new_deaths"])
