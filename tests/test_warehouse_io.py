"""Warehouse load, registration, layer reads and the quality report sink."""
import datetime as dt
import uuid

import pytest
from pyspark.errors import AnalysisException

from tidemark.config import default_rules
from tidemark.operators import quality
from tidemark.plans import stages, warehouse
from tidemark.sources import files

from paths import SF_SMALL


def test_missing_layer_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_layer(spark, str(tmp_path / "nope"))


def test_report_has_run_time_and_round_trips(spark, tmp_path):
    s = stages.silver(spark, SF_SMALL)
    ts = dt.datetime(2024, 1, 1, 12, 0, 0)
    rep = quality.report(s, default_rules(stages.TABLE_CONFIG), run_time=ts)
    rows = rep.collect()
    assert len(rows) == 14 and all(r["run_time"] == ts for r in rows)
    files.write_report(rep.drop("run_time"), str(tmp_path / "rep"))
    back = spark.read.option("header", True).csv(str(tmp_path / "rep"))
    assert back.count() == 14 and set(back.columns) == {"check", "kind", "status", "unexpected",
                                                        "observed"}


def test_load_enforces_varchar_and_register(spark, tmp_path):
    db = f"t_{uuid.uuid4().hex[:8]}"
    warehouse.create_star(spark, db, str(tmp_path / "wh"), fact_buckets=4)
    star = stages.star(spark, SF_SMALL)
    counts = warehouse.load_star(star.tables(), db)
    assert counts["fact_covid_cases"] == star.fact.count()
    too_long = star.dim_income.limit(1).selectExpr("income_key", "iso_code",
                                                   "repeat('x', 40) AS income_group")
    with pytest.raises(Exception) as exc:
        warehouse._insert_by_name(too_long, f"{db}.dim_income_group")
    assert "EXCEED_LIMIT_LENGTH" in str(exc.value) or "length" in str(exc.value).lower()
    res = stages.scratch(spark, "gold_reg")
    paths = files.write_star(star.tables(), res)
    warehouse.register(spark, paths, database=f"{db}_ext")
    assert spark.table(f"{db}_ext.dim_country").count() == star.country_rows


def test_constraints_clean_on_built_star(spark):
    v = warehouse.constraint_violations(stages.star(spark, SF_SMALL)).collect()
    assert len(v) == 16 and all(r["violations"] == 0 for r in v)


def test_layout_is_registered_whatever_the_skew(spark, tmp_path):
    from pyspark.sql import functions as F
    hot = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 30).alias("country_key"),
        (F.col("id") % 1000).alias("date_key"))
    t = f"hot_{uuid.uuid4().hex[:8]}"
    warehouse.write_fact(hot, str(tmp_path / "hot"), t)
    assert spark.table(t).count() == 30000
    spark.sql(f"DROP TABLE {t}")


def test_bucketed_write_makes_one_file_per_bucket(spark, tmp_path):
    df = spark.range(0, 600, 1, 6).selectExpr("id % 40 AS country_key", "id AS date_key")
    t = f"b_{uuid.uuid4().hex[:8]}"
    warehouse.write_fact_bucketed(df, t, 8, str(tmp_path / "b"))
    assert len(list((tmp_path / "b").glob("*.parquet"))) <= 8
    spark.sql(f"DROP TABLE {t}")


def test_csv_headers_name_files_only_where_they_differ(spark, tmp_path):
    from tidemark.sources.files import csv_headers
    for i, header in enumerate(["a,b,c", "a, b ,c", "\ufeffa,b,c"]):
        (tmp_path / f"f{i}.csv").write_text(header + "\n1,2,3\n")
    assert csv_headers(spark, str(tmp_path)) == {("a", "b", "c"): [str(tmp_path)]}
    (tmp_path / "g.csv").write_text("c,a,b\n1,2,3\n")
    found = csv_headers(spark, str(tmp_path))
    assert {h: len(f) for h, f in found.items()} == {("a", "b", "c"): 3, ("c", "a", "b"): 1}
    assert found["c", "a", "b"][0].endswith("/g.csv")
