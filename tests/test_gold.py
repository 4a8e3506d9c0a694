"""Gold labels, one dimension row per entity, keys and NULL handling."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.config import PanelConfig
from tidemark.functions.metrics import date_label, is_weekend, threshold_label
from tidemark.operators import gold, silver

CFG = PanelConfig()


def test_income_labels(spark):
    df = spark.createDataFrame([(12000.0,), (11999.9,), (4000.0,), (1000.0,), (999.0,), (None,)],
                               "g double")
    lab = threshold_label(F.col("g"), CFG.income_thresholds, CFG.income_low, CFG.income_unknown)
    got = [r[0] for r in df.select(lab).collect()]
    assert got == ["High Income", "Upper-Middle Income", "Upper-Middle Income",
                   "Lower-Middle Income", "Low Income", "Unknown"]


def test_wave_and_weekend(spark):
    dates = [dt.date(2020, 6, 30), dt.date(2020, 7, 1), dt.date(2021, 1, 1), dt.date(2021, 7, 1),
             dt.date(2022, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = [r[0] for r in df.select(date_label(F.col("d"), CFG.wave_dates, CFG.wave_labels)).collect()]
    assert got == [CFG.wave_labels[i] for i in (0, 1, 2, 3, 4, 4)]
    strict = [r[0] for r in df.select(date_label(F.col("d"), CFG.wave_dates, CFG.wave_labels,
                                                 True)).collect()]
    assert strict[-1] is None
    wk = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)],
                               "d date")
    assert [r[0] for r in wk.select(is_weekend(F.col("d"))).collect()] == [True, True, False]


def _silver(spark, rows):
    cols = "iso_code string, location string, continent string, date string, population string"
    return silver.transform(spark.createDataFrame(rows, cols), CFG)


def test_one_dim_row_per_entity_and_no_fanout(spark):
    s = _silver(spark, [("AAA", "A", "Asia", "2021-01-01", "10"),
                        ("AAA", "A", "Asia", "2021-01-02", "20"),
                        ("BBB", "B", "Europe", "2021-01-01", "5"),
                        ("BBB", "B", "Europe", "bad", None)])
    star = gold.build_star(s, CFG)
    dc = {r["iso_code"]: r for r in star.dim_country.collect()}
    assert len(dc) == 2 and dc["AAA"]["population"] == 20.0   # latest by date
    assert dc["BBB"]["population"] == 5.0                      # latest non-null
    assert star.fact.count() == s.count() == 4
    assert [r["country_key"] for r in star.dim_country.orderBy("iso_code").collect()] == [1, 2]
    dd = star.dim_date.orderBy("date_key").collect()
    assert dd[-1]["date"] is None                              # NULL date: own row, last key
    assert star.fact.where(F.col("date_key").isNull()).count() == 1   # NULL never matches
    inc = {r["iso_code"]: r["income_key"] for r in star.dim_income.collect()}
    assert inc == {k: v["country_key"] for k, v in dc.items()}


def test_daily_trend_country_slicer(spark):
    from paths import SF_SMALL
    from tidemark.plans import marts, stages
    star = stages.star(spark, SF_SMALL)
    name = star.dim_country.orderBy("country_key").first()["country_name"]
    one = marts.m3_daily_trend(star, country=name)
    alls = marts.m3_daily_trend(star)
    assert 0 < one.count() < alls.count()
    assert one.select("continent").distinct().count() == 1
