"""Profile helpers: exact vs sketch distinct counts, describe, nulls."""
from tidemark.operators import profile
from tidemark.plans import stages

from paths import SF_MID


def test_distinct_exact_and_approx(spark):
    b = stages.bronze(spark, SF_MID)
    exact = {r[0]: r[1] for r in profile.distinct_counts(b).collect()}
    approx = {r[0]: r[1] for r in profile.distinct_counts(b, exact=False).collect()}
    assert set(exact) == set(approx) == set(b.columns)
    for c, n in exact.items():
        assert abs(approx[c] - n) <= max(2, 0.05 * n)


def test_describe_exact_and_approx(spark):
    b = stages.bronze(spark, SF_MID)
    ex = {r["column"]: r for r in profile.describe(b, ["new_cases", "total_cases"]).collect()}
    ap = {r["column"]: r for r in profile.describe(b, ["new_cases", "total_cases"], exact=False).collect()}
    for c in ex:
        assert ex[c]["count"] == ap[c]["count"] and ex[c]["max"] == ap[c]["max"]
        assert abs(ex[c]["p50"] - ap[c]["p50"]) <= 0.01 * max(1.0, abs(ex[c]["max"]))


def test_null_report_only_columns_with_nulls(spark):
    b = stages.bronze(spark, SF_MID)
    rep = profile.nulls_report(b).collect()
    assert rep and all(r["null_count"] > 0 for r in rep)
    pcts = [r["null_pct"] for r in rep]
    assert pcts == sorted(pcts, reverse=True)


def test_exact_quantiles_match_percentile(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.quantiles import exact_quantiles
    df = spark.range(0, 20000).select(
        ((F.col("id") * 7919) % 1013).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") / 7.0).alias("b"),
        F.lit(None).cast("double").alias("empty"))
    probs = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {(r[0], r[1]): r[2] for r in exact_quantiles(df, ["a", "b", "empty"], probs,
                                                       max_group=500, accuracy=100).collect()}
    exp = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c)
                   for c in ("a", "b")]).first()
    for c in ("a", "b"):
        for p, v in zip(probs, exp[c]):
            assert got[(c, p)] == __import__("pytest").approx(v, rel=1e-12, abs=1e-9)
    assert got[("empty", 0.5)] is None


def test_distinct_values_are_typed(spark):
    from tidemark.operators import profile
    rows = [(0.0, "a" * 50), (-0.0, "a" * 50), (float("nan"), "a" * 49 + "b"), (None, None), (1.5, "x")]
    df = spark.createDataFrame(rows, "v double, s string")
    got = {r["column"]: (r["null_count"], r["unique_count"]) for r in profile.column_profile(df).collect()}
    assert got == {"v": (2, 2), "s": (1, 3)}
    assert {r["column"]: r["unique_count"] for r in profile.distinct_counts(df).collect()} == {"v": 2, "s": 3}
    fold = [1604206800, 1604210400]        # the same local time twice, as clocks go back
    t = spark.createDataFrame([(s,) for s in fold], "s long").selectExpr("timestamp_seconds(s) AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert profile.column_profile(t).first()["unique_count"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_profiles_of_new_files_only(spark, tmp_path):
    from pyspark.sql import functions as F
    from tidemark.operators import profile, stored_profile as S
    path, store = str(tmp_path / "t"), str(tmp_path / "store")

    def add(low, high, files):
        (spark.range(low, high, 1, files).select(
            F.when(F.col("id") % 5 != 0, F.col("id") * 0.25).alias("x"), F.when(F.col("id") % 7 == 3, float("nan"))
            .otherwise(F.col("id") % 40).cast("double").alias("few"), F.lit(None).cast("double").alias("none"),
            (F.col("id") % 900).cast("string").alias("name")).write.mode("append").parquet(path))

    add(0, 3000, 3)
    assert S.update_profile(spark.read.parquet(path), store, 0, ["x", "few", "none"]) == 3
    add(3000, 7001, 2)
    add(0, 0, 1)                                    # a file without rows has no profile
    new = S.update_profile(spark.read.parquet(path), store, 1, ["x", "few", "none"])
    assert 2 <= new <= 3
    assert S.update_profile(spark.read.parquet(path), store, 1, ["x", "few", "none"]) == new        # repeated
    assert S.update_profile(spark.read.parquet(path), store, 2, ["x", "few", "none"]) <= 1
    table, stored = spark.read.parquet(path), S.read_store(spark, store)
    got = {r["column"]: r for r in S.merged_profile(stored).collect()}
    exact = {r["column"]: r for r in profile.column_profile(table).collect()}
    assert set(got) == set(exact)
    for c, r in exact.items():
        assert (got[c]["null_count"], got[c]["null_pct"]) == (r["null_count"], r["null_pct"])
        assert abs(got[c]["unique_count"] - r["unique_count"]) <= 0.03 * r["unique_count"]
    want = profile.describe(table.where("NOT isnan(few) OR few IS NULL"), ["few"]).collect()
    assert S.describe_stored(table, stored, ["x", "none"]).collect() == profile.describe(table, ["x", "none"]).collect()
    assert S.describe_stored(table, stored, ["few"]).collect() == want
