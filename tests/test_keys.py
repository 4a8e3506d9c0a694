"""Dense surrogate keys: equal to the global rank, independent of buckets and partitions."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.keys import dense_key


def _expected(df, key):
    w = Window.orderBy(F.col(key).asc_nulls_last())
    return {r[0]: r[1] for r in df.select(key, F.row_number().over(w)).collect()}


def test_multi_bucket_equals_global_rank(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("k"))
    df = df.union(spark.createDataFrame([(None,)], "k string"))
    exp = _expected(df, "k")
    for buckets in (None, 1, 17, 135):
        got = dense_key(df, "k", "key", buckets)
        assert got.rows == 5001
        assert {r[0]: r[1] for r in got.df.collect()} == exp
    assert exp[None] == 5001


def test_stable_across_shuffle_partitions(spark):
    df = spark.range(0, 2000).select(((F.col("id") * 31) % 2000).cast("int").alias("k"))
    results = []
    for parts in ("3", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(sorted(tuple(r) for r in dense_key(df, "k", "key").df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
    assert [r[1] for r in results[0]] == list(range(1, 2001))


def test_dense_key_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow])
    @given(st.sets(st.text("abcxyz", min_size=0, max_size=4), min_size=1, max_size=300),
           st.booleans(), st.integers(1, 60))
    def check(keys, with_null, buckets):
        data = [(k,) for k in keys] + ([(None,)] if with_null else [])
        df = spark.createDataFrame(data, "k string")
        got = {r[0]: r[1] for r in dense_key(df, "k", "key", buckets).df.collect()}
        ordered = sorted(keys, key=lambda s: s.encode()) + ([None] if with_null else [])
        assert got == {k: i + 1 for i, k in enumerate(ordered)}

    check()


def test_plan_does_not_grow_with_the_buckets(spark):
    df = spark.range(0, 20_000).select(F.format_string("k%06d", "id").alias("k"))
    small, large = (len(dense_key(df, "k", "key", n).df._jdf.queryExecution().optimizedPlan().toString()) for n in (4, 400))
    assert large < small + 2000
