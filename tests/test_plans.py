"""Physical-plan properties that matter at scale."""
import contextlib
import io
import uuid

from pyspark.sql import functions as F

from tidemark.plans import queries, stages, warehouse
from tidemark.sources import panel

from paths import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_joins_once_and_prunes(spark):
    p = _plan(panel.panel(spark, SF_SMALL))
    assert p.count("lineitem.parquet") == 1          # grouping sets: one pass over the join
    # the large aggregate, by nation key and date, lies below the grouping sets and the names
    assert p.index("Expand") < p.index("keys=[c_nationkey")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        panel.panel(spark, SF_SMALL).explain("formatted")
    formatted = buf.getvalue()
    assert ("ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_discount:double,"
            "l_returnflag:string,l_linestatus:string>") in formatted


def test_star_queries_broadcast_dims_and_topk(spark):
    star = stages.star(spark, SF_SMALL)
    p2 = _plan(queries.q2_monthly_continent(star))
    assert "BroadcastHashJoin" in p2 and "CartesianProduct" not in p2
    p1 = _plan(queries.q1_top_countries(star))
    assert "TakeOrderedAndProject" in p1


def test_bucketed_fact_aggregates_without_exchange(spark):
    star = stages.star(spark, SF_SMALL)
    table = f"t_{uuid.uuid4().hex[:8]}"
    warehouse.write_fact_bucketed(star.fact, table, buckets=4,
                                  path=stages.scratch(spark, "bucket_test"))
    agg = spark.table(table).groupBy("country_key").agg(F.sum("new_cases"))
    p = _plan(agg)
    assert "Exchange" not in p


def test_silver_is_narrow_over_panel(spark):
    from tidemark.operators import silver
    b = stages.bronze(spark, SF_SMALL)
    n_b = _plan(b).count("Exchange")
    n_s = _plan(silver.transform(b, stages.TABLE_CONFIG)).count("Exchange")
    assert n_s == n_b                                  # Silver adds no shuffle


def test_year_partitioned_silver_prunes(spark):
    from tidemark.sources import files
    path = stages.scratch(spark, "silver_by_year")
    files.write_layer(stages.silver(spark, SF_SMALL), path, partition_by=("record_year",))
    df = files.read_layer(spark, path).where(F.col("record_year") == 1996)
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(record_year" in plan and "= 1996)" in plan
    assert df.count() == stages.silver(spark, SF_SMALL).where(F.col("record_year") == 1996).count()


def test_sql_text_equals_dataframe_queries(spark):
    from tidemark.plans import sql_text
    star = stages.star(spark, SF_SMALL)
    suffix = f"_{uuid.uuid4().hex[:8]}"
    sql_text.register_star(star, suffix)
    for name in ("q1_top_countries", "q4_by_wave", "q6_by_income", "q9_top10"):
        a = sql_text.run(spark, name, suffix).collect()
        b = getattr(queries, name)(star).collect()
        assert [tuple(r) for r in a] == [tuple(r) for r in b], name


def test_broadcasts_follow_the_planners_byte_limit(spark):
    star = stages.star(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(queries.q2_monthly_continent(star))
        rows = sorted(map(tuple, queries.q2_monthly_continent(star).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p and ("SortMergeJoin" in p or "ShuffledHashJoin" in p)
    assert rows == sorted(map(tuple, queries.q2_monthly_continent(star).collect()))


def test_maxima_reduce_the_fact_before_names(spark):
    p = _plan(queries.q1_top_countries(stages.star(spark, SF_SMALL)))
    fact = p.index("total_cases")
    assert p.index("country_name") >= 0 and fact >= 0
    assert p.rindex("keys=[country_key") > p.index("BroadcastHashJoin")      # below the join to the names


def test_lineitems_preaggregated_before_their_shuffle(spark):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        panel.panel(spark, SF_SMALL).explain("formatted")
    text = buf.getvalue()
    # the line-item scan feeds a partial aggregate keyed by the order key, then the exchange
    scan = text.index("Location: InMemoryFileIndex [file:" + SF_SMALL + "/lineitem.parquet]")
    after = text[scan:]
    partial = after.index("Keys [1]: [l_orderkey")
    exchange = after.index("hashpartitioning(l_orderkey")
    assert partial < exchange
    assert "partial_sum" in after[partial:exchange]
