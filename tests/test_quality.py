"""Data-quality rules on passing and failing inputs; the gate."""
import pytest

from tidemark.config import Rule, default_rules
from tidemark.operators import quality
from tidemark.plans import stages
from tidemark.sources.tables import read_table

from paths import SF_MID


def test_unique_pass_and_fail(spark):
    od = read_table(spark, SF_MID, "orders", "o_orderkey")
    assert quality.duplicate_groups(od, ["o_orderkey"]).first()["duplicate_groups"] == 0
    li = read_table(spark, SF_MID, "lineitem", "l_orderkey", "l_linenumber")
    assert quality.duplicate_groups(li, ["l_orderkey", "l_linenumber"]).first()[0] == 11785


def test_fk_pass(spark):
    li = read_table(spark, SF_MID, "lineitem", "l_orderkey")
    od = read_table(spark, SF_MID, "orders", "o_orderkey")
    assert quality.orphans(li, ["l_orderkey"], od, ["o_orderkey"]).count() == 0


def test_rules_semantics(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, "b"), (5.0, None), (200.0, "a")], "x double, s string")
    rules = [Rule("x nn", "not_null", ("x",)), Rule("x 0-10", "between", ("x",), 0, 10),
             Rule("x 0-10 mostly", "between", ("x",), 0, 10, mostly=0.6),
             Rule("s in", "in_set", ("s",), values=("a", "b")),
             Rule("rows", "row_count", (), 1, 3), Rule("x float", "type", ("x",), dtype="double"),
             Rule("s unique", "unique", ("s",))]
    rep = {r["check"]: r for r in quality.evaluate(df, rules).collect()}
    assert rep["x nn"]["status"] == "FAIL" and rep["x nn"]["unexpected"] == 1
    assert rep["x 0-10"]["status"] == "FAIL" and rep["x 0-10"]["observed"] == 3
    assert rep["x 0-10 mostly"]["status"] == "PASS"          # 2 of 3 non-null pass >= 0.6
    assert rep["s in"]["status"] == "PASS"                  # NULL ignored
    assert rep["rows"]["status"] == "FAIL" and rep["rows"]["observed"] == 4
    assert rep["x float"]["status"] == "PASS"
    assert rep["s unique"]["status"] == "FAIL"
    assert [r["check"] for r in quality.evaluate(df, rules).collect()] == [r.name for r in rules]


def test_gate_raises_and_passes(spark):
    s = stages.silver(spark, SF_MID)
    cfg = stages.TABLE_CONFIG
    with pytest.raises(quality.QualityError) as exc:
        quality.gate(s, default_rules(cfg))              # row-count bounds are the reference's
    assert any("row count" in r["check"] for r in exc.value.failed)
    # the panel's rows without a date fail their rule; without them the gate opens
    s = s.where("date IS NOT NULL")
    ok = quality.gate(s, default_rules(cfg.with_(row_count_bounds=(1000, 100000))))
    assert ok.count() == 14


def test_row_rules_one_scan(spark):
    s = stages.silver(spark, SF_MID)
    rules = [r for r in default_rules(stages.TABLE_CONFIG) if r.kind not in ("unique", "type")]
    plan = quality.evaluate(s, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 5   # the five source tables, scanned once each


def test_nan_is_missing_and_mostly_holds_for_every_kind(spark):
    from tidemark.config import Rule
    from tidemark.operators import quality
    df = spark.createDataFrame([(float(i), "x" if i else "odd", None if i == 5 else i) for i in range(100)]
                               + [(float("nan"), None, 1)], "v double, s string, n int")
    got = {r["check"]: r for r in quality.evaluate(df, [
        Rule("between", "between", ("v",), 0, 99),
        Rule("in_set", "in_set", ("s",), values=("x",), mostly=0.9),
        Rule("in_set strict", "in_set", ("s",), values=("x",)),
        Rule("not_null", "not_null", ("n",), mostly=0.9),
        Rule("nan is null", "not_null", ("v",))]).collect()}
    assert got["between"]["status"] == "PASS" and got["between"]["observed"] == 100
    assert got["in_set"]["status"] == "PASS" and got["in_set strict"]["status"] == "FAIL"
    assert got["not_null"]["status"] == "PASS" and got["not_null"]["unexpected"] == 1
    assert got["nan is null"]["status"] == "FAIL" and got["nan is null"]["unexpected"] == 1
