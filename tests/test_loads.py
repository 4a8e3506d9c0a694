"""Layouts, load errors with their place, enforced loads, keys over many loads, uniqueness on arrival."""
import datetime as dt
import glob
import random
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.config import PanelConfig
from tidemark.operators import keys, uniqueness
from tidemark.plans import enforce, stages, warehouse
from tidemark.sources import load_errors
from tidemark.streaming import audit

from paths import SF_MID, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_colocated_join_has_no_exchange(spark, tmp_path):
    star, name = stages.star(spark, SF_SMALL), uuid.uuid4().hex[:8]
    warehouse.write_fact_bucketed(star.fact, f"f_{name}", 4, str(tmp_path / "f"))
    warehouse.write_dim_bucketed(star.dim_country, f"d_{name}", 4, str(tmp_path / "d"))
    joined = warehouse.join_colocated(spark, f"f_{name}", f"d_{name}")
    agg = joined.groupBy("country_key", "country_name").agg(F.sum("new_cases"))
    p = _plan(agg)
    assert "SortMergeJoin" in p and "Exchange" not in p
    assert joined.count() == star.fact.count()
    for t in (f"f_{name}", f"d_{name}"):
        spark.sql(f"DROP TABLE {t}")


def _groups_met(path, column, low, high):
    """Row groups whose statistics meet [low, high], and all row groups."""
    met = every = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        i = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(i).statistics
            every += 1
            met += s is not None and s.has_min_max and s.min <= high and s.max >= low
    return met, every


def test_curve_prunes_on_either_key(spark, tmp_path):
    star = stages.star(spark, SF_MID)
    fact = stages.materialize(star.fact, "fact")
    warehouse.write_fact_clustered(fact, str(tmp_path / "z"), ranges=[(1, star.country_rows), (1, star.date_rows)], files=32)
    (fact.repartitionByRange(32, "country_key", "date_key").sortWithinPartitions("country_key", "date_key")
     .write.parquet(str(tmp_path / "s")))
    found = {(kind, c): _groups_met(tmp_path / kind, c, low, high) for kind in "zs"
             for c, low, high in (("country_key", 3, 3), ("date_key", 100, 120))}
    for c in ("country_key", "date_key"):
        met, every = found["z", c]
        assert every >= 30 and met <= every / 3, found
    # the sorted layout prunes on its first key alone
    assert found["s", "country_key"][0] <= 4 and found["s", "date_key"][0] >= 3 * found["z", "date_key"][0], found


def test_curve_spreads_a_hot_key_and_takes_odd_keys(spark, tmp_path):
    rows = spark.range(0, 20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 30).cast("long")
        .alias("country_key"), F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 900).alias("date_key"), "id")
    warehouse.write_fact_clustered(rows, str(tmp_path / "hot"), files=10)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/hot/*.parquet")]
    assert sum(sizes) == 20_000 and max(sizes) < 4_000
    assert spark.read.parquet(str(tmp_path / "hot")).agg(F.sum("id")).first()[0] == sum(range(20_000))
    warehouse.write_fact_clustered(rows.limit(0), str(tmp_path / "none"))


def _csv(folder, name, lines, end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(end.join(lines).encode() + end.encode())


def test_lines_are_exact_in_split_files(spark, tmp_path):
    rng, cfg = random.Random(2), PanelConfig()
    want = set()
    for f, order in enumerate((["iso_code", "date", "new_cases"], ["date", "new_cases", "note", "iso_code"], ["iso_code", "date", "new_cases"])):
        lines = [",".join(order)]
        for i in range(1500):
            cell = {"iso_code": f"C{i % 9}", "date": "2021-02-03", "new_cases": str(i), "note": '"a, ""b"""'}
            kind = rng.randrange(40)
            number = len(lines) + 1
            if kind == 0:
                lines.append("")
                continue
            if kind == 1:
                cell["date"] = "2021-13-45"
                want.add((f"f{f}.csv", number, "date", "2021-13-45", "not a date"))
            if kind in (1, 2):
                cell["new_cases"] = "many"
                want.add((f"f{f}.csv", number, "new_cases", "many", "not a number"))
            if kind == 3:
                cell["new_cases"] = ""                      # missing is no error
            text = ",".join(cell[c] for c in order)
            if kind == 4:
                text += ",1,2"
                want.add((f"f{f}.csv", number, "_line", text, "wrong number of fields"))
            lines.append(text)
        _csv(tmp_path / "in", f"f{f}.csv", lines, "\r\n" if f == 2 else "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = load_errors.find_errors(spark, str(tmp_path / "in"), cfg)
        got = [(r["file"].rsplit("/", 1)[1], r["line"], r["column"], r["raw_value"], r["reason"]) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == len(set(got)) and set(got) == want


def test_error_loads_replace_their_own(spark, tmp_path):
    cfg, base = PanelConfig(), str(tmp_path / "errors")
    _csv(tmp_path / "a", "a.csv", ["iso_code,date,new_cases", "A,2021-01-01,1", "A,soon,1"])
    _csv(tmp_path / "b", "b.csv", ["iso_code,date,new_cases", "A,2021-01-01,x"])
    _csv(tmp_path / "c", "c.csv", ["iso_code,date,new_cases", "A,2021-01-01,1"])
    for load, name in ((0, "a"), (1, "b"), (0, "a"), (2, "c")):
        load_errors.record_errors(spark, str(tmp_path / name), base, cfg, load, dt.datetime(2024, 1, 1 + load))
    errors = load_errors.read_errors(spark, base)
    assert errors.count() == 2
    assert [(r["load"], r["line"], r["column"]) for r in load_errors.latest_errors(errors).collect()] == [(1, 2, "new_cases"), (0, 3, "date")]
    assert load_errors.latest_errors(errors, 1).count() == 1


def _dims(spark, pairs):
    return spark.createDataFrame(pairs, "country_key long, iso_code string")


def test_enforced_load(spark, tmp_path):
    base = str(tmp_path / "db")
    first = _dims(spark, [(1, "A"), (2, "B"), (2, "C"), (None, "D"), (None, "E" * 11), (3, None)])
    enforce.load_enforced(spark, {"dim_country": first}, base, 0)
    assert sorted(tuple(r) for r in enforce.published(spark, base, "dim_country").collect()) == [(1, "A"), (2, "B")]
    assert sorted((r["reason"], r["iso_code"]) for r in enforce.rejected(spark, base, "dim_country").collect()) == [
        ("country_key is null", "D"), ("country_key is null; iso_code longer than 10", "E" * 11),
        ("country_key repeated in the load", "C"), ("iso_code is null", None)]
    # a load that is not published is not seen; one that is published twice counts once
    facts = spark.createDataFrame([(1, None, None), (4, None, None), (None, None, None)], "country_key long, date_key long, income_key long")
    later = {"dim_country": _dims(spark, [(1, "X"), (4, "F")]), "fact_covid_cases": facts}
    enforce.split_rows(later["dim_country"], "dim_country", enforce.published(spark, base, "dim_country"), {})
    assert enforce.published(spark, base, "fact_covid_cases") is None
    for _ in range(2):
        enforce.load_enforced(spark, later, base, 1)
    assert enforce.published(spark, base, "dim_country").count() == 3
    assert enforce.published(spark, base, "fact_covid_cases").count() == 3
    assert enforce.published(spark, base, "dim_country", 1).count() == 2
    # facts alone refer to the stored dimensions; unknown and missing parents
    enforce.load_enforced(spark, {"fact_covid_cases": facts.withColumn("country_key", F.col("country_key") + 3)}, base, 2)
    assert sorted((r["country_key"], r["reason"]) for r in enforce.rejected(spark, base, "fact_covid_cases").collect()) == [
        (7, "country_key not in dim_country")]
    enforce.load_enforced(spark, {"fact_covid_cases": facts.withColumn("date_key", F.lit(1).cast("long")).limit(1),
                                  "dim_country": first.limit(0)}, base, 3)
    assert enforce.rejected(spark, base, "fact_covid_cases").where("load = 3").first()["reason"] == "date_key not in dim_date"


def test_enforced_load_of_a_hot_key(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).cast("long").alias("country_key"),
                                             F.lit("A").alias("iso_code"))
    enforce.load_enforced(spark, {"dim_country": rows}, str(tmp_path / "db"), 0)
    taken = enforce.published(spark, str(tmp_path / "db"), "dim_country")
    assert taken.count() == taken.select("country_key").distinct().count() == rows.select("country_key").distinct().count()


def test_keys_persist_and_repeat(spark, tmp_path):
    base = str(tmp_path / "keys")

    def load(n, values):
        df = spark.createDataFrame([(v,) for v in values], "name string").distinct()
        return {r["name"]: (r["k"], r["load"]) for r in keys.extend_key_map(df, base, "name", "k", n, 3).collect()}

    first = load(0, ["m", "c", "x"])
    assert first == {"c": (1, 0), "m": (2, 0), "x": (3, 0)}
    second = load(1, ["a", "m", None, "z"])
    assert second == first | {"a": (4, 1), "z": (5, 1), None: (6, 1)}
    assert load(2, ["a", None]) == second
    assert load(1, ["a", "m", None, "z"]) == second             # repeated after a failure
    assert load(3, ["b", "z"]) == second | {"b": (7, 3)}


def test_uniqueness_on_arrival_is_exact_with_any_filter(spark):
    rng = random.Random(5)
    stored = [(p, rng.randrange(4000), rng.choice("ab")) for p in range(4) for _ in range(600)]
    new = [(rng.randrange(4000), rng.choice("ab")) for _ in range(900)] + [(None, "a"), (None, "a"), (1, None)]
    new += [(17, "a")] * 300                                    # a third of all rows
    s = spark.createDataFrame(stored, "part int, k long, t string")
    n = spark.createDataFrame(new, "k long, t string").repartition(4)
    want = set()
    for key in {x for x in new if None not in x}:
        rows = new.count(key)
        want |= {(*key, rows, None)} if rows > 1 else set()
        want |= {(*key, rows, p) for p, k, t in stored if (k, t) == key}
    for bits in (1 << 20, 2000):                                # 2000: nearly every key is looked up
        filters = uniqueness.key_filters(s, ["k", "t"], "part", bits)
        halves = uniqueness.merge_filters(uniqueness.key_filters(s.where("k % 2 = 0"), ["k", "t"], "part", bits).unionByName(
            uniqueness.key_filters(s.where("k % 2 = 1"), ["k", "t"], "part", bits)), "part")
        for f in (filters, halves):
            got = [tuple(r) for r in uniqueness.duplicates_on_arrival(n, ["k", "t"], s, f, "part", bits).collect()]
            assert len(got) == len(set(got)) and set(got) == want
    asked = uniqueness.maybe_stored(n.where("k IS NOT NULL AND t IS NOT NULL").distinct(), ["k", "t"],
                                    uniqueness.key_filters(s, ["k", "t"], "part", 1 << 20), "part", 1 << 20)
    assert asked.count() < len(want) + 50                       # a wide filter looks up hardly any key in vain


def test_notifications_count_once_within_the_span(spark, tmp_path):
    body = ('{"Records": [{"eventTime": "%s", "s3": {"bucket": {"name": "x-gold"}, "object": {"key": "%s", "size": 1}}}]}')
    landing = tmp_path / "n"
    landing.mkdir()
    for i, lines in enumerate(([("2024-01-01T00:00:00", "a"), ("2024-01-01T00:00:00", "a")], [("2024-01-01T00:00:00", "a"), ("2024-01-01T00:00:01", "a")],
                               [("2024-01-02T00:00:00", "b"), ("soon", "c")])):
        (landing / f"{i}.txt").write_text("".join(body % x + "\n" for x in lines))
    audit.stream_events(spark, str(landing), str(tmp_path / "sink"), str(tmp_path / "ckpt"), max_files_per_trigger=1, once_within="9000 days")
    got = sorted((r["event_time"], r["file_key"]) for r in spark.read.parquet(str(tmp_path / "sink")).collect())
    assert got == [("2024-01-01T00:00:00", "a"), ("2024-01-01T00:00:01", "a"), ("2024-01-02T00:00:00", "b"), ("soon", "c")]
