"""Arrival audit golden events (FIXTURES.md section 3) and the file-driven stream."""
import json
import os

from tidemark.streaming import audit


def _body(bucket, key, size=None):
    obj = {"key": key}
    if size is not None:
        obj["size"] = size
    return json.dumps({"Records": [{"eventTime": "2024-01-01T00:00:00Z",
                                    "s3": {"bucket": {"name": bucket}, "object": obj}}]})


def test_golden_events(spark):
    bodies = [_body("x-bronze-y", "raw/a.csv", 1572864),
              _body("x-silver-gold", "p/part.snappy.parquet", 131072),
              _body("gold-y", "a.b/noext"), _body("other", "noext", 0), "{}"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows = {r["file_key"]: r for r in audit.from_events(df).collect()}
    assert len(rows) == 4
    assert (rows["raw/a.csv"]["layer"], rows["raw/a.csv"]["file_ext"],
            rows["raw/a.csv"]["size_mb"]) == ("BRONZE", "CSV", 1.5)
    r = rows["p/part.snappy.parquet"]
    assert (r["layer"], r["file_ext"], r["size_mb"]) == ("SILVER", "PARQUET", 0.12)
    r = rows["a.b/noext"]
    assert (r["layer"], r["file_ext"], r["size_mb"]) == ("GOLD", "B/NOEXT", 0.0)
    r = rows["noext"]
    assert (r["layer"], r["file_ext"], r["status"]) == ("UNKNOWN", "UNKNOWN", "INGESTED")


def test_stream_files_only_new(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("x\n1\n")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    audit.stream_files(spark, str(landing), "b-bronze", sink, ckpt, "*.csv")
    assert spark.read.parquet(sink).count() == 1
    (landing / "b.csv").write_text("x\n2\n")
    audit.stream_files(spark, str(landing), "b-bronze", sink, ckpt, "*.csv")
    got = sorted(os.path.basename(r["file_key"]) for r in spark.read.parquet(sink).collect())
    assert got == ["a.csv", "b.csv"]


def test_timestamp_option(spark):
    df = spark.createDataFrame([(_body("b-bronze", "k.csv", 10),)], "body string")
    out = audit.from_events(df, with_timestamp=True)
    assert out.columns[0] == "timestamp" and out.first()["timestamp"] is not None


def test_event_stream_per_batch_summaries(spark, tmp_path):
    from pyspark.sql import functions as F
    landing = tmp_path / "notes"
    landing.mkdir()
    specs = [("a-bronze", "x/1.csv", 1048576), ("b-silver", "y/2.parquet", 2097152),
             ("c-gold", "z/3", None), ("a-bronze", "x/4.csv", 524288)]
    for i, (b, k, size) in enumerate(specs):
        (landing / f"n{i}.json").write_text(_body(b, k, size) + "\n")
    sink, summary, ckpt = (str(tmp_path / p) for p in ("rows", "summary", "ckpt"))
    audit.stream_events(spark, str(landing), sink, ckpt, max_files_per_trigger=1,
                        summary_sink=summary)
    per_batch = spark.read.parquet(summary)
    assert per_batch.select("batch").distinct().count() == 4          # one file per trigger
    tot = {r["layer"]: (r["f"], r["mb"]) for r in per_batch.groupBy("layer").agg(
        F.sum("files").alias("f"), F.sum("size_mb_sum").alias("mb")).collect()}
    assert tot == {"BRONZE": (2, 1.5), "SILVER": (1, 2.0), "GOLD": (1, 0.0)}
    audit.stream_events(spark, str(landing), sink, ckpt, max_files_per_trigger=1,
                        summary_sink=summary)                          # nothing new
    assert spark.read.parquet(sink).count() == 4


def test_quarantine_keeps_what_gives_no_row(spark):
    from tidemark.streaming import audit
    good = '{"Records": [{"eventTime": "t", "s3": {"bucket": {"name": "b-bronze"}, "object": {"key": "k", "size": 1}}}]}'
    bodies = [good, good[:50], '{"Records": [{"eventTime": "t"}]}', "{}", "", "[1]", None, "null", '{"Records": []}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = {(r["body"], r["reason"], r["records"]) for r in audit.quarantine(df).collect()}
    assert got == {(good[:50], "malformed", 0), (bodies[2], "no bucket", 1), ("", "malformed", 0), ("[1]", "malformed", 0),
                   (None, "malformed", 0), ("null", "malformed", 0)}
    assert audit.from_events(df).count() == 1
