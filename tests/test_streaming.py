"""Streaming Silver equals batch Silver; a rerun adds only new files."""
from tidemark.operators import silver as silver_ops
from tidemark.plans import stages
from tidemark.sources import files
from tidemark.sources.panel import PANEL_COLUMNS
from tidemark.streaming.silver_stream import silver_stream

from paths import SF_SMALL


def test_batch_equals_stream(spark, tmp_path):
    cfg = stages.TABLE_CONFIG
    bronze = stages.bronze(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    files.write_csv(bronze, landing)
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    silver_stream(spark, landing, PANEL_COLUMNS, sink, ckpt, cfg)
    stream = silver_ops.stamp_free(spark.read.parquet(sink).drop("batch"))
    batch = silver_ops.stamp_free(stages.silver(spark, SF_SMALL))
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch.select(*stream.columns)).count() == 0
    n = stream.count()
    silver_stream(spark, landing, PANEL_COLUMNS, sink, ckpt, cfg)     # nothing new
    assert spark.read.parquet(sink).drop("batch").count() == n
