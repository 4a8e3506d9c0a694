"""Bronze -> Silver on arrival (ST4) with Structured Streaming.

The stream is of arriving files: its checkpoint records which files were taken, and ``availableNow`` drains
the backlog in micro-batches of at most ``max_files_per_trigger`` files.  Each batch reads its files with
the batch reader, so columns are found by name in every file's header, and cleans them with the batch
transform.  All Silver rules are stateless and row-local: no watermark, no state store.  A batch
overwrites its own folder ``batch=<id>``, so one that is repeated after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import PanelConfig
from tidemark.operators import silver as silver_ops
from tidemark.sources.files import read_panel_csv


def silver_stream(spark: SparkSession, landing: str, columns: Sequence[str], sink: str,
                  checkpoint: str, cfg: PanelConfig, max_files_per_trigger: int = 64):
    # only the paths are read here, not the contents
    arrivals = (spark.readStream.format("binaryFile").option("pathGlobFilter", "*.csv")
                .schema("path string, modificationTime timestamp, length long, content binary")
                .option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path"))

    def clean(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.collect())      # at most max_files_per_trigger
        if files:
            raw = read_panel_csv(batch.sparkSession, landing, columns, files=files)
            silver_ops.transform(raw, cfg).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    q = (arrivals.writeStream.foreachBatch(clean).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
