"""Token-id files: documents in ascending id order, as range-coded blocks (see ``idcoder``).

Documents are range-partitioned by id, so that each task writes one file of a run of ids; their ids (with an end id) are
coded in blocks of whole documents of about ``block_ids`` ids.  A block is a row (file, block, first id's place in
the file, documents' ids and lengths, payload) of a Parquet table, so Spark's committer publishes only
finished files and any store that Spark can write will do.  Reading decodes block by block, checks both
checksums and gives each document its ids and its place; the place of a file's first id follows from the files' totals, which
Spark sums up in two steps (runs of files, then within a run) and joins to the blocks.

Defined results: a null text is empty and has the end id alone; null ids come first; of equal ids the order is that of a
hash of the text; empty tables give no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents, materialize, scratch_path, ship, text_or_empty
from tidemark.llm.idcoder import decode, encode
from tidemark.llm.tokens import encoder

END = 1


def _write(path: str | None, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), END.to_bytes(2, "little")
        file_no, block_no, first = TaskContext.get().partitionId(), 0, 0
        held: list[bytes] = []
        keys: list[pa.Array] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u2")
            key = pa.concat_arrays(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int64()), pa.array([block_no], pa.int64()), pa.array([first], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key),
                 pa.array([[len(h) // 2 for h in held]], pa.list_(pa.int64())), pa.array([encode(ids)], pa.binary())],
                names=["file", "block", "first", "n_ids", "docs", "lengths", "payload"])

        for b in batches:
            start = 0
            for k, own in enumerate(enc.encode_all(b.column(1))):
                ids = own + end
                if size and size + len(ids) // 2 > block_ids:
                    keys.append(b.column(0).slice(start, k - start))
                    yield block()
                    first, block_no, held, keys, size, start = first + size, block_no + 1, [], [], 0, k
                held.append(ids)
                size += len(ids) // 2
            keys.append(b.column(0).slice(start))
        if held:
            yield block()
    return run


def write_ids(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 32_000_000,
              block_ids: int = 2_000_000, tokenizer_path: str | None = None) -> None:
    """Writes the files of all documents under ``folder``, about ``file_bytes`` of text each."""
    ship(docs.sparkSession)
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    kind = docs.schema[id_col].dataType.simpleString()
    (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(max(1, math.ceil(total / file_bytes)), "id", "tie")
     .sortWithinPartitions("id", "tie").select("id", "text")
     .mapInArrow(_write(tokenizer_path, block_ids), f"file long, block long, first long, n_ids long, docs array<{kind}>, "
                                                    "lengths array<long>, payload binary")
     .write.mode("overwrite").option("compression", "uncompressed").parquet(folder))


RUN = 4096  # files in a run, whose places are summed up in one group


def _places(files: DataFrame) -> DataFrame:
    """(file, base): the place of each file's first id; written once, as small as the number of files."""
    before = (Window.unboundedPreceding, -1)
    totals = (files.groupBy("file").agg(F.sum("n_ids").alias("n"))
              .withColumn("run", F.floor(F.col("file") / RUN)))
    runs = (totals.groupBy("run").agg(F.sum("n").alias("n"))
            .select("run", F.coalesce(F.sum("n").over(Window.orderBy("run").rowsBetween(*before)), F.lit(0)).alias("past")))
    within = F.sum("n").over(Window.partitionBy("run").orderBy("file").rowsBetween(*before))
    return materialize(totals.withColumn("own", F.coalesce(within, F.lit(0))).join(runs, "run")
                       .select("file", (F.col("past") + F.col("own")).alias("base")), "token-places")


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document of the files: id, start, n_tokens, ids_crc32 and, if asked for, ids (32-bit little-endian)."""
    ship(spark)
    files = spark.read.parquet(folder)
    kind = files.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                first = b.column(0)[k].as_py()
                keys = b.column(1).slice(k, 1).flatten()
                n = b.column(2).slice(k, 1).flatten().to_numpy()
                ids = decode(b.column(3)[k].as_py()).astype("<u4").tobytes()
                ends = np.cumsum(n)
                own = [ids[4 * (e - c):4 * e] for e, c in zip(ends, n, strict=True)]
                cols = [keys, pa.array(first + ends - n), pa.array(n),
                        pa.array([zlib.crc32(x) for x in own], pa.int64())]
                names = [id_col, "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(own, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    placed = files.join(_places(files), "file")
    return placed.select((F.col("base") + F.col("first")).alias("first"), "docs", "lengths", "payload").mapInArrow(
        run, f"`{id_col}` {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def op3_token_files(spark, sf_dir):
    folder = scratch_path(spark, "token-files")
    write_ids(documents(spark, sf_dir), folder)
    return read_ids(spark, folder, with_ids=False)
