"""Cost-balanced packing of tokenised documents into training sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n`` (its own feed-forward and attention work).
Documents are dealt by a hash of their row number into blocks of about ``block_bytes`` of text, so rows that are equal
in everything spread over all blocks; the ids are written once with their block, so that a task that runs again
deals them alike.  A block is packed in one task, so all memory is bounded by the block (or by one longer document).  In a block, the full lengths
that fit no sequence twice are cut off first; then documents in descending order go whole to the
sequence of lowest cost that has room; a document that no sequence has room for is cut, and fills
the roomiest ones.

The sequences of a block are opened so that they hold its tokens exactly: as many full ones as fit
and, for the rest, powers of two, which need no padding.  So no sequence is padded, and at most
log2(sequence length) sequences of a block are short.

Defined results: a null text is empty; an empty document is its end id alone; null and repeated ids are
packed row by row like others; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, each, materialize, ship, text_or_empty
from tidemark.llm.tokens import encoder

END = 2


def pack(lengths: np.ndarray, size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of the documents of these lengths."""
    out, rest, done = [], [], 0
    for d in np.argsort(-lengths, kind="stable"):
        full = int(lengths[d]) // size
        out += [(int(d), size * i, size, done + i, 0) for i in range(full)]
        done += full
        if lengths[d] % size:
            rest.append((int(lengths[d]) % size, int(d), full * size))
    rest.sort(key=lambda x: (-x[0], x[1]))
    total = sum(n for n, _, _ in rest)
    tail = total % size
    room = np.array([size] * (total // size) + [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1],
                    dtype=np.int64)
    used = np.zeros(len(room), dtype=np.int64)
    cost = np.zeros(len(room))
    for n, d, start in rest:
        while n:
            fits = np.flatnonzero(room >= n)
            if not len(fits):                   # a cut: the roomiest, so that there are few
                fits = np.flatnonzero(room == room.max())
            k = int(fits[np.argmin(cost[fits])])
            take = min(n, int(room[k]))
            out.append((d, start, take, done + k, int(used[k])))
            room[k] -= take
            used[k] += take
            cost[k] += linear * take + quadratic * take * take
            n, start = n - take, start + take
    return out


def _encode(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, 250_000), END.to_bytes(2, "little")
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([enc.encode(t) + end for t in each(b.column(2))], pa.binary())],
                names=["block", "id", "ids"])
    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4096,
                   linear: float = 1.0, quadratic: float = 1 / 2048, block_bytes: int = 8_000_000,
                   tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    id_type = docs.schema[id_col].dataType.simpleString()
    dealt = rows.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"),
                        "id", "text")
    coded = materialize(dealt.mapInArrow(_encode(tokenizer_path), f"block int, id {id_type}, ids binary"), "packing-ids")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "ids"], kind="stable", na_position="first").reset_index(drop=True)
        lengths = frame["ids"].str.len().to_numpy(dtype=np.int64) // 2
        first = int(frame["block"].iloc[0]) << 32
        pieces = pack(lengths, size, linear, quadratic)
        pieces.sort(key=lambda x: x[0])
        d, start, length, seq, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces, strict=True))
        ids, at, now = [], -1, b""
        for k, s, n in zip(d, start, length, strict=True):
            if k != at:
                at, now = k, np.frombuffer(frame["ids"].iat[k], "<u2").astype("<u4").tobytes()
            ids.append(now[4 * s:4 * (s + n)])
        return pd.DataFrame({"id": frame["id"].to_numpy()[d], "start": start, "length": length, "ids": ids,
                             "doc_tokens": lengths[d], "sequence_id": first + seq, "offset": offset})

    return (coded.groupBy("block").applyInPandas(run, f"id {id_type}, start long, length long, ids binary, doc_tokens long, "
                                                 "sequence_id long, offset long")
            .withColumnRenamed("id", id_col))


def digest(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_packing(spark, sf_dir):
    return digest(pack_documents(documents(spark, sf_dir)))
