"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, scratch_path

__all__ = ["documents", "each", "materialize", "scratch_path", "ship", "text_or_empty", "shuffle_width"]

_SHIPPED: set[str] = set()


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(text_col: str = "text") -> Column:
    """The whole text as a string; a null text counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (``addPyFile``), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tidemark-py-")
    target = os.path.join(folder, "tidemark_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def each(column: pa.Array) -> Iterator:
    """A column's values one by one, so that a batch of texts is not held twice."""
    for v in column:
        yield v.as_py()
