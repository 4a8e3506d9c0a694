"""Parquet table access for the driver-generated test tables (and any other layer path).

Reads are lazy; callers ``select`` only the columns they need so Parquet column pruning and
filter pushdown reach the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Declared schemas of the test tables.  Giving the reader a schema skips the footer-reading job
# that schema inference launches per table (measurable per query at small scale, and a listing
# plus footer read over every file at large scale).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
               "value double, props string"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
