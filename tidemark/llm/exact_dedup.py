"""Exact dedup by a heavy-hitter split (DataFrame functions only).

Texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]`` became one space.
1. One scan computes the SHA-256 digest of the normalised text; (row, digest) is written once.
2. A Misra-Gries summary (``approx_top_k``, a bounded frequent-items sketch merged map-side) names
   the digests that may be frequent.  At most ``top_k`` candidates leave it.
3. The candidates are verified by an exact aggregate (true size and winning row); these winners,
   at most ``top_k`` rows, are broadcast, so copies of frequent texts are settled map-side and
   never meet in one task.
4. All other digests are settled by an ordinary shuffle: an aggregate with map-side combine finds each digest's
   size and winner, those of two or more rows are written once and joined back.  So copies beyond the broadcast
   ones never meet in one group, and the join's hot keys are left to AQE (broadcast or split).

Defined results: a null text counts as empty; null doc_ids sort after all others; when rows with the
same doc_id and equal texts repeat, exactly one of them stays; empty input gives no rows; other
columns are passed through by ``drop_copies`` and ignored by ``exact_dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents, materialize, text_or_empty

# A run that is already one plain space needs no replacement, so the pattern skips those.
SPACE_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_RUN, " ")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, __row, __digest, __fp): digest of the normalised text, hash of the text as it is; written once."""
    text = text_or_empty(text_col)
    return materialize(docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("__row"),
                                   F.unhex(F.sha2(normalised(text), 256)).alias("__digest"),
                                   F.xxhash64(text).alias("__fp")), "dedup-digests")


def settle(digests: DataFrame, top_k: int, tracked: int, min_copies: int) -> DataFrame:
    """``_digests`` with keep_id, group_size, kept."""
    # order of the row that stays: smallest id, nulls last, then the text's hash, then the first stored row
    rank = F.struct(F.col("id").isNull().alias("n"), "id", "__fp", "__row")
    summary = digests.agg(F.expr(f"approx_top_k(hex(__digest), {top_k}, {tracked})").alias("t"))
    candidates = (summary.select(F.explode("t").alias("t"))
                  .where(F.col("t.count") >= min_copies)
                  .select(F.unhex(F.col("t.item")).alias("__digest")))
    winners = materialize(
        digests.join(F.broadcast(candidates), "__digest")
        .groupBy("__digest").agg(F.min(rank).alias("__best"), F.count(F.lit(1)).alias("group_size")),
        "dedup-winners")
    heavy = digests.join(F.broadcast(winners), "__digest")
    rest = digests.join(F.broadcast(winners.select("__digest")), "__digest", "left_anti")
    repeated = materialize(
        rest.groupBy("__digest").agg(F.min(rank).alias("__first"), F.count(F.lit(1)).alias("__size"))
        .where("__size > 1"), "dedup-repeated")
    light = (rest.join(repeated, "__digest", "left")
             .withColumns({"__best": F.coalesce("__first", rank), "group_size": F.coalesce("__size", F.lit(1))}))
    cols = ["id", "__fp", "__digest", F.col("__best.id").alias("keep_id"), "group_size",
            (F.col("__row") == F.col("__best.__row")).alias("kept")]
    return heavy.select(*cols).unionByName(light.select(*cols))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", top_k: int = 1000,
                tracked: int = 65536, min_copies: int = 32) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (normalised text).

    ``tracked`` counters bound the summary, ``top_k`` bounds the broadcast, ``min_copies`` is the
    estimated size from which a digest is worth a broadcast row; none of them changes the result.
    """
    out = settle(_digests(docs, id_col, text_col), top_k, tracked, min_copies)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                      F.lower(F.hex("__digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", top_k: int = 1000,
                tracked: int = 65536, min_copies: int = 32) -> DataFrame:
    """The input rows that stay, with exactly the input's columns.

    Rows are found again by id and text hash; of rows that are equal in both, one stays."""
    out = settle(_digests(docs, id_col, text_col), top_k, tracked, min_copies)
    marked = materialize(
        out.groupBy("id", "__fp").agg(F.max("kept").alias("__kept"), F.count(F.lit(1)).alias("rows"))
        .where("NOT __kept OR rows > 1").select(F.col("id").alias("__id"), F.col("__fp").alias("__hash"), "__kept"),
        "dedup-marked")
    tagged = docs.withColumn("__text_hash", F.xxhash64(text_or_empty(text_col))).join(
        marked, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left")
    stay = tagged.where(F.col("__kept").isNull())
    repeated = tagged.where("__kept").withColumn("__k", F.row_number().over(
        Window.partitionBy("__id", "__hash").orderBy(F.monotonically_increasing_id()))).where("__k = 1")
    return stay.select(*docs.columns).unionByName(repeated.select(*docs.columns))


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM n
"""
