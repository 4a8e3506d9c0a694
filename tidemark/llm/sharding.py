"""Sharding by histogram sort, in DataFrame functions only.  Law: ``bytes`` (shard sizes near equal).

Rows are ordered by (hash of the text, id); equal texts are neighbours.  A shard is a range of that
order, so only its boundaries (splitters) must be found:
1. Probes divide each splitter's interval of hashes evenly; one aggregate counts the exact bytes below every
   probe over all partitions.  The interval that holds the target is refined until a probe's bytes
   are within ``tolerance`` of a shard's share, or until the interval is one single hash.
2. A splitter that falls into the rows of one hash (a large group of equal texts) is refined likewise
   by id within that hash, so such a group is split no finer than needed, and never one task's burden.
3. Then rows are exchanged once, to (shard, cell); cells are an even division of each shard by hash and id.
   Exact row counts by cell give the first slot of each; slots in a cell follow by row number.

The driver sees only counts by probe and by cell.

Defined results: a null text has size 1 and the checksum of the empty text; null ids sort first; rows with equal
text and id stay together; an empty table gives no rows; ``shard_rows`` keeps the input's other columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents, materialize, shuffle_width, text_or_empty

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class _Search:
    """One splitter: rows with key < at are below it; the interval that still holds the target."""
    target: int
    lo: int = LOW               # bytes below lo <= target
    hi: int = HIGH + 1          # bytes below hi >= target
    below_lo: int = 0
    below_hi: int = 0
    at: int | None = None

    def probes(self, count: int) -> list[int]:
        width = self.hi - self.lo
        return sorted({self.lo + width * k // (count + 1) for k in range(1, count + 1)} - {self.lo})

    def learn(self, below: list[tuple[int, int]], tolerance: float) -> None:
        for p, b in below:
            if self.lo < p < self.hi:
                if b <= self.target and p > self.lo:
                    self.lo, self.below_lo = p, b
                elif b > self.target:
                    self.hi, self.below_hi = p, b
                    break
        best = min(((self.lo, self.below_lo), (self.hi, self.below_hi)), key=lambda x: abs(x[1] - self.target))
        if abs(best[1] - self.target) <= tolerance or self.hi - self.lo <= 1:
            self.at = best[0]


def _count_below(rows: DataFrame, key: str, probes: list[int]) -> list[tuple[int, int]]:
    """Exact bytes of the rows below each probe: one aggregate by the interval between probes."""
    bound = F.array(*[F.lit(p) for p in probes])
    slot = F.size(F.filter(bound, lambda p: p <= F.col(key)))
    got = {r["slot"]: r["below"] for r in
           rows.groupBy(slot.alias("slot")).agg(F.sum("__size").alias("below")).collect()}
    out, total = [], 0
    for k, p in enumerate(probes):
        total += got.get(k, 0)
        out.append((p, total))
    return out


def _refine(rows: DataFrame, key: str, searches: list[_Search], tolerance: float, probes: int) -> None:
    while open_ := [s for s in searches if s.at is None]:
        each = max(1, probes // len(open_))
        below = _count_below(rows, key, sorted({p for s in open_ for p in s.probes(each) if p <= HIGH}))
        for s in open_:
            s.learn(below, tolerance)


def splitters(keyed: DataFrame, shards: int, tolerance: float, probes: int) -> list[tuple[int, int]]:
    """``shards - 1`` boundaries (hash, id) in ascending order: rows strictly below are on the left."""
    total = keyed.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    near = tolerance * total / shards
    searches = [_Search(total * k // shards, below_hi=total) for k in range(1, shards)]
    if not total:
        return [(LOW, LOW)] * (shards - 1)
    _refine(keyed, "__hash", searches, near, probes)
    out = []
    for s in searches:
        best = s.below_lo if s.at == s.lo else s.below_hi
        if abs(best - s.target) <= near:
            out.append((s.at, LOW))
            continue
        # the target lies within the rows of the hash s.lo: go on by id
        inner = _Search(s.target - s.below_lo, below_hi=s.below_hi - s.below_lo)
        _refine(keyed.where(F.col("__hash") == s.lo), "__id", [inner], near, probes)
        out.append((s.lo, inner.at) if inner.at <= HIGH else (min(s.lo + 1, HIGH), LOW))
    return out


def _shard_of(bounds: list[tuple[int, int]]) -> Column:
    """The number of boundaries at or below the row's (hash, id)."""
    out = F.lit(0)
    for h, i in bounds:
        out = out + F.when((F.col("__hash") > h) | ((F.col("__hash") == h) & (F.col("__id") >= i)), 1).otherwise(0)
    return out


def shard_rows(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
               tolerance: float = 0.001, probes: int = 128) -> DataFrame:
    """The rows of ``docs`` with __size, __shard and __slot, exchanged once to their shards' cells."""
    text = text_or_empty(text_col)
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(LOW))
    keyed = docs.withColumns({"__hash": F.xxhash64(text), "__id": number, "__size": F.octet_length(text).cast("long") + 1})
    light = materialize(keyed.select("__hash", "__id", "__size"), "shard-keys")
    bounds = splitters(light, shards, tolerance, probes)
    shard = _shard_of(bounds)
    cells = max(1, shuffle_width(docs.sparkSession) // shards)
    cell = F.pmod(F.xxhash64("__hash", "__id"), F.lit(cells)).cast("int")
    count = {(r["s"], r["c"]): r["n"] for r in light.groupBy(shard.alias("s"), cell.alias("c"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    first, at = [], 0
    for s in range(shards):
        at = 0
        for c in range(cells):
            first.append(at)
            at += count.get((s, c), 0)
    begin = F.get(F.array(*[F.lit(x).cast("long") for x in first]), F.col("__shard") * cells + F.col("__cell"))
    order = Window.partitionBy("__shard", "__cell").orderBy("__hash", "__id")
    return (keyed.withColumns({"__shard": shard.cast("int"), "__cell": cell})
            .withColumn("__slot", begin + F.row_number().over(order) - 1)
            .drop("__hash", "__id", "__cell"))


def op8_sharding(spark, sf_dir):
    # the checksum stands for the text from here on: the query returns no texts, so none are exchanged
    docs = documents(spark, sf_dir).select("doc_id", "text", F.crc32(text_or_empty().cast("binary")).alias("crc"))
    return shard_rows(docs).select(
        "doc_id", F.col("__size").alias("size"), F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
