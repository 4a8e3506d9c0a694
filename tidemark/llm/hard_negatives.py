"""Hard-negative mining with an STR-packed R-tree.

* Packing.  Rows are range-partitioned by their first coordinates and cut into chunks; in a chunk, sort-tile-
  recursive order by the next coordinates gives leaves of ``leaf`` rows.  A leaf keeps its minimum bounding box.
  Leaves are dealt to shards, and the tree is written once to the shared folder.
* Interval.  For a query a and a box [lo, hi], each coordinate's products lie between a*lo and a*hi, so their
  sums bound every inner product in the box from below and above.
* Search.  A query asks for its first k rows, of its own or of other labels, whose score lies in a window.
  A best-first queue takes boxes by upper bound, and prunes those outside all windows or strictly below the
  kth score so far.  Each query first searches the shard that it lies in; the kth score found there prunes in the others.
* Mining.  One search finds the positives (own label, no window).  Each positive's score gives a window, and a
  second search finds the negatives.

The queries against all shards are dealt in blocks, so a task holds one block and one shard, and only
a query's k rows per shard are merged.  Nothing passes through the driver but row counts.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part.  Null
ids are no queries and come last among ties; of rows that agree in score and id the one stored first comes first.
A repeated anchor row is mined on its own.  Vectors of different lengths are compared over their common
components.  Scores are exact integers; those beyond a long are held at its ends.  An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, materialize, ship, shuffle_width

LONG = np.iinfo(np.int64)
LEAF_ROWS = 256
CHUNK_ROWS = 8192       # rows that are tiled together
SHARD_ROWS = 4096       # about so many rows of the tree meet a block of queries in a task
BLOCK_QUERIES = 512
_TREE = ("shard long, leaf long, row array<long>, id array<long>, label array<long>, vec array<array<double>>")


def quantised(vector: Column, scale: float = 256.0) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(vector: Column) -> Column:
    """No null and no non-finite component; null for a null vector."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _tiles(at: np.ndarray, vecs: np.ndarray, leaf: int, axis: int) -> Iterator[np.ndarray]:
    """Sort-tile-recursive order of the rows ``at``: slabs by coordinate ``axis``, each tiled by the next."""
    pages = -(-len(at) // leaf)
    if pages <= 1 or axis >= vecs.shape[1]:
        yield from (at[i:i + leaf] for i in range(0, len(at), leaf))
        return
    at = at[np.argsort(vecs[at, axis], kind="stable")]
    slabs = max(2, round(pages ** 0.5))
    step = -(-pages // slabs) * leaf
    for i in range(0, len(at), step):
        yield from _tiles(at[i:i + step], vecs, leaf, axis + 1)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of one length; shorter ones are filled with 0, which adds nothing to a product."""
    lengths = vectors.value_lengths().to_numpy()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _pack(shards: int, leaf: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33

        def settle(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal number
            vecs = _matrix(rows.column(3))
            for at in _tiles(np.arange(len(rows)), vecs, leaf, 1 % max(1, vecs.shape[1])):
                own = [pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), c.take(pa.array(at))) for c in rows.columns]
                yield pa.RecordBatch.from_arrays([pa.array([(number * 0x9E3779B1 >> 7) % shards]), pa.array([number]), *own],
                                                 names=["shard", "leaf", "row", "id", "label", "vec"])
                number += 1

        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            while sum(map(len, held)) >= chunk:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield from settle(whole.slice(0, chunk))
                held = [whole.slice(chunk)] if len(whole) > chunk else []
        if sum(map(len, held)):
            yield from settle(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    return run


def pack(rows: DataFrame, shards: int, leaf: int = LEAF_ROWS, chunk: int = CHUNK_ROWS) -> DataFrame:
    """The tree's leaves over ``rows`` (row, id, label, vec); copies of one vector are spread by their row number."""
    order = [F.get(F.col("vec"), F.lit(0)), F.get(F.col("vec"), F.lit(1)), F.xxhash64("row")]
    return (rows.select("row", "id", "label", "vec").repartitionByRange(max(1, shuffle_width(rows.sparkSession)), *order)
            .sortWithinPartitions(*order).mapInArrow(_pack(shards, leaf, chunk), _TREE))


class Shard:
    """Leaves of one shard with their boxes, in a task."""

    def __init__(self, table: pa.Table, width: int) -> None:
        self.leaves, boxes = [], []
        columns = [table.column(c).combine_chunks() for c in ("row", "id", "label", "vec")]
        for r in range(table.num_rows):
            row, ident, label, vec = (c[r].values for c in columns)
            m = np.zeros((len(vec), width))
            own = _matrix(vec)[:, :width]
            m[:, :own.shape[1]] = own
            none = ident.is_null().to_numpy(zero_copy_only=False)
            ident, row = ident.fill_null(0).to_numpy(), row.to_numpy()
            order = np.lexsort((row, ident, none))
            self.leaves.append((row[order], ident[order], none[order], label.to_numpy()[order], m[order]))
            boxes.append((m.min(axis=0), m.max(axis=0)))
        self.lo, self.hi = (np.stack(x) for x in zip(*boxes, strict=True))

    def largest(self) -> float:
        return max(np.abs(self.lo).max(initial=0), np.abs(self.hi).max(initial=0))


def _bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner products of each query with each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def _exact(m: np.ndarray, a: np.ndarray, small: bool) -> np.ndarray:
    """Inner products: whole numbers in doubles where those are exact, else longs."""
    if small:
        return m @ a
    ints = [[int(x) for x in r] for r in m]
    own = [int(x) for x in a]
    return np.array([max(LONG.min, min(LONG.max, sum(x * y for x, y in zip(r, own, strict=True)))) for r in ints], np.int64)


def search_shard(shard: Shard, vec: np.ndarray, row: int, label: int, same: bool, k: int, windows: list[tuple[int, int, int]],
                 least: np.ndarray, most: np.ndarray, small: bool) -> list[list[tuple]]:
    """First k rows by (score, id, row) for each window (lowest, highest, kth score known so far).

    ``least`` and ``most`` bound the scores of the shard's leaves."""
    found: list[list[tuple]] = [[] for _ in windows]
    queue = [(-most[i], i) for i in range(len(most))]
    heapq.heapify(queue)
    kth = [max(lo, known) for lo, _, known in windows]
    while queue:
        top, i = heapq.heappop(queue)
        if -top < min(kth):                                     # all further boxes lie strictly below
            break
        open_ = [w for w, (_, hi, _) in enumerate(windows) if least[i] <= hi and -top >= kth[w]]
        if not open_:
            continue
        rows, ids, none, labels, m = shard.leaves[i]
        scores = _exact(m, vec, small)
        own = np.flatnonzero((scores >= min(kth[w] for w in open_)) & ((labels == label) == same) & (rows != row))
        if not len(own):
            continue
        scores = scores.astype(np.int64)
        own = own[np.argsort(-scores[own], kind="stable")]      # ids and rows are in order within a leaf
        down = -scores[own]
        for w in open_:
            lo, hi, _ = windows[w]
            a, b = np.searchsorted(down, -hi, "left"), np.searchsorted(down, -max(lo, kth[w]), "right")
            if a < b:
                best = found[w]
                at = own[a:min(b, a + k)]
                best += zip(*[c[at].tolist() for c in (-scores, none, ids, rows)], strict=True)
                best.sort()
                del best[k:]
                if len(best) == k:
                    kth[w] = max(kth[w], -best[-1][0])
    return found


_FOUND = "query long, window int, score long, found_id long, found_row long"


def _search(same: bool, k: int):
    """(queries, leaves) of one block and one shard -> the first k rows of the shard for each query and window."""
    def run(key: tuple, queries: pa.Table, tree: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and tree.num_rows:
            a = _matrix(queries.column("vec").combine_chunks())
            shard = Shard(tree, a.shape[1])
            size = np.abs(a).max(initial=0) * shard.largest() * max(1, a.shape[1])
            small = bool(size < 2.0 ** 52)
            least, most = _bounds(a, shard.lo, shard.hi)
            slack = 0.0 if small else size * 1e-12              # rounding of the bounds themselves
            for q, (row, label, windows) in enumerate(zip(*[queries.column(c).to_pylist() for c in ("row", "label", "windows")],
                                                          strict=True)):
                own = [(w["lo"], w["hi"], w["kth"]) for w in windows]
                found = search_shard(shard, a[q], row, label, same, k, own, np.clip(least[q] - slack, -9e18, 9e18) - 0.5,
                                     np.clip(most[q] + slack, -9e18, 9e18) + 0.5, small)
                out += [(row, w["at"], -s, None if none else i, r) for w, best in zip(windows, found, strict=True)
                        for s, none, i, r in best]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                    names=["query", "window", "score", "found_id", "found_row"])
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(tree: DataFrame, queries: DataFrame, same: bool, k: int, shards: int, blocks: int) -> DataFrame:
    """(query, window, score, found_id, found_row, rank): first k rows of the tree for each window of each query.

    ``queries`` has row, label, vec, shard (its own) and windows (at, lo, hi)."""
    def run(asked: DataFrame, met: DataFrame) -> DataFrame:
        keys = ("block", "shard")
        return (asked.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(_search(same, k), _FOUND))

    asked = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    met = tree.select("shard", "row", "id", "label", "vec",
                      F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    window = "struct(w.at AS at, w.lo AS lo, w.hi AS hi, {} AS kth)"
    home = materialize(run(asked.withColumn("windows", F.expr(
        f"transform(windows, w -> {window.format(LONG.min)})")), met), "negatives-home")
    kth = (_first(home, k).groupBy("query", "window").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n"))
           .where(F.col("n") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "s"))).alias("known")))
    away = (asked.join(kth, asked["row"] == kth["query"], "left")
            .withColumn("windows", F.expr(f"transform(windows, w -> {window.format(f'coalesce(known[w.at], {LONG.min})')})"))
            .withColumnRenamed("shard", "own")
            .select("row", "label", "vec", "windows", "block", "own",
                    F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
            .where("shard <> own").drop("own"))
    return _first(home.unionByName(run(away, met)), k)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, leaf: int = LEAF_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vector_col`` holds integers as doubles (``quantised``).  A negative's score lies between ``low`` and ``high``
    hundredths of the positive's."""
    ship(vectors.sparkSession)
    rows = materialize(
        vectors.where(F.col(label_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vec"),
                F.coalesce(is_anchor, F.lit(False)).alias("anchor")), "negatives-rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("a")).first()
    shards, blocks = max(1, -(-size["n"] // shard_rows)), max(1, -(-size["a"] // block_queries))
    tree = materialize(pack(rows, shards, leaf), "negatives-tree")
    anchors = materialize(
        tree.select("shard", F.explode(F.arrays_zip("row", "id", "label", "vec")).alias("x")).select("shard", "x.*")
        .join(rows.where("anchor").select("row"), "row", "left_semi"), "negatives-anchors")
    whole = F.array(F.struct(F.lit(0).alias("at"), F.lit(LONG.min).alias("lo"), F.lit(LONG.max).alias("hi")))
    near = materialize(search(tree, anchors.withColumn("windows", whole), True, positives, shards, blocks)
                       .select("query", F.col("rank").alias("at"), F.col("found_id").alias("positive_id"),
                               F.col("score").alias("positive_score")), "negatives-positives")
    # low * p <= 100 * n <= high * p, in decimals, as low * p may pass a long
    score = F.col("positive_score").cast("decimal(19,0)")
    windows = (near.where("positive_score >= 0").select(
        "query", "at", F.ceil(score * low / 100).cast("long").alias("lo"), F.floor(score * high / 100).cast("long").alias("hi"))
        .where("lo <= hi").groupBy("query").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("windows")))
    asked = anchors.join(windows, anchors["row"] == windows["query"]).drop("query")
    far = search(tree, asked, False, negatives, shards, blocks)
    return (far.join(near, (far["query"] == near["query"]) & (far["window"] == near["at"]))
            .join(anchors.select("row", F.col("id").alias("anchor_id")), far["query"] == F.col("row"))
            .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def op11_hard_negatives(spark, sf_dir):
    vec_id = F.col("vec_id")
    table = (documents(spark, sf_dir, "embeddings")
             .withColumn("label", F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
             .where(usable(F.col("embedding"))).withColumn("embedding", quantised(F.col("embedding"))))
    return mine(table, vec_id % 50 == 0)


ORACLE = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scores AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS other_id, a.label = b.label AS same,
                  list_inner_product(a.v, b.v)::BIGINT AS s
           FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (SELECT ar, anchor_id, br, other_id AS positive_id, s AS positive_score FROM scores WHERE same
              QUALIFY row_number() OVER (PARTITION BY ar ORDER BY s DESC, other_id, br) <= 5),
ranked AS (SELECT p.anchor_id, p.positive_id, p.positive_score, n.other_id AS negative_id, n.s AS negative_score,
                  row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.s DESC, n.other_id, n.br) AS rank
           FROM positives p JOIN scores n ON n.ar = p.ar AND NOT n.same
            AND 50 * p.positive_score <= 100 * n.s AND 100 * n.s <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
