"""Benchmark decontamination: a BM25 index of the test items searched by block-max WAND.

Every document is read as passages of ``2 * CHUNK`` words that overlap by half; every passage is a
query against the index of test items, and all items at or above the threshold are retrieved.  Items
are indexed in chunks of at most ``CHUNK`` words, so a chunk always lies whole inside some passage.
An impact is a term's BM25 weight over the chunk's own total, so one threshold ``rho`` (the share of
the chunk's weight that the passage must hold) serves all lengths.  A retrieved item is verified:
5-word shingles of the item found around the retrieving passages, at least ``overlap`` (0.8) of
them in all and ``half_overlap`` of those of the question (first half) and of the answer (second half).

The items are dealt by hash to blocks of about ``block_bytes`` of text.  Tasks build a block's index each and store
it; one block after another is sent to the executors, so neither they nor the driver hold more than one, and the
documents are scanned once per block.  Documents are never shuffled.

Defined results: words are runs of letters and digits, ASCII and others, compared in lower case; null or
empty texts hold no item and are no item; an item of under 5 words is one shingle; repeated items
are indexed once; repeated documents give repeated rows; other columns are ignored or, by ``drop_leaks``,
passed through unchanged.
"""

from __future__ import annotations

import math
import pickle
import uuid
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import documents, each, materialize, scratch_path, ship, text_or_empty

CHUNK = 64
SHINGLE = 5
K1, B = 1.2, 0.75
POSTING_BLOCK = 32
CHUNK_BLOCK = 4         # chunks of one block of the block-max test
GROUPS = 16             # groups of chunks of the first, coarser test
WORDS = 1 << 16         # words of texts that are tested together
AT_ONCE = 1 << 20       # blocks' maxima that are added up together
_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_FOLD).split()


def shingles(ws: list[bytes]) -> set[bytes]:
    if len(ws) < SHINGLE:
        return {b" ".join(ws)} if ws else set()
    return {b" ".join(ws[i:i + SHINGLE]) for i in range(len(ws) - SHINGLE + 1)}


def _halves(ws: list[bytes]) -> tuple[set[bytes], set[bytes]]:
    """Shingles that start in the question half and those that start in the answer half."""
    all_starts = max(1, len(ws) - SHINGLE + 1)
    cut = (all_starts + 1) // 2
    return shingles(ws[:cut + SHINGLE - 1]), shingles(ws[cut:]) if all_starts > 1 else set()


class Index:
    """BM25 impacts of item chunks: postings by term in chunk order, in blocks with their maxima."""

    def __init__(self, items: list[tuple[object, str]], rho: float, overlap: float, half_overlap: float):
        self.rho, self.overlap, self.half_overlap = rho, overlap, half_overlap
        self.items: list[tuple[object, set, set]] = []
        chunks: list[tuple[int, list[bytes]]] = []
        for item_id, text in items:
            ws = words(text)
            if ws:
                chunks += [(len(self.items), ws[i:i + CHUNK]) for i in range(0, len(ws), CHUNK)]
                self.items.append((item_id, *_halves(ws)))
        self.item_of = [i for i, _ in chunks]
        self.terms: dict[bytes, bytes] = {}
        counts: list[dict[int, int]] = []
        for _, ws in chunks:
            own: dict[int, int] = {}
            for w in ws:
                t = int.from_bytes(self.terms.setdefault(w, len(self.terms).to_bytes(4, "little")), "little")
                own[t] = own.get(t, 0) + 1
            counts.append(own)
        n, mean = len(chunks), sum(len(ws) for _, ws in chunks) / max(1, len(chunks))
        df = np.zeros(len(self.terms))
        for own in counts:
            df[list(own)] += 1
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for c, own in enumerate(counts):
            length = len(chunks[c][1])
            weight = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * length / mean)) for t, f in own.items()}
            total = sum(weight.values())
            for t, x in weight.items():
                postings[t].append((c, x / total))
        self.chunk = [np.array([c for c, _ in p], dtype=np.int64) for p in postings]
        self.impact = [np.array([x for _, x in p]) for p in postings]
        self.block_max = [np.maximum.reduceat(x, np.arange(0, len(x), POSTING_BLOCK)) for x in self.impact]
        self.bound = np.array([x.max() for x in self.impact])
        # each term's maximum in each group
        self.group_max = np.zeros((len(self.terms), GROUPS), dtype=np.float32)
        width = -(-max(1, n) // GROUPS)
        # each term's maxima by block of CHUNK_BLOCK chunks, term after term
        blocks, maxima = [], []
        for t, (c, x) in enumerate(zip(self.chunk, self.impact, strict=True)):
            np.maximum.at(self.group_max[t], c // width, x.astype(np.float32))
            first = np.flatnonzero(np.diff(c // CHUNK_BLOCK, prepend=-1))
            blocks.append(c[first] // CHUNK_BLOCK)
            maxima.append(np.maximum.reduceat(x, first))
        self.from_block = np.concatenate([[0], np.cumsum([len(x) for x in blocks])]).astype(np.int64)
        self.blocks = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.int64)
        self.maxima = np.concatenate(maxima) if maxima else np.zeros(0)
        self.n_blocks = -(-max(1, n) // CHUNK_BLOCK)

    def ids(self, ws: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.terms.get, ws, repeat(b"\xff\xff\xff\xff"))), dtype="<i4")

    def reaching(self, terms: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
        """For n passages, given by (term, passage) pairs: whether any block's maxima add up to the threshold."""
        count = self.from_block[terms + 1] - self.from_block[terms]
        at = np.repeat(self.from_block[terms] - np.cumsum(count) + count, count) + np.arange(count.sum())
        spot = np.repeat(passage * self.n_blocks, count) + self.blocks[at]
        total = np.bincount(spot, self.maxima[at], minlength=n * self.n_blocks)
        return total.reshape(n, self.n_blocks).max(axis=1) >= self.rho - 1e-9

    def may_reach(self, terms: np.ndarray) -> bool:
        """Whether any block's maxima over these terms add up to the threshold."""
        return len(terms) > 0 and bool(self.reaching(terms, np.zeros(len(terms), dtype=np.int64), 1)[0])

    def hopeful(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, list[int]]]:
        """(text, number of the passage in it, its different terms) of the passages that may reach the threshold, in order."""
        size = np.array([len(ws) for ws in texts], dtype=np.int64)
        ids = self.ids([w for ws in texts for w in ws])
        # passage k of a text is its CHUNK words k and k + 1; passages are numbered text after text
        passages = np.maximum(1, -(-size // CHUNK) - 1)
        base = np.cumsum(passages) - passages
        known = np.flatnonzero(ids >= 0)
        text = np.repeat(np.arange(len(texts)), size)[known]
        chunk = (known - (np.cumsum(size) - size)[text]) // CHUNK
        bits = len(self.terms).bit_length()
        pair = (base[text] + chunk) << bits | ids[known]
        pair = np.sort(np.concatenate([pair[chunk < passages[text]], pair[chunk > 0] - (1 << bits)]))
        pair = pair[np.diff(pair, prepend=-1) != 0]
        passage, term = pair >> bits, pair & ((1 << bits) - 1)
        begin = np.flatnonzero(np.diff(passage, prepend=-1))
        if not len(begin):
            return
        end = np.append(begin[1:], len(pair))
        # a passage whose terms' maxima don't sum up to the threshold in any group can't reach it
        on = np.flatnonzero(np.add.reduceat(self.group_max[term], begin, axis=0).max(axis=1) >= self.rho - 1e-3)
        cost = np.add.reduceat(self.from_block[term + 1] - self.from_block[term], begin)[on] + self.n_blocks
        cut = np.flatnonzero(np.diff(np.cumsum(cost) // AT_ONCE, prepend=-1))
        for some in np.split(on, cut[1:]):
            n = end[some] - begin[some]
            at = np.repeat(begin[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            for k in some[self.reaching(term[at], np.repeat(np.arange(len(some)), n), len(some))] if len(some) else ():
                t = int(np.searchsorted(base, passage[begin[k]], side="right")) - 1
                yield t, int(passage[begin[k]] - base[t]), term[begin[k]:end[k]].tolist()

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All (chunk, score) with score >= rho for a set of terms: block-max WAND."""
        goal, out = self.rho - 1e-9, []
        chunk, impact, block_max = ({t: memoryview(x[t]) for t in terms} for x in (self.chunk, self.impact, self.block_max))
        bound = dict(zip(terms, self.bound[terms].tolist(), strict=True))
        cur = [(chunk[t][0], t, 0) for t in terms]        # chunk at the cursor, term, position
        while cur:
            cur.sort()
            reach, pivot = 0.0, None
            for k, (_, t, _) in enumerate(cur):
                reach += bound[t]
                if reach >= goal:
                    pivot = k
                    break
            if pivot is None:
                return out
            target = cur[pivot][0]
            while pivot + 1 < len(cur) and cur[pivot + 1][0] == target:
                pivot += 1
            upto, skip = 0.0, math.inf
            for _, t, pos in cur[:pivot + 1]:
                own = chunk[t]
                at = bisect_left(own, target, pos)
                if at < len(own):
                    block = at // POSTING_BLOCK
                    upto += block_max[t][block]
                    skip = min(skip, own[min(len(own), (block + 1) * POSTING_BLOCK) - 1] + 1)
            if upto < goal:
                # nothing in these blocks reaches the goal: go past the first block that ends
                ahead = cur[pivot + 1][0] if pivot + 1 < len(cur) else math.inf
                to = max(min(skip, ahead), target + 1)
                moved = pivot + 1
            elif cur[0][0] == target:
                total = 0.0
                for c, t, pos in cur[:pivot + 1]:
                    total += impact[t][pos] if c == target else 0.0
                if total >= goal:
                    out.append((target, total))
                to, moved = target + 1, pivot + 1
            else:
                to, moved = target, pivot
            kept = []
            for c, t, pos in cur[:moved]:
                if c < to:
                    own = chunk[t]
                    pos = len(own) if to == math.inf else bisect_left(own, to, pos)
                    if pos >= len(own):
                        continue
                    c = own[pos]
                kept.append((c, t, pos))
            cur = kept + cur[moved:]
        return out

    def leaks(self, text: str) -> list[tuple[object, float, float, float]]:
        """(item id, best score, question overlap, answer overlap) of the verified items of a text."""
        return next(self.leaks_of([text]))

    def leaks_of(self, texts: Iterable[str]) -> Iterator[list[tuple[object, float, float, float]]]:
        """The ``leaks`` of each text; passages of about ``WORDS`` words are tested together."""
        held: list[list[bytes]] = []
        size = 0
        for text in texts:
            held.append(words(text))
            size += len(held[-1]) + 1
            if size >= WORDS:
                yield from self._leaks(held)
                held, size = [], 0
        yield from self._leaks(held)

    def _leaks(self, texts: list[list[bytes]]) -> Iterator[list[tuple[object, float, float, float]]]:
        found: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
        for t, k, terms in self.hopeful(texts) if self.items else ():
            own, size = found[t], len(texts[t])
            for c, score in self.search(terms):
                i = self.item_of[c]
                best, lo, hi = own.get(i, (0.0, size, 0))
                own[i] = (max(best, score), min(lo, k * CHUNK), max(hi, min((k + 2) * CHUNK, size)))
        for ws, own in zip(texts, found, strict=True):
            yield self._verified(ws, own)

    def _verified(self, ws: list[bytes], found: dict[int, tuple[float, int, int]]) -> list[tuple[object, float, float, float]]:
        """Of items found (best score, first word, past the last), those whose shingles are there."""
        out = []
        for i, (best, lo, hi) in sorted(found.items()):
            item_id, question, answer = self.items[i]
            # the item may begin before or end after the passages that retrieved it
            reach = len(question) + len(answer) + SHINGLE
            near = ws[max(0, lo - reach):hi + reach]
            if len(question) == 1 and not answer:
                n = next(iter(question)).count(b" ") + 1
                here = {b" ".join(near[j:j + n]) for j in range(len(near) - n + 1)}
            else:
                here = shingles(near)
            q = len(question & here) / len(question)
            a = len(answer & here) / len(answer) if answer else q
            share = len((question | answer) & here) / len(question | answer)
            if share >= self.overlap and min(q, a) >= self.half_overlap:
                out.append((item_id, best, q, a))
        return out


PART = 16_000_000       # bytes of a stored row of a block's index


def _built(rho: float, overlap: float, half_overlap: float):
    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by([("i", "ascending"), ("t", "ascending")])
        items = list(zip(block["i"].to_pylist(), block["t"].to_pylist(), strict=True))
        data = pickle.dumps(Index(items, rho, overlap, half_overlap), protocol=5)
        parts = [data[k:k + PART] for k in range(0, len(data), PART)]
        return pa.table({"block": pa.array([block["block"][0].as_py()] * len(parts), pa.int32()),
                         "part": pa.array(range(len(parts)), pa.int32()), "data": pa.array(parts, pa.binary())})
    return build


def item_indexes(items: DataFrame, id_col: str, text_col: str, block_bytes: int, rho: float, overlap: float,
                 half_overlap: float) -> tuple[DataFrame, int]:
    """The indexes of the distinct items, dealt by hash to blocks of about ``block_bytes`` of text: a stored table
    (block, part, data) that tasks build, one block each, and the number of blocks."""
    rows = (items.select(F.col(id_col).alias("i"), text_or_empty(text_col).alias("t"))
            .where(F.col("t") != "").distinct())
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = -(-size // block_bytes)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("t", "i"), F.lit(max(1, n))).cast("int"))
    built = dealt.groupBy("block").applyInArrow(_built(rho, overlap, half_overlap), "block int, part int, data binary")
    return materialize(built, "item-index"), n


def _loaded(indexes: DataFrame, block: int) -> Broadcast | None:
    """One block's index, sent to the executors as bytes; the driver never holds more than this block."""
    parts = indexes.where(F.col("block") == block).orderBy("part").select("data").toLocalIterator()
    data = b"".join(bytes(r["data"]) for r in parts)
    return indexes.sparkSession.sparkContext.broadcast(data) if data else None


_OPEN: dict[str, Index] = {}


def _index(sent: Broadcast, name: str) -> Index:
    """A worker's index of the block it works on; an earlier block's is let go."""
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = pickle.loads(sent.value)
    return _OPEN[name]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", rho: float = 0.6, overlap: float = 0.8,
               half_overlap: float = 0.5, block_bytes: int = 16_000_000) -> DataFrame:
    """One row per document row and item it holds: id, item id, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    ship(spark)
    item_type = items.schema[item_id_col].dataType
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(item_id_col, item_type),
                           *[T.StructField(c, T.DoubleType()) for c in ("score", "question_overlap", "answer_overlap")]])
    source = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    indexes, n = item_indexes(items, item_id_col, item_text_col, block_bytes, rho, overlap, half_overlap)
    found = scratch_path(spark, "leaks")
    for block in range(n):
        sent, name = _loaded(indexes, block), f"{found}/{block}"
        if sent is None:
            continue

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[pa.RecordBatch]:
            index = _index(sent, name)
            for b in batches:
                at, rows = [], []
                for k, own in enumerate(index.leaks_of(each(b.column(1)))):
                    at += [k] * len(own)
                    rows += own
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], to_arrow_type(item_type)),
                         *[pa.array(c, pa.float64()) for c in cols[1:]]], names=schema.names)
        source.mapInArrow(run, schema).write.mode("overwrite").parquet(f"{found}/block={block}")
        sent.destroy()
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{found}/block=-1")
    return spark.read.schema(schema).parquet(found).select(*schema.names)


def _clean(sent: Broadcast, name: str):
    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = _index(sent, name)
        for texts in batches:
            yield pa.array([not own for own in index.leaks_of(each(texts))], pa.bool_())
    return clean


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", rho: float = 0.6, overlap: float = 0.8, half_overlap: float = 0.5,
               block_bytes: int = 16_000_000) -> DataFrame:
    """The documents that hold no item, with exactly the input's columns; stored after each block but the last."""
    ship(docs.sparkSession)
    indexes, n = item_indexes(items, item_id_col, item_text_col, block_bytes, rho, overlap, half_overlap)
    for block in range(n):
        sent, name = _loaded(indexes, block), uuid.uuid4().hex
        if sent is None:
            continue
        docs = docs.where(_clean(sent, name)(text_or_empty(text_col)))
        if block < n - 1:
            docs = materialize(docs, "no-leaks")
            sent.destroy()
    return docs


def op6_decontamination(spark, sf_dir):
    return find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
