"""N-gram Jaccard self-join with token-combination prefixes, and its connected components.

A document's set holds its distinct 5-word shingles as 64-bit hashes; two sets link when
``|x & y| >= 0.8 * |x | y|``.  Copies (equal sets) form a class first; the join is between classes.

1. One pass computes each document's set size and class (a 128-bit digest of the set), and counts the
   shingles of all documents.  The counts become a table of bounded size: a Bloom filter of the
   shingles that occur more than once, and for each hash cell the frequency class of its most
   frequent shingle.  Any such table gives right results, as long as all documents use the same one.
2. All documents order their shingles alike: single ones first, then by frequency class, then by hash.
   Let n be the set size.  Linked sets share a shingle in their first ``n - ceil(.8 n) + 1``.
   * If the first shared one is of a rare class, it is an index entry of both: *single shingles*.
   * Otherwise all shared shingles are of frequent classes.  Linked sets differ in at most n/4 shingles,
     so in the *extended prefix* of ``n - ceil(.8 n) + n/4 + 2`` they share more shingles than differing
     ones can separate: some two shared shingles are neighbours in both.  So each two neighbours of
     the extended prefix are an index entry: *2-combinations*, as many as shingles, not their square.
3. In each bucket (equal entry) every member is verified against one leader, and linked members are grouped;
   then only buckets that still hold several groups have their members of different groups verified, if
   parity sketches of the sets (an exact lower bound of their difference) leave a link possible.  A group of
   near copies thus costs one test a member, not all pairs, and no link that could change a component
   is lost.
4. Verification counts the intersection of the whole sets exactly.

Defined results: words are separated by ``[\\x20\\x09-\\x0D]``, A-Z in lower case; with fewer than five words
the whole sequence is one shingle; null or wordless texts have an empty set and link with nothing;
``component_id`` is the least id reachable by links, itself included (nulls are ignored); repeated
rows are copies of one another; empty tables give no rows; other columns are ignored or passed
through by ``drop_near_copies``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents, each, materialize, ship, text_or_empty
from tidemark.llm.components import components, downward, star_round

WORDS = 5
PERCENT = 80
FREQUENT = 64           # from this many occurrences a shingle is of a frequent class
SKETCH = 1024           # parity bits of a set
EARLIER = 8             # preceding index entries by which a pair is known to have met
LOW_BITS = 24           # bits of a shingle's hash that are counted, besides those of its hash range
FLUSH = 2_000_000       # shingles that a task holds while counting
KNOWN_WORDS = 250_000   # word hashes that a worker keeps
_P = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, w: bytes) -> bytes:
        h = hashlib.blake2b(w, digest_size=8).digest()
        if len(self) < KNOWN_WORDS:
            self[w] = h
        return h


_HASH = _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str) -> np.ndarray:
    """The distinct shingles' hashes, ascending."""
    ws = text.encode("utf-8").lower().split()
    if not ws:
        return np.zeros(0, dtype=np.uint64)
    h = np.frombuffer(b"".join(map(_HASH.__getitem__, ws)), dtype=np.uint64)
    k = min(WORDS, len(h))
    s = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        s = s * _P + h[i:len(h) - k + 1 + i]
    return np.unique(_mix(s + np.uint64(k)))


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sets_and_counts(part_bits: int):
    """Per document (id, fingerprint, n, key); per flush and hash range the counted shingles."""
    shift = np.uint64(64 - part_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[np.ndarray] = []
        size = 0

        def flush(schema) -> pa.RecordBatch:
            t = np.sort(np.concatenate(held))
            cut = np.searchsorted(t, np.arange(1, 1 << part_bits, dtype=np.uint64) << shift)
            low = (t << np.uint64(part_bits) >> np.uint64(64 - LOW_BITS)).astype("<u4")
            parts = np.split(low.view(np.uint8).reshape(-1, 4)[:, :LOW_BITS // 8], cut)
            blobs = pa.array([p.tobytes() for p in parts], pa.binary())
            none = [pa.nulls(len(parts), schema.field(i).type) for i in range(4)]
            return pa.RecordBatch.from_arrays([*none, pa.array(range(len(parts)), pa.int32()), blobs], names=NAMES)

        schema = None
        for b in batches:
            n, keys = [], []
            schema = pa.schema([("id", b.column(0).type), ("fp", pa.int64()), ("n", pa.int64()), ("key", pa.binary())])
            for text in each(b.column(2)):
                t = shingle_set(text)
                key = set_key(t)
                n.append(len(t))
                keys.append(key)
                if key not in seen:
                    if len(seen) < KNOWN_WORDS:
                        seen.add(key)
                    held.append(t)
                    size += len(t)
                    if size >= FLUSH:
                        yield flush(schema)
                        held, size = [], 0
            none = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()),
                                              pa.array(keys, pa.binary()), *none], names=NAMES)
        if held and size:
            yield flush(schema)
        _HASH.clear()               # workers live on: later stages need the memory
    return run


NAMES = ["id", "fp", "n", "key", "part", "blob"]


def _frequency_class(count: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.floor(4 * np.log2(count))).astype(np.uint8)


_RARE_BELOW = int(_frequency_class(np.array([FREQUENT]))[0])


def _spots(t: np.ndarray, bits: int, times: int) -> list[np.ndarray]:
    """``times`` places among 2**bits of each of the hash prefixes ``t``."""
    h, out = _mix(t + np.uint64(1)), []
    for _ in range(times):
        out.append((h >> np.uint64(64 - bits)).astype(np.int64))
        h = _mix(h + _P)
    return out


class Frequencies:
    """Bounded table: which shingles occur more than once, and their frequency classes.

    2**bits Bloom bits and 2**(bits - 4) class cells, in slices by the hash range of the shingles."""

    def __init__(self, part_bits: int, bits: int):
        self.part_bits, self.bits = part_bits, bits
        self.bloom = np.zeros(1 << (bits - 3), dtype=np.uint8)
        self.cells = np.zeros(1 << (bits - 4), dtype=np.uint8)

    def look_up(self, tokens: np.ndarray) -> np.ndarray:
        """-1 for single shingles, else the frequency class."""
        t = tokens >> np.uint64(64 - LOW_BITS - self.part_bits)
        part = (t >> np.uint64(LOW_BITS)).astype(np.int64)
        own = self.bits - self.part_bits
        out = np.full(len(t), -1, dtype=np.int64)
        left = np.arange(len(t))
        for spots in _spots(t, own, 4):
            s = (part[left] << own) | spots[left]
            left = left[(self.bloom[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1]
        out[left] = self.cells[(part[left] << (own - 4)) | _spots(t[left], own - 4, 1)[0]]
        return out


def _count_parts(part_bits: int, bits: int):
    own = bits - part_bits

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        part = int(frame["part"].iloc[0])
        packed = np.frombuffer(b"".join(frame["blob"]), dtype=np.uint8).reshape(-1, LOW_BITS // 8)
        wide = np.zeros((len(packed), 4), dtype=np.uint8)
        wide[:, :LOW_BITS // 8] = packed
        low = np.sort(wide.view("<u4").ravel())
        at = np.flatnonzero(np.diff(low, prepend=low[:1] + np.uint32(1)) != 0) if len(low) else np.zeros(0, int)
        count = np.diff(at, append=len(low))
        more = count > 1
        t = (np.uint64(part) << np.uint64(LOW_BITS)) | low[at[more]].astype(np.uint64)
        bloom, cells = np.zeros(1 << own, dtype=bool), np.zeros(1 << (own - 4), dtype=np.uint8)
        for s in _spots(t, own, 4):
            bloom[s] = True
        np.maximum.at(cells, _spots(t, own - 4, 1)[0], _frequency_class(count[more]))
        return pd.DataFrame({"part": [part], "bloom": [np.packbits(bloom, bitorder="little").tobytes()],
                             "cells": [cells.tobytes()]})
    return run


def _frequencies(counted: DataFrame, part_bits: int, bits: int) -> Frequencies:
    """Counts each hash range in a group of its own and collects the slices of the bounded table."""
    out = Frequencies(part_bits, bits)
    slices = materialize(counted.groupBy("part").applyInPandas(_count_parts(part_bits, bits),
                                                               "part int, bloom binary, cells binary"), "join-table")
    for r in slices.toLocalIterator():          # a file at a time
        for table, piece in ((out.bloom, r["bloom"]), (out.cells, r["cells"])):
            table[r["part"] * len(piece):(r["part"] + 1) * len(piece)] = np.frombuffer(piece, dtype=np.uint8)
    return out


def signatures(tokens: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Index entries of a set: rare single shingles of the prefix, neighbours of the extended prefix."""
    n = len(tokens)
    need = (PERCENT * n + 99) // 100
    prefix = n - need + 1
    order = np.lexsort((tokens, kinds))[:n - need + n // 4 + 2]
    t, k = tokens[order], kinds[order]
    single = t[:prefix][(k[:prefix] >= 0) & (k[:prefix] < _RARE_BELOW)]
    if (k[:prefix] >= _RARE_BELOW).any():
        f = t[k >= _RARE_BELOW]
        pairs = _mix(f[:-1] * _P + _mix(f[1:]))
        single = np.concatenate([single, pairs])
    return np.unique(single)


def _pack48(tokens: np.ndarray) -> bytes:
    t = tokens >> np.uint64(16)
    return (t & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (t >> np.uint64(32)).astype("<u2").tobytes()


def _unpack48(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    return (np.frombuffer(blob, "<u4", n).astype(np.uint64)
            | np.frombuffer(blob, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32))


def parity(tokens: np.ndarray) -> np.ndarray:
    """Parities of the numbers of tokens in SKETCH hash places, as 64-bit words.  Two sets' parities differ in
    no more places than the sets differ in tokens."""
    odd = np.bincount((tokens >> np.uint64(8)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _may_link(a: str, na: str, b: str, nb: str):
    """Linked sets differ in at most a quarter of the smaller one's tokens."""
    apart = sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH // 64)),
                F.lit(0))
    return _sizes_fit(na, nb) & (4 * apart <= F.least(na, nb))


def _indexed(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = table.value, set()
        for b in batches:
            rows = []
            for text in each(b.column(0)):
                t = shingle_set(text)
                if len(t) < 4:              # smaller sets can only link with equal ones
                    continue
                key = set_key(t)
                if key in seen:
                    continue
                if len(seen) < KNOWN_WORDS:
                    seen.add(key)
                s = signatures(t, known.look_up(t))
                if len(s):
                    rows.append((key, len(t), s.view(np.int64), _pack48(t), parity(t)))
            if rows:
                key, n, sig, blob, sketch = zip(*rows, strict=True)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sig])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.binary()), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sig))),
                     pa.array(blob, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))],
                    names=["key", "n", "sigs", "blob", "sketch"])
        _HASH.clear()
    return run


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple[bytes, np.ndarray] = (b"", np.zeros(0))
    for b in batches:
        ok = []
        for x, y in zip(each(b.column(2)), each(b.column(3)), strict=True):
            if last[0] != y:
                last = (y, _unpack48(y))
            u, v = _unpack48(x), last[1]
            at = np.searchsorted(v, u)
            same = int((v[np.minimum(at, len(v) - 1)] == u).sum())
            ok.append(100 * same >= PERCENT * (len(u) + len(v) - same))
        yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among candidate ``pairs(a, b)``."""
    blob = sets.select("key", "blob")
    joined = (pairs.join(blob.select(F.col("key").alias("a"), F.col("blob").alias("x")), "a")
              .join(blob.select(F.col("key").alias("b"), F.col("blob").alias("y")), "b"))
    return joined.select("a", "b", "x", "y").mapInArrow(_linked, "a binary, b binary")


def _sizes_fit(a: str, b: str):
    return ((100 * F.least(a, b) >= PERCENT * F.greatest(a, b)))


def links(sets: DataFrame) -> DataFrame:
    """Edges (a, b) between classes with the components of all links."""
    entries = materialize(sets.select("key", "n", F.explode("sigs").alias("sig")).distinct(), "join-entries")
    lead = (entries.groupBy("sig").agg(F.min(F.struct("key", "n")).alias("lead"), F.max("key").alias("last"))
            .where("lead.key <> last").select("sig", "lead"))
    shared = materialize(entries.join(lead, "sig"), "join-buckets")
    first = materialize(shared.where((F.col("key") != F.col("lead.key")) & _sizes_fit("n", "lead.n"))
                        .select(F.col("key").alias("a"), F.col("lead.key").alias("b")).distinct(), "join-star")
    found = materialize(_verify(first, sets), "join-links")
    # A rough grouping is enough to skip pairs that are surely connected: two rounds, equal labels are connected.
    merged = materialize(downward(found), "join-merged")
    for _ in range(2):
        merged = materialize(star_round(merged), "join-merged")
    comp = merged.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("component"))
    # buckets that still hold several components
    own = (shared.select("sig", "key", "n").join(comp.withColumnRenamed("v", "key"), "key", "left")
           .withColumn("c", F.coalesce("component", "key")).drop("component"))
    several = own.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("sig")
    before = Window.partitionBy("key").orderBy("sig").rowsBetween(-EARLIER, -1)
    left = materialize(own.join(several, "sig").withColumn("earlier", F.collect_list("sig").over(before)), "join-left")
    most = (left.groupBy("sig", "c").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("sig").agg(F.max_by("c", F.struct("k", "c")).alias("most")))
    # Only pairs whose parity sketches allow a link leave the join, and not those that certainly met in an
    # earlier bucket: that share one of the last few entries before this one.
    sketched = left.join(sets.select("key", "sketch"), "key")
    few = (sketched.join(most, "sig").where("c <> most")
           .select("sig", *[F.col(x).alias(f"{x}_x") for x in ("key", "n", "c", "sketch", "earlier")]))
    cross = (few.join(sketched, "sig").where((F.col("c_x") != F.col("c")) & _may_link("sketch_x", "n_x", "sketch", "n")
                                         & ~F.arrays_overlap("earlier_x", "earlier"))
             .select(F.greatest("key_x", "key").alias("a"), F.least("key_x", "key").alias("b")).distinct()
             .join(first, ["a", "b"], "left_anti"))
    more = _verify(materialize(cross, "join-cross"), sets)
    return merged.unionByName(more)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 27) -> DataFrame:
    """One row per input row: id, fp (hash of the text), n (set size), component_id, stays (one id and text of
    each component).

    ``max_bits`` bounds the frequency table (2**27 bits and 2**23 cells: 24 MB)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = min(max_bits, max(20, math.ceil(math.log2(max(1, size)))))
    # hash ranges of about 1 MB of counted shingles each
    part_bits = min(bits - 8, max(4, math.ceil(math.log2(max(1, size / 4 / 250_000)))))
    id_type = docs.schema[id_col].dataType.simpleString()
    work = materialize(rows.select("id", F.xxhash64("text").alias("fp"), "text").mapInArrow(
        _sets_and_counts(part_bits), f"id {id_type}, fp long, n long, key binary, part int, blob binary"), "join-sets")
    table = spark.sparkContext.broadcast(
        _frequencies(work.where("part IS NOT NULL").select("part", "blob"), part_bits, bits))
    sets = materialize(rows.select("text").mapInArrow(_indexed(table), "key binary, n long, sigs array<long>, blob binary, sketch array<long>"), "join-index")
    comp = components(links(sets), "join-components")
    table.destroy()
    own = (work.where("key IS NOT NULL").select("id", "fp", "n", "key")
           .join(comp.select(F.col("v").alias("key"), "component"), "key", "left")
           .withColumn("root", F.coalesce("component", "key")))
    some, empty = own.where("n > 0"), own.where("n = 0")
    # the row that stays: the least id, nulls last, then the least hash of the text
    best = F.min(F.struct(F.col("id").isNull(), "id", "fp"))
    least = some.groupBy("root").agg(F.min("id").alias("component_id"), best.alias("best"))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("fp") == F.col("best.fp"))
    return (some.join(least, "root").select("id", "fp", "n", "component_id", stays.alias("stays"))
            .unionByName(empty.select("id", "fp", "n", F.col("id").alias("component_id"), F.lit(True).alias("stays"))))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id."""
    return classes(docs, id_col, text_col).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                                  "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that of the least id (of repeated rows one), in the input's columns."""
    out = materialize(classes(docs, id_col, text_col), "join-classes")
    # rows that need a decision: those that go, and those whose id and text repeat
    marked = (out.groupBy("id", "fp").agg(
        F.max(~F.col("stays")).alias("goes"),
        F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
        .where("goes OR (rows > 1 AND n > 0)")
        .select(F.col("id").alias("__id"), F.col("fp").alias("__fp"), F.col("goes").alias("__goes")))
    tagged = docs.withColumn("__text_fp", F.xxhash64(text_or_empty(text_col))).join(
        marked, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_fp") == F.col("__fp")), "left")
    stay = tagged.where(F.col("__goes").isNull())
    repeated = (tagged.where(~F.col("__goes")).withColumn("__k", F.row_number().over(
        Window.partitionBy("__id", "__fp").orderBy(F.monotonically_increasing_id()))).where("__k = 1"))
    return stay.select(*docs.columns).unionByName(repeated.select(*docs.columns))


def op4_ngram_join(spark, sf_dir):
    return near_copies(documents(spark, sf_dir))


# Words of A-Z in lower case (other letters unchanged), 5-word shingles, links, least reachable id.
ORACLE = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT e.a, e.b FROM e JOIN n x ON x.doc_id = e.a JOIN n y ON y.doc_id = e.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.a, r.c FROM l JOIN r ON r.doc_id = l.b WHERE r.c < l.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""
