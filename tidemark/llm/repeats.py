"""Removal of bytes covered by a repeated 400-byte string, with a column-wise multi-document BWT.

The column-wise construction inserts one symbol per document each round and updates the order of the suffixes (the
transform) and their common prefixes.  Over whole documents its rounds number as the longest document and each
reads all that is there, so here it runs over short pieces that content-defined anchors bring together:

1. Anchors.  In each 400-byte window the 64-byte substring of least hash is its anchor; equal windows have equal
   anchors at equal places.  The windows of one anchor are consecutive; the *stretch* they cover (up to 736 bytes)
   is known by its hash.  One pass writes (anchor, stretch, document, place) of all documents, about one
   row per 170 bytes.
2. Stretches that occur twice are repeated whole.  Anchors that occur in different stretches go on: a second pass fetches
   the bytes of those, one per different stretch.  A Bloom filter of bounded size tells it which to fetch.
3. Column by column, from the right, one symbol of every piece is inserted: a stable sort by symbol within each anchor
   gives the new suffix order, range minima the new common prefixes.  A window is repeated if its suffix has a common
   prefix of 400 with a neighbour.  An anchor with over ``hot`` different stretches is instead settled by counting
   its windows' hashes in an ordinary aggregate, so no group is unbounded in a task.
4. The repeated windows of each stretch, joined to its places, are each document's removed bytes.

Passages of over 50 words may be shorter than 400 bytes.  They are not removed, but told by a column of their own, from the
same anchors and stretches over words: a first pass names the anchors that occur twice, a second one writes their stretches,
or, where these differ, the hashes of their windows, and those that two rows have are joined back to the texts.

Defined results: texts are UTF-8 bytes; a null text is empty; texts of under 400 bytes lose nothing; equal rows are each
other's repeats; overlapping occurrences count; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, each, materialize, shuffle_width, ship, text_or_empty

LENGTH, ANCHOR = 400, 64
SPAN = LENGTH - ANCHOR                  # an anchor's places in a window: 0 to SPAN
SEGMENT = 1 << 22                       # bytes of a text that are worked on at once
WORDS, ANCHOR_WORDS = 51, 12            # words of a passage and of its anchor
SLICE = 1 << 20                         # bytes of texts whose words are taken at once
CHUNK = 8192                            # pieces whose transform is built at once
_PLACE = 24                             # bits of a place in a segment
_ROOT = 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.isin(_FOLD, np.r_[48:58, 97:123, 128:256])    # letters, digits and what is not ASCII
_VARIED = 0x5851F42D4C957F2D            # marks an anchor with different stretches in the Bloom filter


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _ROOT), ("down", pow(_ROOT, -1, 1 << 64))):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def _prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any run of bytes, or of words given by their hashes, follows; the inverse powers."""
    up, down = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_BYTE[data] if data.dtype == np.uint8 else data) * up[:len(data)], out=out[1:])
    return out, down


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    blocks = -(-len(v) // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:len(v)] = v
    full = full.reshape(blocks, width)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:len(v) - width + 1], left[width - 1:len(v)])


def _stretched(data: np.ndarray, length: int, anchor: int, inside: np.ndarray | None = None) -> Iterator[tuple]:
    """For each segment of some bytes or words: its start, prefix sums and inverse powers, and its stretches of windows of
    ``length`` as in ``stretches``, first windows counted from its start.  Only windows marked by ``inside`` are taken."""
    for at in range(0, max(0, len(data) - length + 1), SEGMENT):
        part = data[at:at + SEGMENT + length - 1]
        prefix, down = _prefix(part)
        h = _mix((prefix[anchor:] - prefix[:-anchor]) * down[:len(part) - anchor + 1])
        place = np.arange(len(h), dtype=np.uint64)
        least = _sliding_least(h >> np.uint64(_PLACE) << np.uint64(_PLACE) | place, length - anchor + 1)
        where = (least & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        window = None if inside is None else np.flatnonzero(inside[at:at + len(where)])
        where = where if window is None else where[window]
        first = np.flatnonzero(np.diff(where, prepend=-1))
        count = np.diff(first, append=len(where))
        p = where[first]
        first = first if window is None else window[first]
        end = first + count - 1 + length
        body = (prefix[end] - prefix[first]) * down[first]
        off = p - first
        # least hashes are small ones, so they are mixed again
        yield at, prefix, down, _mix(h[p] + np.uint64(1)), _mix(body + _mix((off * 1024 + count).astype(np.uint64))), first, count, off


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, stretch hash, first window, number of windows, place of the anchor in the stretch) of a text."""
    out = [(anchor, stretch, first + at, count, off)
           for at, _, _, anchor, stretch, first, count, off in _stretched(data, LENGTH, ANCHOR)]
    if not out:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def repeated_windows(pieces: list[bytes], off: np.ndarray, group: np.ndarray) -> list[list[tuple[int, int]]]:
    """Runs of repeated windows (first, past the last) of each piece.  Pieces are sorted by group (0, 1, ...) and aligned at
    their anchors (``off`` bytes from their start).

    One symbol of every piece is inserted per round, from the rightmost column on; ``order`` is the suffix order
    within groups and ``common`` the common prefix of each suffix with the one before it."""
    n = len(pieces)
    size = np.array([len(p) for p in pieces])
    begin, width = SPAN - off, SPAN + LENGTH
    table = np.zeros((n, width), dtype=np.uint8)
    for i, p in enumerate(pieces):
        table[i, begin[i]:begin[i] + size[i]] = np.frombuffer(p, dtype=np.uint8)
    columns = np.ascontiguousarray(table.T)
    end = begin + size
    base = group.astype(np.int64) * 257
    order, common = np.arange(n), np.zeros(n, dtype=np.int64)
    repeated = np.zeros((SPAN + 1, n), dtype=bool)
    for c in range(int(end.max()) - 1, int(begin.min()) - 1, -1):
        inside = (begin <= c) & (c < end)
        key = (base + np.where(inside, columns[c].astype(np.int64) + 1, 0))[order]
        turn = np.argsort(key, kind="stable")
        ranked = key[turn]
        u, v = turn[:-1], turn[1:]
        alike = (ranked[1:] == ranked[:-1]) & (ranked[1:] % 257 != 0)
        new = np.zeros(n, dtype=np.int64)
        near = np.flatnonzero(alike & (v == u + 1))
        new[near + 1] = common[v[near]] + 1
        far = np.flatnonzero(alike & (v != u + 1))
        if len(far):
            # the least common prefix between two places of the old order
            cut = np.empty(2 * len(far), dtype=np.int64)
            cut[0::2], cut[1::2] = u[far] + 1, v[far] + 1
            new[far + 1] = np.minimum.reduceat(np.append(common, 0), cut)[0::2] + 1
        order, common = order[turn], new
        if c <= SPAN:
            long_ = common >= LENGTH
            either = long_.copy()
            either[:-1] |= long_[1:]
            repeated[c, order] = either
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    edge = np.diff(np.vstack([np.zeros((1, n), bool), repeated, np.zeros((1, n), bool)]).astype(np.int8), axis=0)
    piece, at = np.nonzero(edge.T)
    for k in range(0, len(piece), 2):
        i = piece[k]
        out[i].append((int(at[k] - begin[i]), int(at[k + 1] - begin[i])))
    return out


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        refs, cols = [], []
        for ref, text in zip(each(b.column(0)), each(b.column(1)), strict=True):
            s = stretches(np.frombuffer(text, dtype=np.uint8))
            if len(s[0]):
                refs += [ref] * len(s[0])
                cols.append(s)
        if cols:
            anchor, stretch, first, count, _ = (np.concatenate(x) for x in zip(*cols, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(refs, pa.binary()), pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)),
                 pa.array(first), pa.array(count.astype(np.int32))], names=["ref", "anchor", "stretch", "first", "count"])


class _Wanted:
    """A Bloom filter of anchors in slices by hash range."""

    def __init__(self, bits: int):
        self.bits, self.bytes = bits, np.zeros(1 << (bits - 3), dtype=np.uint8)

    def has(self, anchors: np.ndarray) -> np.ndarray:
        ok = np.ones(len(anchors), dtype=bool)
        for s in bloom_spots(anchors, self.bits):
            ok &= (self.bytes[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
        return ok


SLICES = 8      # bits of a slice's number


def bloom_spots(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    own, h, out = bits - SLICES, anchors, []
    part = (anchors >> np.uint64(64 - SLICES)).astype(np.int64) << own
    for _ in range(4):
        h = _mix(h + np.uint64(0x9E3779B97F4A7C15))
        out.append(part | (h >> np.uint64(64 - own)).astype(np.int64))
    return out


def _wanted(anchors: DataFrame, max_bits: int) -> _Wanted:
    bits = max_bits if max_bits < 20 else min(max_bits, max(20, 4 + anchors.count().bit_length()))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        part, own = int(frame["part"].iloc[0]), bits - SLICES
        on = np.zeros(1 << own, dtype=bool)
        for s in bloom_spots(frame["anchor"].to_numpy().view(np.uint64), bits):
            on[s - (part << own)] = True
        return pd.DataFrame({"part": [part], "piece": [np.packbits(on, bitorder="little").tobytes()]})

    out = _Wanted(bits)
    parts = anchors.select("anchor", F.shiftrightunsigned("anchor", 64 - SLICES).cast("int").alias("part"))
    for r in parts.groupBy("part").applyInPandas(run, "part int, piece binary").collect():
        out.bytes[r["part"] * len(r["piece"]):(r["part"] + 1) * len(r["piece"])] = np.frombuffer(r["piece"], np.uint8)
    return out


def _fetch(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            rows = []
            for text in each(b.column(0)):
                anchor, stretch, first, count, off = stretches(np.frombuffer(text, dtype=np.uint8))
                for k in np.flatnonzero(table.value.has(anchor)) if len(anchor) else ():
                    s = int(stretch[k])
                    if s not in seen:
                        if len(seen) < 300_000:
                            seen.add(s)
                        rows.append((int(anchor[k].view(np.int64)), int(stretch[k].view(np.int64)), int(off[k]),
                                     text[first[k]:first[k] + count[k] - 1 + LENGTH]))
            if rows:
                a, s, o, p = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(s, pa.int64()), pa.array(o, pa.int32()),
                                                  pa.array(p, pa.binary())], names=["anchor", "stretch", "off", "piece"])
    return run


_RUNS = "anchor long, stretch long, lo int, hi int"


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor -> repeated runs of windows of each stretch."""
    held: list[tuple] = []

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        anchors = np.array([r[0] for r in rows])
        group = np.cumsum(np.diff(anchors, prepend=anchors[:1]) != 0)
        found = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows]), group)
        flat = [(r[0], r[1], lo, hi) for r, f in zip(rows, found, strict=True) for lo, hi in f]
        cols = list(zip(*flat, strict=True)) if flat else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["anchor", "stretch", "lo", "hi"])

    last = None
    for b in batches:
        for row in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
            if held and row[0] != held[-1][0] and len(held) >= CHUNK:
                yield settle(held)
                held = []
            if last != row[:2]:             # the same stretch from another task
                held.append(row)
            last = row[:2]
    if held:
        yield settle(held)


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a, s, off, p in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
            prefix, down = _prefix(np.frombuffer(p, dtype=np.uint8))
            h = _mix((prefix[LENGTH:] - prefix[:-LENGTH]) * down[:len(p) - LENGTH + 1])
            lo = np.arange(len(h), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a] * len(h), pa.int64()), pa.array([s] * len(h), pa.int64()), pa.array(lo),
                 pa.array(lo - off, pa.int32()), pa.array(h.view(np.int64))], names=["anchor", "stretch", "lo", "x", "h"])


def repeated_places(docs: DataFrame, hot: int, max_bits: int) -> DataFrame:
    """(ref, spans): for each text, arrays of (start, end) of bytes in repeated windows; ``docs`` has ref, bytes."""
    spark = docs.sparkSession
    places = materialize(docs.mapInArrow(_places, "ref binary, anchor long, stretch long, first long, count int"),
                         "repeat-places")
    per = materialize(places.groupBy("anchor", "stretch").agg(F.count(F.lit(1)).alias("n"), F.first("count").alias("count"))
                      .join(places.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1").drop("m"), "anchor"),
                      "repeat-stretches")
    whole = per.where("n > 1").select("anchor", "stretch", F.lit(0).alias("lo"), F.col("count").alias("hi"))
    varied = materialize(per.groupBy("anchor").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "repeat-anchors")
    table = spark.sparkContext.broadcast(_wanted(varied, max_bits))
    pieces = materialize(docs.select("bytes").mapInArrow(_fetch(table), "anchor long, stretch long, off int, piece binary"),
                         "repeat-pieces")
    columns = ("anchor", "stretch", "off", "piece")
    cool = (pieces.join(varied.where(F.col("d") <= hot).select("anchor"), "anchor").select(*columns)
            .repartition(max(1, shuffle_width(spark)), "anchor").sortWithinPartitions("anchor", "stretch")
            .mapInArrow(_transform, _RUNS))
    crowd = (pieces.join(varied.where(F.col("d") > hot).select("anchor"), "anchor").select(*columns)
             .dropDuplicates(["anchor", "stretch"])
             .mapInArrow(_window_hashes, "anchor long, stretch long, lo int, x int, h long"))
    common = crowd.groupBy("anchor", "x", "h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    single = (crowd.join(common, ["anchor", "x", "h"]).select("anchor", "stretch", "lo", (F.col("lo") + 1).alias("hi")))
    runs = materialize(whole.unionByName(cool).unionByName(single), "repeat-runs")
    table.destroy()
    return (places.join(runs, ["anchor", "stretch"])
            .select("ref", F.struct((F.col("first") + F.col("lo")).alias("start"),
                                    (F.col("first") + F.col("hi") - 1 + LENGTH).alias("end")).alias("span"))
            .groupBy("ref").agg(F.collect_set("span").alias("spans")))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word; upper case A-Z is as lower case."""
    at = np.flatnonzero(_IN_WORD[data])
    if not len(at):
        return np.zeros(0, dtype=np.uint64), at
    begin = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    size = np.diff(begin, append=len(at))
    up, _ = _powers(int(size.max()))
    place = np.arange(len(at)) - np.repeat(begin, size)
    return _mix(np.add.reduceat(_BYTE[_FOLD[data[at]]] * up[place], begin)), at[begin]


def _word_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of whole texts together: refs, the words' hashes, their texts' numbers, and whether a passage of one text starts there."""
    def take(rows: list[tuple]) -> tuple:
        refs, texts = zip(*rows, strict=True)
        words, first = _words(np.frombuffer(b"\n".join(texts), dtype=np.uint8))
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first, side="right")
        return pa.array(refs, pa.binary()), words, text, text[WORDS - 1:] == text[:len(text) - WORDS + 1]

    held, size = [], 0
    for b in batches:
        for row in zip(each(b.column(0)), each(b.column(1)), strict=True):
            if len(row[1]) >= 2 * WORDS - 1:
                held.append(row)
                size += len(row[1])
            if size >= SLICE:
                yield take(held)
                held, size = [], 0
    if held:
        yield take(held)


def _word_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, words, _, inside in _word_slices(batches):
        for _, _, _, anchor, stretch, *_ in _stretched(words, WORDS, ANCHOR_WORDS, inside):
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64))],
                                             names=["anchor", "stretch"])


def _word_windows(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for refs, words, text, inside in _word_slices(batches):
            keys, owners = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
            for at, prefix, down, anchor, stretch, first, count, _ in _stretched(words, WORDS, ANCHOR_WORDS, inside):
                varied = table.value.has(anchor ^ np.uint64(_VARIED))
                whole = ~varied & table.value.has(anchor)
                n = count[varied]
                lo = np.arange(n.sum()) + np.repeat(first[varied] - (np.cumsum(n) - n), n)
                keys += [stretch[whole], _mix((prefix[lo + WORDS] - prefix[lo]) * down[lo])]
                owners += [text[at + first[whole]], text[at + lo]]
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((key, owner))
            key, owner = key[order], owner[order]
            # a row counts once for a passage, however often it has it
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), refs.take(pa.array(owner[new]))],
                                             names=["key", "ref"])
    return run


def shared_passages(docs: DataFrame, max_bits: int) -> DataFrame:
    """(ref) of the texts with a passage of ``WORDS`` words that another row has too; ``docs`` has ref, bytes."""
    spark = docs.sparkSession
    anchors = materialize(
        docs.mapInArrow(_word_anchors, "anchor long, stretch long")
        .groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("stretch").alias("least"), F.max("stretch").alias("most"))
        .where("n > 1").select("anchor", (F.col("least") != F.col("most")).alias("varied")), "passage-anchors")
    marked = anchors.where("varied").select(F.col("anchor").bitwiseXOR(F.lit(_VARIED)).alias("anchor"))
    table = spark.sparkContext.broadcast(_wanted(marked.unionByName(anchors.where("not varied").select("anchor")), max_bits))
    windows = materialize(docs.mapInArrow(_word_windows(table), "key long, ref binary"), "passage-windows")
    table.destroy()
    common = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return windows.join(common, "key").select("ref").distinct()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut(data: bytes, spans: list) -> tuple[bytes, list[tuple[int, int]]]:
    runs, kept, at = merged([(s["start"], s["end"]) for s in spans or []]), [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]]), runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = 2048,
                   max_bits: int = 28, with_kept: bool = True, with_passages: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, has_repeats (it lost bytes), maybe the kept bytes, and
    maybe shared_passage (1 if ``WORDS`` words in a row are in another row too, of whatever length in bytes, else 0)."""
    ship(docs.sparkSession)
    data = text_or_empty(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("__id"), F.unhex(F.md5(data)).alias("ref"), data.alias("bytes"))
    found = repeated_places(rows.select("ref", "bytes"), hot, max_bits).withColumn("shared", F.lit(None).cast("int"))
    if with_passages:
        passages = shared_passages(rows.select("ref", "bytes"), max_bits).withColumn("shared", F.lit(1))
        found = found.drop("shared").join(passages, "ref", "full")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [_cut(x, s) for x, s in zip(each(b.column(1)), each(b.column(2)), strict=True)]
            cols = [b.column(0), pc.binary_length(b.column(1)).cast(pa.int64()),
                    pa.array([sum(y - x for x, y in r) for _, r in cut], pa.int64()),
                    pa.array([len(r) for _, r in cut], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k, _ in cut]),
                    pa.array([bool(r) for _, r in cut])]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "has_repeats"]
            if with_kept:
                cols, names = [*cols, pa.array([k for k, _ in cut], pa.binary())], [*names, "kept"]
            if with_passages:
                cols, names = [*cols, b.column(3).fill_null(0)], [*names, "shared_passage"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return (rows.join(found, "ref", "left").select("__id", "bytes", "spans", "shared").mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, has_repeats boolean"
             + ", kept binary" * with_kept + ", shared_passage int" * with_passages))


def op7_repeats(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir), with_kept=False, with_passages=True)
