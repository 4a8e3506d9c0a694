"""Source divergence audit by count-cell ranking.

Within a language, every source's smoothed term shares are compared with those of each other source (part
``pair``) and with the language as a whole (part ``term``).  A share depends on a term's count alone, so terms
with equal counts form a *cell*, and all arithmetic is done once per cell:

* Counting.  Tasks combine the occurrences and rows of each (lang, source, term) before the shuffle.  A term is
  kept if it stands in at least ``min_docs`` rows of its language.
* Part ``term``: cells (group count, language count) with their multiplicity; ``f`` per cell; cells of equal
  value merged; the cumulative multiplicity of the values finds those that reach into the first ``ranks``
  places; only their terms are expanded, in UTF-8 order.
* Part ``pair``: for groups a and b the sum over all kept terms is, with a0 and b0 the shares of count 0,
  ``V f(a0,b0)``, plus for each cell of a ``m (f(a,b0) - f(a0,b0))``, plus for each cell of b
  ``m (f(a0,b) - f(a0,b0))``, plus for each cell of terms that both have
  ``m (f(a,b) - f(a,b0) - f(a0,b) + f(a0,b0))``.  Absent terms are never written out.  The last part takes a
  term's sources in blocks of at most ``width``, so no task holds all sources of a common term.

All arithmetic is on integers (decimals of 38 digits where a product may pass 64 bits).  The result has a row for
each ordered pair of a language's sources, which the report asks for, and at most ``ranks`` terms a group.

Defined results: null text, lang and source count as empty; every row is a document, with repeated or null ids
too; a language without kept terms has pair values 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, each, materialize, ship

# the bytes of terms: A-Z lower-cased, a-z, and all bytes of other characters; the rest become spaces
_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))
SCALE = 1_000_000_000
HELD = 500_000          # combined terms that a task holds before it hands them on
PAIRS = 2_000_000       # pairs of a term's sources that a task looks at in one go
_ROW = 1 << 40          # a combined term's rows are counted in the bits above, its occurrences below


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) -> (lang, source, term, n, docs) combined; term null: the group itself."""
    found: dict[tuple[str, str], dict[bytes | None, int]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in found.items():
            sums = np.fromiter(own.values(), np.int64, len(own))
            name = [pa.array([x]).take(pa.array(np.zeros(len(own), np.int32))) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays(
                [*name, pa.array(list(own), pa.binary()).cast(pa.string()), pa.array(sums % _ROW), pa.array(sums // _ROW)],
                names=["lang", "source", "term", "n", "docs"])
        found.clear()

    held = rows = 0
    for b in batches:
        for lang, source, text in zip(*[each(b.column(i)) for i in range(3)], strict=True):
            own = found.setdefault((lang, source), {})
            before, get = len(own), own.get
            own[None] = get(None, 0) + _ROW
            for t, n in Counter(terms(text)).items():
                own[t] = get(t, 0) + n + _ROW
            held, rows = held + len(own) - before, rows + 1
            if held >= HELD or rows >= 1 << 22:
                yield from out()
                held = rows = 0
    yield from out()


def share(count: Column, total: Column, v: Column) -> Column:
    """p = 1 + floor(10^9 (count + 1) / (total + v)); null where total + v is 0."""
    wide = "decimal(20,0)"
    product = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast(wide)
    return F.call_function("div", product, F.nullif((total + v).cast(wide), F.lit(0).cast(wide))) + 1


def distance(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / q); shares are at most 10^9 + 1, so a long holds the square."""
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, left, right) of one term each, entries (group, share, share of count 0) -> (a, b, value).

    Cells (a, share in a, b, share in b) of a batch are counted first; f is evaluated once per cell.
    """
    def parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries by row, their kinds (group, share, share of count 0) and each entry's kind."""
        flat = column.flatten()
        g, p, p0 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        groups, own = np.unique(g, return_inverse=True)
        _, at, code = np.unique(own * (SCALE + 2) + p, return_index=True, return_inverse=True)
        return column.value_lengths().to_numpy().astype(np.int64), np.stack([g[at], p[at], p0[at]]), code

    def settle(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        (nl, kinds_l, code_l), (nr, kinds_r, code_r) = parts(rows.column(0)), parts(rows.column(1))
        # every left entry of a row meets every right entry of the row
        row = np.repeat(np.arange(len(nl)), nl)
        left = np.repeat(code_l, nr[row])
        first = np.cumsum(nr) - nr
        start = np.cumsum(nr[row]) - nr[row]
        right = code_r[np.arange(len(left)) - np.repeat(start - first[row], nr[row])]
        cells, m = np.unique(left * kinds_r.shape[1] + right, return_counts=True)
        a, p, a0 = kinds_l[:, cells // kinds_r.shape[1]]
        b, q, b0 = kinds_r[:, cells % kinds_r.shape[1]]
        value = m * (_f(p, q) - _f(p, b0) - _f(a0, q) + _f(a0, b0))
        own = a != b
        if not own.any():
            return None
        (left, x), (right, y) = (np.unique(c[own], return_inverse=True) for c in (a, b))
        pairs, place = np.unique(x * len(right) + y, return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, place, value[own])
        return pa.RecordBatch.from_arrays([pa.array(left[pairs // len(right)]), pa.array(right[pairs % len(right)]), pa.array(total)],
                                          names=["a", "b", "value"])

    for b in batches:
        size = np.cumsum(b.column(0).value_lengths().to_numpy().astype(np.int64) * b.column(1).value_lengths().to_numpy())
        at = 0
        while at < len(b):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PAIRS, "right")))
            found = settle(b.slice(at, end - at))
            if found is not None:
                yield found
            at = end


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               min_docs: int = 3, ranks: int = 200, width: int = 256) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts."""
    ship(docs.sparkSession)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    counts = materialize(
        docs.select(*[c.alias(n) for c, n in zip(text, ("lang", "source", "text"), strict=True)])
        .mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = (counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    terms = materialize(counts.where("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]), "divergence-terms")

    totals = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = (terms.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang"))
             .groupBy("lang").agg(F.sum("n_lang").alias("total_lang"), F.count(F.lit(1)).alias("v")))
    zero = F.lit(0).cast("long")
    groups = counts.where("term IS NULL").select("lang", "source").distinct()
    # a language's sources in blocks of about ``width``, so that no join key holds all pairs of a large language
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / width).alias("blocks"))
    groups = materialize(
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(blocks, "lang")
        .select("lang", "source", F.monotonically_increasing_id().alias("g"), "blocks",
                F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block"),
                *[F.coalesce(c, zero).alias(c) for c in ("total", "total_lang", "v")])
        .withColumn("p0", share(zero, F.col("total"), F.col("v"))), "divergence-groups")
    return _term_part(terms, groups, ranks).unionByName(_pair_part(terms, groups))


def _term_part(terms: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    key, by_group = ["lang", "source", "n", "n_lang"], Window.partitionBy("lang", "source")
    cells = (terms.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).join(groups, ["lang", "source"])
             .withColumns({"p": share(F.col("n"), F.col("total"), F.col("v")),
                           "q": share(F.col("n_lang"), F.col("total_lang"), F.col("v"))})
             .where("p > q").select(*key, "m", distance(F.col("p"), F.col("q")).alias("value")))
    cells = materialize(cells, "divergence-cells")
    # a value holds a term at least, so no group needs more than its first ``ranks`` values
    best = (cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
            .withColumn("at", F.row_number().over(by_group.orderBy(F.desc("value")))).where(F.col("at") <= ranks)
            .withColumn("before", F.sum("m").over(by_group.orderBy(F.desc("value"))) - F.col("m"))
            .where(F.col("before") < ranks).select("lang", "source", "value"))
    chosen = cells.join(best, ["lang", "source", "value"]).select(*key, "value")
    return (terms.join(chosen, key)
            .withColumn("rank", F.row_number().over(by_group.orderBy(F.desc("value"), "term"))).where(F.col("rank") <= ranks)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))


def _other_groups(rows: DataFrame, groups: DataFrame, *names: str) -> DataFrame:
    """Each of ``rows`` (with lang, blocks) with every group of its language, block by block."""
    own = groups.select("lang", "block", *[F.col(c).alias(n) for c, n in zip(("g", "p0"), names, strict=False)])
    return (rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .join(own, ["lang", "block"]).drop("block", "blocks"))


def _pair_part(terms: DataFrame, groups: DataFrame) -> DataFrame:
    pairs = _other_groups(groups.select("lang", "blocks", F.col("g").alias("a"), F.col("p0").alias("a0"), "v"),
                          groups, "b", "b0").where("a <> b")                          # the rows of the report
    # a language without kept terms has no shares, and value 0
    base = pairs.select("a", "b", F.coalesce(F.col("v") * distance(F.col("a0"), F.col("b0")), F.lit(0)).alias("value"))
    # cells of one group against the share of count 0 in the other, in both directions
    named = groups.select("lang", "source", "g", "block", "blocks", "total", "v", "p0")
    one = _other_groups(
        terms.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m")).join(named, ["lang", "source"])
        .select("lang", "blocks", "g", "m", "p0", share(F.col("n"), F.col("total"), F.col("v")).alias("p")),
        groups, "h", "h0").where("g <> h")
    p, p0, h0, m = (F.col(c) for c in ("p", "p0", "h0", "m"))
    one = one.groupBy("g", "h").agg(F.sum(m * (distance(p, h0) - distance(p0, h0))).alias("forth"),
                                    F.sum(m * (distance(h0, p) - distance(h0, p0))).alias("back"))
    single = one.select(F.inline(F.array(F.struct(F.col("g").alias("a"), F.col("h").alias("b"), F.col("forth").alias("value")),
                                         F.struct(F.col("h").alias("a"), F.col("g").alias("b"), F.col("back").alias("value")))))
    lists = (terms.join(named, ["lang", "source"])
             .select("lang", "term", "block", "g", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), "p0")
             .groupBy("lang", "term", "block").agg(F.collect_list(F.struct("g", "p", "p0")).alias("list")))
    both = (lists.select("lang", "term", F.col("list").alias("left"))
            .join(lists.select("lang", "term", F.col("list").alias("right")), ["lang", "term"])
            .select("left", "right").mapInArrow(_both, "a long, b long, value long"))
    values = base.unionByName(single).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
    found = (values.join(groups.select("lang", "source", F.col("g").alias("a")), "a")
             .join(groups.select(F.col("source").alias("item"), F.col("g").alias("b")), "b"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def op12_source_divergence(spark, sf_dir):
    return divergence(documents(spark, sf_dir))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n_lang FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
           GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
langs AS (SELECT lang, sum(n_lang) AS total_lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.n_lang + 1)) // (l.total_lang + l.v)::HUGEINT AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM grid WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
