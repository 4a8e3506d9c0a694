"""Secret scan: known shapes, and a randomness test battery over long tokens (DataFrame functions only).

Base kinds (``assign``, ``access``, ``hex``) are found by pattern.  The method adds the kind ``random``: every token of
20 or more characters of the base64 alphabets that overlaps no base span is tested.
* Its encoding is inferred: hex, base32, base64, or plain words.
* Uniformity: chi-squared of the character counts over the encoding's alphabet.  It must not reject
  uniformity, and it is tested against what words give (their index of coincidence).
* Runs: changes between character classes, against the few that words and identifiers have.
* Serial correlation: lag-1 correlation of the vowels, against the alternation that words have.
The three p-values (of the token being word-like) are combined by Fisher's method.  A Benjamini-Hochberg rule then
controls the false-discovery rate over all tokens of the corpus, in strata of token length, because short
tokens carry little evidence and long ones much.  The rule needs only counts by (stratum, p-value bin).

Positions come from ``split``: the lengths of the pieces between matches and of the matches add up.

Defined results: a null text is empty; rows without spans have counts of 0, the checksum of the empty string and no
spans; positions count code points, ends are exclusive; repeated rows give repeated results; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import documents, materialize, text_or_empty

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 8
# Word-like tokens: index of coincidence, share of class changes, correlation of neighbouring vowels.
WORD_IC, WORD_IC_SPREAD, WORD_CHANGES, WORD_VOWELS = 0.062, 0.045, 0.12, -0.25
LENGTH_STRATA = (24, 32, 48, 80)


def _pieces(kind: int, pattern: str, group: int) -> Column:
    """An array of (kind, place, length before, match length, value) of all matches of a pattern."""
    text, regex = F.col("__text"), F.lit(pattern)
    zipped = F.arrays_zip(F.regexp_extract_all(text, regex, F.lit(0)).alias("m"),
                          F.regexp_extract_all(text, regex, F.lit(group)).alias("v"),
                          F.transform(F.split(text, pattern, -1), F.length).alias("b"))
    made = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["b"].cast("long").alias("before"),
        F.length(x["m"]).cast("long").alias("size"), x["v"].alias("value")))
    # the piece after the last match has none
    return F.when(text.rlike(pattern), F.filter(made, lambda x: x["value"].isNotNull())).otherwise(
        F.array().cast("array<struct<kind:int,i:int,before:bigint,size:bigint,value:string>>"))


def _upper_tail(z: Column) -> Column:
    """P(normal > z), to a few per cent also far out (Karagiannidis and Lioumpas)."""
    a = F.greatest(F.abs(z), F.lit(1e-6))
    tail = F.exp(-a * a / 2) * (1 - F.exp(-1.4 * a)) / (1.135 * math.sqrt(2 * math.pi) * a)
    return F.greatest(F.lit(1e-300), F.when(z >= 0, tail).otherwise(1 - tail))


def battery(tokens: DataFrame) -> DataFrame:
    """Adds encoding, p (of being word-like), uniform (p of the alphabet's uniformity) to rows with ``value``."""
    body = F.rtrim("value", F.lit("="))
    encoding = (F.when(F.col("body").rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(F.col("body").rlike("^[A-Z2-7]+$"), "base32")
                .when(F.col("body").rlike("[0-9]") & F.col("body").rlike("[A-Za-z]")
                      | F.col("body").rlike("[a-z][A-Z]+[a-z]"), "base64").otherwise("words"))
    letters = {"hex": 16, "base32": 32, "base64": 64, "words": 26}
    size = F.lit(26.0)
    for name, n in letters.items():
        size = F.when(F.col("encoding") == name, float(n)).otherwise(size)
    kind = F.transform("chars", lambda c: F.when(c.rlike("[a-z]"), 1).when(c.rlike("[A-Z]"), 2)
                       .when(c.rlike("[0-9]"), 3).otherwise(4))
    vowel = F.transform("chars", lambda c: F.when(c.rlike("[aeiouyAEIOUY]"), 1.0).otherwise(0.0))
    n = F.col("n")

    def neighbours(name: str, fn) -> Column:
        return F.zip_with(F.slice(name, 1, n.cast("int") - 1), F.slice(name, 2, n.cast("int") - 1), fn)

    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    t = (tokens.withColumn("body", body).withColumn("encoding", encoding)
         .withColumn("chars", F.filter(F.split("body", ""), lambda c: c != "")).withColumn("n", F.size("chars").cast("double"))
         .withColumns({"class": kind, "vowel": vowel, "letters": size, "squares": total(F.transform(
             F.array_distinct("chars"), lambda x: F.pow(F.size(F.filter("chars", lambda y: y == x)).cast("double"), F.lit(2.0))))}))
    t = t.withColumns({
        "chi2": F.col("letters") * F.col("squares") / n - n,
        "ic": (F.col("squares") - n) / (n * (n - 1)),
        "changes": total(neighbours("class", lambda a, b: F.when(a != b, 1.0).otherwise(0.0))),
        "mean": total(F.col("vowel")) / n})
    spread = F.greatest(F.col("mean") * (1 - F.col("mean")), F.lit(0.02))
    t = t.withColumn("serial", total(neighbours("vowel", lambda a, b: (a - F.col("mean")) * (b - F.col("mean")))) / (n - 1) / spread)
    freedom = F.col("letters") - 1
    # Wilson and Hilferty: the cube root of chi-squared over its freedom is nearly normal
    z = (F.pow(F.greatest(F.col("chi2"), F.lit(0.0)) / freedom, F.lit(1 / 3)) - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom))
    alike = F.when(F.col("encoding") == "hex", 0.5).otherwise(       # words' letters are as uneven as hex digits
        _upper_tail((WORD_IC - F.col("ic")) / (WORD_IC_SPREAD * F.sqrt(F.lit(20.0) / n))))
    runs = _upper_tail((F.col("changes") - (n - 1) * WORD_CHANGES) / F.sqrt((n - 1) * (WORD_CHANGES * (1 - WORD_CHANGES))))
    serial = _upper_tail((F.col("serial") - WORD_VOWELS) * F.sqrt(n))
    half = -(F.log(alike) + F.log(runs) + F.log(serial))
    return t.withColumns({
        "uniform": _upper_tail(z),
        "p": F.least(F.lit(1.0), F.exp(-half) * (1 + half + half * half / 2))})


def _threshold(tested: DataFrame, rate: float) -> dict[int, float]:
    """Benjamini-Hochberg by length stratum: the largest p-value bin edge that the rule accepts."""
    counts = tested.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[int, float] = {}
    for s in {r["stratum"] for r in counts}:
        own = sorted(((r["bin"], r["n"]) for r in counts if r["stratum"] == s), reverse=True)
        m, below = sum(n for _, n in own), 0
        for b, n in own:                    # from the smallest p-values on; a bin's edge is its largest p-value
            below += n
            if 10 ** (-b / 10) * m <= rate * below:
                out[s] = float(b)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01,
                 uniform_level: float = 0.001) -> DataFrame:
    """One row per input row: id, spans (array of kind, start, end, value), base spans first by start."""
    hits = F.concat(_pieces(0, ASSIGN, 2), _pieces(1, ACCESS, 0), _pieces(2, HEX, 0), _pieces(3, TOKEN, 0))
    rows = materialize(docs.select(F.col(id_col), text_or_empty(text_col).alias("__text"))
                       .select(id_col, F.monotonically_increasing_id().alias("__row"), hits.alias("__hits")), "secret-hits")
    order = Window.partitionBy("__row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    spans = (rows.select("__row", F.inline("__hits")).withColumn("end", F.sum(F.col("before") + F.col("size")).over(order))
             .withColumn("start", F.col("end") - F.col("size"))
             .where((F.col("kind") > 0) | (F.length("value") >= MIN_VALUE)))
    spans = materialize(spans.select("__row", "kind", "start", "end", "value"), "secret-spans")
    base, tokens = spans.where("kind < 3"), spans.where("kind = 3")
    # tokens that overlap a base span are known already: the greatest end of base spans that began before, and the next start
    line = Window.partitionBy("__row").orderBy("start", "kind")
    free = (spans.withColumns({
        "reach": F.max(F.when(F.col("kind") < 3, F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1)),
        "next": F.min(F.when(F.col("kind") < 3, F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))})
        .where("kind = 3 AND (reach IS NULL OR reach <= start) AND (next IS NULL OR next >= end)"))
    stratum = sum((F.when(F.col("end") - F.col("start") >= n, 1).otherwise(0) for n in LENGTH_STRATA), F.lit(0))
    tested = materialize(battery(free.select("__row", "start", "end", "value", "kind")).select(
        "__row", "kind", "start", "end", "value", "uniform", stratum.alias("stratum"),
        F.floor(F.least(F.lit(300.0), -F.log10(F.greatest("p", F.lit(1e-300)))) * 10).cast("int").alias("bin")), "secret-tests")
    accept = F.lit(False)
    for s, least in _threshold(tested, rate).items():
        accept = accept | ((F.col("stratum") == s) & (F.col("bin") >= least))
    found = tested.where(accept & (F.col("uniform") >= uniform_level))
    per_row = (base.select("__row", "kind", "start", "end", "value").unionByName(
        found.select("__row", "kind", "start", "end", "value"))
        .groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "value"))).alias("spans")))
    return (rows.select(id_col, "__row").join(per_row, "__row", "left")
            .select(id_col, F.coalesce("spans", F.array().cast(
                "array<struct<start:bigint,kind:int,end:bigint,value:string>>")).alias("spans")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_joined(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"), count(3).alias("n_random"))


def op5_secret_scan(spark, sf_dir):
    return digest(find_secrets(documents(spark, sf_dir)))
