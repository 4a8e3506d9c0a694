"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

* Voters.  Lexicon voters fire on a word of a fixed insult list.  Pattern voters fire on a word or
  word prefix induced from the labelled training rows: every one that stands in several
  different toxic texts (so that a group of copies counts once), far more often than in clean rows measured against
  the share of toxic rows, and more often than chance would have it, by tests that are the same at every size.
  Their number is not bounded.
* Label model.  Each row has a hidden label; voter j fires with a probability that depends on it and
  else abstains, silence of all voters is a voter of its own, and the given label, where there is
  one, is one more voter of known reliability.  EM over the vote patterns of *all* rows estimates
  priors and accuracies; the summed correlations of each voter with the others
  within the toxic class then discount voters that repeat one another.
* Classifier.  A logistic regression is trained on the posteriors of about ``sample_rows`` labelled
  training rows with votes (the documented bound), half of each class, and a few more of each rare voter,
  weighted by their inverse chance; rows without votes are counted.  A voter that the sample never shows keeps
  the label model's weight; a lexicon word that no labelled row shows keeps it shrunk towards 0 and is no hit.
  It scores every row from its text alone.

All corpus counts (term counts, vote patterns, correlations) cover all rows and are Spark
aggregates; the driver and the workers hold per-voter numbers, and the driver the training sample.

Defined results: null and empty texts get the score of a row without hits; rows with a null id are
never learned from; several labels of one id count as toxic if any is; null labels are ignored;
without any labelled training row the lexicon alone decides; an empty table gives no rows; ids,
language, source and labels are no inputs of a score.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import documents, each, materialize, ship, text_or_empty

# Words of insult and contempt, the lexicon voters.
INSULTS = (
    "arsehole", "asshole", "bastard", "bitch", "bollocks", "clown", "coward", "crap", "creep", "cretin",
    "cunt", "degenerate", "despicable", "dickhead", "dimwit", "disgrace", "disgusting", "dumb", "dumbass",
    "dunce", "failure", "fool", "freak", "fuck", "fucking", "garbage", "halfwit", "hideous", "idiot", "idiotic",
    "ignorant", "imbecile", "jackass", "jerk", "liar", "loser", "lowlife", "lunatic", "maggot", "moron",
    "moronic", "motherfucker", "nitwit", "parasite", "pathetic", "pervert", "pig", "prick", "psycho", "rat",
    "retard", "rubbish", "scum", "scumbag", "shit", "shithead", "shitty", "sicko", "simpleton", "slut", "stupid",
    "subhuman", "swine", "thug", "trash", "twat", "ugly", "vermin", "vile", "wanker", "whore", "worthless",
)
PREFIX_BYTES = (4, 5, 6)
# ASCII bytes that are no letters become spaces; letters are lower-cased; other bytes stay.
_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_FOLD).split()


def terms(ws: set[bytes]) -> set[bytes]:
    """The words and their prefixes (marked by a trailing ``*``) that may become pattern voters."""
    out = {w for w in ws if len(w) >= 3}
    for k in PREFIX_BYTES:
        out.update([w[:k] + b"*" for w in ws if len(w) > k])
    return out


@dataclass(frozen=True)
class Model:
    """Voters (term -> index) and the classifier's weights; small and picklable."""
    voters: dict[bytes, int]
    weights: tuple[float, ...]      # one per voter, then log hits, hit density
    bias: float
    accuracies: tuple[float, ...] = ()
    unseen: frozenset[int] = frozenset()        # voters that no labelled row shows; their words are no hits

    def fired(self, text: str) -> tuple[list[int], int, int]:
        """(sorted distinct voters that fire, words with a hit, words)."""
        ws, get = words(text), self.voters.get
        hit: dict[bytes, list[int]] = {}
        for w in set(ws):
            own = [i for i in [get(w), *[get(w[:k] + b"*") for k in PREFIX_BYTES if len(w) > k]]
                   if i is not None]
            if own:
                hit[w] = own
        if not hit:
            return [], 0, len(ws)
        known = {w for w, v in hit.items() if not self.unseen.issuperset(v)} if self.unseen else hit
        return sorted({i for v in hit.values() for i in v}), sum(map(known.__contains__, ws)), len(ws)

    def score(self, text: str) -> float:
        on, hits, n = self.fired(text)
        z = self.bias + sum(self.weights[i] for i in on) + sum(
            a * b for a, b in zip(self.weights[-2:], _numbers(hits, n), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _numbers(hits: int, n: int) -> tuple[float, float]:
    return math.log1p(hits), math.sqrt(hits / n) if n else 0.0


def held_out(id_col: str) -> Column:
    """Rows that are never learned from: crc32(id as text) mod 5 = 0, and rows without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _labels(labels: DataFrame, id_col: str, broadcast_rows: int) -> DataFrame:
    """(__id, __toxic) of the training ids; a broadcast only while the row count is small."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("__id"))
             .agg((F.max("toxic") > 0).cast("int").alias("__toxic")))
    known = materialize(known, "toxic-labels")
    return F.broadcast(known) if known.count() <= broadcast_rows else known


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found: dict[bytes, list[int]] = {}
        for text, toxic in zip(each(b.column(0)), each(b.column(1)), strict=True):
            for t in terms(set(words(text))):
                found.setdefault(t, [0, 0])[0 if toxic else 1] += 1
        if found:
            n = list(found.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), *[pa.array([x[k] for x in n], pa.int64()) for k in range(2)]],
                names=["term", "n_toxic", "n_clean"])


def _texts(index: dict[bytes, int]):
    """(term, digest of the row's words) of the rows, for the terms of ``index``; each once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: set[tuple[int, bytes]] = set()
            for text in each(b.column(0)):
                ws = words(text)
                own = [j for j in map(index.get, terms(set(ws))) if j is not None]
                if own:
                    digest = hashlib.blake2b(b" ".join(ws), digest_size=12).digest()
                    found.update((j, digest) for j in own)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()),
                                              pa.array([x[1] for x in found], pa.binary())], names=["j", "text"])
    return run


LIFT = 50.0         # least odds of a voter's rows against the odds of all rows, or 4 to 1 where toxic rows are common
SIGNIFICANT = 15.0  # least log-likelihood ratio statistic of a voter (chance below 1 in 9,000), at every size


def _significance(toxic: Column, clean: Column, rate: float) -> Column:
    """G statistic of a term's toxic and clean rows against the toxic share of all rows."""
    n = toxic + clean
    return 2 * (toxic * F.log(toxic / (n * rate))
                + F.when(clean > 0, clean * F.log(clean / (n * (1 - rate)))).otherwise(0.0))


def _induce(train: DataFrame) -> tuple[list[tuple[bytes, int, int]], int, int]:
    """All significant terms (term, different toxic texts, clean rows), best first; numbers of toxic and clean rows."""
    size = train.agg(F.coalesce(F.sum("__toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_clean = int(size["t"]), int(size["n"]) - int(size["t"])
    if not n_toxic or not n_clean:
        return [], n_toxic, n_clean
    rate = n_toxic / (n_toxic + n_clean)
    odds = min(4.0, LIFT * n_toxic / n_clean)

    def passing(t: DataFrame, toxic: str) -> DataFrame:
        return t.where((F.col(toxic) >= 3) & (F.col(toxic) >= odds * (F.col("n_clean") + 0.25))
                       & (_significance(F.col(toxic), F.col("n_clean"), rate) >= SIGNIFICANT))

    counts = (train.select("__text", "__toxic")
              .mapInArrow(_term_counts, "term binary, n_toxic long, n_clean long")
              .groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean")))
    # rows bound different texts from above, so only terms that pass by rows are counted by texts
    found = passing(counts, "n_toxic").select("term", "n_clean").toArrow()
    names, clean = found["term"].to_pylist(), found["n_clean"].to_pylist()
    texts = (train.where("__toxic = 1").select("__text")
             .mapInArrow(_texts({t: i for i, t in enumerate(names)}), "j int, text binary")
             .distinct().groupBy("j").agg(F.count(F.lit(1)).alias("texts")).toArrow())
    table = train.sparkSession.createDataFrame(pa.table({
        "j": texts["j"], "texts": texts["texts"],
        "n_clean": pa.array([clean[j] for j in texts["j"].to_pylist()], pa.int64())}))
    best = [(names[r["j"]], r["texts"], r["n_clean"]) for r in passing(table, "texts").collect()]
    best.sort(key=lambda r: (-r[1] / (1 + r[2]), len(r[0]), r[0]))
    return best, n_toxic, n_clean


def _choose(best: list[tuple[bytes, int, int]], max_voters: int | None) -> dict[bytes, int]:
    """Lexicon words first, then induced terms that no chosen shorter prefix, or no chosen words of theirs, cover."""
    chosen: dict[bytes, int] = {w.encode(): i for i, w in enumerate(INSULTS)}
    held: dict[bytes, int] = {}                     # toxic texts of the chosen words by prefix

    def add(t: bytes, toxic: int) -> None:
        for k in PREFIX_BYTES:
            if len(t) > k and not t.endswith(b"*"):
                held[t[:k]] = held.get(t[:k], 0) + toxic

    for t, toxic, _ in best:
        if t in chosen:
            add(t, toxic)
    for t, toxic, _ in best:
        stem = t.rstrip(b"*")
        covered = (any(stem[:k] + b"*" in chosen for k in PREFIX_BYTES if len(stem) > k)
                   or t.endswith(b"*") and held.get(stem, 0) >= toxic)
        if (max_voters is None or len(chosen) < max_voters) and t not in chosen and not covered:
            chosen[t] = len(chosen)
            add(t, toxic)
    return chosen


def _votes(voters: dict[bytes, int]):
    model = Model(voters, (), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [model.fired(t) for t in each(b.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64()), b.column(1)], names=["fired", "hits", "n", "toxic"])
    return run


RELIABILITY = 0.97  # of a given label, as one more voter


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every entry of a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy(zero_copy_only=False)


def _posterior(rows: np.ndarray, voters: np.ndarray, toxic: np.ndarray, steps: np.ndarray, base: float) -> np.ndarray:
    label = math.log(RELIABILITY / (1 - RELIABILITY))
    z = (base + np.bincount(rows, steps[voters], minlength=len(toxic))
         + np.where(toxic == 1, label, np.where(toxic == 0, -label, 0.0)))
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _voter_sums(patterns: DataFrame, steps: np.ndarray, base: float, scale: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over all rows by voter and, as the last entry, over the rows themselves.

    p: posterior, n: rows, t and c: labelled toxic and clean rows, s: posterior times the row's sum of ``scale``.
    """
    k, fields = len(steps), "pntcs"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, voters = _flat(b.column(0))
            toxic = b.column(1).cast(pa.float64()).to_numpy(zero_copy_only=False)
            n = b.column(2).to_numpy(zero_copy_only=False).astype(float)
            p = n * _posterior(rows, voters, toxic, steps, base)
            own = [p, n, n * (toxic == 1), n * (toxic == 0), p * np.bincount(rows, scale[voters], minlength=len(n))]
            at, place = np.unique(voters, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, k).astype(np.int32)),
                 *[pa.array(np.append(np.bincount(place, x[rows], minlength=len(at)), x.sum())) for x in own]],
                names=["j", *fields])

    found = (patterns.mapInArrow(run, "j int, " + ", ".join(f"{f} double" for f in fields))
             .groupBy("j").agg(*[F.sum(f).alias(f) for f in fields]).toArrow())
    out = {f: np.zeros(k + 1) for f in fields}
    at = found["j"].to_numpy()
    for f in fields:
        out[f][at] = found[f].to_numpy()
    return out


def _label_model(votes: DataFrame, k: int, n_toxic: int, n_clean: int, rounds: int) -> dict:
    """EM over the vote patterns of all rows; returns per-voter log-likelihood ratios and accuracies."""
    # voter k: no other voter fires
    patterns = materialize(
        votes.withColumn("fired", F.when(F.size("fired") == 0, F.array(F.lit(k))).otherwise(F.col("fired")))
        .groupBy("fired", "toxic").agg(F.count(F.lit(1)).alias("n")), "toxic-patterns")
    none = np.zeros(k + 1)
    first = _voter_sums(patterns, none, 0.0, none)
    total, count1, count0 = first["n"][-1], first["t"][:-1], first["c"][:-1]
    prior = (n_toxic + 1) / (n_toxic + n_clean + 10)
    # a voter that no labelled row shows starts without a leaning; what it is worth follows from the voters beside it
    lean = np.where(count1 + count0 > 0, 0.5, 0.05 * (n_toxic + 10) / (n_clean + 10))
    on1, on0 = (count1 + lean) / (n_toxic + 10), (count0 + 0.05) / (n_clean + 10)
    for _ in range(rounds if total else 0):
        sums = _voter_sums(patterns, np.log(on1 / on0), math.log(prior / (1 - prior)), none)
        t, p, n = sums["p"][-1], sums["p"][:-1], sums["n"][:-1]
        prior = (t + 1) / (total + 10)
        # the labelled counts stay in as a prior
        on1 = np.clip((p + count1 + lean) / (t + n_toxic + 10), 1e-7, 0.999)
        on0 = np.clip((n - p + count0 + 0.05) / (total - t + n_clean + 10), 1e-8, 0.999)
    # a voter's summed correlation with all others within the toxic class: its covariance with the sum of all
    # voters in units of their deviation, so that no pairs need to be formed; silence is left out
    scale = 1 / np.sqrt(on1 * (1 - on1))
    scale[k] = 0.0
    sums = _voter_sums(patterns, np.log(on1 / on0), math.log(prior / (1 - prior)), scale)
    t = max(1.0, sums["p"][-1])
    mean = sums["p"][:-1] / t
    repeat = (sums["s"][:-1] / t - mean * (mean * scale).sum()) * scale - mean * (1 - mean) * scale ** 2
    steps = np.log(on1 / on0) / (1 + np.maximum(0.0, repeat))
    accuracy = prior * on1 / (prior * on1 + (1 - prior) * on0)
    return {"steps": steps, "base": math.log(prior / (1 - prior)), "accuracy": accuracy[:k],
            "labelled": count1[:k] + count0[:k], "rows": first["n"][:k],
            "firing": (first["c"][-1] - count0[k], first["t"][-1] - count1[k])}


def _logistic(rows: np.ndarray, cols: np.ndarray, numbers: np.ndarray, y: np.ndarray, weight: np.ndarray,
              start: np.ndarray, ridge: float = 1.0, steps: int = 25) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on weighted soft labels by Newton's method with conjugate gradients.

    Row ``rows[i]`` has voter ``cols[i]``; the ridge draws the voters' weights to ``start``.  Only the hits are
    held, so memory grows with them and with the voters.
    """
    k, m = len(start), numbers.shape[1]
    at = np.concatenate([start, np.zeros(m + 1)])
    keep = np.full(k + m + 1, ridge)
    keep[-1] = 1e-3

    def forth(v: np.ndarray) -> np.ndarray:
        return np.bincount(rows, v[cols], minlength=len(y)) + numbers @ v[k:k + m] + v[-1]

    def back(u: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(cols, u[rows], minlength=k), u @ x, [u.sum()]])

    w = at.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(forth(w), -40, 40)))
        d = weight * (p * (1 - p) + 1e-9)
        diagonal = back(d, numbers ** 2) + keep
        r = back(weight * (y - p), numbers) - keep * (w - at)
        move, z = np.zeros_like(w), r / diagonal
        q, rz, least = z, r @ z, 1e-16 * max(1e-300, r @ (r / diagonal))
        for _ in range(300):
            h = back(d * forth(q), numbers) + keep * q
            a = rz / max(1e-300, q @ h)
            move, r = move + a * q, r - a * h
            z = r / diagonal
            rz, old = r @ z, rz
            if rz <= least:
                break
            q = z + rz / old * q
        move *= min(1.0, 4 / (1e-9 + np.abs(move).max()))
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


PER_VOTER = 8  # labelled rows that the sample expects of a voter, if it has as many


def _sample(votes: DataFrame, labelled: np.ndarray, firing: tuple[float, float], sample_rows: int) -> pa.Table:
    """(fired, hits, n, toxic, weight) of a sample of the labelled rows; equal rows once, with their weight.

    A row in which a voter fires is drawn with the larger of its class's and its voters' shares, and weighs the
    inverse, so a rare class and a rare voter are shown.  Rows in which none fires are all alike and all counted.
    """
    clean, toxic = max(1.0, firing[0]), max(1.0, firing[1])
    half = sample_rows / 2
    share = np.array([min(1.0, max(half, sample_rows - toxic) / clean), min(1.0, max(half, sample_rows - clean) / toxic)])
    own = np.minimum(1.0, PER_VOTER / np.maximum(1.0, labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, voters = _flat(b.column(0))
            q = share[b.column(3).to_numpy(zero_copy_only=False).astype(int)]
            np.maximum.at(q, rows, own[voters])
            q[np.bincount(rows, minlength=len(q)) == 0] = 1.0
            kept = pa.array(b.column(4).to_numpy(zero_copy_only=False) < q)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(1 / q)],
                                             names=["fired", "hits", "n", "toxic", "weight"]).filter(kept)

    return (votes.where("toxic IS NOT NULL")
            .select("fired", "hits", F.when(F.col("hits") > 0, F.col("n")).otherwise(0).alias("n"), "toxic",
                    F.rand(7).alias("u"))
            .mapInArrow(run, "fired array<int>, hits long, n long, toxic int, weight double")
            .groupBy("fired", "hits", "n", "toxic").agg(F.sum("weight").alias("weight")).toArrow())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_voters: int | None = None,
        rounds: int = 4, sample_rows: int = 40_000, broadcast_rows: int = 2_000_000) -> Model:
    """Learn from ``labels`` (id, toxic); ``sample_rows`` bounds the classifier's training rows (and 8 a voter).

    All significant terms are voters; ``max_voters`` may bound them.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    known = _labels(labels, id_col, broadcast_rows)
    best, n_toxic, n_clean = _induce(rows.join(known, "__id"))
    voters = _choose(best, max_voters)
    k = len(voters)
    votes = materialize(rows.join(known, "__id", "left").select("__text", "__toxic")
                        .mapInArrow(_votes(voters), "fired array<int>, hits long, n long, toxic int"),
                        "toxic-votes")
    found = _label_model(votes, k, n_toxic, n_clean, rounds)
    if n_toxic + n_clean < 20 or not 0 < n_toxic < n_toxic + n_clean:
        return Model(voters, tuple([3.0] * k + [0.0, 0.0]), -2.0, tuple(found["accuracy"]))
    sample = _sample(votes, found["labelled"], found["firing"], sample_rows)
    fired = sample["fired"].combine_chunks()
    at, cols = _flat(fired)
    silent = np.flatnonzero(fired.value_lengths().to_numpy() == 0)
    hits, n = sample["hits"].to_numpy().astype(float), sample["n"].to_numpy()
    numbers = np.stack([np.log1p(hits), np.sqrt(hits / np.maximum(n, 1))], axis=1)
    y = _posterior(np.append(at, silent), np.append(cols, np.full(len(silent), k)), sample["toxic"].to_numpy(),
                   found["steps"], found["base"])
    # a voter that the sample never shows keeps the label model's weight
    shown = np.bincount(cols, minlength=k) > 0
    w, b = _logistic(at, cols, numbers, y, sample["weight"].to_numpy(), np.where(shown, 0.0, found["steps"][:k]))
    # a lexicon word that the labelled rows never show has the label model's estimate, shrunk to 0 where few rows show it
    unseen = np.flatnonzero(found["labelled"] == 0)
    w[unseen] = found["steps"][unseen] * found["rows"][unseen] / (found["rows"][unseen] + PER_VOTER)
    return Model(voters, tuple(float(v) for v in w), b, tuple(found["accuracy"]), frozenset(unseen.tolist()))


def score_column(model: Model, text: Column) -> Column:
    @F.arrow_udf("double")
    def toxicity_score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in each(texts)], pa.float64())
    return toxicity_score(text)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array([model.score(t) for t in each(b.column(2))], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), scores], names=[id_col, "held_out", "score"])

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), text_or_empty(text_col).alias("__text"))
    schema = T.StructType([docs.schema[id_col], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with exactly the input's columns."""
    return docs.where(score_column(model, text_or_empty(text_col)) < threshold)


def op9_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, documents(spark, sf_dir, "labels")))
