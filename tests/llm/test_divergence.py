import collections
import random
import re

import pytest

from tidemark.llm import divergence as X


def brute(rows, ranks=200, min_docs=3):
    """Rows (lang, source, text) -> the report, straight from its definition."""
    docs = [(lang or "", source or "", [t for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
             "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        in_docs = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in in_docs.items() if n >= min_docs)
        of = {s: collections.Counter() for s in {d[1] for d in own}}
        for d in own:
            of[d[1]].update(t for t in d[2] if in_docs[t] >= min_docs)
        whole = sum(of.values(), collections.Counter())
        v = len(kept)

        def share(counts, t, v=v):
            return 1 + 1_000_000_000 * (counts[t] + 1) // (sum(counts.values()) + v)

        for s, counts in of.items():
            pairs = [(-sum((share(counts, t) - share(o, t)) ** 2 // share(o, t) for t in kept), n.encode())
                     for n, o in of.items() if n != s]
            terms = [(-((share(counts, t) - share(whole, t)) ** 2 // share(whole, t)), t.encode()) for t in kept
                     if counts[t] and share(counts, t) > share(whole, t)]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, i.decode(), -value, r) for r, (value, i) in enumerate(items, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeéß漢Z", k=rng.randint(1, 4))) for _ in range(120)]
    out = []
    for _ in range(260):
        lang, source = rng.choice(["en", "en", "de", None]), f"s{min(rng.randrange(9), rng.randrange(9))}"
        out.append((lang, source, " ".join(rng.choices(words, k=rng.randint(0, 40)))))
    return [*out, ("xx", "a", "only here"), ("xx", "b", None), ("xx", None, ""), (None, None, None), ("yy", "a", "1 2 3"), *[("zz", "a", "dup Dup")] * 3]


@pytest.mark.parametrize("width", [256, 2])         # 2: sources in many blocks
def test_brute_force(spark, rows, width):
    df = spark.createDataFrame([(i % 7, *r, "q", 1) for i, r in enumerate(rows)],
                               "doc_id long, lang string, source string, text string, term string, n int").repartition(5)
    got = sorted(tuple(r) for r in X.divergence(df, width=width, ranks=10).collect())
    assert got == brute(rows, ranks=10)


def test_tasks_hand_on_and_split(spark, rows, monkeypatch):
    # in this process, as workers have their own copy
    import pyarrow as pa
    batch = pa.record_batch([pa.array([r[i] or "" for r in rows]) for i in range(3)], names=["lang", "source", "text"])
    def total():
        found = collections.Counter()
        for b in X._counts(iter([batch])):
            for r in b.to_pylist():
                found[r["lang"], r["source"], r["term"]] += 10 ** 6 * r["n"] + r["docs"]
        return found
    want = total()
    monkeypatch.setattr(X, "HELD", 5)
    assert total() == want
    entry = pa.struct([("g", pa.int64()), ("p", pa.int64()), ("p0", pa.int64())])
    rng = random.Random(3)
    lists = [[{"g": g, "p": rng.randint(5, 9), "p0": g + 1} for g in rng.sample(range(6), rng.randint(1, 6))] for _ in range(50)]
    lists = pa.record_batch([pa.array(lists, pa.list_(entry)), pa.array(lists, pa.list_(entry))], names=["left", "right"])
    def pairs():
        found = collections.Counter()
        for b in X._both(iter([lists])):
            for r in b.to_pylist():
                found[r["a"], r["b"]] += r["value"]
        return found
    whole = pairs()
    monkeypatch.setattr(X, "PAIRS", 7)
    assert pairs() == whole and len(whole) == 30


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F
    n, total, v = 10 ** 13 + 7, 10 ** 15 + 9, 10 ** 9 + 21
    got = spark.range(1).select(X.share(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first()["p"]
    assert got == 1 + 10 ** 9 * (n + 1) // (total + v)


def test_odd_rows(odd, empty):
    rows = [(r.lang, None, r.text) for r in odd.collect()]
    got = sorted(tuple(r) for r in X.divergence(odd, source_col="lang").collect())
    assert got == brute([(a, a, t) for a, _, t in rows])
    assert X.divergence(empty, source_col="lang").count() == 0
