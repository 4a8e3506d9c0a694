import itertools
import random

import numpy as np

from tidemark.llm import ngram_join as X
from tidemark.llm.components import components


def shingles(text):
    ws = (text or "").encode().lower().split()
    return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [d]
        out.append((d, len(sets[i]), min(ids) if ids and ids[0] is not None else None))
    return sorted(out, key=repr)


def check(df):
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert sorted((tuple(r) for r in X.near_copies(df).collect()), key=repr) == want
    return want


def near(words, edits):
    out = list(words)
    for _ in range(edits):
        out[random.randrange(len(out))] = f"e{random.random()}"
    return " ".join(out)


def texts():
    random.seed(4)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = random.choices(vocabulary, k=60)
    out = [" ".join(random.choices(vocabulary, k=random.randint(1, 12))) for _ in range(30)]
    for size in (6, 9, 20, 80, 250):
        base = random.choices(vocabulary, k=size)
        out += [near(base, random.choice([0, 1, 1, 2, 3, size // 40 + 1])) for _ in range(24)]
    out += [" ".join(random.choices(vocabulary, k=random.randint(5, 90)) + passage) for _ in range(30)]
    return out


def test_brute_force(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(5)
    want = check(df)
    assert 20 < len({c for _, _, c in want}) < 150
    # all shared shingles are of frequent classes: only 2-combinations are indexed
    monkeypatch.setattr(X, "_RARE_BELOW", 0)
    every = [X.shingle_set(t) for t in texts()]
    count = {}
    for s in every:
        for t in s.tolist():
            count[t] = count.get(t, 0) + 1
    sigs = []
    for s in every:
        kinds = np.array([-1 if count[t] == 1 else int(4 * np.log2(count[t])) for t in s.tolist()])
        sigs.append(set(X.signatures(s, kinds).tolist()) if len(s) >= 4 else set())
    for i, j in itertools.combinations(range(len(every)), 2):
        a, b = set(every[i].tolist()), set(every[j].tolist())
        if a != b and a and b and 100 * len(a & b) >= 80 * len(a | b):
            assert sigs[i] & sigs[j]


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for n in (5, 100, 3000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[n // 10:], rng.integers(0, 1 << 63, n // 20).astype(np.uint64)])
        apart = sum(int(x).bit_count() for x in (X.parity(a) ^ X.parity(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_odd_rows(spark, odd, empty):
    rows = check(odd)
    assert (3, 0, 3) in rows and (4, 0, 4) in rows
    assert X.near_copies(empty).count() == 0
    kept = X.drop_near_copies(odd)
    assert kept.columns == odd.columns and X.drop_near_copies(empty).count() == 0
    left = [r.text for r in kept.collect()]
    with_words = [" ".join(t.split()) for t in left if t and t.split()]
    assert len(with_words) == len(set(with_words))


def test_one_of_each_group_stays(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    want = sorted({c for _, _, c in check(df)})
    assert sorted(r.doc_id for r in X.drop_near_copies(df).collect()) == want


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.v: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[v] == find(v) for v in got) and {v for a, b in edges if a != b for v in (a, b)} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
