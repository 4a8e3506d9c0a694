import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import repeats as X


def brute(texts):
    seen = collections.Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i:i + 400]] > 1:
                gone[i:i + 400] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    words = ["".join(random.choices("abcdefgh", k=random.randint(2, 7))) for _ in range(300)]
    passages = [" ".join(random.choices(words, k=90)) for _ in range(3)]
    base = random.choices(words, k=300)
    out = []
    for i in range(40):
        near = list(base)
        near[random.randrange(300)] = random.choice(words)
        out.append([" ".join(random.choices(words, k=random.randint(1, 200))), " ".join(near),
                    " ".join(random.choices(words, k=30)) + random.choice(passages) + " ".join(random.choices(words, k=9)),
                    "For " * random.randint(1, 200), out[i // 2] if out else "", "é" * random.randint(0, 300)][i % 6])
    return [*out, "", None, "x" * 900]


@pytest.mark.parametrize("hot", [2048, 2])          # 2: nearly all anchors are settled by counting
def test_brute_force(spark, texts, hot):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in X.remove_repeats(df, hot=hot).collect()}
    for i, want in enumerate(brute([(t or "").encode() for t in texts])):
        assert tuple(got[i])[1:5] == want
        assert hashlib.sha256(got[i].kept).hexdigest() == want[3]


def test_odd_rows(odd, empty):
    texts = [r.text or "" for r in odd.collect()]
    got = sorted(tuple(r)[1:] for r in X.remove_repeats(odd, with_kept=False).collect())
    assert got == sorted((*w, w[1] > 0) for w in brute([t.encode() for t in texts]))
    assert X.remove_repeats(empty).count() == 0


def test_segments(monkeypatch):
    data = np.frombuffer(bytes(random.Random(1).choices(b"abc", k=6000)), np.uint8)
    whole = X.stretches(data)
    monkeypatch.setattr(X, "SEGMENT", 1000)
    parts = X.stretches(data)
    # every window is in exactly one stretch, with the same anchor place, however the text is cut
    def windows(s):
        return {first + k: (int(a), first + off) for a, _, first, count, off in zip(*s, strict=True) for k in range(count)}
    assert windows(whole) == windows(parts) and len(windows(whole)) == 6000 - 399


def test_column_transform_counts_common_prefixes():
    left, core, right = b"l" * 336, b"c" * 64, b"r" * 336
    a, b = left + core + right, b"L" + left[1:] + core + right
    runs = X.repeated_windows([a, b, b"q" * 736], np.array([336, 336, 336]), np.array([0, 0, 1]))
    assert runs == [[(1, 337)], [(1, 337)], []]


def has_passage(texts):
    """Whether 51 words in a row are in another row too."""
    rows = collections.Counter()
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        sets.append({tuple(w[i:i + 51]) for i in range(len(w) - 50)})
        rows.update(sets[-1])
    return [int(any(rows[x] > 1 for x in s)) for s in sets]


@pytest.mark.parametrize("max_bits", [28, 11])      # 11: nearly every anchor passes the Bloom filter
def test_passages_of_over_50_words(spark, tmp_path, texts, monkeypatch, max_bits):
    random.seed(8)
    fresh = lambda n: " ".join("".join(random.choices("abcdefgh", k=random.randint(3, 6))) for _ in range(n))
    passage = {n: fresh(n) for n in (49, 50, 51, 60)}
    planted = [f"{fresh(70)} {passage[51]}. {fresh(40)}", f"{fresh(5)}, {passage[51].upper()} {fresh(90)}",
               f"{passage[60]}", f"{fresh(300)} ({passage[60]})"]
    clean = [f"{fresh(60)} {passage[n]} {fresh(60)}" for n in (49, 50) for _ in "ab"] + [fresh(100)] + [" ".join([fresh(80)] * 2)]
    rows = [*planted, *clean, *texts]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(X, "SLICE", 5000)
    query = X.remove_repeats(df, with_kept=False, with_passages=True, max_bits=11) if max_bits == 11 else X.op7_repeats(spark, tmp_path)
    got = {r.doc_id: r for r in query.collect()}
    want = has_passage([(t or "").encode() for t in rows])
    assert want[:10] == [1] * 4 + [0] * 6 and 0 < sum(want[10:]) < len(texts)
    assert [got[i].shared_passage for i in range(len(rows))] == want
    # the removal is by bytes, as before
    assert [tuple(got[i])[1:5] for i in range(len(rows))] == brute([(t or "").encode() for t in rows])
    assert got[0].n_removed == got[1].n_removed == 0
