import pickle
import random

import pytest

from tidemark.llm import decontam as X

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{DIR}/benchmark.parquet")


def test_planted_items(spark, docs, items):
    texts, wanted = {r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in items.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in wanted.items() if x in t}
    got = X.find_leaks(docs, items).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert exact <= found
    for d, i in found - exact:      # others hold nearly all of the item's shingles
        s, ws = X.shingles(X.words(wanted[i])), X.shingles(X.words(texts[d]))
        assert len(s & ws) >= 0.8 * len(s)


def test_wand_equals_brute_force():
    random.seed(2)
    vocabulary = [f"w{i}" for i in range(200)]
    text = lambda n: " ".join(random.choices(vocabulary, weights=[1 / (i + 1) for i in range(200)], k=n))
    index = X.Index([(i, text(random.randint(3, 150))) for i in range(300)], 0.3, 0.8, 0.5)
    for _ in range(60):
        terms = sorted({int.from_bytes(index.terms[w], "little") for w in X.words(text(40)) if w in index.terms})
        score = {}
        for t in terms:
            for c, x in zip(index.chunk[t], index.impact[t], strict=True):
                score[int(c)] = score.get(int(c), 0.0) + x
        want = {c: s for c, s in score.items() if s >= 0.3 - 1e-9}
        got = dict(index.search(terms))
        assert got.keys() == want.keys() and all(abs(got[c] - s) < 1e-9 for c, s in want.items())
        assert not want or index.may_reach(__import__("numpy").array(terms))


@pytest.mark.parametrize("where", [0, 1, 63, 64, 100, 127, 400])
@pytest.mark.parametrize("size", [1, 4, 5, 40, 64, 65, 200])
def test_any_place_and_size(where, size):
    random.seed(size)
    filler = [f"f{random.random()}".replace(".", "") for _ in range(600)]
    item = [f"item{size}word{k}" for k in range(size)]
    index = X.Index([(7, " ".join(item)), (8, "something else entirely here now")], 0.6, 0.8, 0.5)
    text = " ".join(filler[:where] + item + filler[where:])
    assert [x[0] for x in index.leaks(text.upper())] == [7]
    assert index.leaks(" ".join(filler)) == []
    if size >= 40:      # half an item is no leak
        assert index.leaks(" ".join(filler[:where] + item[:size // 2] + filler[where:])) == []


@pytest.mark.parametrize("at_once", [1, 1000, 1 << 20])
def test_texts_are_tested_together(monkeypatch, at_once):
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(400)]
    some = lambda n: random.choices(vocabulary, weights=[1 / (i + 1) for i in range(400)], k=n)
    items = [(i, " ".join(some(random.randint(3, 160)))) for i in range(120)]
    index = X.Index(items, 0.6, 0.8, 0.5)
    texts = ["", " "] + [" ".join([*some(random.randint(0, 300)), random.choice(items)[1], *some(random.randint(0, 90))])
                         for _ in range(150)] + ["unknown " * 500, ""]
    monkeypatch.setattr(X, "AT_ONCE", at_once)
    calls, reaching = [], index.reaching
    monkeypatch.setattr(index, "reaching", lambda *a: calls.append(a[2]) or reaching(*a))
    together = list(index.leaks_of(texts))
    if at_once > 1000:
        assert len(calls) <= 2 and sum(calls) >= 150
    # one by one, and with each passage searched whatever the tests say
    assert together == [index.leaks(t) for t in texts]
    held = [X.words(t) for t in texts]
    for t, ws in enumerate(held):
        reached = {k: terms for _, k, terms in index.hopeful([ws])}
        for k in range(max(1, -(-len(ws) // X.CHUNK) - 1)):
            terms = sorted({int.from_bytes(index.terms[w], "little")
                            for w in ws[k * X.CHUNK:(k + 2) * X.CHUNK] if w in index.terms})
            assert reached.get(k, terms) == terms and (k in reached or not terms or not index.search(terms)), (t, k)
    assert list(index.leaks_of([])) == [] and list(X.Index([], 0.6, 0.8, 0.5).leaks_of(texts[:3])) == [[]] * 3


def test_blocks_and_odd_rows(spark, docs, items, odd, empty):
    key = lambda df: sorted((r.doc_id, r.item_id) for r in df.collect())
    assert key(X.find_leaks(docs, items)) == key(X.find_leaks(docs, items, block_bytes=1500))
    strange = spark.createDataFrame([(1, None), (2, ""), (None, "same text here and there"), (3, "x"), (3, "x")],
                                    "item_id long, text string")
    got = X.find_leaks(odd, strange).collect()
    assert sum(r.item_id is None for r in got) == 4 and sum(r.item_id == 3 for r in got) == 1
    kept = X.drop_leaks(odd, strange)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 5
    assert X.find_leaks(empty, items).count() == 0 and X.drop_leaks(empty, items).count() == 0
    assert X.find_leaks(odd, items.limit(0)).count() == 0 and X.drop_leaks(odd, items.limit(0)).count() == odd.count()


def test_indexes_are_built_in_blocks(spark):
    n = 20_000
    items = spark.range(n).selectExpr("id AS item_id", "concat('item ', id, ' asks for number ', id * 7, ' here') AS text")
    items = items.unionByName(items.limit(50))              # repeated items are indexed once
    stored, blocks = X.item_indexes(items, "item_id", "text", 100_000, 0.6, 0.8, 0.5)
    rows = stored.collect()
    assert 5 < blocks == len({r.block for r in rows})
    found = [i for b in range(blocks) for i, *_ in pickle.loads(X._loaded(stored, b).value).items]
    assert sorted(found) == list(range(n))
    docs = spark.createDataFrame([(1, "so ITEM 777 asks for number 5439 here we go"), (2, "nothing of that kind")],
                                 "doc_id long, text string")
    found = X.find_leaks(docs, items, block_bytes=200_000).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 777)}
    assert [r.doc_id for r in X.drop_leaks(docs, items, block_bytes=200_000).collect()] == [2]
