import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality as X

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    n1 = y.sum()
    return (order[y > 0].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = X.fit(docs, labels)
    return X.score(docs, model).join(labels, "doc_id").toPandas(), model


def test_held_out_accuracy(scored):
    rows = scored[0]
    rows = rows[rows.held_out]
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.985
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert rows[rows.quality == 1].predicted.mean() > 0.97          # clean rows stay
    assert set(rows.predicted[rows.score >= 0.5]) <= {1}


def test_labels_and_other_columns_are_no_inputs(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    a = {r.doc_id: r.score for r in X.score(docs, scored[1]).collect()}
    moved = docs.withColumns({"lang": F.lit("q"), "source": F.lit("q"), "score": F.lit(3), "n_chars": F.lit(-1)})
    b = {r.doc_id: r.score for r in X.score(moved, scored[1]).collect()}
    assert a == b


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(60)]
    ratio = rng.normal(size=12)
    scale = np.array([1 / np.sqrt((ratio[a] ** 2).sum()) for a in rows])
    x = np.zeros((60, 13))
    for i, a in enumerate(rows):
        x[i, a] = ratio[a] * scale[i]
    x[:, 12] = 1
    y = np.where(x[:, :12].sum(axis=1) + rng.normal(size=60) * 0.3 > 0, 1.0, -1.0)
    u, bias = X.dual_coordinate_descent(rows, scale, ratio ** 2, y, 1.0, 3000, 1e-6)
    w = np.append(u / ratio, bias)

    def primal(w):
        return (w ** 2).sum() / 2 + np.maximum(0, 1 - y * (x @ w)).sum()

    best = primal(w)
    for _ in range(400):
        assert primal(w + rng.normal(size=13) * rng.choice([1e-3, 1e-2, 0.1])) >= best - 1e-4


def test_places_are_the_texts_ngrams():
    both = set(X.places("qz vx")) & set(X.places("12 qz vx"))
    assert len(both) == 3 + 3 + 1                                       # triples, two words and their pair, the count
    assert list(X.places("A b\tc")) != list(X.places("a b c"))          # bytes keep their case
    assert len(X.places("")) == 1
    assert len(X.places("a" * 100_000)) == 3                            # count, one triple, one word
    long = X.places("word " * 50_000)
    assert (np.diff(long) > 0).all()


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 0), (5, 1, 0), (5, 0, 1), (6, 1, 0), (9, 0, 0), (11, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = X.fit(odd, labels)
    got = X.score(odd, model).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r.doc_id is None, r.doc_id or 0) for r in odd.collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1         # null and empty texts alike
    assert X.score(empty, X.fit(empty, labels)).count() == 0
    only = X.score(odd, X.fit(odd, labels.where("quality = 1"))).collect()
    assert {r.predicted for r in only} == {1}
    none = X.score(odd, X.fit(odd, labels.where("quality = 0"))).collect()
    assert {r.predicted for r in none} == {0}
