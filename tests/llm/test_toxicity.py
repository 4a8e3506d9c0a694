import zlib

import pytest

from tidemark.llm import toxicity as X

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in X.op9_toxicity(spark, DIR).collect()}


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    held = [(labels[i], r) for i, r in scored.items() if r.held_out and i in labels]
    assert sum(r.predicted == y for y, r in held) >= 0.95 * len(held)


def test_contract(spark, scored):
    ids = [r.doc_id for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id").collect()]
    assert sorted(scored) == sorted(ids)
    for i, r in scored.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_induced_voters(spark):
    """A prefix that only toxic rows have becomes a voter; a word of one copied text does not count as many."""
    rows = [(i, f"wort{i % 7} quark{i % 11}x haus{i % 13} baum{i % 5} und{i}", 1) for i in range(0, 400, 4)]
    rows += [(i, f"wort{i % 7} haus{i % 13} baum{i % 5} tisch{i % 3} und{i}", 0) for i in range(400) if i % 4]
    docs = spark.createDataFrame([(i, t.replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d")) for i, t, _ in rows],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    assert any(t.startswith(b"quar") for t in model.voters)
    assert model.score("haus quarkzz baum") > 0.5 > model.score("haus tisch baum")


def _coded(i):
    return "".join(chr(97 + int(c)) for c in str(i))


def test_all_significant_terms_vote(spark):
    """Rare toxic words vote however many there are, and whatever word follows them; words of one copied text do not."""
    rows = [(f"{_coded(i)}m {_coded(1000 + i // 8)}zq the end", 1) for i in range(2400)]
    rows += [("pqr copied stu text vwx again", 1)] * 30
    rows += [(f"{_coded(i)}m some words the end", 0) for i in range(8000)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    train = X.held_out("doc_id")
    kept = {r.doc_id for r in docs.where(~train).collect()}
    model = X.fit(docs, labels)
    want = {f"{_coded(1000 + g)}zq" for g in range(300) if sum(8 * g + x in kept for x in range(8)) >= 6}
    assert len(want) > 150
    assert all(model.fired(f"{w} the end")[0] for w in want)
    assert not model.fired("pqr copied stu text vwx again")[0]


def test_support_does_not_rise_with_the_rows(spark):
    """The same term counts at a larger size: still a voter."""
    for times in (1, 20):
        rows = [(f"{_coded(i)}n xyxyx {_coded(i * i)}p", 1) for i in range(6)]
        rows += [(f"{_coded(i)}m idiot", 1) for i in range(200 * times)] + [(f"{_coded(i)}m fine", 0) for i in range(1800 * times)]
        docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
        labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
        assert X.fit(docs, labels).fired("the xyxyx")[0]


def test_rare_voters_count_beyond_the_sample(spark):
    """A voter found on all rows raises scores, however small the classifier's sample is."""
    rows = [(f"{_coded(i)}m {_coded(1000 + i // 8)}zq the end", 1) for i in range(400)]
    rows += [(f"{_coded(i)}m some words the end", 0) for i in range(8000)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    model = X.fit(docs, labels, sample_rows=100)
    voters = [w for w in (f"{_coded(1000 + g)}zq" for g in range(50)) if model.fired(w)[0]]
    assert len(voters) > 40
    assert all(model.score(f"{w} the end") > 0.5 > model.score("some words the end") for w in voters)


def test_unlabelled_lexicon_words_prove_nothing(spark):
    """A lexicon word that no labelled row shows scores as if it were not there, unless it stands beside known voters."""
    rows = [(f"{_coded(i)}m you idiot", 1) for i in range(300)] + [(f"{_coded(i)}m some words", 0) for i in range(3000)]
    rows += [(f"{_coded(i)}m the failure of the pump", None) for i in range(200)]
    rows += [(f"{_coded(i)}m idiot and moron", None) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    plain = model.score("some words")
    assert model.score("a failure of the pump") < 2 * plain + 0.01
    assert model.score("take out the trash") < 2 * plain + 0.01        # no row at all has it
    assert model.score("what a moron") > model.score("a failure of the pump")
    assert model.score("hey you idiot") > 0.5


def test_rare_toxicity_still_has_voters(spark):
    """At 0.5 % toxic rows, a term with far more than that share votes although most of its rows are clean."""
    rows = [(f"{_coded(i)}m qwxz here", 1) for i in range(40)] + [(f"{_coded(i)}n qwxz here", 0) for i in range(50)]
    rows += [(f"{_coded(i)}p some words", 0) for i in range(8000)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    assert X.fit(docs, labels).fired("the qwxz")[0]


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (2, None), (6, 1), (6, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        model = X.fit(odd, some)
        got = X.score(odd, model).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        assert all(r.held_out for r in got if r.doc_id is None)
        assert X.drop_toxic(odd, model).columns == odd.columns
    assert X.score(empty, X.fit(empty, labels)).count() == 0


def test_model_uses_the_text_alone():
    model = X.Model({b"idiot": 0, b"abcd*": 1}, (4.0, 2.0, 0.0, 0.0), -3.0)
    assert model.score("You IDIOT!") > 0.5 > model.score("") == model.score("nice")
    assert model.fired("abcdef idiot idiot x") == ([0, 1], 3, 4)
