import hashlib
import re

from tidemark.llm import exact_dedup as X


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_brute_force(docs, odd):
    for df in (docs, odd):
        for settings in ({}, {"min_copies": 2, "top_k": 2}):        # with and without a heavy-hitter path
            got = X.exact_dedup(df, **settings).collect()
            want = expected([(r.doc_id, r.text) for r in df.collect()])
            assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == want
            by = {}
            for r in got:
                by.setdefault(r.text_sha256, []).append(r)
            assert all(sum(r.kept for r in g) == 1 for g in by.values())        # ties: exactly one stays
            assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies(odd):
    got = X.drop_copies(odd)
    assert got.columns == odd.columns
    texts = [re.sub("[\x20\x09-\x0D]+", " ", r.text or "") for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub("[\x20\x09-\x0D]+", " ", r.text or "") for r in odd.collect()})


def test_empty(empty):
    assert X.exact_dedup(empty).count() == 0 and X.drop_copies(empty).count() == 0


def test_heavy_group_is_broadcast(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', cast(id AS string)) AS text")
    got = X.exact_dedup(df)
    assert got.where("text_sha256 = sha2('hot', 256) AND keep_id = 0 AND group_size = 1000").count() == 1000
    assert got.where("kept").count() == 2001


def test_main_path_is_native(docs):
    plan = X.exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_meet_in_no_window(docs):
    assert "Window" not in X.exact_dedup(docs)._jdf.queryExecution().toString()
