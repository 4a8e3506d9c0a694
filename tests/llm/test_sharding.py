import zlib

from pyspark.sql import functions as F

from tidemark.llm import sharding as X


def check(df, shards=8, **settings):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = X.shard_rows(df, shards, **settings).collect()
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(rows, key=repr)
    assert sorted(r["__size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in rows)
    by = {}
    for r in got:
        by.setdefault(r["__shard"], []).append(r)
    for g in by.values():
        assert sorted(r["__slot"] for r in g) == list(range(len(g)))
    return [sum(r["__size"] for r in by.get(s, [])) for s in range(shards)]


def test_near_equal_bytes(docs):
    sizes = check(docs)
    largest = docs.agg(F.max(F.octet_length("text"))).first()[0]
    assert max(sizes) - min(sizes) <= 2 * largest


def test_hot_text_is_split(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'hot text', concat('t', id)) AS text")
    sizes = check(df)
    assert max(sizes) - min(sizes) <= 0.03 * sum(sizes) / 8


def test_odd_rows(odd, empty):
    check(odd)
    assert X.shard_rows(empty).count() == 0
    assert set(odd.columns) <= set(X.shard_rows(odd).columns)


def test_query(spark):
    got = X.op8_sharding(spark, "/root/testdata/sf0.001")
    assert "Python" not in got._jdf.queryExecution().toString()
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in got.collect():
        assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.size == len(text[r.doc_id].encode()) + 1
        assert r.law == "bytes" and r.grown_shard is None
