import re

import corpus_pipeline as P
from tidemark.llm import decontam, ngram_join, toxicity
from tidemark.llm.common import materialize

DIR = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]


def test_each_stage_on_its_input(spark, docs):
    out, inputs = docs, {}
    for name, stage in P.STAGES:
        inputs[name] = out
        out = materialize(stage(spark, out, DIR), "test-stage")
        if name != "packing":
            assert out.columns == docs.columns
            assert out.exceptAll(inputs[name]).count() == 0        # rows are kept as they are
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in inputs.items()}
    text = {r.doc_id: r.text for r in docs.collect()}

    model = toxicity.fit(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert ids["exact_dedup"] == {i for i, t in text.items() if model.score(t) < 0.5}

    least = {}
    for i in sorted(ids["exact_dedup"]):
        least.setdefault(re.sub("[\x20\x09-\x0D]+", " ", text[i]), i)
    assert ids["ngram_join"] == set(least.values())

    kept = {r.component_id for r in ngram_join.near_copies(inputs["ngram_join"]).collect()}
    assert ids["decontamination"] == kept

    items = spark.read.parquet(f"{DIR}/benchmark.parquet")
    leaked = {r.doc_id for r in decontam.find_leaks(inputs["decontamination"], items).collect()}
    assert ids["packing"] == ids["decontamination"] - leaked
    assert not any(x.text in text[i] for i in ids["packing"] for x in items.collect())

    assert {r.doc_id for r in out.select("doc_id").collect()} == ids["packing"]
    run = P.run(spark, DIR)
    assert run.exceptAll(out).count() == 0 and out.exceptAll(run).count() == 0


def test_odd_rows(spark, odd, empty):
    for df in (odd, empty):
        out = df
        for name, stage in P.STAGES:
            out = materialize(stage(spark, out, DIR), "test-odd")
            assert name == "packing" or out.columns == df.columns
        assert (out.count() > 0) == (df is odd)
