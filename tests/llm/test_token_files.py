import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import idcoder, packing, tokenfiles, tokens
from tidemark.llm.common import scratch_path

TOKENIZER = Tokenizer.from_file(tokens.default_path())


def ids_of(text, end):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end], "<u4").tobytes()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 127, 1000, 5001, 30_000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    for x in (rng.integers(0, 65536, n), np.zeros(n), rng.zipf(1.3, n) % 49408, np.arange(n) % 7):
        x = x.astype(np.uint16)
        assert (idcoder.decode(idcoder.encode(x)) == x).all()


def test_damage_is_found():
    block = bytearray(idcoder.encode(np.arange(4000, dtype=np.uint16)))
    block[200] ^= 4
    with pytest.raises(ValueError):
        idcoder.decode(bytes(block))
    with pytest.raises(ValueError):
        idcoder.decode(bytes(block[:10]))


def test_it_compresses():
    x = np.tile(np.random.default_rng(0).integers(0, 300, 500), 40).astype(np.uint16)
    assert len(idcoder.encode(x)) < 0.3 * 2 * len(x)


@pytest.mark.parametrize("text", ["", " ", "The cat, the CAT. 12 3", "<|endoftext|> a <|ENDOFTEXT|>", "it's 'LL we'll, end.",
                                  "ÀÉ\r\nA\x0bB  C", "a\tb\x1cc d  e Σς ΑΣ x́ ́y", "a!!, b?. ok.", "İı ǅ K", "x.y,z ,a"])
def test_encoder_equals_the_library(text):
    got = np.frombuffer(tokens.encoder().encode(text), "<u2").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_columns_look_up_each_stretch_once(docs, monkeypatch):
    enc = tokens.encoder()
    texts = [r.text for r in docs.limit(40).collect()] + ["", " ", "a\n\nB  c", "x <|endoftext|> <|ENDOFTEXT|> Y", "\n", "Éa ß İ."]
    for part in (1, 500, 1 << 24):
        monkeypatch.setattr(tokens, "PART", part)
        assert [*enc.encode_all(pa.array(["gone", *texts]).slice(1))] == [*map(enc.encode, texts)]
        assert [*enc.encode_all(pa.array([], pa.string()))] == []
    # not kept, as it is over 64 characters long
    rare, asked, whole = "1-" * 40, [], enc._whole
    monkeypatch.setattr(enc, "_whole", lambda s: asked.append(s) or whole(s), raising=False)
    got = [*enc.encode_all(pa.array([f"{rare} a {rare}"] * 50))]
    assert got == [enc.encode(f"{rare} a {rare}")] * 50 and asked[0] == rare and len(asked) == 3


def test_files(spark, docs, odd, empty):
    for df, settings in ((docs, {}), (docs, {"file_bytes": 60_000, "block_ids": 3000}), (odd, {"file_bytes": 1000})):
        folder = scratch_path(spark, "test-files")
        tokenfiles.write_ids(df, folder, **settings)
        got = tokenfiles.read_ids(spark, folder).collect()
        want = sorted(((r.doc_id, ids_of(r.text, 1)) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
        got.sort(key=lambda r: r.start)
        assert [r.doc_id for r in got] == [i for i, _ in want]
        assert sorted((repr(r.doc_id), r.ids) for r in got) == sorted((repr(i), x) for i, x in want)
        at = 0
        for r in got:
            assert r.start == at and r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
            at += r.n_tokens
    folder = scratch_path(spark, "test-files")
    tokenfiles.write_ids(empty, folder)
    assert tokenfiles.read_ids(spark, folder).count() == 0


@pytest.mark.parametrize("lengths", [[1], [4096], [5000, 3], [4097] * 3, [1] * 100, [700] * 31, [12_288, 1, 2, 4095]])
def test_pack(lengths):
    pieces = packing.pack(np.array(lengths), 4096, 1.0, 1 / 2048)
    seen = {}
    for d, start, n, _, _ in sorted(pieces):
        assert start == seen.get(d, 0) and n > 0
        seen[d] = start + n
    assert seen == dict(enumerate(lengths))
    ends = {}
    for _, _, n, s, offset in sorted(pieces, key=lambda x: (x[3], x[4])):
        assert offset == ends.get(s, 0)
        ends[s] = offset + n
    assert all(x <= 4096 and x & (x - 1) == 0 for x in ends.values())       # nothing to pad


def test_pack_balances_cost():
    rng = np.random.default_rng(1)
    pieces = packing.pack(rng.integers(50, 1500, 800), 4096, 1.0, 1 / 2048)
    cost, size = {}, {}
    for _, _, n, s, _ in pieces:
        cost[s] = cost.get(s, 0) + n + n * n / 2048
        size[s] = size.get(s, 0) + n
    full = [cost[s] for s in cost if size[s] == 4096]
    assert max(full) < 1.5 * sum(full) / len(full)


def test_packing(docs, odd, empty):
    for df in (docs, odd):
        got = packing.pack_documents(df, block_bytes=200_000).collect()
        want = sorted((repr(r.doc_id), ids_of(r.text, 2)) for r in df.collect())
        by = {}
        for r in sorted(got, key=lambda r: r.start):
            # rows that share an id are told apart by their pieces' sequence of starts only in the plain case
            by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        assert sum(len(r.ids) for r in got) == sum(len(x) for _, x in want)
        ids = [i for i, _ in want]
        for (i, n), rs in by.items():
            if ids.count(repr(i)) == 1:
                assert b"".join(r.ids for r in rs) == dict(want)[repr(i)] and len(b"".join(r.ids for r in rs)) == 4 * n
        size = {}
        for r in got:
            size[r.sequence_id] = size.get(r.sequence_id, 0) + r.length
        assert all(x <= 4096 and x & (x - 1) == 0 for x in size.values())
    assert packing.pack_documents(empty).count() == 0


def test_packing_spreads_equal_rows(spark):
    """A third of all rows without id and text: they are dealt to many blocks, and none is lost."""
    df = spark.range(0, 9000, 1, 6).selectExpr("if(id % 3 = 0, null, id) AS doc_id",
                                               "if(id % 3 = 0, null, repeat('plain words ', 20)) AS text")
    got = packing.pack_documents(df, block_bytes=50_000).where("doc_id IS NULL").selectExpr(
        "sequence_id >> 32 AS block").groupBy("block").count().collect()
    assert sum(r["count"] for r in got) == 3000
    assert len(got) > 20 and max(r["count"] for r in got) < 3 * 3000 / len(got)


def test_places_over_many_files(spark, monkeypatch):
    """Places of files over several runs equal running totals, whatever files are missing."""
    monkeypatch.setattr(tokenfiles, "RUN", 4)
    rows = [(f, b, 10 * f + b + 1) for f in range(0, 40, 3) for b in range(2)]
    got = {r["file"]: r["base"] for r in tokenfiles._places(
        spark.createDataFrame(rows, "file long, block long, n_ids long")).collect()}
    at = 0
    for f in range(0, 40, 3):
        assert got[f] == at
        at += sum(n for g, _, n in rows if g == f)
