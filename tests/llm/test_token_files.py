import random
import zlib

import numpy as np
import pytest

from tiffin.llm import token_files
from tiffin.llm.common import scratch_path
from tiffin.llm.perfect_hash import PerfectHash, fingerprints
from tiffin.llm.tokens import Encoder, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    encoder = Encoder(tokenizer_path())
    return lambda text: [*encoder.whole(text or "").tolist(), 2]


def check(df, plain, **kw):
    folder = scratch_path(df.sparkSession, "ids")
    manifest = token_files.write_shards(df, folder, **kw)
    rows = token_files.read_documents(manifest, folder, at_once=1000).collect()
    got = sorted(((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=str)
    expected = [(r.doc_id is not None, r.doc_id or 0, plain(r.text)) for r in df.collect()]
    assert got == sorted(expected, key=str)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    keys = [(r.doc_id is not None, r.doc_id) for r in sorted(rows, key=lambda r: r.start)]
    assert keys == sorted(keys)
    return manifest, folder, rows


def test_round_trip_and_lookup(spark, documents, plain):
    manifest, folder, rows = check(documents, plain, shard_ids=5000)
    assert manifest.count() > 8
    wanted = [r.doc_id for r in rows[::7]]
    keys = spark.createDataFrame([(k,) for k in [*wanted, -5, 10**12, None]], "doc_id long")
    found = {r.doc_id: r.ids for r in token_files.lookup(manifest, folder, keys).collect()}
    assert found == {r.doc_id: r.ids for r in rows if r.doc_id in wanted}


def test_odd_documents(odd_documents, no_documents, plain):
    check(odd_documents, plain)
    check(odd_documents, plain, shard_ids=10)
    assert token_files.round_trip(no_documents).count() == 0


def test_every_key_is_found_whatever_stands_first(spark, odd_documents, plain):
    keys = spark.createDataFrame([(k,) for k in [*range(-1, 13), None]], "doc_id long")
    some = spark.createDataFrame([(None, "a b"), (1, "c"), (2, "d e f"), (3, "g"), (3, "h"), (3, "i j"), (4, "k")], "doc_id long, text string")
    for docs, sizes in ((odd_documents, (1 << 25, 10, 4)), (some.coalesce(1), (1 << 25, 1, 2, 3, 5))):
        for size in sizes:
            manifest, folder, rows = check(docs, plain, shard_ids=size)
            found = {r.doc_id: r.ids for r in token_files.lookup(manifest, folder, keys).collect()}
            first = {}
            for r in sorted((r for r in rows if r.doc_id is not None), key=lambda r: r.start):
                first.setdefault(r.doc_id, r.ids)
            assert found == first


def test_crc_of_the_query(spark, documents, plain):
    from tiffin.llm.queries import op7_token_ids

    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in op7_token_ids(spark, "/root/testdata/sf0.001").collect():
        assert r.ids_crc32 == zlib.crc32(np.array(plain(texts[r.doc_id]), "<u4").tobytes())


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 50_000):
        keys = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        index = PerfectHash.build(keys)
        assert sorted(index.number(keys)) == list(range(len(keys)))
        others = rng.integers(1 << 62, 1 << 63, 1000).astype(np.uint64)
        number = index.number(others)
        assert ((number >= -1) & (number < max(1, len(keys)))).all()
    assert len(np.unique(fingerprints(keys))) > 0.99 * len(keys)


def test_cached_units_equal_whole_texts(plain):
    rng = random.Random(1)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "12", "\x00", "\xa0", "<|endoftext|>", "_", "\n\n"]
    parts += ["日", "!!", "ing", "\r", "́", "\x1c", " \n", "²", "x"]
    encoder = Encoder(tokenizer_path(), store=500)
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(30)] + [None]
        for text, got in zip(texts, encoder.encode(texts), strict=True):
            assert got.tolist() == encoder.whole(text or "").tolist(), repr(text)
    assert encoder.encode([]) == []


def test_added_tokens_are_as_the_library_has_them():
    from tokenizers import Tokenizer

    plain, encoder = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path())
    for text in ["a<|endoftext|>b", "x <|endoftext|> y, z.", "<|endoftext|>", "one\n<|endoftext|>two", "no <|end", "plain words."]:
        want = plain.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text])[0].tolist() == encoder.whole(text).tolist() == want, text
    assert len(encoder.whole("a<|endoftext|>b")) == 3
