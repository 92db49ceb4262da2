import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tiffin.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_search(docs, queries, k=10):
    """(query, rank, doc_id, score) over all documents and all terms, one by one."""
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    N, L = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for q, text in queries:
        scored = []
        for d, c, n in counted:
            m = 100 - 90 + (90 * n * N) // L
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(plain_terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(q, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def rows(df):
    order = lambda x: tuple((v is None, v or 0) for v in x)
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=order)


def expected(docs, queries, k=10):
    order = lambda x: tuple((v is None, v or 0) for v in x)
    return sorted(plain_search(docs, queries, k), key=order)


@pytest.mark.parametrize("text", ["", None, "a B-c_9 é日本x\x00z~", "UPPER ÀÉ lower 12.5", "...", " \x7f"])
def test_terms(text):
    assert [t.decode() for run in lexical.term_runs(text) for t in run] == plain_terms(text)


@pytest.mark.parametrize("item_terms,block", [(1 << 18, 1 << 15), (200, 17)])
def test_equals_brute_force(spark, documents, item_terms, block):
    queries = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = lexical.search(documents, queries, item_terms=item_terms, block=block)
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows(got) == expected(docs, [(r.item_id, r.text) for r in queries.collect()])
    assert dict(got.dtypes) == {"item_id": dict(queries.dtypes)["item_id"], "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_odd_rows(spark, odd_documents, no_documents):
    asked = [(1, "alpha DELTA unknown"), (1, "alpha DELTA unknown"), (2, None), (3, ""), (None, "id text"), (4, "w1x1 w2x2"), (5, "日本語 naïve")]
    queries = spark.createDataFrame(asked, "item_id long, text string").selectExpr("*", "1 as qid", "'x' as terms", "1 as _id")
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows(lexical.search(odd_documents, queries)) == expected(docs, asked)
    assert lexical.search(no_documents, queries).count() == 0
    assert lexical.search(odd_documents, queries.limit(0)).count() == 0


def test_limited_accumulators_are_exact():
    rng = random.Random(5)
    for _ in range(60):
        size, n_terms, k = rng.randint(1, 60), rng.randint(1, 12), rng.randint(1, 8)
        held = [(t, r, rng.randint(1, 9) * 10) for t in range(n_terms) for r in range(size) if rng.random() < (t + 1) / n_terms]
        if not held:
            continue
        terms, at, impacts = (np.array(c, dtype=np.int64) for c in zip(*held, strict=True))
        index = lexical.Index(terms, at, impacts, size)
        own = np.arange(n_terms + 2)
        weights = np.array([rng.choice([0, 1, 5, 50]) * (n_terms + 2 - t) for t in own], dtype=np.int64)
        score = np.zeros(size, dtype=np.int64)
        for t, r, x in held:
            score[r] += weights[t] * x
        best = sorted((-s, r) for r, s in enumerate(score.tolist()) if s > 0)[:k]
        got, exact = index.best(own, weights, k)
        assert (score[got] == exact).all()
        assert sorted(zip((-exact).tolist(), got.tolist(), strict=True))[:k] == best


def test_common_terms_make_no_accumulators():
    """A rare, heavy term settles the result: the common one updates survivors alone."""
    size = 1000
    terms = np.concatenate([np.zeros(3, np.int64), np.ones(size, np.int64)])
    at = np.concatenate([np.array([5, 6, 7]), np.arange(size)])
    index = lexical.Index(terms, at, np.full(len(terms), 10, dtype=np.int64), size)
    got, scores = index.best(np.array([0, 1]), np.array([100, 1]), 3)
    assert got.tolist() == [5, 6, 7] and scores.tolist() == [1010] * 3
