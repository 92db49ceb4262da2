import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tiffin.llm import collocations as co


def plain(docs, least=30, covered=80, best=2000):
    """The contract's rules over every contiguous phrase, with every longer candidate."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        inside = defaultdict(int)
        for p, c in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], c)
        rows = []
        for p, a in cand.items():
            if 100 * inside[p] >= covered * a:
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:best])]  # noqa: E741
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(12)] + ["the", "é", "x\x01y", "rare"]
    stock = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 6))] for _ in range(8)]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 12)):
            words += rng.choice(stock) if rng.random() < 0.6 else [rng.choice([*vocabulary, f"u{i}"])]
            words.append(rng.choice(["", ".", ",", "\n", "\t", "?!"]))
        out.append((rng.choice(["en", "en", "en", "fr", None]), " ".join(words).replace(" ,", ",")))
    return out


@pytest.mark.parametrize(
    "seed,kw", [(1, {"least": 5}), (2, {"least": 4, "dictionary": 3, "bucket_words": 40, "bucket_phrases": 7}), (3, {"least": 3, "bucket_words": 30, "bucket_phrases": 5, "best": 9, "covered": 60})]
)
def test_equals_brute_force(spark, seed, kw):
    docs = texts(seed, 120)
    got = rows(co.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(3), **kw))
    expected = plain(docs, **{k: v for k, v in kw.items() if k in ("least", "covered", "best")})
    assert len(expected) > 10 and got == expected


def test_documents(documents):
    assert rows(co.collocations(documents, least=12)) == plain([(r.lang, r.text) for r in documents.collect()], least=12)


def test_odd_documents(odd_documents, no_documents):
    many = odd_documents
    for _ in range(2):
        many = many.union(many)
    docs = [(r.lang, r.text) for r in many.collect()]
    assert rows(co.collocations(many, least=4)) == plain(docs, least=4)
    assert co.collocations(no_documents).count() == 0


@pytest.mark.parametrize("compact", [True, False])
def test_places_follow_the_order(compact):
    rng = np.random.default_rng(4)
    ids = np.unique(rng.integers(1, 1 << 63, 30).astype(np.uint64))
    shares = rng.random(len(ids)) ** 4
    shares /= shares.sum() * (1 if compact else 2)
    known = ids if compact else ids[::3]
    layout = co.Layout(known, shares if compact else shares[::3], compact)
    table = rng.choice(ids, (4, 5000))
    length = rng.integers(1, 5, 5000)
    columns = [np.where(i < length, table[i], np.uint64(0)) for i in range(4)]
    *columns, _ = co.summed(columns, np.ones(5000, dtype=np.int64))
    low, high = layout.places(columns), layout.places(columns, True)
    assert (np.diff(low) >= 0).all() and (low <= high).all()
    for k in range(1, 4):  # extensions lie within the range of what they extend
        held = {tuple(c[i] for c in columns[:k]): high[i] for i in range(len(low)) if columns[k - 1][i] and (k == 4 or not columns[k][i])}
        for i in range(len(low)):
            top = held.get(tuple(c[i] for c in columns[:k]))
            assert top is None or low[i] <= top
    assert (layout.unpacked(layout.packed(columns[0])) == columns[0]).all() if compact else True


def test_large_counts_are_exact(spark):
    big = 9_000_000_000_000
    row = spark.createDataFrame([(big, big, big + 7)], "a long, l long, r long")
    got = row.selectExpr("cast(cast(a as decimal(38, 0)) * 2000000 div (l + r) as bigint) as score").first().score
    assert got == 2000000 * big // (2 * big + 7)
