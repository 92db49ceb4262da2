import random
import re

import numpy as np
import pytest
import xxhash

from tiffin.llm import simhash
from tiffin.llm.common import stored


def plain_fingerprint(text, size=3):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(marked, most=3):
    """Smallest key by fingerprint, through all pairs."""
    fps = sorted({fp for _, fp in marked})
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= most:
                root[top(a)] = top(b)
    least = {}
    for key, fp in marked:
        r = top(fp)
        if key is not None and (least.get(r) is None or key < least[r]):
            least[r] = key
    return {fp: least.get(top(fp)) for fp in fps}


@pytest.mark.parametrize("at_once", [1 << 22, 1, 9])
def test_fingerprints(monkeypatch, documents, at_once):
    runs = simhash.word_runs
    monkeypatch.setattr(simhash, "word_runs", lambda raw: runs(raw, at_once))
    texts = ["", None, "one", "two words", "A b C", "a b c d", " \t x\x0by\x0cz\r\n", "É é É é"]
    texts += [r.text for r in documents.limit(10).collect()]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_groups_equal_all_pairs(documents):
    rows = simhash.near_duplicates(documents, ["doc_id"]).collect()
    marked = [(r.doc_id, r.fp & (1 << 64) - 1) for r in rows]
    assert sorted(marked) == sorted((r.doc_id, plain_fingerprint(r.text)) for r in documents.collect())
    expected = plain_components(marked)
    assert all(r.component_id == expected[r.fp & (1 << 64) - 1] for r in rows)


@pytest.mark.parametrize("group", [2048, 2, 5])
def test_refined_groups_lose_no_link(spark, group):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {0, (1 << 64) - 1}
    for b in base:
        for _ in range(40):  # dense groups and chains
            fps.add(b)
            for _ in range(rng.randint(1, 3)):
                b ^= 1 << rng.randrange(64)
    marked = [(i, f) for i, f in enumerate(sorted(fps, key=lambda f: rng.random()))]
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in marked]
    df = stored(spark.createDataFrame(signed, "doc_id long, fp long"), "t")
    distinct = df.select("fp")
    roots = {r.fp: r.root for r in simhash.components(simhash.links(distinct, 3, group)).collect()}
    expected = plain_components(marked)
    by_root, seen = {}, {}
    for i, f in marked:
        s = f - (1 << 64) if f >> 63 else f
        by_root.setdefault(roots.get(s, s), set()).add(f)
        seen.setdefault(expected[f], set()).add(f)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, seen.values()))


def test_forest_spans_each_group():
    rng = np.random.default_rng(3)
    keys = np.repeat(np.arange(30), rng.integers(1, 20, 30))
    fps = rng.integers(0, 256, len(keys)).astype(np.uint64)
    pairs = simhash.forest(keys, fps, 2)
    assert len(pairs) <= len(keys) and all(keys[a] == keys[b] for a, b in pairs)
    for key in range(30):
        rows = np.flatnonzero(keys == key).tolist()
        mine = {r: {r} for r in rows}
        for a, b in [p for p in pairs.tolist() if p[0] in rows]:
            joined = mine[a] | mine[b]
            for r in joined:
                mine[r] = joined
        full = {r: {r} for r in rows}
        for a in rows:
            for b in rows:
                if int(fps[a] ^ fps[b]).bit_count() <= 2:
                    joined = full[a] | full[b]
                    for r in joined:
                        full[r] = joined
        assert mine == full


def test_odd_documents(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents, ["doc_id"]).collect()
    assert len(rows) == odd_documents.count()
    expected = plain_components([(r.doc_id, r.fp) for r in rows])
    assert all(r.component_id == expected[r.fp] for r in rows)
    assert simhash.near_duplicates(no_documents, ["doc_id"]).count() == 0
    one = simhash.one_of_each(odd_documents)
    assert one.columns == odd_documents.columns
    assert one.count() == len(set(expected[r.fp] if expected[r.fp] is not None else r.fp for r in rows))
    assert simhash.one_of_each(no_documents).count() == 0
