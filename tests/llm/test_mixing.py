import math
import re
from collections import defaultdict

import pytest

from tiffin.llm.mixing import mix, mixed


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        share = (total - sum(held.values())) / max(1, sum(weights[s] for s in free))
        over = {s: 3 * sizes[s] for s in free if weights[s] * share > 3 * sizes[s]}
        if not over:
            return {s: held.get(s, weights[s] * share) for s in order}
        held |= over


def check(df):
    rows = mix(df).collect()
    source = defaultdict(int)
    docs = sorted((r.doc_id or -1, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in df.collect())
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == docs
    for r in rows:
        source[r.source] += r["size"]
    targets = brute_targets(source)
    taken, most = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == source[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        rate = r.target / r.source_size if r.source_size else 0
        assert math.floor(rate) <= r.copies <= math.ceil(rate)
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r["size"])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 2 * most[s] + 1e-6  # steps over documents of like size
    return rows


def test_targets_and_copies(documents):
    rows = check(documents)
    again = mix(documents.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_odd_documents(odd_documents, no_documents):
    check(odd_documents.select("doc_id", "text", "source", "slice", "pos", "copies"))
    assert mix(no_documents).count() == 0
    assert mixed(no_documents).count() == 0


def test_rows_as_often_as_taken(odd_documents):
    out = mixed(odd_documents)
    assert out.columns == odd_documents.columns
    copies = defaultdict(int)
    for r in mix(odd_documents).collect():
        copies[r.doc_id, r["size"]] += r.copies
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))] += 1
    assert dict(got) == {k: v for k, v in copies.items() if v}


def test_rows_that_differ_in_a_map_alone_stay_apart(spark):
    from tiffin.llm.common import with_row_keys

    rows = spark.createDataFrame(
        [(1, {"a": 1, "b": 2}, [{"x": None}]), (1, {"b": 2, "a": 1}, [{"x": None}]), (1, {"a": 1}, [{"x": None}]), (1, None, [{"x": 3}]), (1, {}, None)],
        "doc_id long, tags map<string,int>, more array<map<string,int>>",
    )
    keys = [(r._k0, r._k1) for r in with_row_keys(rows, ["doc_id"]).orderBy("_row.doc_id").collect()]
    assert len(keys) == 5 and len(set(keys)) == 4
    docs = rows.selectExpr("1 as doc_id", "'one two' as text", "'s' as source", "tags")
    kept = {str(r.tags and sorted(r.tags.items())) for r in mixed(docs, weights=(1,), most=1).collect()}
    assert len(kept) == 4
