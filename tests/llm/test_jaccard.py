import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tiffin.llm import jaccard


def plain_set(text, size=5):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def plain_join(docs, percent=80):
    """(doc_id, n_shingles, n_links, component_id) through all pairs."""
    sets = [plain_set(t) for _, t in docs]
    root, links = list(range(len(docs))), [0] * len(docs)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        known = [x for x in (least.get(top(i)), d) if x is not None]
        least[top(i)] = min(known) if known else None
    return sorted(
        ((d, len(sets[i]), links[i], least[top(i)]) for i, (d, _) in enumerate(docs)), key=lambda r: tuple((x is None, x or 0) for x in r)
    )


def rows(df):
    got = [(r.doc_id, r.n_shingles, r.n_links, r.component_id) for r in df.collect()]
    return sorted(got, key=lambda r: tuple((x is None, x or 0) for x in r))


def family(rng, n, words=60):
    """Near copies of one text and of its copies, exact copies, unrelated texts with a common passage, and short texts."""
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.6:
            t = list(rng.choice([base, *[x.split() for x in texts if x]]) if texts else base)
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = f"e{i}x{rng.randrange(9)}"
        elif kind < 0.75:
            t = [f"u{i}y{j}" for j in range(rng.randint(1, 40))] + passage
        elif kind < 0.85:
            t = [f"s{rng.randrange(3)}"] * rng.randint(0, 7)
        else:
            t = rng.choice(texts).split() if texts else base
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize("size,at_once", [(1, 1 << 20), (5, 1 << 20), (5, 3)])
def test_sets(monkeypatch, documents, size, at_once):
    texts = ["", None, "one", "two Words", "A b C d e", "a b c d e f", " \t x\x0by\x0cz\r\n", "É é É é é", "a a a a a a a"]
    texts += [r.text for r in documents.limit(10).collect()]
    plain = [plain_set(t, size) for t in texts]
    monkeypatch.setattr(jaccard.word_hashes, "__defaults__", (at_once,))
    sets = [frozenset(s.tolist()) for s in jaccard.shingle_sets(pa.array(texts), size)]
    alone = [frozenset(jaccard.shingle_sets(pa.array([t], pa.string()), size)[0].tolist()) for t in texts]
    assert sets == alone and [len(s) for s in sets] == [len(s) for s in plain]
    assert all(len(a & sets[j]) == len(p & plain[j]) for a, p in zip(sets, plain, strict=True) for j in range(len(texts)))
    first, second, third = jaccard.shingle_sets(pa.array(["Ab\tc d  e F", "ab c d e f", "ab c d f e"]).slice(0))
    assert first.tolist() == second.tolist() != third.tolist()


def test_equals_all_pairs(documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows(jaccard.join(documents)) == plain_join(docs)


@pytest.mark.parametrize(
    "seed,kw",
    [
        (3, {"group": 2, "block": 512, "fragments": 1, "least_frequent": 8}),
        (4, {"group": 6, "block": 7, "bucket_grams": 50, "least_frequent": 9, "fragments": 3}),
        (5, {"percent": 50, "group": 6, "block": 9}),
    ],
)
def test_hot_groups_lose_no_link(spark, seed, kw):
    rng = random.Random(seed)
    docs = [(rng.randrange(10_000), t) for t in family(rng, 150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(jaccard.join(df, **kw)) == plain_join(docs, kw.get("percent", 80))


def test_odd_documents(odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows(jaccard.join(odd_documents)) == plain_join(docs)
    assert jaccard.join(no_documents).count() == 0


def test_a_cell_counts_by_fragment_and_connects():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, rng.integers(5, 30))) for _ in range(30)]
    sets += [np.union1d(s, [50 + i]) for i, s in enumerate(sets[:10])]
    others = [np.array([900 + i % 4]) if i % 3 else np.zeros(0, np.int64) for i in range(len(sets))]

    def side(some):
        return jaccard.Side(
            some, [len(sets[i]) for i in some], [1] * len(some), [sets[i] for i in some], [sets[i] // 9 for i in some], [others[i] for i in some]
        )

    for left, right, same in (([*range(40)], [*range(40)], True), ([*range(15)], [*range(15, 40)], False)):
        links = jaccard.cell_links(side(left), side(right), same, 60)
        for x, i in enumerate(left):
            for y, j in enumerate(right):
                both = len(np.intersect1d(sets[i], sets[j]))
                apart = not len(np.intersect1d(others[i], others[j])) and (x < y or not same)
                assert links[x, y] == (apart and 100 * both >= 60 * (len(sets[i]) + len(sets[j]) - both))
        tree = jaccard.spanning(links, same)
        assert all(links[a, b] for a, b in tree)
        nodes = {("l", i): {("l", i)} for i in range(len(left))} | ({} if same else {("r", j): {("r", j)} for j in range(len(right))})

        def connected(pairs, name="l" if same else "r", start=nodes):
            groups = dict(start)
            for a, b in pairs:
                joined = groups[("l", a)] | groups[(name, b)]
                for x in joined:
                    groups[x] = joined
            return groups

        assert connected(tree) == connected(zip(*map(lambda v: v.tolist(), np.nonzero(links)), strict=True))


@pytest.mark.parametrize("percent", [30, 80, 95])
def test_sets_that_link_share_enough_of_their_first_grams(spark, percent):
    rng, gen = random.Random(percent), np.random.default_rng(percent)
    pool = np.unique(gen.integers(0, 2**63, 4000).astype(np.uint64))
    known = np.sort(gen.choice(pool, 300, replace=False))
    cases = []
    for _ in range(400):
        union = gen.choice(pool, rng.choice([1, 2, 5, 9, 60, 400, 900]), replace=False)
        n = -(-len(union) * percent // 100)  # the fewest that link; what is left is dealt to either side
        cut = rng.choice([n, len(union), rng.randint(n, len(union))])
        sets = {1: np.sort(np.concatenate([union[:n], union[n:cut]])), 2: np.sort(np.concatenate([union[:n], union[cut:]]))}
        firsts = jaccard.first_grams(sets, known, percent)
        assert all(np.isin(firsts[k], sets[k]).all() and len(firsts[k]) == len(np.unique(firsts[k])) for k in sets)
        cases += [(len(s), len(np.intersect1d(firsts[1], firsts[2]))) for s in sets.values()]
    df = spark.createDataFrame(cases, "n long, met long").withColumn("least", jaccard.least_shared(F.col("n"), percent))
    assert df.filter("met < least").count() == 0 and df.filter("least > 5").count() > 0


def test_bitmap_holds_all_keys_and_few_others(spark, monkeypatch):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63, 6000)
    df = spark.createDataFrame([(int(k),) for k in keys[:3000]], "key long")
    bitmap = jaccard._bitmap(df, 3000)
    assert jaccard.held_in(bitmap, keys[:3000]).all() and jaccard.held_in(bitmap, keys[3000:]).mean() < 0.1
    assert not jaccard.held_in(jaccard._bitmap(df.limit(0), 0), keys).any()
    monkeypatch.setattr(jaccard, "MOST_BITS", jaccard._ROW)  # a full bitmap lets more through and misses none
    bitmap = jaccard._bitmap(df, 3000)
    assert len(bitmap) == jaccard._ROW // 8 and jaccard.held_in(bitmap, keys[:3000]).all()


def test_a_full_bitmap_changes_no_link(spark, monkeypatch):
    docs = [(i, " ".join(f"w{(i // 3) * 40 + j}" for j in range(30)) + f" x{i % 3}" * (i % 2)) for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = rows(jaccard.join(df))
    assert want == plain_join(docs)
    monkeypatch.setattr(jaccard, "_bitmap", lambda keys, n: np.full(4096, 255, np.uint8))
    assert rows(jaccard.join(df)) == want


WRITTEN = """
import glob, json, sys
from pyspark.sql import functions as F
from pyspark.sql import functions as F

from tiffin.llm import jaccard
from tiffin.llm.common import ship_package
from tiffin.session import local_session
at = sys.argv[1]
log = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{at}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}
spark = local_session(4, 8, extra={**log, "spark.checkpoint.dir": f"file://{at}/scratch", "spark.local.dir": f"{at}/local"})
ship_package(spark)
word = lambda w: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", w), F.lit(50_000)).cast("string"))
docs = spark.range(0, 4000, 1, 4).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(399)), word), " ").alias("text"))
out = jaccard.join(docs).agg(F.sum("n_shingles").alias("n"), F.sum("n_links").alias("links")).first()
spark.stop()
events = [json.loads(x) for f in glob.glob(f"{at}/*") if f.rsplit("/", 1)[1].startswith(("local-", "app-")) for x in open(f)]
ends = [e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics")]
print("written", out.n, out.links, sum(ends))
"""


def test_texts_without_a_partner_are_not_dealt_out_whole(tmp_path):
    """Of sets that link with nothing, only the first n-grams are shuffled: whole sets took 7 bytes an n-gram."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", WRITTEN, str(tmp_path)], capture_output=True, text=True, check=True, timeout=300, cwd=root)
    n, links, written = map(int, out.stdout.split("written")[-1].split())
    assert n > 1_500_000 and links == 0
    assert 0 < written < 4 * n
