import math

import numpy as np
from pyspark.sql import functions as F

from tiffin.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, score long, rank int, v int"


def brute(rows, k, every=20):
    usable = [
        (i, tuple(math.floor(64 * float(np.float32(x))) for x in v))
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        own = {v for i, v in usable if i == q}
        scored = [(-sum(a * b for a, b in zip(w, v, strict=False)), i) for w in own for i, v in usable if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows, k, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_k(df, F.col("vec_id") % 20 == 0, k, **kw)
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


def test_equals_brute_force_for_any_grid(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=12)], 0, 0, 0) for i in range(300)]
    rows += [(300 + i, rows[0][1], 0, 0, 0) for i in range(60)]  # many ties
    expected = brute(rows, 7)
    assert found(spark, rows, 7) == expected
    assert found(spark, rows, 7, lists=3, query_block=4, row_block=50) == expected
    assert found(spark, rows, 7, lists=1, row_block=90) == expected


def test_nulls_lengths_repeats_and_few_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1, 1, 1),
        (0, [1.0, 2.0], 1, 1, 1),
        (1, [0.5, -3.0], 1, 1, 1),
        (1, [0.25], 1, 1, 1),
        (2, None, 1, 1, 1),
        (3, [1.0, None], 1, 1, 1),
        (4, [float("nan"), 1.0], 1, 1, 1),
        (5, [float("inf"), 1.0], 1, 1, 1),
        (None, [9.0, 9.0], 1, 1, 1),
        (20, [], 1, 1, 1),
        (40, [1000.0, 40000.0, 3.0], 1, 1, 1),
    ]
    assert found(spark, rows, 20) == brute(rows, 20)
    assert found(spark, rows, 2) == brute(rows, 2)
    assert found(spark, rows[:1], 20) == []
    assert found(spark, [], 20) == []


def test_rows_that_share_an_id_and_a_score_are_results_of_their_own(spark):
    rows = [(1, [1.0, 0.5], 0, 0, 0), (1, [1.0, 0.25], 0, 0, 0), (2, [0.5, 0.0], 0, 0, 0), (2, [0.5, 0.0], 0, 0, 0), (20, [1.0, 0.0], 0, 0, 0)]
    expected = [(20, 1, 1, 4096), (20, 2, 1, 4096), (20, 3, 2, 2048), (20, 4, 2, 2048)]
    assert found(spark, rows, 20) == brute(rows, 20) == expected
    assert found(spark, rows, 3, row_block=2) == expected[:3]
