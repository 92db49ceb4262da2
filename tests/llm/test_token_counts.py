import random

import pytest

from tiffin.llm.common import scratch_path
from tiffin.llm.token_counts import Rollup, token_counts
from tiffin.llm.tokens import Encoder, tokenizer_path

SCHEMA = "op string, doc_id long, source string, lang string, version string, n long, at int, live int, docs int"


def plain_totals(state):
    out = {}
    for (_, version), (source, lang, n) in state.items():
        docs, tokens = out.get((source, lang, version), (0, 0))
        out[source, lang, version] = docs + 1, tokens + n
    return out


def totals(rollup):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_deltas_equal_a_recount(spark):
    rng = random.Random(2)
    rollup, state, scans = Rollup(spark, scratch_path(spark, "rollup"), fold=2), {}, []
    assert totals(rollup) == {}
    for batch in range(6):
        rows = []
        for doc_id in rng.sample([None, *range(12)], 8):
            op, version = rng.choice(["insert", "revise", "delete", "other"]), rng.choice(["v1", "v2"])
            value = rng.choice(["a", None]), rng.choice(["en", "fr"]), rng.randrange(50)
            rows.append((op, doc_id, value[0], value[1], version, value[2], 0, 1, 1))
            if op == "delete":
                state.pop((doc_id, version), None)
            elif op != "other":
                state[doc_id, version] = value
        df = spark.createDataFrame(rows + rows[:3], SCHEMA)
        assert rollup.apply(f"b{batch}", df)
        assert totals(rollup) == plain_totals(state)
        assert not rollup.apply(f"b{batch}", df)
        assert totals(rollup) == plain_totals(state)
        scans.append(rollup.live()._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
    assert max(scans) == 3 and not rollup.committed("b6")  # a snapshot and two batches, however many came before
    assert all(not rollup.apply(f"b{batch}", df) for batch in range(6))
    rollup.compact()
    assert totals(rollup) == plain_totals(state)


def test_of_two_writers_at_one_place_the_second_fails(spark, monkeypatch):
    path = scratch_path(spark, "rollup")
    first, second = Rollup(spark, path), Rollup(spark, path)
    rows = spark.createDataFrame([("insert", 1, "a", "en", "v", 5, 0, 1, 1)], SCHEMA)
    seen = second._state()
    assert first.apply("x", rows)
    with monkeypatch.context() as stale:
        stale.setattr(second, "_state", lambda: seen)
        with pytest.raises(Exception, match="(?i)exist"):
            second.apply("x", rows)
    assert totals(first) == {("a", "en", "v"): (1, 5)}
    assert not second.apply("x", rows) and second.apply("y", rows) and totals(second) == {("a", "en", "v"): (1, 5)}


def test_the_last_change_of_a_batch_holds(spark):
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    rows = [("insert", 1, "a", "en", "v", 5, 0, 1, 1), ("revise", 1, "b", "en", "v", 3, 1, 1, 1), ("insert", 2, "a", "en", "v", None, 0, 1, 1)]
    rollup.apply("x", spark.createDataFrame(rows, SCHEMA))
    assert totals(rollup) == {("b", "en", "v"): (1, 3), ("a", "en", "v"): (1, 0)}


def test_a_batch_without_its_commit_counts_for_nothing(spark):
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    rows = spark.createDataFrame([("insert", 1, "a", "en", "v", 5, 0, 1, 1)], SCHEMA)
    rollup.apply("x", rows)
    spark.createDataFrame([("a", "en", "v", 9, 9)], "source string, lang string, version string, docs long, tokens long").write.parquet(
        f"{rollup.path}/batches/broken/delta"
    )
    assert totals(rollup) == {("a", "en", "v"): (1, 5)}
    assert rollup.apply("empty", rows.limit(0)) and totals(rollup) == {("a", "en", "v"): (1, 5)}


def test_the_query_equals_a_recount(spark, documents):
    from tiffin.llm.queries import op10_token_counts

    encoder = Encoder(tokenizer_path())
    state = {
        (r.doc_id, "byte_bpe_50k"): (r.source, r.lang, len(encoder.whole(r.text)))
        for r in documents.collect()
        if r.text and len(encoder.whole(r.text))
    }
    rows = op10_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rows} == plain_totals(state)


def test_counts_of_odd_documents(odd_documents, no_documents):
    encoder = Encoder(tokenizer_path())
    for r in token_counts(odd_documents.drop("n"), ["doc_id", "text"]).collect():
        assert r.n == len(encoder.whole(r.text or ""))
    assert token_counts(no_documents.drop("n"), ["doc_id"]).count() == 0


def test_every_row_counts_whatever_its_id(spark, odd_documents, tmp_path):
    from tiffin.llm.queries import op10_token_counts

    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    encoder, docs, tokens = Encoder(tokenizer_path()), {}, {}
    for r in odd_documents.collect():
        n = len(encoder.whole(r.text or ""))
        docs[r.source, r.lang] = docs.get((r.source, r.lang), 0) + 1
        tokens[r.source, r.lang] = tokens.get((r.source, r.lang), 0) + n
    got = {(r.source, r.lang): (r.docs, r.tokens) for r in op10_token_counts(spark, str(tmp_path)).collect()}
    assert got == {k: (docs[k], tokens[k]) for k in docs}


def test_a_revision_replaces_all_copies_of_its_row(spark, odd_documents):
    from tiffin.llm.token_counts import COPIES, ROW_KEY, row_counts

    rollup = Rollup(spark, scratch_path(spark, "rollup"), ROW_KEY, COPIES)
    rows = row_counts(odd_documents).selectExpr("*", "'v' as version", "0 as at").cache()
    rollup.apply("in", rows.selectExpr("*", "'insert' as op"))
    rollup.apply("again", rows.drop("n").selectExpr("*", "7 as n", "'revise' as op"))
    assert sum(d for d, _ in totals(rollup).values()) == odd_documents.count()
    assert all(t == 7 * d for d, t in totals(rollup).values())
    rollup.apply("out", rows.filter("doc_id = 1 or doc_id is null").selectExpr("*", "'delete' as op"))
    assert sum(d for d, _ in totals(rollup).values()) == odd_documents.filter("doc_id != 1").count()


def test_documents_without_a_token_are_counted(spark, odd_documents, tmp_path):
    from tiffin.llm.queries import op10_token_counts

    odd_documents.write.parquet(f"{tmp_path}/documents.parquet")
    rows = op10_token_counts(spark, str(tmp_path)).collect()
    assert sum(r.docs for r in rows) == odd_documents.count()
    assert ("", "", 1, 0) in {(r.source, r.lang, r.docs, r.tokens) for r in rows}
