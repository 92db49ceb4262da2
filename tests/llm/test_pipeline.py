from collections import Counter

import corpus_pipeline as pipeline
from test_quality import plain_measures
from test_simhash import plain_components, plain_fingerprint

from tiffin.llm import langid
from tiffin.llm.common import stored
from tiffin.llm.mixing import mix

SF = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)


def rows_of(df):
    return Counter(str(r) for r in df.collect())


def test_each_stage_by_brute_force(spark, documents):
    docs = documents
    for name, stage in pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF), name)
        assert out.columns == documents.columns
        given = docs.collect()
        if name == "language_id":
            train = docs.filter(~langid.held_out(docs.doc_id)).selectExpr("doc_id as key", "text", "lang")
            known = langid.Profiles(langid.learn(train))
            expected = [r for r in given if known.predict(r.text)[1] >= pipeline.LEAST_SCORE]
        elif name == "quality_rules":
            expected = []
            for r in given:
                m = plain_measures(r.text, 10) if len(r.text or "") < 20_000 else None
                if m is None:
                    expected.append(r)
                    continue
                failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
                if not failed and m["repeat_covered"] <= 0.3 * m["n_words"] and m["longest_repeat"] <= 200:
                    expected.append(r)
        elif name == "simhash_near_dedup":
            marked = [(r.doc_id, plain_fingerprint(r.text)) for r in given]
            least = plain_components(marked)
            expected = [r for r, (_, fp) in zip(given, marked, strict=True) if least[fp] == r.doc_id]
        else:
            copies = {r.doc_id: r.copies for r in mix(docs).collect()}
            expected = [r for r in given for _ in range(copies[r.doc_id])]
        assert rows_of(out) == Counter(map(str, expected)), name
        docs = out
    tokens = sum(r.length for r in STAGES["packing"](spark, docs, SF).collect())
    assert tokens == sum(r.length for r in pipeline.run(spark, SF).collect()) > 10_000


def test_odd_documents_pass_all_stages(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in pipeline.STAGES[:-1]:
            out = stored(stage(spark, docs, SF), name)
            assert out.columns == docs.columns, name
            again = stored(stage(spark, odd_documents, SF), name)
            assert again.columns == odd_documents.columns
            docs = out
        STAGES["packing"](spark, docs, SF).collect()
