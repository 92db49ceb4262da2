import zlib
from collections import Counter

import pytest

from tiffin.llm import langid


def plain_counts(text):
    out = Counter()
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for w in words:
        padded = f" {w} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                g = padded[i : i + n]
                if g != " ":
                    out[g] += 1
    # The space between two words belongs to both, so it starts and ends n-grams once for each.
    return {_code(g): n for g, n in out.items()}


def _code(gram):
    code = 0
    for c in gram:
        code = (code << 21) | (langid.SPACE if c == " " else ord(c))
    return code


@pytest.mark.parametrize("piece", [1 << 20, 1, 2, 3, 7])
def test_counts_are_those_of_padded_words(monkeypatch, piece):
    monkeypatch.setattr(langid, "_PIECE", piece)
    for text in ["", "a", "ab", "Ab  c", " hello, wörld 12 x ", "...", "éa\n\nbç é", "İstanbul", "x" * 50]:
        codes, counts = langid.gram_counts(text)
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == plain_counts(text)


def plain_prediction(profiles, text, top):
    counts = plain_counts(text)
    own = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:top]]
    if not own:
        return "und", 0.0
    away = {
        lang: sum(abs(r - profile.index(g)) if g in profile else top for r, g in enumerate(own))
        for lang, profile in profiles.items()
    }
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (top * len(own))


def test_distance_is_out_of_place(documents):
    train = documents.selectExpr("doc_id as key", "text", "lang").limit(60)
    profiles = langid.learn(train, top=50)
    texts = {r.doc_id: r.text for r in documents.limit(40).collect()}
    known = langid.Profiles(profiles, 50)
    for text in [*texts.values(), "", "zzz qqq", "123"]:
        lang, score = known.predict(text)
        expected = plain_prediction(profiles, text, 50)
        assert lang == expected[0] and score == pytest.approx(expected[1])


def test_profiles_are_the_most_frequent_ngrams(documents):
    rows = documents.limit(80)
    profiles = langid.learn(rows.selectExpr("doc_id as key", "text", "lang"), top=40)
    sums = {}
    for r in rows.collect():
        if r.text is not None and r.lang is not None:
            sums.setdefault(r.lang, Counter()).update(plain_counts(r.text))
    assert profiles == {k: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:40]] for k, c in sums.items()}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null and text is not null")
    rows = langid.language_of(docs, ["doc_id", "lang", "text"]).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 200 and sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_learned(documents):
    wrong = documents.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 'xx' else lang end as lang")
    assert "xx" not in {r.lang_pred for r in langid.language_of(wrong, ["doc_id"]).collect()}


def test_odd_documents(odd_documents, no_documents):
    rows = langid.language_of(odd_documents.drop("lang_pred", "score"), ["doc_id", "text"]).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "fr", "") and 0 <= r.score <= 1
    assert langid.language_of(no_documents, ["doc_id"]).count() == 0
    unlabelled = odd_documents.withColumn("lang", odd_documents.lang.substr(9, 1)).selectExpr("doc_id", "text", "nullif(lang, '') as lang")
    assert {r.lang_pred for r in langid.language_of(unlabelled, ["doc_id"]).collect()} == {"und"}


@pytest.mark.parametrize("broadcast", [1 << 16, 3])
def test_every_label_is_learned_and_rows_without_an_id_teach(spark, monkeypatch, broadcast):
    monkeypatch.setattr(langid, "BROADCAST_LANGUAGES", broadcast)
    rows = [(None, f"{chr(97 + i % 26)}{chr(97 + i // 26)} word{'x' * (i % 7)}", f"l{i:03d}") for i in range(520)]
    profiles = langid.learn(spark.createDataFrame(rows, "key long, text string, lang string"), top=20)
    assert len(profiles) == 520
    many = [(None, "aa bb" if i % 2 else "cc dd", "x" if i % 2 else "y") for i in range(4000)]
    profiles = langid.learn(spark.createDataFrame(many, "key long, text string, lang string").repartition(4), sample=100, top=20)
    assert sorted(profiles) == ["x", "y"]
