import re
import string

from tiffin.llm import licenses


def plain_words(text):
    lower = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return re.sub("[^a-z0-9]+", " ", lower).strip(" ").split(" ")


def plain_bigrams(w):
    return frozenset(zip(w, w[1:], strict=False))


def brute(docs):
    words = [plain_words(t) for _, t in licenses.TEMPLATES]
    sets = [plain_bigrams(w) for w in words]
    out = {}
    for doc_id, text in {(d, t) for d, t in docs if t is not None}:
        w = plain_words(text)
        found = set()
        for i, (own, b) in enumerate(zip(words, sets, strict=True)):
            rare = sorted(b, key=lambda g: (sum(g in other for other in sets), -len(" ".join(g)), " ".join(g)))
            for g in rare[: len(b) // 3 + 1]:
                place = next(k for k in range(len(own)) if tuple(own[k : k + 2]) == g)
                for at in (k for k in range(len(w) - 1) if (w[k], w[k + 1]) == g):
                    lo, hi = max(at - place, 0), min(at - place + len(own), len(w))
                    part = plain_bigrams(w[lo:hi])
                    dice = 2 * len(part & b) / (len(part) + len(b))
                    if dice >= licenses.LEAST:
                        found.add((lo, hi, dice, i, part))
        for lo, hi, dice, i, part in found:
            if not any(o[0] < hi and lo < o[1] and o[2] > dice for o in found):
                out.setdefault((doc_id, licenses.TEMPLATES[i][0]), set()).add((dice, -i, part))
    return {k: (max(v[:2] for v in found), len({v[2] for v in found})) for k, found in out.items()}


def scanned(df):
    return {(r.doc_id, r.license): ((r.dice, -r.template), r.n_units) for r in licenses.scan(df).collect()}


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400)
    got = scanned(docs)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()]) and len(got) > 5


def test_notices_over_lines_and_changed_words(spark):
    mit = licenses.TEMPLATES[4][1]
    wrapped = mit.replace("copies of the Software", "copies of the\nSoftware").replace("limitation the", "limitation\nthe")
    rows = [
        (1, wrapped),
        (2, f"Some text.\n\n{wrapped}\n \nmore text"),
        (3, mit.upper().replace("FREE OF CHARGE", "FREE of any CHARGE")),
        (4, "This work is under another license"),
        (5, "Licensed under CC BY-NC 4.0"),
        (6, "license " * 500),
        (7, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = scanned(df)
    assert got == brute(rows)
    assert {k for k in got if k[0] < 4} == {(1, "MIT"), (2, "MIT"), (3, "MIT")} and (5, "CC-BY-NC-4.0") in got


def test_a_unit_states_its_best_template_alone(spark):
    notices = {
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    }
    rows = [(i, f"some text\n{t}\nmore") for i, t in enumerate(notices.values())]
    got = scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert set(got) == set(enumerate(notices)) and got == brute(rows)


def test_notices_anywhere_in_a_text(spark):
    gpl = next(t for name, t in licenses.NOTICES if name == "GPL-3.0" and len(t) > 100).split()
    block = "/*\n * tool.c\n *\n" + "".join(f" * {' '.join(gpl[i : i + 8])}\n" for i in range(0, len(gpl), 8)) + " *\n */\nint main() {}\n"
    rows = [
        (1, "The code of this page, as all that we publish here, is yours. Released under the MIT License. Have fun with it and write to us."),
        (2, block),
        (3, "# SPDX-License-Identifier: LGPL-2.1\nimport os"),
        (4, "word " * 3000 + licenses.TEMPLATES[4][1] + " word" * 3000),
        (5, "The licence of a work says under which terms others may copy, change and distribute it."),
        (6, "this permission notice shall be included in all copies or substantial portions of the software and then some"),
    ]
    got = scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    assert {k for k in got if k[0] < 6} == {(1, "MIT"), (2, "GPL-3.0"), (3, "LGPL-2.1"), (4, "MIT")}


def test_every_template_is_found_and_states_its_licence(spark):
    rows = [(i, f"some words before it {t} and some more behind") for i, (_, t) in enumerate(licenses.TEMPLATES)]
    got = scanned(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    assert set(got) == {(i, name) for i, (name, _) in enumerate(licenses.TEMPLATES)}


def test_sql_states_the_same_rule(spark, tmp_path):
    import duckdb

    from tiffin.llm.oracle import ORACLE_SQL

    rows = [(i, f"words {t} more\n{licenses.TEMPLATES[i - 1][1]}") for i, (_, t) in enumerate(licenses.TEMPLATES)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, None), (9, ""), (9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    db = duckdb.connect()
    db.register("documents", df.toPandas())
    said = db.sql(ORACLE_SQL["op8_license_scan"]).df()
    told = {(None if r.doc_id != r.doc_id else r.doc_id, r.license): ((r.dice, -r.template), r.n_units) for r in said.itertuples()}
    assert told == scanned(df) == brute(rows)


def test_odd_documents(odd_documents, no_documents):
    got = scanned(odd_documents)
    assert got == brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert set(got) == {(10, "MIT")}
    assert licenses.scan(no_documents).count() == 0


def test_no_python_in_the_plan(documents):
    plan = licenses.scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
