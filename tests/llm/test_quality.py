import random
import re

import numpy as np

from tiffin.llm import quality


def plain_longest(w):
    out = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            n = 0
            while i != j and max(i, j) + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            out[i] = max(out[i], n)
    return out


def plain_measures(text, least_repeat):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    longest = plain_longest(w)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]

    def cover(spans):
        return len({p for i, n in spans for p in range(i, i + n)})

    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": cover((i, 3) for i, n in enumerate(longest) if n >= 3),
        "repeat_covered": cover((i, n) for i, n in enumerate(longest) if n >= least_repeat),
        "longest_repeat": max(longest, default=0),
    }


def test_suffix_arrays_equal_all_pairs():
    rng = random.Random(3)
    for _ in range(150):
        texts = [" ".join(rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 30))) for _ in range(5)]
        words, starts = quality.word_numbers(texts)
        got = quality.longest_repeats(words, starts).tolist()
        assert got == [n for t in texts for n in plain_longest(t.split())]


def test_measures(documents, odd_documents):
    texts = [None, "", " a", "a\n \na\nb\na", "x # y\n\nx # y\n", "é\xa0ü é\xa0ü\x0bé\xa0ü", "\n\n", "a b c a b c"]
    texts += [r.text for r in documents.filter("length(text) < 1500").limit(40).collect()]
    got = quality.measures(texts, 4)
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == plain_measures(text, 4), text


def test_verdicts(spark):
    rng = random.Random(1)
    clean = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)) for _ in range(2)]
    passage = " ".join(clean[0].split()[:90])
    rows = [
        (1, clean[0], False, True),
        (2, " ".join(clean[0].split()[:49]), True, False),
        (3, " ".join(clean[0].split()[:50]), False, True),
        (4, f"{clean[0]} {clean[1]} {passage}", False, True),  # 20 % repeats
        (5, f"{' '.join(clean[0].split()[:200])} {passage}", True, False),  # over half repeats
        (6, f"{clean[0]} {passage}", False, False),  # 37 % repeats
        (7, f"{clean[0]} {clean[1]} {clean[1]} " * 1 + " ".join(f"u{i}" for i in range(3000)), False, False),  # 400 words again
        (8, None, True, False),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judged(df, ["doc_id"]).collect()}
    assert got == {r[0]: r[2:] for r in rows}


def test_odd_documents(odd_documents, no_documents):
    rows = quality.judged(odd_documents, ["doc_id", "text"]).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if r.text is None or len(r.text) < 1000:
            expected = plain_measures(r.text, 10)
            assert {k: r[k] for k in expected} == expected and not r.kept
    assert quality.judged(no_documents, ["doc_id"]).count() == 0


def test_covered_spans():
    assert quality.covered(np.array([2, 0, 0, 1, 0, 3, 0, 0]), np.array([0, 4, 4, 8])).tolist() == [3, 0, 3]


def test_memory_grows_with_the_words(tmp_path):
    import subprocess
    import sys

    code = "import resource; from tiffin.llm import quality; m = quality.measures(['a b ' * {n}], 10); peak = resource.getrusage(resource.RUSAGE_SELF); print(m['longest_repeat'][0], m['repeat_covered'][0], peak.ru_maxrss // 1024)"

    def run(n):
        out = subprocess.run([sys.executable, "-c", code.format(n=n)], capture_output=True, text=True, check=True, timeout=300)
        longest, cover, mb = map(int, out.stdout.split()[-3:])
        assert (longest, cover) == (2 * n - 2, 2 * n)
        return mb

    idle, small, large = run(10), run(500_000), run(2_000_000)
    assert large - idle < 600 and large - idle < 6 * (small - idle)


def test_long_repeats_equal_all_pairs():
    rng = random.Random(11)
    for words, size in ((1, 40), (2, 60), (3, 60), (30, 80)):
        part = [str(rng.randrange(words)) for _ in range(size)]
        texts = [" ".join(part + part[: size // 2] + part), "", " ".join(part), " ".join(part[::-1] + part)]
        got = quality.measures(texts, 10)
        for i, text in enumerate(texts):
            assert {k: int(v[i]) for k, v in got.items()} == plain_measures(text, 10)
