import zlib
from collections import defaultdict

import numpy as np

from tiffin.llm.packing import hashed_projection, hilbert_keys, pack, sequences, tail_bounds, with_crc
from tiffin.llm.tokens import Encoder, tokenizer_path


def plain_ids(text):
    return [*Encoder(tokenizer_path(), whole_texts=True).whole(text or "").tolist(), 0]


def check(df, length=1024):
    texts = defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        texts[r.doc_id].append(plain_ids(r.text))
    pieces = pack(df, length).collect()
    docs = defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append((p.start, p.length, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
        assert len(p.ids) == 4 * p.length > 0
    for doc_id, made in docs.items():
        # Each id in one piece: the pieces' ids are those of the documents with that id.
        expected = sorted(x for ids in texts[doc_id] for x in ids)
        assert sorted(x for _, _, ids, _ in made for x in ids) == expected
        if len(texts[doc_id]) == 1:
            ids = texts[doc_id][0]
            assert all(got == ids[s : s + n] and total == len(ids) for s, n, got, total in made)
    assert sum(p.length for p in pieces) == sum(len(i) for t in texts.values() for i in t)
    filled = defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    sizes = []
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        sizes.append(at)
    assert all(s == length or (s < length and s & (s - 1) == 0) for s in sizes)
    assert sorted(filled) == list(range(len(filled)))
    return pieces


def test_every_id_is_packed_once(documents):
    pieces = check(documents)
    assert len({p.curve for p in pieces}) > 100


def test_odd_documents(odd_documents, no_documents):
    check(odd_documents)
    check(odd_documents, 64)
    assert pack(no_documents).count() == 0


def test_crc_and_sequences(documents):
    pieces = pack(documents)
    rows = {(r.doc_id, r.start): r for r in pieces.collect()}
    for r in with_crc(pieces).collect():
        assert r.ids_crc32 == zlib.crc32(rows[r.doc_id, r.start].ids)
    built = sequences(pieces).collect()
    assert sum(len(r.ids) for r in built) == 4 * sum(r.length for r in rows.values())


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims)
        keys = hilbert_keys((cells + 0.5) / side, bits)
        assert sorted(keys) == list(range(side**dims))
        assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_like_documents_are_near():
    a, b = np.arange(0, 400), np.arange(30_000, 30_400)
    points = hashed_projection([a, a[:390], b, np.zeros(0, int)])
    assert np.abs(points[0] - points[1]).max() < np.abs(points[0] - points[2]).max()
    assert points[3].tolist() == [0.5] * 4


def test_tail_is_cut_at_powers_of_two():
    assert tail_bounds(2048 + 700, 1024) == [2048, 2560, 2688, 2720, 2736, 2744, 2748]
    assert tail_bounds(2048, 1024) == [2048]
    assert tail_bounds(0, 1024) == [0]
