from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from adinsight.llm import substring_dedup as S


def brute(rows, size):
    """(n_words, spans, kept) of each row, by counting windows as tuples."""
    each = [[] if t is None else t.encode().split() for _, t in rows]
    count = Counter(tuple(w[i:i + size]) for w in each for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, each):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((doc_id, len(w), sum(gone), kept))
    return sorted(out, key=str)


def got(docs, size):
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text)
                   for r in S.remove_repeats(docs, size).collect()), key=str)


@pytest.mark.parametrize("chunk, bucket", [(4_000_000, 2_000_000), (20_000, 500)])
def test_equals_brute_force_on_edges(monkeypatch, edge_docs, chunk, bucket):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "BUCKET_WINDOWS", bucket)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(edge_docs, 5) == brute(rows, 5)


def test_equals_brute_force_on_documents(sample_docs):
    rows = [(r.doc_id, r.text) for r in sample_docs.collect()]
    assert got(sample_docs, 35) == brute(rows, 35)


def test_empty_table(no_docs):
    out = S.remove_repeats(no_docs)
    assert out.columns == ["doc_id", "n_words", "spans", "kept_text"] and out.collect() == []


def test_windows_within_one_document(spark):
    text = " ".join("abcdefg") + " x " + " ".join("abcdefg")
    out = S.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string"), 7).first()
    assert [(s.start, s.end) for s in out.spans] == [(0, 7), (8, 15)] and out.kept_text == "x"


def test_rolling_hash_is_that_of_each_window():
    words = np.random.default_rng(0).integers(0, 1 << 63, 300).astype(np.uint64)
    for size in (1, 2, 5, 8, 35):
        one = S.window_hashes(words, size, S.BASES[0])
        again = [S.window_hashes(words[i:i + size], size, S.BASES[0])[0] for i in range(300 - size + 1)]
        assert one.tolist() == [int(x) for x in again]
