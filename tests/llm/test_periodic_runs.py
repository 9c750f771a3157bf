from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from adinsight.llm import periodic_runs as P
from adinsight.llm.queries import op11_periodic_runs


def plain_runs(w):
    """Every run, by comparing all words of every period."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    """Words with repeats inside repeats, so that runs nest, touch and overlap."""
    k, n, w = rng.randint(1, 4), rng.randint(0, 250), []
    while len(w) < n:
        if rng.random() < 0.6:
            p = [rng.randrange(k) for _ in range(rng.randint(1, 45))]
            if rng.random() < 0.3:
                p = [p[i % min(len(p), 3)] for i in range(len(p))]
            w += (p * rng.randint(1, 9))[:rng.randint(1, 9 * len(p))]
        else:
            w += [rng.randrange(3 * k) for _ in range(rng.randint(1, 30))]
    return [b"w%d" % x for x in w]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(30):
        texts = [random_words(rng) for _ in range(rng.randint(1, 8))]
        assert P.runs_of(texts) == [plain_runs(w) for w in texts]


def test_equal_hashes_do_not_make_runs(monkeypatch):
    # Hashes of four values only: nearly all contexts look equal.
    monkeypatch.setattr(P, "_joined", lambda a, b: (a * np.uint64(3) + b) & np.uint64(3))
    rng = random.Random(5)
    for _ in range(20):
        texts = [random_words(rng) for _ in range(4)]
        for got, w in zip(P.runs_of(texts), texts):
            assert set(got) <= set(plain_runs(w))


def test_a_document_of_one_long_run_and_one_of_one_word():
    w = [b"x%d" % (i % 977) for i in range(20_000)]
    assert P.runs_of([w, [], [b"a"] * 5_000, [b"a"] * 5]) == [[(0, 20_000, 977)], [], [(0, 5_000, 1)], []]


def test_runs_and_kept_text_of_edge_rows(edge_docs):
    rows = edge_docs.collect()
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in P.periodic_runs(edge_docs).collect()), key=str)
    want = []
    for r in rows:
        w = (r.text or "").encode().split()
        runs = plain_runs(w) if len(w) < 5_000 else P.runs_of([w])[0]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((r.doc_id, len(w), runs, b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    assert got == sorted(want, key=str)


def contract(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_the_registered_query_equals_brute_force(spark, tmp_path, edge_docs):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect() if r.text is None or len(r.text) < 20_000]
    rows += [(i, b" ".join(random_words(rng)).decode()) for i in range(100, 300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((contract(*r) for r in rows), key=str)


def test_empty_table(no_docs):
    assert P.periodic_runs(P.planted(no_docs)).collect() == []
