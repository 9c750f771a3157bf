from __future__ import annotations

import random

import numpy as np
import pytest

from adinsight.llm import minhash as M
from tests.llm.conftest import prose


def plain_set(text, size=3):
    w = [] if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)] if w else [])


def plain_classes(sets, percent=85):
    """Number of the first set in reach of each, comparing all pairs; empty sets stay alone."""
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [root(i) for i in range(len(sets))]


def expected(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    roots, least = plain_classes(sets, percent), {}
    for (i, _), c in zip(rows, roots):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, len(s), least.get(c), i == least.get(c)) for (i, _), s, c in zip(rows, sets, roots)), key=str)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return w


@pytest.mark.parametrize("block_nodes", [1_000, 7])
def test_families_of_near_copies_equal_brute_force(spark, block_nodes):
    rng, rows = random.Random(block_nodes), []
    for f in range(6):
        base = prose(50 + f, 150).split()
        # One large family with a wide spread of similarities, and chains.
        for _ in range(120 if f == 0 else 25):
            base = edited(rng, base, 1) if f % 2 else base
            rows.append((len(rows), " ".join(edited(rng, base, rng.randint(0, 14)))))
    rows += [(len(rows) + k, prose(900 + k, rng.randint(1, 60))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, M.near_duplicates(docs, block_nodes=block_nodes).collect()), key=str)
    assert got == expected(rows)
    assert len({r[2] for r in got}) > 60  # not all in one component


def test_edge_rows_and_real_rows(edge_docs, sample_docs):
    docs = edge_docs.select("doc_id", "text").unionByName(sample_docs.select("doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    out = M.near_duplicates(edge_docs.unionByName(sample_docs, allowMissingColumns=True))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted(map(tuple, out.collect()), key=str)
    # A null id in a component without ids is its own: equal, so kept.
    want = sorted(((i, n, c, k or (i is None and c is None)) for i, n, c, k in expected(rows)), key=str)
    empty = {i for i, t in rows if not plain_set(t)}
    assert [g for g in got if g[1]] == [w for w in want if w[1]]
    assert sorted(g[0] for g in got if not g[1] and g[0] is not None) == sorted(i for i in empty if i is not None)
    assert all(g[0] == g[2] and g[3] for g in got if not g[1])


def test_every_pair_under_the_signature_distance_shares_a_key(spark):
    rng = np.random.default_rng(4)
    rows, k = [], M.CHUNKS * M.WIDTH
    for i in range(300):
        a = rng.integers(0, 1 << 16, k, dtype=np.uint16)
        b = a.copy()
        b[rng.permutation(k)[:M.MAX_DIFFERENCES]] ^= 1
        rows += [(2 * i, *a.view(np.int64).tolist()), (2 * i + 1, *b.view(np.int64).tolist())]
    keyed = spark.createDataFrame(rows, ", ".join(["node long", *(f"{s} long" for s in M.SIGNATURE)])) \
                 .select("node", M._keys().alias("k")).select("node", "k.key")
    met = keyed.alias("a").join(keyed.alias("b"), "key").filter("a.node + 1 = b.node AND a.node % 2 = 0")
    assert met.selectExpr("a.node").distinct().count() == 300


def test_signature_is_independent_of_blocks_and_near_for_near_sets(monkeypatch):
    a = M.shingle_set(prose(1, 5_000), 3)
    whole = M.signature(a)
    monkeypatch.setattr(M, "HASHES_AT_ONCE", 17)
    assert (M.signature(a) == whole).all()
    x, y = M.signature(a[:2_000]), M.signature(a[150:2_000])
    assert (x.view(np.uint16) != y.view(np.uint16)).sum() <= M.MAX_DIFFERENCES


def test_threshold_is_exact():
    a = np.arange(20, dtype=np.uint64)
    assert M._jaccard_at_least(a, a[:17], 85) and not M._jaccard_at_least(a, a[:16], 85)
    assert M._jaccard_at_least(a[:17], a, 85)


def test_empty_table(no_docs):
    assert M.near_duplicates(no_docs).collect() == []
