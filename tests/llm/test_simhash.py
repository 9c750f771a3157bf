from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from adinsight.llm import simhash as S
from adinsight.llm.components import components


def plain_fingerprint(text, size=4):
    w = [] if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(codes, limit):
    """Smallest index in reach of each code, by comparing all pairs."""
    codes, root = np.array(codes, np.uint64), list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes[i + 1:] ^ codes[i]) <= limit):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    return [find(i) for i in range(len(codes))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_components_equal_brute_force(edge_docs):
    rows = edge_docs.collect()
    got = {(r.doc_id, r.fp): r.component_id for r in S.near_duplicates(edge_docs).collect()}
    codes = [plain_fingerprint(r.text) for r in rows]
    assert S.near_duplicates(edge_docs).count() == len(rows)
    roots = classes(codes, 4)
    least = {}
    for r, c in zip(rows, roots):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert got == {(r.doc_id, signed(f)): least.get(c) for r, f, c in zip(rows, codes, roots)}


@pytest.mark.parametrize("split, limit", [(20_000, 4), (3, 4), (3, 2)])
def test_links_lose_no_pair(spark, monkeypatch, split, limit):
    monkeypatch.setattr(S, "SPLIT_GROUP", split)
    monkeypatch.setattr(S, "QUERIES_AT_ONCE", 37)
    rng = random.Random(split + limit)
    codes = [rng.getrandbits(64) for _ in range(120)] + [0]
    for _ in range(500):  # chains of near codes, some dense
        c = rng.choice(codes)
        for _ in range(rng.randint(1, 5)):
            c ^= 1 << rng.randrange(64)
        codes.append(c)
    codes = sorted(set(codes))
    df = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    found = {r.node: r.root for r in components(S.links(df, limit)).collect()}
    want = classes(codes, limit)
    group = lambda keys: sorted(sorted(i for i, k in enumerate(keys) if k == x) for x in set(keys))
    assert group([found.get(signed(c), signed(c)) for c in codes]) == group(want)


def test_one_of_each_keeps_one_row_and_all_columns(edge_docs):
    out = S.one_of_each(edge_docs)
    assert out.columns == edge_docs.columns
    rows = edge_docs.collect()
    codes = [plain_fingerprint(r.text) for r in rows]
    roots = classes(codes, 4)
    kept = out.collect()
    assert len(kept) == len(set(roots))
    for c in set(roots):
        ids = [r.doc_id for r, x in zip(rows, roots) if x == c]
        least = min((i for i in ids if i is not None), default=None)
        assert sum(k.doc_id == least and plain_fingerprint(k.text) in {f for f, x in zip(codes, roots) if x == c}
                   for k in kept) == 1


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 500 for k in range(500, 560)}}


def test_empty_table(no_docs):
    assert S.near_duplicates(no_docs).collect() == [] and S.one_of_each(no_docs).collect() == []


def test_more_bits_than_the_blocks_promise_are_refused(no_docs):
    with pytest.raises(ValueError):
        S.near_duplicates(no_docs, max_bits=5)
