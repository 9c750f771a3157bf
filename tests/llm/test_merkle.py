from __future__ import annotations

import hashlib
import zlib

import pytest

from adinsight.llm import merkle as M


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    out = b""
    for v in (r.doc_id, r.source, r.lang, r.n_chars, text):
        x = None if v is None else str(v).encode()
        out += b"-" if x is None else str(len(x)).encode() + b":" + x
    return hashlib.sha256(out).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i // 3 * 3
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + 3])))
        i //= 3
    return out


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {s: tree([leaf(r, r.text) for r in by[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            proof = siblings(trees[s], i) + siblings(top, k)
            changed = r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            x = leaf(r, r.text.replace("\n", "") if changed else r.text)
            for left, right in proof:
                x = sha(left + x + right)
            root = top[-1][0]
            out.append((r.doc_id, leaf(r, r.text), trees[s][-1][0], root, sha("".join(a + b for a, b in proof)), x, x == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_equals_a_tree_built_in_one_place(spark, sample_docs, edge_docs, depth):
    docs = sample_docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        edge_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    rows = docs.collect()
    got = sorted(map(tuple, M.manifest(docs, depth).collect()), key=str)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n, sources", [(1, 1), (2, 2), (3, 1), (9, 1), (10, 1), (28, 1), (40, 40)])
def test_sizes_around_whole_superblocks(spark, n, sources):
    rows = [(i, f"line {i}\nend", "en", f"s{i % sources}", i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, M.manifest(docs, 2).collect()), key=str) == plain_manifest(docs.collect())


def test_extra_and_clashing_columns_are_ignored(spark, edge_docs):
    more = edge_docs.selectExpr("*", "1 AS grp", "2 AS at", "'x' AS node", "'y' AS tampered", "3 AS block", "4 AS row_id")
    assert sorted(map(tuple, M.manifest(more).collect()), key=str) == plain_manifest(edge_docs.collect())


def test_a_proof_fails_for_every_other_leaf(spark):
    docs = spark.createDataFrame([(i, "t", None, "a" if i % 3 else "b", 1) for i in range(30)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    # Text without line feeds: nothing is tampered with, all verify.
    assert all(r.verified for r in M.manifest(docs, 1).collect())
    path = [{"left": "x", "right": ""}, {"left": "", "right": "y"}]
    assert M.folded("a", path) == sha(sha("xa") + "y") != M.folded("b", path)


def test_empty_table(no_docs):
    assert M.manifest(no_docs).collect() == []
