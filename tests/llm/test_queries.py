"""The registered queries against their SQL, and on tables with odd rows."""

from __future__ import annotations

import hashlib
import zlib

import pytest
import xxhash

from adinsight.llm import queries as Q
from adinsight.llm.common import table
from tests.conftest import SF_SMALL, duck
from tests.llm.test_simhash import classes, plain_fingerprint


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = Q.queries()[name](spark, SF_SMALL)
    want = duck(SF_SMALL).execute(Q.oracle_sql()[name])
    assert as_rows(got.columns, got.collect()) == as_rows([c[0] for c in want.description], want.fetchall())


def test_op4_digest(spark, tmp_path, edge_docs):
    from tests.llm.test_substring_dedup import brute
    edge_docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = sorted(map(tuple, Q.op4_substring_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows, 35)), key=str)


def test_op6_digest(spark):
    from tests.llm.test_tokens_packing import want
    import numpy as np
    ids = {r.doc_id: np.array([*want(r.text), 0], "<u4") for r in table(spark, SF_SMALL, "documents").collect()}
    got = Q.op6_retrieval_packing(spark, SF_SMALL).collect()
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for r in got:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])


def test_op7_counts(spark):
    from tests.llm.test_token_counts import n_tokens
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    got = Q.op7_token_counts(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got[:80]:
        assert r.tokens_before == n_tokens(texts[r.doc_id] or "") and r.n_edits > 0


def test_op9_fingerprints_and_components(spark):
    rows = table(spark, SF_SMALL, "documents").collect()
    codes = [plain_fingerprint(r.text) for r in rows]
    roots, least = classes(codes, 4), {}
    for r, c in zip(rows, roots):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    got = sorted(map(tuple, Q.op9_simhash_near_dedup(spark, SF_SMALL).collect()))
    assert got == sorted((r.doc_id, f"{f:016x}", least[c]) for r, f, c in zip(rows, codes, roots))
    assert xxhash.xxh64_intdigest(b"a b c d", 42) == plain_fingerprint("A b  C d")
