from __future__ import annotations

import corpus_pipeline
from adinsight.llm import decontaminate as D
from adinsight.llm import queries
from adinsight.llm.common import cut, table
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as leaked
from tests.llm.test_line_dedup import brute as spread
from tests.llm.test_simhash import classes, plain_fingerprint
from tests.llm.test_tokens_packing import want


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "retrieval_packing"]
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        outs.append(cut(stage(spark, docs if not outs else outs[-1], SF_SMALL)))
    rows = [docs.collect(), *(o.collect() for o in outs)]
    assert all(o.columns == columns for o in outs[:-1])
    # 1: exactly what the operator's query keeps
    kept = {r.doc_id for r in queries.op10_quality_rules(spark, SF_SMALL).filter("kept").collect()}
    assert {r.doc_id for r in rows[1]} == kept and len(rows[1]) < len(rows[0])
    # 2: every document; spread lines stay once
    assert {r.doc_id for r in rows[2]} == kept
    marks = " \t\r\x0b\x0c"
    for line in spread(rows[1], 10):
        assert sum(x.strip(marks) == line for r in rows[2] for x in r.text.split("\n")) == 1
    assert all(r.n_chars == len(r.text) for r in rows[2])
    # 3: the smallest id of each class
    roots = classes([plain_fingerprint(r.text) for r in rows[2]], 4)
    least = {}
    for r, c in zip(rows[2], roots):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in rows[3]) == sorted(least.values())
    # 4: without the leaked ones
    bad = {d for d, _, _ in leaked(rows[3], table(spark, SF_SMALL, "benchmark").collect(), D.MIN_COVERAGE)}
    assert bad and {r.doc_id for r in rows[4]} == {r.doc_id for r in rows[3]} - bad
    # 5: every token of what is left
    assert sum(r.length for r in rows[5]) == sum(len(want(r.text)) + 1 for r in rows[4])
    again = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.doc_tokens) for r in again} == {(r.doc_id, r.doc_tokens) for r in rows[5]}
    assert sum(r.length for r in again) == sum(r.length for r in rows[5])


def test_stages_on_odd_rows_and_clashing_columns(spark, edge_docs):
    more = edge_docs.selectExpr("*", "77 AS n_lines", "doc_id AS `a.b`", "'x' AS others", "5 AS n_removed")
    whole = set(more.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = cut(stage(spark, more, SF_SMALL))
        assert out.columns == more.columns, name
        rows = out.collect()
        for r in rows:
            assert r.n_lines == 77 and r.n_removed == 5 and r.others == "x" and r["a.b"] == r.doc_id and r["odd name"] == "o", name
            if name != "line_dedup":
                assert r in whole, name
            else:
                assert r.n_chars == (None if r.text is None else len(r.text))
        if name in ("line_dedup", "benchmark_decontamination"):
            assert len(rows) == more.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, more, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == more.select("doc_id").distinct().count()


def test_stages_on_an_empty_table(spark, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_SMALL).collect() == [], name
