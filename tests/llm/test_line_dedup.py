from __future__ import annotations

from collections import defaultdict

import pytest

from adinsight.llm import line_dedup as L
from adinsight.llm import queries
from tests.conftest import SF_ORACLE, duck


def brute(rows, least):
    sites, first = defaultdict(set), {}
    for r in rows:
        for p, line in enumerate((r.text or "").split("\n")):
            if line.strip(L.BLANKS):
                if r.source is not None:
                    sites[line.strip(L.BLANKS)].add(r.source)
    return {k for k, v in sites.items() if len(v) >= least}


@pytest.mark.parametrize("errors", [4, 1e9])  # with all lines near the threshold, too
def test_spread_lines_are_exact(spark, monkeypatch, errors):
    if errors > 4:
        monkeypatch.setattr(L, "ERRORS", 1e9)
    rows = [(k * 100 + s, f"line on {k} sites\n own {k} {s} \n\n", f"site{s}") for k in range(1, 15) for s in range(k)]
    rows += [(9000 + i, "line on 2 sites\nline on 3 sites", None) for i in range(20)]  # no site
    rows += [(9100 + i, "line on 4 sites", "site0") for i in range(20)]  # often, few sites
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in L.remove_spread_lines(docs, min_sites=5).collect()}
    spread = brute(docs.collect(), 5)
    assert {f"line on {k} sites" for k in range(5, 15)} == spread
    for doc_id, text, _ in rows:
        lines = text.split("\n")
        first = min((i for i, t, _ in rows if lines[0] in t.split("\n")), default=None)
        keep = [x for x in lines if x.strip(L.BLANKS) not in spread or doc_id == first]
        assert out[doc_id].text == "\n".join(keep) and out[doc_id].n_removed == len(lines) - len(keep)


def test_edges_keep_rows_columns_and_texts(edge_docs):
    out = L.remove_spread_lines(edge_docs)  # too few sites: nothing goes
    assert out.columns == [*edge_docs.columns, "n_lines", "n_removed"]
    assert sorted(map(str, out.select(edge_docs.columns).collect())) == sorted(map(str, edge_docs.collect()))
    assert {r.n_removed for r in out.collect()} == {0}


def test_repeats_in_one_document_and_equal_rows(spark):
    rows = [(1, "x\ny\nx", "a"), (1, "x\ny\nx", "a"), (2, "x", "b"), (None, "x\nz", "c")]
    out = L.remove_spread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=3)
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == [("1", "x\ny"), ("1", "x\ny"), ("2", ""), ("None", "z")]


def test_empty_table(no_docs):
    assert L.remove_spread_lines(no_docs).collect() == []


def test_query_equals_its_sql(spark):
    got = sorted(map(tuple, queries.op3_line_dedup(spark, SF_ORACLE).collect()))
    assert got == sorted(duck(SF_ORACLE).sql(queries.oracle_sql()["op3_line_dedup"]).fetchall())


def test_plan_has_no_python(spark):
    plan = queries.op3_line_dedup(spark, SF_ORACLE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
