from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from adinsight.llm import quality_rules as Q
from adinsight.llm import queries
from adinsight.llm.common import crc_fold, table
from tests.conftest import SF_ORACLE

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    twice = [False] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            twice[i:i + 5] = [True] * 5
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(twice))


def rows_of(df):
    return sorted((str(r.row.doc_id), r.row.text or "", r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in df.collect())


def test_counts_equal_brute_force(edge_docs, sample_docs):
    for docs in (edge_docs, sample_docs):
        want = sorted((str(r.doc_id), r.text or "", *brute(r.text)) for r in docs.collect())
        assert rows_of(Q.with_counts(docs)) == want


def test_columns_are_carried_and_base_rule_decides(edge_docs):
    out = Q.judged(edge_docs, [])
    assert out.select("row.*").columns == edge_docs.columns
    for r in out.collect():
        n, _, _, _, rep = brute(r.row.text)
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n) and r.kept == (not r.base_failed)


def test_empty_table(no_docs, spark):
    assert Q.judged(no_docs, []).collect() == []
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.learn(Q.labelled_rows(no_docs, labels)) == []


def test_a_known_list_is_learned():
    rows = [({"a": float(i % 50), "b": float(i % 7)}, int(i % 50 > 39 or (i % 7 == 0 and i % 50 < 10))) for i in range(3000)]
    rules = Q.learn(rows)
    judge = lambda x: any(all(c.holds(x) for c in r) for r in rules)
    assert sum(judge(x) == bool(y) for x, y in rows) / len(rows) > 0.98 and len(rules) <= 4


def test_expression_equals_the_list(sample_docs):
    rules = [(Q.Condition("symbols a word", True, 0.05),), (Q.Condition("words", False, 60.0), Q.Condition("word length", True, 4.0))]
    names = Q.features()
    out = Q.judged(sample_docs, rules).select("base_failed", "kept", *[c.alias(f) for f, c in names.items()])
    for r in out.collect():
        x = {f: r[f] for f in names}
        assert r.kept == (not r.base_failed and not any(all(c.holds(x) for c in rule) for rule in rules))


def test_labels_with_nulls_repeats_and_unknown_values(spark, sample_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 0), (4, 7), (6, 0)], "doc_id long, quality int")
    assert sorted(y for _, y in Q.labelled_rows(sample_docs, labels)) in ([0, 1], [0], [1])


def test_held_out_documents_are_judged_well(spark):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    rules = Q.learn(Q.labelled_rows(docs, labels.filter(crc_fold(F.col("doc_id"), 3) != 0)))
    held = labels.filter(crc_fold(F.col("doc_id"), 3) == 0)
    out = Q.judged(docs.join(held, "doc_id"), rules).select("row.quality", "kept").collect()
    good, bad = [r.kept for r in out if r.quality], [r.kept for r in out if not r.quality]
    assert sum(good) / len(good) > 0.95 and 1 - sum(bad) / len(bad) > 0.85


def test_query_uses_no_python(spark):
    plan = queries.op10_quality_rules(spark, SF_ORACLE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
