from __future__ import annotations

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adinsight.llm import token_counts as T
from adinsight.llm.queries import ranks_path
from adinsight.llm.tokens import encoder

tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
tokenizer.encode_special_tokens = True
PRE = T.PreTokens(ranks_path())


def n_tokens(text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def apply(text, start, removed, inserted):
    start = min(max(start or 0, 0), len(text))
    return text[:start] + (inserted or "") + text[start + max(removed or 0, 0):]


chars = st.text(alphabet=st.sampled_from("ab'sterlvdm 9\n\t \u00a0\x1cé漢.,-"), max_size=120)
edits = st.lists(st.tuples(st.integers(-2, 130), st.integers(0, 40), chars), max_size=6)


@settings(max_examples=400, deadline=None)
@given(chars, edits, st.sampled_from([1, 2, 32]))
def test_counts_equal_encoding_anew(text, steps, leaf):
    kept, T.LEAF_PIECES = T.LEAF_PIECES, leaf
    try:
        tree = T.trees_of([text], encoder(ranks_path()), PRE)[0]
        assert tree.tokens == n_tokens(text)
        for e in steps:
            text = apply(text, *e)
            tree.edit(*e)
            assert "".join(tree.texts) == text and tree.length == len(text) and tree.tokens == n_tokens(text)
    finally:
        T.LEAF_PIECES = kept


def test_an_edit_encodes_its_region_only():
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = T.trees_of([text], encoder(ranks_path()), PRE)[0]
    tree.edit(60_000, 5, "other")
    assert tree.encoded < 1_500 and tree.tokens == n_tokens(apply(text, 60_000, 5, "other"))
    big = " more" * 5_000
    tree.edit(10, 0, big)  # more than a leaf holds
    assert tree.tokens == n_tokens(apply(apply(text, 60_000, 5, "other"), 10, 0, big))


def test_edges(edge_docs, no_docs):
    odd = F.array(F.struct(F.lit(3).alias("start"), F.lit(100).alias("removed"), F.lit(" x").alias("inserted")),
                  F.lit(None).cast("struct<start: int, removed: int, inserted: string>"),
                  F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("removed"), F.lit(None).cast("string").alias("inserted")),
                  F.struct(F.lit(1_000_000).alias("start"), F.lit(-4).alias("removed"), F.lit("end").alias("inserted")))
    docs = edge_docs.withColumn("edits", F.when(F.col("doc_id") != 2, odd)).withColumn("counts", F.lit("clash"))
    out = T.count_edited(docs, ranks_path())
    got = sorted(((str(r.doc_id), r.tokens_before, r.counts) for r in out.collect()), key=str)
    want = []
    for r in docs.collect():
        text, after = r.text or "", []
        n = n_tokens(text)
        for e in r.edits or ():
            text = apply(text, *(e or (0, 0, "")))
            after.append(n_tokens(text))
        want.append((str(r.doc_id), n, after))
    assert got == sorted(want, key=str)
    assert "odd name" in out.columns and "text" not in out.columns
    assert T.count_edited(no_docs.withColumn("edits", odd), ranks_path()).collect() == []


def test_edits_from_a_table(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, "left alone"), (None, "no id")], "doc_id long, text string")
    rows = spark.createDataFrame([(1, 2, 0, 0, "B"), (1, 1, 0, 4, "A")], "doc_id long, seq int, start long, removed long, inserted string")
    got = {r.doc_id: r.counts for r in T.count_edited(T.attach_edits(docs, rows), ranks_path()).collect()}
    assert got == {1: [n_tokens("A text"), n_tokens("BA text")], 2: [], None: []}


def test_sampled_edits_on_documents(sample_docs):
    docs = sample_docs.withColumn("edits", T.sample_edits(F.col("doc_id"), F.col("text")))
    got = {r.doc_id: (r.tokens_before, r.counts[-1]) for r in T.count_edited(docs, ranks_path()).collect()}
    for r in docs.collect():
        text = r.text
        for e in r.edits:
            text = apply(text, *e)
        assert got[r.doc_id] == (n_tokens(r.text), n_tokens(text))
