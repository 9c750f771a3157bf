from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from adinsight.llm import lm as M
from adinsight.llm.common import crc_fold, table
from tests.conftest import SF_ORACLE


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*low.encode().split(), None]


def base(rows):
    """(n_tokens, n_known, base score) per row and the training tokens, by counting."""
    c = Counter()
    for _, t, train in rows:
        if train:
            c.update(words(t))
    n = sum(c.values())
    low = n + 0.1 * (len(c) + 1)
    return [(i, len(words(t)), sum(c[w] > 0 for w in words(t)), sum(math.log10((c[w] + 0.1) / low) for w in words(t)))
            for i, t, _ in rows], n


def compare(docs, training):
    rows = [(r.doc_id, r.text, r.train) for r in docs.withColumn("train", training).collect()]
    want, n = base(rows)
    got = M.score_texts(docs, training).collect()
    key = lambda x: (str(x[0]), x[1], round(x[3], 4))
    got_rows = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got), key=key)
    for a, b in zip(got_rows, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9)
    assert {r.train_tokens for r in got} == {n}
    return got


def test_counts_on_edges(monkeypatch, edge_docs):
    monkeypatch.setattr(M, "CHUNK_BYTES", 50_000)
    monkeypatch.setattr(M, "BUCKET_BYTES", 50_000)
    got = compare(edge_docs, crc_fold(F.col("doc_id"), 10) != 0)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    equal = [r.score for r in got if r.doc_id == 1]
    assert len(equal) == 2 and math.isclose(*equal, rel_tol=1e-5)


def test_no_training_rows(edge_docs):
    got = compare(edge_docs, F.lit(False))
    assert all(math.isfinite(r.score) for r in got)


def test_empty_table(no_docs):
    assert M.score_texts(no_docs, F.lit(True)).collect() == []


def test_model_beats_the_base_score_on_held_out_texts(spark):
    docs = table(spark, SF_ORACLE, "documents")
    held = {r.doc_id for r in docs.filter(crc_fold(F.col("doc_id"), 10) == 0).collect()}
    got = [r for r in M.score_texts(docs, crc_fold(F.col("doc_id"), 10) != 0).collect() if r.doc_id in held]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.7 * len(got)


def encoded(spark, rows):
    """Documents as numbers: (doc_id, row, train, word numbers)."""
    return spark.createDataFrame([(i, r, t, np.array(x, np.uint16).tobytes()) for i, r, t, x in rows],
                                 "doc_id long, row long, train boolean, ids binary")


def test_every_training_document_gives_a_gradient(spark):
    """Also alone in its table; equal rows count as often as they are there."""
    v = vocabulary()
    rows = [(i, 100 + i, i != 3, [i, 5, 9, M.HEAD + i]) for i in range(6)] + [(1, 101, True, [1, 5, 9, M.HEAD + 1])] * 3
    dealt = M.training_rows(encoded(spark, rows)).collect()
    assert sorted((r.doc_id, r.copy) for r in dealt) == [(0, 0), (1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (4, 0), (5, 0)]
    for i in range(6):
        assert (M.fit(encoded(spark, rows[i:i + 1]), v) != M.Gru(v).flat()).any() == (i != 3)


def test_scores_do_not_depend_on_how_files_are_cut(spark, monkeypatch, sample_docs):
    monkeypatch.setattr(M, "GROUP_TOKENS", 9_000)  # several groups
    docs = sample_docs.select("doc_id", "text")
    training = crc_fold(F.col("doc_id"), 10) != 0
    one, eight = ({r.doc_id: r.score for r in M.score_texts(docs.repartition(n), training).collect()} for n in (1, 8))
    assert one.keys() == eight.keys()
    assert all(math.isclose(one[k], eight[k], rel_tol=1e-6) for k in one)


def test_equal_rows_are_dealt_to_many_chunks(spark):
    docs = spark.createDataFrame([(7, "the same few words over and over " * 12)] * 3_000, "doc_id long, text string")
    got = M.score_texts(docs, F.lit(True)).collect()
    assert len(got) == 3_000 and {r.train_tokens for r in got} == {3_000 * 85}
    assert len({r.base_score for r in got}) == 1 and max(r.score for r in got) - min(r.score for r in got) < 1e-2
    chunk = F.pmod(F.xxhash64(F.xxhash64("doc_id", "text"), F.monotonically_increasing_id()), F.lit(16))
    assert docs.select(chunk.alias("c")).distinct().count() == 16


def plain_score(model, v, keys, counts, n, distinct):
    """The log10 probability of one text, a word at a time in double precision."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, total, k = np.zeros(M.HIDDEN), 0.0, M.HIDDEN
    for key, c in zip(keys, counts):
        i = int(v.ids(np.array([key]))[0])
        e = h @ model.class_w + model.class_b
        cls = i // M.MEMBERS if i < M.HEAD else i - M.HEAD + M.HEAD // M.MEMBERS
        total += (e[cls] - np.log(np.exp(e).sum())) / M.LOG10
        if i < M.HEAD:
            m = h @ model.member_w[cls] + model.member_b[cls]
            total += (m[i % M.MEMBERS] - np.log(np.exp(m).sum())) / M.LOG10
        else:
            total += math.log10((c + 0.1) / (v.tail_n[i - M.HEAD] + 0.1 * (v.tail_v[i - M.HEAD] + 1)))
        x, g = model.inputs[i].astype(float), h @ model.recurrent
        z, r = sigmoid(x[:k] + g[:k]), sigmoid(x[k:2 * k] + g[k:2 * k])
        h = z * h + (1 - z) * np.tanh(x[2 * k:] + r * g[2 * k:])
    return total


def test_model_scores_equal_a_word_by_word_model(spark, monkeypatch, sample_docs):
    kept = {}
    fit = M.fit
    monkeypatch.setattr(M, "fit", lambda e, v: kept.setdefault("w", (v, fit(e, v)))[1])
    training = crc_fold(F.col("doc_id"), 10) != 0
    docs = sample_docs.select("doc_id", "text")
    got = {r.doc_id: r.score for r in M.score_texts(docs, training).collect()}
    v, w = kept["w"]
    model, rows = M.Gru(v).load(w), docs.withColumn("t", training).collect()
    c = Counter()
    for r in rows:
        if r.t:
            c.update(M.keys_of([r.text])[0].tolist())
    for r in rows[:12]:
        keys = M.keys_of([r.text])[0]
        want = plain_score(model, v, keys, [c[int(k)] for k in keys], v.n, v.v)
        assert math.isclose(got[r.doc_id], want, rel_tol=1e-4)


def test_keys_tell_words_apart_and_share_tails():
    texts = ["one two  three\nthree", None, "", "  ", "é x ONE", "three"]
    keys, sizes = M.keys_of(texts)
    assert sizes.tolist() == [5, 1, 1, 1, 4, 2]
    each = np.split(keys, np.cumsum(sizes)[:-1])
    assert each[0][2] == each[0][3] == each[5][0] and each[4][2] == each[0][0]
    assert len(set(keys.tolist())) == 6 and {int(x[-1]) for x in each} == {int(M.END)}
    a, b = M.keys_of(["alone stone"])[0][:2]
    assert a % M.TAILS == b % M.TAILS and a != b


def test_the_registered_query(spark):
    from adinsight.llm.queries import op5_lm_scoring
    import zlib
    got = op5_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    rows = table(spark, "/root/testdata/sf0.001", "documents").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)


def test_streams_hold_every_word():
    for sizes in ([1], [3, 60], [65], [100, 27], [640], [500, 1, 210]):
        n = sum(sizes)
        texts = np.split(np.arange(n), np.cumsum(sizes)[:-1])
        ids, start = M.streams_of(texts)
        assert set(ids.ravel()) == set(range(n)) and ids.size < n + M.TRAIN_LANES
        assert (np.diff(ids, axis=0) == 1).all() and set(ids[start]) == {x[0] for x in texts}


def vocabulary():
    rng = np.random.default_rng(3)
    keys = rng.choice(1 << 40, 300, replace=False).astype(np.uint64)
    counts = np.sort(rng.integers(1, 1000, 300))[::-1]
    return M.Vocabulary(keys, counts, rng.integers(1, 50, M.TAILS), rng.integers(1, 9, M.TAILS), 10_000, 500)


def test_probabilities_of_all_words_sum_to_one():
    v = vocabulary()
    model = M.Gru(v)
    rng = np.random.default_rng(0)
    for n in model.NAMES:
        if n != "member_b":
            getattr(model, n)[...] += rng.normal(0, 0.3, getattr(model, n).shape)
    h = rng.normal(0, 1, (1, M.HIDDEN)).astype(np.float32)
    ids = np.r_[np.arange(len(v.keys)), M.HEAD + np.arange(M.TAILS)]
    p = np.exp(model.log_probs(np.repeat(h, len(ids), 0), ids))
    assert abs(p.sum() - 1) < 1e-3  # a tail class holds its words, seen and unseen, whole


def test_gradients_equal_differences():
    v = vocabulary()
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 300, (6, 3))
    ids[2] = M.HEAD + 5
    new = np.zeros(ids.shape, bool)
    new[0] = True
    new[3, 1] = True

    def loss(flat):
        model = M.Gru(v)
        at = 0
        for n in model.NAMES:  # double precision
            x = getattr(model, n)
            setattr(model, n, flat[at:at + x.size].reshape(x.shape))
            at += x.size
        h, total = np.zeros((3, M.HIDDEN)), 0.0
        for t in range(len(ids)):
            h = np.where(new[t][:, None], 0, h)
            total -= model.log_probs(h, ids[t]).sum()
            h = model.step(h, ids[t])[0]
        return total / ids.size

    start = M.Gru(v)
    start.class_w[...] = rng.normal(0, 0.3, start.class_w.shape)
    start.member_w[...] = rng.normal(0, 0.3, start.member_w.shape)
    before = start.flat().astype(np.float64)
    M.TRAIN_STEPS, kept = 6, M.TRAIN_STEPS
    try:
        trained = M.Gru(v).load(before)
        trained.train(ids, new)
    finally:
        M.TRAIN_STEPS = kept
    # One Adagrad step moves each weight by RATE * g / sqrt(1e-6 + g * g).
    moved = (before.astype(np.float32) - trained.flat()) / M.RATE
    g = moved * 1e-3 / np.sqrt(np.maximum(1 - np.minimum(moved * moved, 1 - 1e-7), 1e-7))
    for k in rng.choice(np.flatnonzero((np.abs(moved) > 0.05) & (np.abs(moved) < 0.9)), 40, replace=False):
        step = np.zeros_like(before)
        step[k] = 1e-5
        real = (loss(before + step) - loss(before - step)) / 2e-5
        assert math.isclose(g[k], real, rel_tol=0.05, abs_tol=2e-5)


def test_lanes_score_as_one_text_at_a_time():
    model = M.Gru(vocabulary())
    rng = np.random.default_rng(2)
    model.class_w[...] = rng.normal(0, 0.5, model.class_w.shape)
    texts = [np.r_[rng.integers(0, 300, n), M.HEAD + 3] for n in (0, 5, 700, 1, 130, 64, 63)]
    got = model.score(np.concatenate(texts), np.array([len(t) for t in texts]))
    for t, s in zip(texts, got):
        h, total = np.zeros((1, M.HIDDEN), np.float32), 0.0
        for i in t:
            total += model.log_probs(h, np.array([i]))[0]
            h = model.step(h, np.array([i]))[0]
        assert math.isclose(total, s, rel_tol=1e-4)


def test_shortcuts_of_scoring_change_no_bit():
    rng = np.random.default_rng(3)
    model = M.Gru(vocabulary())
    model.load(model.flat() + rng.normal(0, 0.5, model.flat().size).astype(np.float32))
    h, ids = rng.uniform(-1, 1, (300, M.HIDDEN)).astype(np.float32), rng.integers(0, 8, 300)
    for one, other in zip(model.step(h, ids), model.step(h, ids, model.halved())):
        assert (one == other).all()
    assert model.calm()
    assert (model.log_probs(h, ids) == model.log_probs(h, ids, calm=True)).all()
    model.class_w[:, 1] += 100
    assert not model.calm()
    assert np.isfinite(model.log_probs(np.ones_like(h), ids)).all()


def test_few_lanes_wait_for_more_steps(monkeypatch):
    """A long text beside short ones is scored in full blocks, not in one for every few steps."""
    model = M.Gru(vocabulary())
    texts = [np.arange(n) % 300 for n in (5000, 40, 3)]
    sizes, calls = np.array([len(t) for t in texts]), []
    log_probs = M.Gru.log_probs
    monkeypatch.setattr(M.Gru, "log_probs", lambda self, h, ids, *a, **k: calls.append(len(ids)) or log_probs(self, h, ids, *a, **k))
    got = model.score(np.concatenate(texts), sizes)
    assert sum(calls) == sizes.sum() and len(calls) <= 2
    monkeypatch.setattr(M, "STEPS", 1)
    monkeypatch.setattr(M, "LANES", 1)  # a block for every word
    assert np.allclose(got, model.score(np.concatenate(texts), sizes), rtol=1e-6)
