from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from adinsight.llm import toxicity as T
from adinsight.llm.common import crc_fold, table

SF_LARGE = "/root/testdata/sf0.1"  # the smaller ones have too few toxic labels to judge by

READER = T.Reader({"idiot": 4.0, "scum$": 5.0})


def total(text):
    return sum(READER.clause_scores(text))


def test_composed_grammar():
    near = lambda a, b: math.isclose(a, b, rel_tol=1e-9)
    assert total("the cat sat") == 0 and total("scummy thing") == 0
    assert near(total("such idiots here"), 4) and near(total("SCUM!"), 5)
    assert near(total("you idiot"), 4 * 1.5) and near(total("not an idiot"), 4 * 0.3)
    assert near(total("not one of the very many idiots"), 4)  # too far from the negation
    assert near(total("he said an idiot"), 4 * 1.5 * 0.5) and near(total('"an idiot" walked'), 4 * 0.5)
    assert near(total("i will kill you"), T.THREAT_WEIGHT) and total("a kill") == 0
    assert near(total("they said we will not hurt"), T.THREAT_WEIGHT * 0.3 * 0.5 * 1.5)
    assert len(READER.clause_scores("idiot. scum")) == 2
    # A clause ends what a negation, a target or a report began.
    assert near(total("you said not. idiot"), 4)


def test_quotes_lines_apostrophes_and_grammar_words():
    near = lambda a, b: math.isclose(a, b, rel_tol=1e-9)
    # A quote that is not closed in its paragraph, or not opened, is none.
    assert READER.clause_scores('" an idiot. an idiot.') == [4, 4]
    assert READER.clause_scores('a 5" idiot. an idiot.') == [4, 4]
    assert near(total('"an idiot\n\nan idiot" here'), 8) and near(total('"an idiot\nan idiot" here'), 4)
    assert near(total("« an idiot » idiot"), 4 * 0.5 + 4)
    # Lines end clauses; curly apostrophes are apostrophes.
    assert near(total("not here\nan idiot"), 4) and near(total("don’t idiot"), 4 * 0.3)
    # A stem does not take a word out of its class.
    reader = T.Reader({"idiot": 4.0, "not$": 2.0, "kill": 3.0})
    assert near(sum(reader.clause_scores("not an idiot")), 4 * 0.3)
    assert near(sum(reader.clause_scores("i will kill you")), T.THREAT_WEIGHT + 3.0)


def test_the_letter_transducer_finds_the_best_stem():
    rng = np.random.default_rng(2)
    word = lambda n: "".join(rng.choice(list("abc"), n))
    stems = {word(rng.integers(4, 9)) + "$" * int(rng.random() < 0.3): float(rng.uniform(1, 6)) for _ in range(150)}
    insults = T.Insults(stems)
    for _ in range(2_000):
        w = word(rng.integers(1, 11))
        want = max((stems[s] for s in T.stems_of(w) if s in stems), default=0.0)
        assert math.isclose(insults.weight(w), want, abs_tol=1e-12)


def plain_scores(reader, text):
    """Clause scores by looking around each word, without transducers."""
    stems = {"idiot": 4.0, "scum$": 5.0}
    clauses, clause, paragraph = [], [], []
    for line in text.splitlines():
        tokens = line.split()
        if not tokens:
            paragraph = []
        for t in tokens:
            bare = t.strip(T._STRIP).lower().replace("’", "'")
            word = {"bare": bare, "quoted": False, "open": t[0] in T.OPENING,
                    "close": t.rstrip(".,;:!?")[-1:] in T.CLOSING}
            word["class"] = next((c for c, ws in T.WORD_CLASSES.items() if bare in ws.split()), T.OTHER)
            clause.append(word)
            paragraph.append(word)
            if word["close"]:
                start = next((k for k, x in enumerate(paragraph) if x["open"]), None)
                if start is not None:
                    for x in paragraph[start:]:
                        x["quoted"] = True
                    paragraph = []
            if t.rstrip(T.QUOTES)[-1:] in T.ENDING:
                clauses.append(clause)
                clause = []
        clauses.append(clause)
        clause = []
    out = []
    for words in clauses:
        score = 0.0
        for k, x in enumerate(words):
            near = {y["class"] for y in words[max(0, k - T.NEAR):k]}
            w = max((v for s, v in stems.items() if s in T.stems_of(x["bare"])), default=0.0) if x["class"] == T.OTHER else 0.0
            if x["class"] == T.HARM and T.INTENT in near:
                w = T.THREAT_WEIGHT
            if w:
                w *= 0.3 if T.NEGATION in near else 1
                said = T.REPORT in {y["class"] for y in words[:k] if not y["quoted"]}
                w *= 0.5 if x["quoted"] or said else 1
                w *= 1.5 if T.TARGET in {y["class"] for y in words[:k]} else 1
            score += w
        out.append(score)
    return [x for x in out if x > 0]


def test_scores_equal_a_plain_reader():
    rng = np.random.default_rng(9)
    words = ["idiots", "scum", "you", "not", "said", "will", "kill", "a", "b", "they", "don’t", "hurt", "idiot.", "x;", "never", "no!"]
    for _ in range(1_500):
        text = ""
        for _ in range(rng.integers(1, 25)):
            text += str(rng.choice(words)) + str(rng.choice([" ", " ", " ", "\n", "\n\n", ". "], p=[.3, .3, .2, .08, .04, .08]))
        got, want = READER.clause_scores(text), plain_scores(READER, text)
        assert len(got) == len(want) and np.allclose(got, want), text


def test_quoted_scores_equal_a_plain_reader():
    rng = np.random.default_rng(10)
    words = ["idiots", "scum", "you", "a", "b", '"x', 'y"', "“idiot", "idiot”", "«scum", "c»", "idiot.", 'd."', "5\"", '"scum"']
    for _ in range(1_500):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", "\n", "\n\n"], p=[.86, .09, .05])) for _ in range(rng.integers(1, 25)))
        got, want = READER.clause_scores(text), plain_scores(READER, text)
        assert len(got) == len(want) and np.allclose(got, want), text


def test_composition_is_running_one_after_the_other():
    a, b = T._countdown(T.NEGATION, lambda c: (c, -1.0 if c == T.INSULT else 0.0)), T._target()
    both, rng = a.then(b), np.random.default_rng(0)
    for _ in range(50):
        classes = rng.integers(0, 10, 12).tolist()
        one = list(a.run(classes))
        two = list(b.run([c for c, _ in one]))
        assert list(both.run(classes)) == [(c2, w1 + w2) for (_, w1), (c2, w2) in zip(one, two)]


def test_edges(edge_docs, no_docs, spark):
    model = ({"same$": 3.0}, [1.0, 1.0, 0.0, 0.0, -2.0])
    out = T.score(edge_docs, model)
    assert out.columns == [*edge_docs.columns, "score"] and out.count() == edge_docs.count()
    rows = out.collect()
    none = 1 / (1 + math.exp(2.0))
    assert all(math.isclose(r.score, none) for r in rows if not (r.text or "").strip())
    assert [r.score > none for r in rows if r.doc_id == 9] == [True]
    assert T.score(no_docs, model).collect() == []
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.learn(no_docs, labels)[0] == {}


def test_one_kind_of_labels(edge_docs, spark):
    labels = spark.createDataFrame([(i, 0) for i in range(14)] + [(None, 1), (3, None), (2, 0)], "doc_id long, toxic int")
    stems, weights = T.learn(edge_docs, labels)
    assert stems == {} and all(r.score < 0.5 for r in T.score(edge_docs, (stems, weights)).collect())


def test_held_out_accuracy(spark):
    docs = table(spark, SF_LARGE, "documents").select("doc_id", "text")
    labels = table(spark, SF_LARGE, "labels")
    model = T.learn(docs, labels.filter(crc_fold(F.col("doc_id"), 5) != 0))
    held = labels.filter(crc_fold(F.col("doc_id"), 5) == 0).join(T.score(docs, model), "doc_id").collect()
    bad, good = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert sum(len(x) for x in (bad, good)) > 100
    assert sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good)) >= 0.956
    assert sum(g >= 0.5 for g in good) / len(good) < 0.05


def test_the_registered_query(spark):
    import zlib
    from adinsight.llm.queries import op1_toxicity
    rows = {r.doc_id: r for r in op1_toxicity(spark, "/root/testdata/sf0.001").collect()}
    assert sorted(rows) == sorted(r.doc_id for r in table(spark, "/root/testdata/sf0.001", "documents").collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
               for i, r in rows.items())
