"""Toxicity: a weighted finite-state grammar over clauses, with learned insults.

Weighted transducers are composed, the first over letters, the others over the
word classes it writes (insult, harm, intent, target, negation, report, quotes,
end of clause):

* insult: reads the letters of a word; the weights of its arcs add up to the
  learned weight of the best stem on the way, and a word of any weight is an insult;
* threat: an intent word soon followed by a harm word becomes a threat;
* negation: an insult or threat soon after a negation loses weight;
* reported speech: so does one after a verb of saying, to the clause's end, or
  between quotes that open and close in one paragraph;
* target: one in a clause that names a person or group gains weight.

Words of the other transducers' classes keep them: negations, verbs of saying,
intents and targets are never insults, a harm word may be one besides.  Clauses
end at their marks and at line ends, paragraphs at blank lines.  A clause scores
the sum of its insults and threats at the weights left by the composed
transducer.  A logistic function of the clause scores of a text (sum, sum per
word, best clause, number) is its score.

The insult transducer's stems are learned: beginnings of words (and whole
words) with their log rate ratio between toxic and other labelled texts.  The
stems are learned from one half of the labelled rows and the logistic function
from the other, so that stems seen by chance carry no weight.  Both use at most
``MAX_ROWS`` labelled rows, those with the smallest hash of their id; scores
cover every row and whole texts.  Language, source and id are no inputs.

Defined results: a null or empty text has no clause and gets the score of a text
without matches; repeated rows score alike; without toxic labels nothing
matches and all scores are the share of toxic labels (0 without labels); an
empty table gives an empty result; ids may be null; other columns are carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows learned from, at most.
MAX_ROWS = 20_000
MAX_STEMS = 2_000
STEM_LETTERS = range(4, 9)
#: A stem needs this log rate ratio, and this many toxic texts or this share of them.
MIN_RATIO, MIN_TEXTS, MIN_TEXT_SHARE = 1.5, 4, 0.004
MEMO_WORDS = 200_000

CLASSES = range(11)
OTHER, INSULT, HARM, INTENT, TARGET, NEGATION, REPORT, OPEN, CLOSE, END, THREAT = CLASSES

#: Fixed word classes of the grammar.
WORD_CLASSES = {
    HARM: "kill hurt destroy beat burn murder punish töten verletzen schlagen tuer frapper détruire matar golpear destruir",
    INTENT: "will gonna going shall must should werde wirst soll vais va veux doit voy vas quiero debe",
    TARGET: "you your yours he she him her they them their du dich dein ihr euch sie tu te toi vous ils elles tú ti usted ustedes ellos",
    NEGATION: "not no never none without isn't aren't don't nicht kein keine nie ohne pas jamais aucun sans nunca sin jamás",
    REPORT: "said says say wrote claimed called reported quoted sagte sagt schrieb nannte dit écrit appelé dijo dice escribió llamó",
}
#: Tokens after a negation, or between intent and harm, that still count.
NEAR = 3
#: Log weights of the transducers' arcs.
NEGATED, REPORTED, TARGETED = math.log(0.3), math.log(0.5), math.log(1.5)
THREAT_WEIGHT = 2.0
FEATURES = 4


class Transducer:
    """Deterministic weighted transducer over word classes: (state, class) to (state, class, log weight)."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def then(self, other: "Transducer") -> "Transducer":
        """Composition: ``other`` reads what this one writes; weights add up."""
        start = (self.start, other.start)
        arcs, todo = {}, [start]
        while todo:
            a, b = state = todo.pop()
            for c in CLASSES:
                if (a, c) not in self.arcs:
                    continue
                a2, out, w = self.arcs[a, c]
                b2, out2, w2 = other.arcs[b, out]
                if (state, c) not in arcs:
                    arcs[state, c] = ((a2, b2), out2, w + w2)
                    if not any(((a2, b2), k) in arcs for k in CLASSES):
                        todo.append((a2, b2))
        return Transducer(start, arcs)

    def run(self, classes: list[int]) -> Iterator[tuple[int, float]]:
        state = self.start
        for c in classes:
            state, out, w = self.arcs[state, c]
            yield out, w


def _countdown(on: int, changed) -> Transducer:
    """After class ``on``, for ``NEAR`` words, arcs are those of ``changed(class)``."""
    arcs = {}
    for s in range(NEAR + 1):
        for c in CLASSES:
            nxt = NEAR if c == on else 0 if c == END else max(0, s - 1)
            arcs[s, c] = (nxt, *(changed(c) if s else (c, 0.0)))
    return Transducer(0, arcs)


def _speech() -> Transducer:
    """Reported speech: from a verb of saying to the clause's end, or between quotes."""
    arcs = {}
    for s in range(3):  # outside, after a verb, in quotes
        for c in CLASSES:
            nxt = 2 if c == OPEN else 0 if c == CLOSE or (c == END and s == 1) else 1 if c == REPORT and s == 0 else s
            arcs[s, c] = (nxt, c, REPORTED if s and c in (INSULT, THREAT) else 0.0)
    return Transducer(0, arcs)


def _target() -> Transducer:
    arcs = {}
    for s in range(2):
        for c in CLASSES:
            nxt = 1 if c == TARGET else 0 if c == END else s
            arcs[s, c] = (nxt, c, TARGETED if s and c in (INSULT, THREAT) else 0.0)
    return Transducer(0, arcs)


def grammar() -> Transducer:
    threat = _countdown(INTENT, lambda c: (THREAT, 0.0) if c == HARM else (c, 0.0))
    negation = _countdown(NEGATION, lambda c: (c, NEGATED if c in (INSULT, THREAT) else 0.0))
    return threat.then(negation).then(_speech()).then(_target())


QUOTES = "\"“”«»„"
OPENING, CLOSING, ENDING = (frozenset(x) for x in ("\"“«„", "\"”»“", ".!?;:"))
_STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„…’‘"


def bare_word(token: str) -> str:
    """A token without marks around it, lower-cased, with plain apostrophes."""
    return token.strip(_STRIP).lower().replace("’", "'")


def stems_of(bare: str) -> list[str]:
    """Beginnings of a word, and the word itself marked as whole."""
    return [bare[:k] for k in STEM_LETTERS if k <= len(bare)] + [bare + "$"]


class Insults:
    """Weighted transducer over letters: the arcs of a word add up to the best stem that begins it.

    States are the beginnings of stems; an arc's weight is what its letter adds
    to the best stem so far.  ``$`` ends a word.  A letter without an arc leaves
    the stems: no later letter adds anything.
    """

    def __init__(self, stems: dict[str, float]):
        self.arcs: dict[tuple[int, str], tuple[int, float]] = {}
        states, best = {"": 0}, [0.0]
        for stem in sorted({s[:k] for s in stems for k in range(1, len(s) + 1)}, key=len):
            before = states[stem[:-1]]
            states[stem] = len(best)
            best.append(max(best[before], stems.get(stem, 0.0)))
            self.arcs[before, stem[-1]] = (states[stem], best[-1] - best[before])

    def weight(self, bare: str) -> float:
        state, total = 0, 0.0
        for letter in bare + "$":
            if (state, letter) not in self.arcs:
                break
            state, w = self.arcs[state, letter]
            total += w
        return total


class Reader(dict):
    """Token to its classes with their weights, and whether it opens or closes a quote or ends a clause."""

    def __init__(self, stems: dict[str, float]):
        self.insults = Insults(stems)
        self.fixed = {w: c for c, ws in WORD_CLASSES.items() for w in ws.split()}
        self.machine = grammar()

    def __missing__(self, token: str) -> tuple:
        if len(self) >= MEMO_WORDS:
            self.clear()
        bare = bare_word(token)
        cls = self.fixed.get(bare, OTHER)
        weight = self.insults.weight(bare) if cls in (OTHER, HARM) else 0.0
        classes = ((INSULT, weight),) if weight > 0 and cls == OTHER else \
            ((HARM, 0.0), (INSULT, weight)) if weight > 0 else ((cls, 0.0),)
        closing = token.rstrip(".,;:!?")[-1:]
        out = self[token] = (classes, token[:1] in OPENING, closing in CLOSING,
                             token.rstrip(QUOTES)[-1:] in ENDING, weight > 0 or cls == HARM)
        return out

    def symbols(self, text: str) -> list[tuple[int, float]]:
        """The classes of a text's words and marks; quotes only where they open and close in one paragraph."""
        out: list[tuple[int, float]] = []
        opened = None
        for line in text.splitlines():
            tokens = line.split()
            if not tokens:
                opened = None  # a paragraph ends
            for token in tokens:
                classes, opens, closes, ends, _ = self[token]
                if opens and closes and len(token) == 1:  # a mark alone opens or closes, as its turn is
                    opens, closes = opened is None, opened is not None
                if opens and opened is None:
                    opened = len(out)
                    out.append((OTHER, 0.0))  # becomes an opening quote once it is closed
                out += classes
                if closes and opened is not None:
                    out[opened] = (OPEN, 0.0)
                    out.append((CLOSE, 0.0))
                    opened = None
                if ends:
                    out.append((END, 0.0))
            out.append((END, 0.0))
        return out

    def clause_scores(self, text: str) -> list[float]:
        if not any(self[t][-1] for t in text.split()):
            return []
        read = self.symbols(text)
        out, clause = [], 0.0
        for (c, log_w), (_, w) in zip(self.machine.run([c for c, _ in read]), read):
            if c == INSULT:
                clause += w * math.exp(log_w)
            elif c == THREAT:
                clause += THREAT_WEIGHT * math.exp(log_w)
            elif c == END:
                out.append(clause)
                clause = 0.0
        return [x for x in [*out, clause] if x > 0]

    def features(self, text: str | None) -> list[float]:
        s = self.clause_scores(text) if text else []
        total = sum(s)
        words = len(text.split()) if s else 0
        return [math.log1p(total), math.log1p(100 * total / max(words, 20)), max(s, default=0.0), math.log1p(len(s))]


def _half(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("half")), F.lit(2))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, half, row`` (a hash of the row) of at most ``MAX_ROWS`` labelled documents."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS))
    # At most MAX_ROWS rows of two numbers, so it is sent to every task.
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id")
            .select("text", "toxic", _half("doc_id").alias("half"), F.xxhash64("doc_id", "text").alias("row")))


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Log rate ratio of the stems that mark toxic texts; ``rows`` has text and toxic."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # per stem: occurrences in other and toxic texts, and toxic texts
            n: dict[str, list[int]] = {}
            for text, toxic in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                words = Counter(map(bare_word, (text or "").split()))
                mine: Counter = Counter()
                for w, k in words.items():
                    for s in stems_of(w):
                        mine[s] += k
                mine[""] = sum(words.values())  # all words
                for s, k in mine.items():
                    c = n.setdefault(s, [0, 0, 0])
                    c[toxic] += k
                    c[2] += toxic
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n)), *(pa.array([c[i] for c in n.values()], pa.int64()) for i in range(3))],
                ["stem", "other", "toxic", "texts"])

    counts = (rows.select("text", "toxic").mapInArrow(count, "stem string, other long, toxic long, texts long")
              .groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("other", "toxic", "texts")]))
    counts = counts.filter(F.col("texts") >= MIN_TEXTS)  # half of the rare words leave here
    every = counts.filter("stem = ''").first()
    if every is None:
        return {}
    ratio = F.log((F.col("toxic") + 0.5) / F.lit(every["toxic"] + 1.0)) - F.log((F.col("other") + 0.5) / F.lit(every["other"] + 1.0))
    found = (counts.filter("stem NOT IN ('', '$')").withColumn("ratio", ratio)
             .filter((F.col("ratio") >= MIN_RATIO) & (F.col("texts") >= MIN_TEXT_SHARE * every["texts"]))
             .orderBy(F.desc(F.col("ratio") * F.col("texts")), "stem").limit(MAX_STEMS).collect())
    return {r["stem"]: float(r["ratio"]) for r in found}


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the constant) by Newton steps with a small ridge."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()) if len(y) else 0.0, 1e-6), 1 - 1e-6)
        return np.r_[np.zeros(x.shape[1]), math.log(p / (1 - p))]
    a = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (p - y) + ridge @ w)
    return w


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], list[float]]:
    """Stems and logistic weights from ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text)."""
    rows = labelled(docs, labels)
    stems = learn_stems(rows.filter("half = 0"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(stems)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([reader.features(t.as_py()) for t in b["text"]], pa.list_(pa.float64())), b["toxic"], b["row"]],
                ["x", "toxic", "row"])

    # Ids may be repeated in the documents: the rows with the smallest hashes.
    seen = (rows.filter("half = 1").select("text", "toxic", "row").mapInArrow(read, "x array<double>, toxic int, row long")
            .orderBy("row", "toxic").limit(MAX_ROWS).collect())
    x = np.array([r["x"] for r in seen], np.float64).reshape(-1, FEATURES)
    return stems, fit_logistic(x, np.array([r["toxic"] for r in seen], np.float64)).tolist()


def score(docs: DataFrame, model: tuple[dict[str, float], list[float]]) -> DataFrame:
    """``docs`` (text and others) with ``score``, in place of a column of that name."""
    carried = [c for c in docs.columns if c != "score"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
                       F.col("text").cast("string").alias("text"))
    schema = rows.select("row").schema.add("score", "double")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = Reader(model[0]), np.array(model[1])
        for b in batches:
            x = np.array([reader.features(t.as_py()) for t in b["text"]], np.float64).reshape(-1, FEATURES)
            z = np.clip(x @ weights[:-1] + weights[-1], -30, 30)
            yield pa.RecordBatch.from_arrays([b["row"], pa.array(1 / (1 + np.exp(-z)))], ["row", "score"])

    return rows.mapInArrow(read, schema).select("row.*", "score")
