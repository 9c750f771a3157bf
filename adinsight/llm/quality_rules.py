"""Quality rules: a learned decision list over counts of the text.

Sequential covering on labelled rows: each rule is a conjunction of thresholds
on interpretable statistics, grown one condition at a time by information gain
on one part of the rows and pruned from its end on the other.  Rows a rule
covers are set aside and the next rule is learned from the rest.  The list
becomes one ordered Spark conditional expression; the first rule that holds
rejects.

Counting and judging use DataFrame functions only.  The list is learned on the
driver from at most ``MAX_ROWS`` labelled rows (those with the smallest hash of
their id); counts and verdicts cover every row.

Defined results: a null or empty text has all counts 0, fails the base rule and
is not kept; ids and other columns may be null and are carried unchanged;
repeated rows each get their verdict; with no labels, or labels of one kind
only, the list is empty and the base rule alone decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import words_column

#: The symbols counted and the window of repeated words.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

#: Labelled rows the list is learned from, at most.
MAX_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: A rule must be right for this share of the rows that prune it ...
MIN_PRECISION = 0.8
#: ... and cover this many bad rows.
MIN_COVER = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


def with_counts(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``) and the ``COUNTS`` of its ``text``.

    n_words, word_chars: words and the code points in them; n_symbols:
    characters of ``SYMBOLS``; n_dup_lines: lines with a word that equal an
    earlier one; n_repeat_words: words in windows of five words found twice or
    more in the text; n_lines: lines with a word; n_upper, n_marks: capital
    letters, and characters that are neither letters, digits nor white space.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    without = lambda pattern: (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    one = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", words_column(text).alias("words"), lines.alias("lines"), without(SYMBOLS).alias("n_symbols"),
        without("\\p{Lu}").alias("n_upper"), without("[^\\p{L}\\p{N}\\s]").alias("n_marks"))
    two = one.select(
        "row", "n_symbols", "n_upper", "n_marks", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # One hash per window, by the place of its first word.
    windows = F.slice(F.transform("hashes", lambda h, i: F.xxhash64(
        h, *[F.get("hashes", i + k) for k in range(1, WINDOW)])), 1, F.greatest(F.col("n_words") - WINDOW + 1, F.lit(0)).cast("int"))
    kept = ["row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_marks"]
    three = two.select(*kept, windows.alias("windows"))
    # Few texts repeat a window; only those sort theirs.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    four = three.select(*kept, F.when(repeats, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("sorted"))
    near = lambda x, i: (x["h"] == F.get("sorted", i - 1)["h"]) | (x["h"] == F.get("sorted", i + 1)["h"])
    five = four.select(*kept, F.sort_array(F.filter(F.transform(
        "sorted", lambda x, i: F.when(near(x, i), x["i"])), lambda p: p.isNotNull())).alias("at"))
    # A repeated window adds the words up to the next one, at most its own.
    added = F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW))))
    n = F.coalesce(F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    # A generator, because a filter on its output is not moved below it: moved
    # through the steps above, a test of n_repeat_words would repeat all of them.
    return five.select(F.inline(F.array(F.struct(
        "row", *[n.alias(c) if c == "n_repeat_words" else F.col(c) for c in COUNTS]))))


def base_failed() -> Column:
    """The fixed rule: too few words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def _share(part: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    """What rules may test: name to expression over the counts."""
    return {
        "words": F.col("n_words").cast("double"),
        "word length": _share("word_chars", "n_words"),
        "symbols a word": _share("n_symbols", "n_words"),
        "marks a word": _share("n_marks", "n_words"),
        "capitals a character": _share("n_upper", "word_chars"),
        "repeated line share": _share("n_dup_lines", "n_lines"),
        "repeated word share": _share("n_repeat_words", "n_words"),
        "words a line": _share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    value: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.value if self.above else row[self.feature] <= self.value

    def column(self, by_name: dict[str, Column]) -> Column:
        x = by_name[self.feature]
        return x > F.lit(self.value) if self.above else x <= F.lit(self.value)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.value:.4g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: list) -> list:
    return [r for r in rows if all(c.holds(r[0]) for c in rule)]


def _best_condition(rows: list) -> Condition | None:
    """The threshold with the highest information gain for the bad rows."""
    bad = sum(r[1] for r in rows)
    before = math.log2(bad / len(rows))
    best, found = 1e-9, None
    for f in rows[0][0]:
        ranked = sorted((r[0][f], r[1]) for r in rows)
        n = p = 0
        for (x, y), (nxt, _) in zip(ranked, ranked[1:]):
            n, p = n + 1, p + y
            if x == nxt:
                continue
            for above, pp, nn in ((False, p, n), (True, bad - p, len(rows) - n)):
                if pp and (gain := pp * (math.log2(pp / nn) - before)) > best:
                    best, found = gain, Condition(f, above, (x + nxt) / 2)
    return found


def learn(rows: list[tuple[dict, int]]) -> list[Rule]:
    """A decision list from ``(features, 1 if bad)`` rows."""
    # The two parts alternate within each class, so both see every kind.
    ranked = sorted(rows, key=lambda r: (r[1], *r[0].values()))
    grow = [r for i, r in enumerate(ranked) if i % 3]
    prune = [r for i, r in enumerate(ranked) if not i % 3]
    out: list[Rule] = []

    def worth(rule: Rule) -> tuple[float, int]:
        got = _covered(rule, prune)
        bad = sum(r[1] for r in got)
        return ((2 * bad - len(got)) / len(got) if got else -1.0), bad

    while len(out) < MAX_RULES and sum(r[1] for r in grow) >= MIN_COVER:
        rule: Rule = ()
        left = grow
        while len(rule) < MAX_CONDITIONS and any(not r[1] for r in left) and (c := _best_condition(left)):
            rule += (c,)
            left = _covered(rule, grow)
        if not rule:
            break
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        value, bad = worth(rule)
        if (value + 1) / 2 < MIN_PRECISION or bad < MIN_COVER:
            break
        out.append(rule)
        grow = [r for r in grow if not all(c.holds(r[0]) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r[0]) for c in rule)]
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame) -> list[tuple[dict, int]]:
    """Features and label (1: bad) of at most ``MAX_ROWS`` labelled documents."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_ROWS))
    # At most MAX_ROWS rows of two numbers, so it is sent to every task.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id").withColumn("hash", F.xxhash64("doc_id", "text"))
    names = features()
    rows = (with_counts(joined).filter(~base_failed())
            .select(F.col("row.quality").alias("quality"), F.col("row.hash").alias("hash"), *[c.alias(f) for f, c in names.items()])
            .orderBy("hash", "quality").limit(MAX_ROWS).collect())  # ids may be repeated in the documents
    return [({f: r[f] for f in names}, 1 - r["quality"]) for r in rows]


def verdict(rules: list[Rule]) -> Column:
    """False where a rule holds, in order; True otherwise."""
    by_name, out = features(), None
    for rule in rules:
        test = None
        for c in rule:
            test = c.column(by_name) if test is None else test & c.column(by_name)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``row``, its counts, ``base_failed`` and ``kept`` for every row of ``docs`` (text and others)."""
    counted = with_counts(docs).withColumn("base_failed", base_failed())
    return counted.withColumn("kept", ~F.col("base_failed") & verdict(rules))
