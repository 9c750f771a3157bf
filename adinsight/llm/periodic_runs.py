"""Periodic run detection with string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) and a length of at least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` that no
neighbouring word extends.  Documents are worked off a batch at a time, whole.

At scale t (4, 8, 16, ... words) a position is selected if, among the hashes of
the t-word windows beginning in the t + 1 positions from it on, the least is that
of the first or the last.  The choice depends on the next 2t words only, so equal
contexts are selected alike, and every stretch of t positions holds a selected one
unless the words around it have a period of at most t/4.  In a run of period q,
t <= q < 2t, a selected position among the first t words therefore meets its next
equal context exactly q words on: neighbouring equal contexts propose the period,
their overlapping spans are joined and grown word by word to the whole run.

Windows of period at most t/4 are not hashed (they would be selected everywhere
or nowhere).  They are exactly the stretches inside the runs of the scales below;
the periods under the smallest scale are found separately, by comparing words 1,
2 and 3 apart, so no small period is missed.

Words are compared as numbers given out by a dictionary, so equality is exact; a
proposed run is checked word by word.  Work per document is n log n, memory that of
a batch of ``BATCH_WORDS`` words or one document.

Defined results: a null or empty text has no words, no runs and an empty
``kept_text``; runs never go across documents; rows with equal ids or texts are
documents of their own; a null id is returned as such; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import words, words_column

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Periods below the smallest scale, compared directly.
SMALL_PERIODS = (1, 2, 3)
FIRST_SCALE = 4
BATCH_WORDS = 200_000

RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text string"
_NONE = ~np.uint64(0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the window made of two neighbouring windows."""
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + (right ^ np.uint64(0xA0761D6478BD642F)))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` + 1 neighbours; ``width`` is a power of two."""
    m, have = x, 1
    while have < width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:-1], m[1:]) if width == 1 else np.minimum(m[:len(x) - width], x[width:])


class Runs:
    """The runs of exponent ``MIN_EXPONENT`` or more of several documents laid end to end."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        self.symbols, self.sizes = symbols, sizes
        self.stop = np.repeat(np.cumsum(sizes), sizes)           # where each position's document ends
        self.first = np.repeat(np.cumsum(sizes) - sizes, sizes)  # and begins
        self.found: dict[tuple[int, int], int] = {}              # (begin, end) -> smallest period

    def _note(self, lo: int, hi: int, period: int) -> None:
        # A smaller period of the same stretch was found at a smaller scale.
        if hi - lo >= MIN_EXPONENT * period:
            self.found.setdefault((lo, hi), period)

    def small(self) -> None:
        """Runs of the periods below the smallest scale."""
        for p in SMALL_PERIODS:
            if len(self.symbols) <= p:
                break
            same = (self.symbols[:-p] == self.symbols[p:]) & (self.stop[:-p] == self.stop[p:])
            edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
            lo, hi = edge[::2], edge[1::2] + p
            for i in np.flatnonzero(hi - lo >= MIN_EXPONENT * p):
                self._note(int(lo[i]), int(hi[i]), p)

    def scales(self) -> None:
        """Runs of all larger periods, scale by scale."""
        name, t = _mixed(self.symbols.astype(np.uint64) + np.uint64(1)), 1
        at, sizes, stop = np.arange(len(name)), self.sizes, self.stop
        while True:
            if t >= FIRST_SCALE:
                # A period of t or more needs a document of MIN_EXPONENT * t words.
                large = sizes >= MIN_EXPONENT * t
                if not large.all():
                    keep = np.repeat(large, sizes)
                    name, at, sizes = name[keep[:len(name)]], at[keep], sizes[large]
                    stop = np.repeat(np.cumsum(sizes), sizes)
            if len(stop) < 2 * t or len(sizes) == 0 or sizes.max() < MIN_EXPONENT * max(t, FIRST_SCALE):
                return
            context = _joined(name[:len(stop) - 2 * t + 1], name[t:len(stop) - t + 1])
            if t >= FIRST_SCALE:
                self._scale(t, name, context, at, stop)
            name, t = context, 2 * t

    def _scale(self, t: int, name: np.ndarray, context: np.ndarray, at: np.ndarray, stop: np.ndarray) -> None:
        n = len(stop)
        name = name[:n - t + 1].copy()
        name[self._periodic(t, at, n)[:len(name)]] = _NONE
        least = _least(name, t)  # over the windows beginning at i .. i + t
        here = np.arange(len(context))
        least, last = least[:len(here)], name[t:t + len(here)]
        chosen = here[((name[:len(here)] == least) | (last == least)) & (least != _NONE) & (here + 2 * t <= stop[:len(here)])]
        order = np.argsort(context[chosen], kind="stable")  # equal contexts by position
        a, b = chosen[order[:-1]], chosen[order[1:]]
        gap = b - a
        proposed = (context[a] == context[b]) & (stop[a] == stop[b]) & (gap >= t) & (gap < 2 * t)
        a, gap = a[proposed], gap[proposed]
        if not len(a):
            return
        order = np.lexsort((a, gap))
        a, gap = a[order], gap[order]
        # Spans a .. a + gap + 2t of one period are one if they share a period.
        new = np.flatnonzero(np.r_[True, (gap[1:] != gap[:-1]) | (a[1:] > a[:-1] + 2 * t)])
        last = np.r_[new[1:], len(a)] - 1
        lo, hi = at[a[new]], at[a[last]] + gap[new] + 2 * t
        for i, p in enumerate(gap[new].tolist()):
            for span in self._grown(int(lo[i]), int(hi[i]), p, t):
                self._note(*span, p)

    def _periodic(self, t: int, at: np.ndarray, n: int) -> np.ndarray:
        """Which windows of ``t`` words have a period of at most ``t / 4``."""
        spans = [(lo, hi) for (lo, hi), p in self.found.items() if 4 * p <= t <= hi - lo]
        if not spans:
            return np.zeros(n, bool)
        lo, hi = np.array(spans).T
        i = np.minimum(np.searchsorted(at, lo), n - 1)
        here = at[i] == lo  # the others lie in documents too short for this scale
        i, size = i[here], (hi - lo)[here]
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, i, 1)
        np.add.at(step, i + size - t + 1, -1)
        return np.cumsum(step[:-1]) > 0

    def _grown(self, lo: int, hi: int, p: int, t: int) -> list[tuple[int, int]]:
        """The whole stretches of period ``p`` around lo .. hi, by comparing words."""
        w, begin, end = self.symbols, int(self.first[lo]), int(self.stop[lo])
        same = w[lo:hi - p] == w[lo + p:hi]
        if not same.all():  # two hashes were equal by chance: look at the document itself
            same = np.concatenate([[False], w[begin:end - p] == w[begin + p:end], [False]])
            edge = np.flatnonzero(same[1:] != same[:-1]) + begin
            return [(int(x), int(z) + p) for x, z in zip(edge[::2], edge[1::2])]
        while lo > begin:
            c = max(begin, lo - t)
            differ = np.flatnonzero(w[c:lo] != w[c + p:lo + p])
            if len(differ):
                lo = c + int(differ[-1]) + 1
                break
            lo = c
        while hi < end:
            c = min(end, hi + t)
            differ = np.flatnonzero(w[hi:c] != w[hi - p:c - p])
            if len(differ):
                hi += int(differ[0])
                break
            hi = c
        return [(lo, hi)]


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each document (a list of words), by start, then period."""
    numbers, fresh = {}, count()
    sizes = np.array([len(w) for w in texts], np.int64)
    symbols = np.fromiter((numbers.setdefault(x, next(fresh)) for w in texts for x in w), np.int64, int(sizes.sum()))
    r = Runs(symbols, sizes)
    r.small()
    r.scales()
    first = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (lo, hi), p in sorted(r.found.items()):
        if hi - lo >= MIN_LENGTH:
            d = int(np.searchsorted(first, lo, "right")) - 1
            while not sizes[d]:  # empty documents begin where their successor does
                d -= 1
            out[d].append((lo - int(first[d]), hi - lo, p))
    return [sorted(x, key=lambda run: (run[0], run[2])) for x in out]


def collapsed(text_words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stay when each run keeps its first period only, joined by one space."""
    if not runs:
        return b" ".join(text_words)
    drop = np.zeros(len(text_words), bool)
    for start, length, period in runs:
        drop[start + period:start + length] = True
    return b" ".join([w for w, gone in zip(text_words, drop.tolist()) if not gone])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, kept_text`` for every row of ``docs`` (doc_id, text).

    ``runs`` are ordered by start, then period; ``kept_text`` has the words left
    when each run is cut down to its first period.
    """
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_of(texts)
        listed = pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in found], pa.list_(kind))
        kept = pa.array([collapsed(w, r) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()), listed, kept],
            ["doc_id", "n_words", "runs", "kept_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for b in batches:
            for i, text in zip(b["doc_id"], b["text"]):
                ids.append(i.as_py())
                texts.append(words(text.as_py()))
                held += len(texts[-1])
                if held >= BATCH_WORDS:
                    yield result(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield result(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, RESULT)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period (compared exactly); ties go to the earliest, then the smallest period."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in a tenth of the documents, by a hash of the id, the words from one place on repeat.

    With h the CRC-32 of the decimal id and g = h div 10, a text of n words with
    10 | h has its word i >= a replaced by word a + (i - a) mod p, where a is
    g mod n and p is 1 + (n - a) div (3 + g mod 8).  A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"), h.alias("h"))
    w = F.when(F.col("chosen"), words_column(F.col("text")))
    held = chosen.withColumn("w", w).withColumn("n", F.size("w").cast("long")).withColumn("g", F.expr("h div 10"))
    held = held.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    held = held.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0L, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return held.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), again).otherwise(F.col("text")).alias("text"))
