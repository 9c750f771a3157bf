"""Lexical retrieval packing: each document's window is filled with its BM25 neighbours.

Documents are dealt into shards of a few MB by a hash, and each shard has its
own inverted index of all its terms.  A seed asks the index of its own shard: this
bounds the work per document, but the neighbours it gets are those among a few MB
of the corpus (README.md gives the recall against one index over everything).
Terms are told apart by 44 bits of their hash.  Document frequencies and the mean
length are those of the whole corpus; the frequencies are a count-min sketch of
fixed size (two rows, the smaller count holds), summed by Spark and sent to every
task, so a rare term may be taken for a more frequent one in its weight only.

In a shard the first unused document is the seed; the unused neighbours its index
returns fill its window one after the other.  One that does not fit is cut, and
what is left of it opens the next window, with itself as the seed.  So only a
shard's last window can stay open; it is cut into sequences whose lengths are
powers of two and need no padding.

Defined results: a null or empty text is the end id alone; equal rows are
separate documents and spread over the shards (which shard a row is in follows
from its place in the files, too); the string of a special token in a text is
that token's id; an empty table gives an empty result; ids may be null and other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import hashed_words, parts
from adinsight.llm.tokens import PieceEncoder, encoder

WINDOW = 1024
END_ID = 0
#: Strings of special tokens and their ids, recognised inside texts.
SPECIAL = {"<|endoftext|>": 50256}
SHARD_BYTES = 4_000_000
#: Bytes of text that the groups of one task hold, about.
TASK_BYTES = 32_000_000
#: Bits of a term's hash that tell it apart, and texts that are numbered beside them.
TERM_BITS, TEXTS_NUMBERED = 44, 1 << 18
#: Counts in a row of the sketch (a power of two), and those in one row of the table that is summed.
SKETCH, BLOCK = 1 << 18, 1 << 12
#: A term in one document of a shard in so many, or more, has a row of weights.
ROW_SHARE = 8
#: Texts whose terms are counted at once.
TEXTS_AT_ONCE = 500
#: Texts are encoded this many characters at a time.
CHARS_AT_ONCE = 2_000_000
K1, B = 1.2, 0.75

RESULT = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences), one entry per distinct term (word, A-Z lower-cased) of each text, in order."""
    out = []
    for first in range(0, max(len(texts), 1), TEXTS_NUMBERED):
        each = [t.encode().lower() if t else b"" for t in texts[first:first + TEXTS_NUMBERED]]
        ends = np.cumsum([len(x) + 1 for x in each])
        hashes, at = hashed_words(b"\n".join(each))
        term, text = (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64), np.searchsorted(ends, at, side="right")
        both, n = np.unique(text << TERM_BITS | term, return_counts=True)
        out.append(((both >> TERM_BITS) + first, both & ((1 << TERM_BITS) - 1), n))
    return tuple(np.concatenate(x) for x in zip(*out))


def _bins(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a term is counted in each row of the sketch: by bits of their own."""
    return term & (SKETCH - 1), (term >> (TERM_BITS // 2)) & (SKETCH - 1)


@dataclass
class Frequencies:
    """Document frequencies of the corpus as a count-min sketch, its documents, their mean length and all bytes."""

    sketch: np.ndarray  # 2 x SKETCH
    documents: int
    mean: float
    bytes: int

    def df(self, term: np.ndarray) -> np.ndarray:
        one, two = _bins(term)
        return np.minimum(self.sketch[0][one], self.sketch[1][two])

    def idf(self, term: np.ndarray) -> np.ndarray:
        df = self.df(term)
        return np.log1p(np.maximum(self.documents - df + 0.5, 0.5) / (df + 0.5))


def corpus_counts(docs: DataFrame) -> Frequencies:
    """The frequencies of all terms in all ``docs`` (text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, length, size = np.zeros((2, SKETCH), np.int64), 0, 0, 0
        for b in batches:
            size += sum(pc.binary_length(b["text"]).drop_null().to_numpy().tolist())
            for at in range(0, b.num_rows, TEXTS_AT_ONCE):
                texts = b["text"].slice(at, TEXTS_AT_ONCE).to_pylist()
                _, term, f = terms(texts)
                for row, bins in zip(total, _bins(term)):
                    row += np.bincount(bins, minlength=SKETCH)
                n, length = n + len(texts), length + int(f.sum())
        if n:
            blocks = total.reshape(-1, BLOCK)
            full = np.flatnonzero(blocks.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([*full.tolist(), -1]),
                 pa.array([*(blocks[i].tobytes() for i in full), np.array([n, length, size]).tobytes()], pa.binary())],
                ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most 2 * SKETCH / BLOCK + 1 blocks
        for b in batches:
            for block, counts in zip(b["block"].to_pylist(), b["counts"]):
                x = np.frombuffer(counts.as_py(), np.int64)
                sums[block] = sums[block] + x if block in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["block", "counts"])

    schema = "block long, counts binary"
    summed = (docs.select("text").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema)).collect()
    sketch, n, length, size = np.zeros((2 * SKETCH // BLOCK, BLOCK), np.int64), 0, 0, 0
    for r in summed:  # a block is in one partition
        x = np.frombuffer(r["counts"], np.int64)
        if r["block"] < 0:
            n, length, size = x.tolist()
        else:
            sketch[r["block"]] = x
    return Frequencies(sketch.reshape(2, SKETCH), n, length / n if n else 1.0, size)


class ShardIndex:
    """BM25 inverted index over the documents of one shard, with document removal."""

    def __init__(self, texts: list[str | None], corpus: Frequencies):
        doc, term, f = terms(texts)
        n = np.bincount(doc, minlength=len(texts))
        norm = K1 * (1 - B + B * np.bincount(doc, f, len(texts)) / max(corpus.mean, 1e-9))
        distinct, place = np.unique(term, return_inverse=True)
        weight = corpus.idf(distinct)[place] * f * (K1 + 1) / (f + norm[doc])
        # A document's query: all its distinct terms.
        self.query = np.split(place, np.cumsum(n)[:-1])
        by_term = np.argsort(place, kind="stable")
        self.doc, self.weight = doc[by_term], weight[by_term]
        self.df = np.bincount(place, minlength=1)
        self.first = np.cumsum(self.df) - self.df
        # Frequent terms have a row each, at most ROW_SHARE times their entries.
        frequent = self.df * ROW_SHARE >= len(texts)
        self.row = np.where(frequent, np.cumsum(frequent) - 1, -1)
        self.rows = np.zeros((int(frequent.sum()), len(texts)), np.float32)
        own = frequent[place]
        self.rows[self.row[place[own]], doc[own]] = weight[own]
        self.unused = np.ones(len(texts), bool)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the query of ``seed``."""
        k = self.query[seed]
        row = self.row[k]
        score = self.rows[row[row >= 0]].sum(0, dtype=np.float64)
        k = k[row < 0]
        df = self.df[k]
        at = np.repeat(self.first[k] - (np.cumsum(df) - df), df) + np.arange(df.sum())
        return score + np.bincount(self.doc[at], self.weight[at], minlength=len(score))

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused documents that share a term with ``seed``, best first; those of equal scores by place."""
        score = np.where(self.unused, self.scores(seed), 0.0)
        while score[best := int(score.argmax())] > 0:
            yield best
            score[best] = 0.0


def token_ids(enc: PieceEncoder, texts: list[str | None]) -> list[np.ndarray]:
    """Ids of each text (int32), special tokens recognised: what stands between them is encoded apart."""
    ids = enc.encode(texts)
    for i, t in enumerate(texts):
        if t and any(s in t for s in SPECIAL):
            parts = re.split("(" + "|".join(map(re.escape, SPECIAL)) + ")", t)
            each = enc.encode(parts[::2])
            marks = [np.array([SPECIAL[m]], np.int32) for m in parts[1::2]]
            ids[i] = np.concatenate([x for pair in zip(each, [*marks, marks[0][:0]]) for x in pair])
    return ids


def filling_order(index: ShardIndex, sizes: list[int], window: int) -> Iterator[int]:
    """The documents in the order in which they fill windows."""
    free, next_seed = 0, 0
    seed = None
    while True:
        if seed is None:
            while next_seed < len(sizes) and not index.unused[next_seed]:
                next_seed += 1
            if next_seed == len(sizes):
                return
            seed = next_seed
            index.unused[seed] = False
            yield seed
            free = (free - sizes[seed]) % window
        cut_one = None
        for d in index.neighbours(seed) if free else ():
            index.unused[d] = False
            yield d
            if sizes[d] >= free:
                cut_one = d if sizes[d] > free else None
                free = (free - sizes[d]) % window
                break
            free -= sizes[d]
        seed = cut_one


def sequence_lengths(total: int, window: int) -> Iterator[int]:
    """Whole windows, then powers of two."""
    for _ in range(total // window):
        yield window
    left = total % window
    for b in reversed(range(window.bit_length())):
        if left >> b & 1:
            yield 1 << b


def pack(docs: DataFrame, ranks_path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in sequences: one row per piece.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers;
    a document is its text's ids and ``END_ID``.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Two rows of SKETCH numbers, whatever the input.
    corpus = corpus_counts(texts)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    shards = parts(corpus.bytes, SHARD_BYTES)

    def fill(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        rows = sorted(zip(group["doc_id"].to_pylist(), group["text"].to_pylist()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        enc, ids, part, chars = encoder(ranks_path), [], [], 0
        for n, (_, t) in enumerate(rows):
            part.append(t)
            chars += len(t or "")
            if chars >= CHARS_AT_ONCE or n == len(rows) - 1:
                ids += [np.append(x, END_ID).astype("<u4") for x in token_ids(enc, part)]
                part, chars = [], 0
        sizes = [len(x) for x in ids]
        index = ShardIndex([t for _, t in rows], shared.value)
        out = []
        lengths = sequence_lengths(sum(sizes), window)
        seq, at, room = shard << 32, 0, next(lengths, 0)
        for d in filling_order(index, sizes, window):
            start = 0
            while start < sizes[d]:
                take = min(room - at, sizes[d] - start)
                out.append((rows[d][0], start, take, ids[d][start:start + take].tobytes(), sizes[d], seq, at))
                start, at = start + take, at + take
                if at == room:
                    seq, at, room = seq + 1, 0, next(lengths, 0)
        cols = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.table({c: pa.array(v, k) for c, v, k in zip(names, cols, kinds)})

    shard = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(shards))
    return (texts.withColumn("shard", shard).repartition(parts(corpus.bytes, TASK_BYTES), "shard")
            .groupBy("shard").applyInArrow(fill, RESULT))
