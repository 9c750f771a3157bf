"""Substring dedup: Rabin-Karp hashes of every word window, counted in Spark.

Every window of ``window`` consecutive words of one document gets a rolling
hash.  Documents are dealt into chunks of a few MB.  A chunk sorts the hashes of
its windows, keeps each once (with a mark if the chunk itself holds it twice)
and sends them, packed, to hash buckets: a hot window sends one entry per chunk,
not one per row.  A bucket counts the hashes of all chunks and answers each
chunk with one bit per hash.  The chunks then merge their repeated windows into
maximal removal intervals.

The window key is a 64-bit hash plus a bucket number taken from a second,
independent hash.  The number of buckets follows the input, so a bucket always
holds about ``BUCKET_WINDOWS`` keys and the share of windows that could be
mistaken for repeated stays near ``BUCKET_WINDOWS / 2**64`` at every size.

Defined results: a null or empty text has no words and gives ``n_words`` 0, no
spans and an empty ``kept_text``; texts shorter than the window lose nothing;
rows with equal ids and texts are separate documents and repeat each other; an
empty table gives an empty result; other columns are ignored.  The documents must
be the same each time they are read, as files are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import parts, text_bytes, words

CHUNK_BYTES = 4_000_000
BUCKET_WINDOWS = 2_000_000
#: Bytes a word takes on average (with its separator), to size the buckets.
WORD_BYTES = 6
#: Odd multipliers of the two rolling hashes, modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Distinct words a task remembers the hash of before it starts anew.
MEMO_WORDS = 200_000

RESULT = ("doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept_text string")


class WordHashes(dict):
    """Word to 64-bit hash, remembering up to ``MEMO_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, text_words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, text_words), np.uint64, len(text_words))


_memo = WordHashes()


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def window_hashes(word_hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash of every run of ``size`` values, modulo 2**64, by Horner's rule."""
    n = len(word_hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Doubling: the hash of 2k words is that of k words shifted, plus the next k.
    pw = [pow(base, 1 << b, 1 << 64) for b in range(size.bit_length())]
    out, have, block, length = None, 0, word_hashes, 1
    for b in range(size.bit_length()):
        if size >> b & 1:
            out = block if out is None else (
                out[: len(out) - length] * np.uint64(pw[b]) + block[have:])
            have += length
        if size >> (b + 1):
            block = block[: len(block) - length] * np.uint64(pw[b]) + block[length:]
            length *= 2
    x = out[:n].copy()
    x ^= x >> np.uint64(33)  # a polynomial's low bits see few of the words' bits
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return x


class Chunk:
    """The words and window hashes of the documents of one chunk, in a fixed order."""

    def __init__(self, group: pa.Table, size: int, buckets: int):
        rows = sorted(zip(group["doc_id"].to_pylist(), group["text"].to_pylist()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        self.ids = [r[0] for r in rows]
        self.words = [words(r[1]) for r in rows]
        hashes, self.windows = [], []
        second = []
        for w in self.words:
            wh = _memo.of(w)
            h = window_hashes(wh, size, BASES[0])
            hashes.append(h)
            second.append(window_hashes(wh, size, BASES[1]))
            self.windows.append(len(h))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        bucket = np.concatenate(second) % np.uint64(buckets) if second else self.hashes
        order = np.lexsort((self.hashes, bucket))
        h, b = self.hashes[order], bucket[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
        rank = np.cumsum(new) - 1
        #: For each window the number of its key among the chunk's keys.
        self.key_of = np.empty(len(h), np.int64)
        self.key_of[order] = rank
        self.keys, self.key_bucket = h[new], b[new]
        self.twice = np.bincount(rank, minlength=len(self.keys)) > 1 if len(h) else new

    def by_bucket(self) -> Iterator[tuple[int, int, int]]:
        """(bucket, first key, end key) of each bucket that has keys."""
        starts = np.flatnonzero(np.r_[True, self.key_bucket[1:] != self.key_bucket[:-1]]) \
            if len(self.keys) else np.empty(0, np.int64)
        for a, z in zip(starts, [*starts[1:], len(self.keys)]):
            yield int(self.key_bucket[a]), int(a), int(z)


def spans_of(repeated: np.ndarray, n_words: int, size: int) -> list[tuple[int, int]]:
    """Maximal intervals of words covered by the windows marked ``repeated``."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return []
    cover = np.zeros(n_words + 1, np.int64)
    cover[at] += 1
    cover[at + size] -= 1
    inside = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per document of ``docs`` (doc_id, text) its words, removal intervals and kept words.

    ``spans`` are half-open word intervals; ``kept_text`` joins the other words
    by one space.
    """
    total = text_bytes(docs)
    n_chunks = parts(total, CHUNK_BYTES)
    buckets = parts(total // WORD_BYTES, BUCKET_WINDOWS)
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
    )
    # Equal rows go to different chunks; which chunk a row is in does not show in the results.
    # The deal is made twice, over the same files in the same order.
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(n_chunks)))

    def send(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        c = Chunk(group, window, buckets)
        out = [(b, key[0].as_py(), c.keys[a:z].tobytes(), np.packbits(c.twice[a:z]).tobytes())
               for b, a, z in c.by_bucket()]
        cols = list(zip(*out)) or [[]] * 4
        return pa.table({"bucket": pa.array(cols[0], pa.int64()), "chunk": pa.array(cols[1], pa.int64()),
                         "hashes": pa.array(cols[2], pa.binary()), "twice": pa.array(cols[3], pa.binary())})

    def count(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        chunks = group["chunk"].to_pylist()
        each = [np.frombuffer(x.as_py(), np.uint64) for x in group["hashes"]]
        ends = np.cumsum([len(x) for x in each])
        keys = np.concatenate(each)
        twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(k)).astype(bool)
                                for x, k in zip(group["twice"], each)])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        repeated = twice
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        out = [(c, key[0].as_py(), np.packbits(m).tobytes())
               for c, m in zip(chunks, np.split(repeated, ends[:-1])) if m.any()]
        cols = list(zip(*out)) or [[]] * 3
        return pa.table({"chunk": pa.array(cols[0], pa.int64()), "bucket": pa.array(cols[1], pa.int64()),
                         "repeated": pa.array(cols[2], pa.binary())})

    def apply(group: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(group, window, buckets)
        marks = dict(zip(answers["bucket"].to_pylist(), answers["repeated"].to_pylist()))
        repeated = np.zeros(len(c.keys), bool)
        for b, a, z in c.by_bucket():
            if b in marks:
                if len(marks[b]) != (z - a + 7) // 8:
                    raise RuntimeError("the documents changed between two reads")
                repeated[a:z] = np.unpackbits(np.frombuffer(marks[b], np.uint8), count=z - a)
        in_doc = np.split(repeated[c.key_of], np.cumsum(c.windows)[:-1]) if c.windows else []
        spans, kept = [], []
        for w, marked in zip(c.words, in_doc):
            cuts = spans_of(marked, len(w), window)
            left, at = [], 0
            for a, z in cuts:
                left += w[at:a]
                at = z
            kept.append(b" ".join(left + w[at:]).decode())
            spans.append([{"start": a, "end": z} for a, z in cuts])
        return pa.table({
            "doc_id": pa.array(c.ids, pa.int64()),
            "n_words": pa.array([len(w) for w in c.words], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept_text": pa.array(kept, pa.string())})

    sent = dealt.groupBy("chunk").applyInArrow(
        send, "bucket long, chunk long, hashes binary, twice binary")
    answers = sent.groupBy("bucket").applyInArrow(count, "chunk long, bucket long, repeated binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(apply, RESULT)
