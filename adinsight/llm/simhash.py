"""SimHash near-dedup with a Gray-order hierarchical index.

Each document gets a 64-bit fingerprint: bit i is 1 if it is 1 in more than half
of the XXH64 hashes of its word shingles.  Only distinct fingerprints are
searched.  They are dealt out by pairs of six bit blocks: two fingerprints that
differ in at most four bits agree in at least two of the six, so they meet under
at least one of the 15 block pairs.  A group that is still large is dealt once
more, by five blocks of the bits its key leaves open.  No pair is lost by this
and no group needs to fit a cap.

Within a partition the fingerprints of a group lie in Gray order, in which
neighbours share most bits, and runs of ``FANOUT`` form the nodes of a tree.  An
upper node holds the bits common to all below it; a lower node holds only the
common bits its parent does not have.  A query walks down adding up the
differences node by node and drops a whole group once the sum passes the limit,
or once the group is known to be in the query's component already.  A partition
passes on its linked fingerprints as stars (at most one link a row), never pairs.

Defined results: a null or empty text has no shingle and the fingerprint 0,
which links like any other; a text with fewer words than the shingle is one
shingle; equal rows share a component; a null id does not become the component
id of others while its component holds an id; an empty table gives an empty
result; other columns are ignored, or carried by ``near_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import cut, words
from adinsight.llm.components import components

#: Blocks of a fingerprint as (lowest bit, number of bits).
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
MAX_BITS = 4  # what two equal blocks of six can promise
#: Groups with more distinct fingerprints than this are dealt by further blocks.
SPLIT_GROUP = 20_000
FANOUT_BITS = 2
FANOUT = 1 << FANOUT_BITS
QUERIES_AT_ONCE = 2_000
#: Hashes whose bits are counted at once.
HASHES_AT_ONCE = 65_536


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``size`` lower-cased words, repeats included."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    joined = b" ".join(w).lower()  # bytes.lower changes A-Z only
    if len(w) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = (np.cumsum([len(x) + 1 for x in w]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(joined[a:z], 42) for a, z in zip(starts, ends[size - 1:])),
                       np.uint64, len(w) - size + 1)


def fingerprint(text: str | None, size: int) -> int:
    """Majority bits of the shingle hashes, as a signed 64-bit integer."""
    h = shingle_hashes(text, size)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for a in range(0, len(h), HASHES_AT_ONCE):
        part = h[a:a + HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int, keyed: bool = False) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) of every row of ``docs``; ``keyed`` adds ``no_id`` and a hash ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t.as_py(), size) for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["hash"], pa.array(fp, pa.int64())], ["doc_id", "hash", "fp"])
    each = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.xxhash64("text").alias("hash"))
            .mapInArrow(run, "doc_id long, hash long, fp long"))
    return each.select("doc_id", "fp", *([F.col("doc_id").isNull().alias("no_id"), F.col("hash").alias("text")] * keyed))


def _bits(at: int, n: int) -> Column:
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1))


def _key(blocks: tuple, tag: int) -> Column:
    """One long from the bits of ``blocks`` under a tag that tells apart the choices of blocks."""
    key = F.lit(tag).cast("long")
    for at, n in blocks:
        key = F.shiftleft(key, n).bitwiseOR(_bits(at, n))
    return key


def _deeper(blocks: tuple) -> list[tuple]:
    """Five parts of the bits that ``blocks`` leave open, each as blocks."""
    left = [i for i in range(64) if not any(a <= i < a + n for a, n in blocks)]
    out = []
    for k in range(MAX_BITS + 1):
        part = left[k * len(left) // (MAX_BITS + 1):(k + 1) * len(left) // (MAX_BITS + 1)]
        runs = [i for i in part if i - 1 not in part]
        out.append(tuple((i, next(n for n in range(1, 65) if i + n not in part)) for i in runs))
    return out


def _dealt(fps: DataFrame) -> DataFrame:
    """``g1, g2, fp``: each fingerprint under every group it is searched in."""
    pairs = list(combinations(BLOCKS, 2))
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), _key(p, i + 1).alias("g1")) for i, p in enumerate(pairs)])).alias("k")
    ).select("fp", "k.i", "k.g1")
    large = (keyed.groupBy("g1").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SPLIT_GROUP)
             .select("g1", F.lit(True).alias("large")))
    deep = F.lit(None).cast("array<long>")
    for i, p in enumerate(pairs):
        deep = F.when(F.col("i") == i, F.array(*[_key(b, k + 1) for k, b in enumerate(_deeper(p))])).otherwise(deep)
    return keyed.join(large, "g1", "left").select(
        "g1", F.explode(F.when(F.col("large"), deep).otherwise(F.array(F.lit(0).cast("long")))).alias("g2"), "fp")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray order."""
    x = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Tree over the rows of one partition, sorted by group and Gray rank."""

    def __init__(self, fp: np.ndarray, end: np.ndarray):
        self.fp, self.end = fp, end  # end: where each row's group ends
        self.label = np.arange(len(fp))
        self.mask, self.pattern, self.own = [np.full(len(fp), ~np.uint64(0))], [fp], []
        while len(self.mask[-1]) > 1:
            at = np.arange(0, len(self.mask[-1]), FANOUT)
            p, m = self.pattern[-1], self.mask[-1]
            # Bits common to the children: known in all and equal in all.
            ones, zeros = np.bitwise_and.reduceat(p, at), np.bitwise_and.reduceat(~p & m, at)
            self.mask.append(ones | zeros)
            self.pattern.append(ones)
        for lower, upper in zip(self.mask, self.mask[1:]):
            self.own.append(lower & ~upper[np.arange(len(lower)) >> FANOUT_BITS])

    def _uniform(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Smallest and largest component label below each node, by level."""
        out = [(self.label, self.label)]
        while len(out[-1][0]) > 1:
            at = np.arange(0, len(out[-1][0]), FANOUT)
            out.append((np.minimum.reduceat(out[-1][0], at), np.maximum.reduceat(out[-1][1], at)))
        return out

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        lab = self.label
        while len(a):
            x, y = lab[a], lab[b]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            apart = lo != hi
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(lab, hi[apart], lo[apart])
            while (nxt := lab[lab]).tobytes() != lab.tobytes():
                lab = self.label = nxt

    def link(self, limit: int) -> None:
        """Put rows of a group that differ in at most ``limit`` bits under one label."""
        n, start = len(self.fp), 0
        has_later = np.flatnonzero(self.end > np.arange(n) + 1)
        for start in range(0, len(has_later), QUERIES_AT_ONCE):
            self._link(has_later[start:start + QUERIES_AT_ONCE], limit)

    def _link(self, q: np.ndarray, limit: int) -> None:
        uniform = self._uniform()
        first, last = q + 1, self.end[q] - 1
        # Start where the group spans a few nodes only.
        span = int((last - first).max()) + 1
        level = min(len(self.mask) - 1, max(0, (span.bit_length() - 1) // FANOUT_BITS))
        lo, hi = first >> (FANOUT_BITS * level), last >> (FANOUT_BITS * level)
        reps = hi - lo + 1
        who = np.repeat(np.arange(len(q)), reps)
        node = np.arange(len(who)) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(lo, reps)
        spent = np.zeros(len(who), np.int64)
        own = self.mask[level]
        while True:
            spent = spent + np.bitwise_count((self.fp[q[who]] ^ self.pattern[level][node]) & own[node])
            low, high = uniform[level]
            known = (low[node] == high[node]) & (low[node] == self.label[q[who]])
            keep = (spent <= limit) & ~known
            who, node, spent = who[keep], node[keep], spent[keep]
            if level == 0:
                break
            level -= 1
            who, spent = np.repeat(who, FANOUT), np.repeat(spent, FANOUT)
            node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            shift = FANOUT_BITS * level
            inside = ((node << shift) <= last[who]) & (((node + 1) << shift) > first[who])
            who, node, spent = who[inside], node[inside], spent[inside]
            own = self.own[level]
        self._union(q[who], node)


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: links that join exactly the distinct ``fps`` (fp) within ``max_bits`` of each other."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(g: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((gray_rank(fp), g[:, 1], g[:, 0]))
            g, fp = g[order], fp[order]
            new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]).any(1)])
            end = np.repeat(np.r_[new[1:], len(g)], np.diff(np.r_[new, len(g)]))
            index = GrayIndex(fp, end)
            index.link(max_bits)
            linked = np.flatnonzero(index.label != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[linked].view(np.int64)), pa.array(fp[index.label[linked]].view(np.int64))], ["a", "b"])

        # Groups arrive whole, one after the other: work off all but the last,
        # which may go on, whenever enough rows have come.
        g, fp = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for b in batches:
            g = np.concatenate([g, np.stack([b["g1"].to_numpy(), b["g2"].to_numpy()], 1)])
            fp = np.concatenate([fp, b["fp"].to_numpy().view(np.uint64)])
            if len(g) >= 100_000 and (cut_at := int(np.flatnonzero((g != g[-1]).any(1)).max(initial=-1)) + 1):
                yield stars(g[:cut_at], fp[:cut_at])
                g, fp = g[cut_at:], fp[cut_at:]
        if len(g):
            yield stars(g, fp)

    return (_dealt(fps).repartition("g1", "g2").sortWithinPartitions("g1", "g2")
            .mapInArrow(search, "a long, b long").distinct())


def components_of(each: DataFrame, max_bits: int) -> DataFrame:
    """``fp, root`` for every fingerprint in ``each``; equal roots are one component."""
    fps = each.select("fp").distinct()
    roots = components(links(fps, max_bits))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs`` (doc_id, text).

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest id in reach.
    """
    each = cut(fingerprints(docs, shingle))
    roots = cut(components_of(each, max_bits))
    least = (each.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
             .groupBy("root").agg(F.min("least").alias("component_id")))
    return each.join(roots.join(least, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component, with all its columns: the smallest (doc_id, text), nulls last.

    Rows that are equal in both are one document and only one of them stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("id"),
                   F.xxhash64("text").alias("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    each = cut(fingerprints(docs, shingle, keyed=True))
    groups = components_of(each, max_bits)
    # One key per fingerprint first: copies collapse before they are shuffled.
    least = each.groupBy("fp").agg(F.min(F.struct("no_id", F.col("doc_id").alias("id"), "text")).alias("key"))
    kept = least.join(groups, "fp").groupBy("root").agg(F.min("key").alias("key")).select("key")
    # A key stands for one row unless rows are equal in it; one of those stays.
    return (rows.join(kept.withColumnRenamed("key", "kept"), rows["key"] == F.col("kept"), "left_semi")
            .dropDuplicates(["key"]).select("row.*"))
