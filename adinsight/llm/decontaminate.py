"""Benchmark decontamination by greedy string tiling.

Words are compared lower-cased and without ASCII punctuation.  A seed is a run
of ``SEED`` words, or a whole item of fewer.  Documents that share a seed with a
benchmark item are found by a bitmap of all seeds (two bits a seed; its size
follows the number of seeds up to ``MAX_BITMAP_BITS``, beyond which it only lets
more documents through) and then by an equi-join on the seed's hash, which decides.

An item joins by its rarer seeds only: those that most items have are left out as
long as the words they cover stay below the threshold.  A document that reaches
the threshold holds another seed as well, so none is lost, and a phrase common to
many items does not bring every document together with every item.

Greedy string tiling then marks the longest common runs first, each word once, so
a passage counts in whatever order its parts stand.  Each length is looked up by
Karp-Rabin hashes of the words not marked yet, in time linear in the text however
often its words repeat.  The share of the item's words in tiles is its coverage;
from ``MIN_COVERAGE`` on the item counts as leaked.

Defined results: a null or empty text shares nothing; an item of fewer than
``SEED`` words leaks where all its words stand in a row; a null or empty item, or
one without id, is ignored; equal documents are each reported, equal items count
once; empty tables give an empty result; document ids may be null, and other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import cut, word_hashes
from adinsight.llm.substring_dedup import BASES, window_hashes

SEED = 5
MIN_COVERAGE = 0.6
MIN_BITMAP_BITS, MAX_BITMAP_BITS = 20, 27  # as powers of two: 128 KB to 16 MB

_PLAIN = bytes(ord(" ") if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else
               b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_PLAIN).split() if text else []


#: Set apart the seeds of each length.
_SALT = np.arange(SEED + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def seeds(text: str | None, lengths: tuple[int, ...] = (SEED,)) -> np.ndarray:
    """Hash of every run of each of ``lengths`` words, as signed 64-bit integers."""
    words = word_hashes(text.encode("utf-8").translate(_PLAIN) if text else b"")
    each = [window_hashes(words, k, BASES[0]) ^ _SALT[k] for k in lengths]
    return np.concatenate(each).view(np.int64) if each else np.empty(0, np.int64)


def _bits(seed: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    s, low = seed.view(np.uint64), np.uint64((1 << power) - 1)
    return s & low, (s >> np.uint64(32)) & low


def _free_windows(ids: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs of ``size`` unmarked words, and their Karp-Rabin hashes."""
    if len(ids) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[size:] == taken[:-size])
    return at, window_hashes(ids, size, BASES[1])[at]


def tiles(item: list, text: list, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length) of each tile.

    Longest matches first, then by place, no word in two tiles.  The longest
    length at which an unmarked run of the item has an equal in the text is found
    by bisection: hashes of that length are compared for each length tried.
    """
    numbers = {w: i for i, w in enumerate(dict.fromkeys(item))}
    odd = np.uint64(0x9E3779B97F4A7C15)
    a = np.array([numbers[w] + 1 for w in item], np.uint64) * odd
    b = np.array([numbers.get(w, -1) + 1 for w in text], np.uint64) * odd
    free_a, free_b = np.ones(len(a), bool), b != 0
    out, most = [], min(len(a), len(b))
    while most >= shortest:
        low, high, found = shortest, most, None
        while low <= high:
            n = (low + high) // 2
            (at_a, h_a), (at_b, h_b) = _free_windows(a, free_a, n), _free_windows(b, free_b, n)
            common = np.isin(h_a, h_b)
            if common.any():
                found, low = (n, at_a[common], h_a[common], at_b, h_b), n + 1
            else:
                high = n - 1
        if found is None:
            break
        n, at_a, h_a, at_b, h_b = found
        order = np.argsort(h_b, kind="stable")
        at_b, h_b = at_b[order], h_b[order]
        first, last = np.searchsorted(h_b, h_a, "left"), np.searchsorted(h_b, h_a, "right")
        behind: dict[int, int] = {}  # places of a hash before this one are taken
        for i, lo, hi in zip(at_a.tolist(), first.tolist(), last.tolist()):
            if not free_a[i:i + n].all():
                continue
            k = behind.get(lo, lo)
            while k < hi and not free_b[at_b[k]:at_b[k] + n].all():
                k += 1
            behind[lo] = k
            j = int(at_b[k]) if k < hi else -1
            if j >= 0 and (a[i:i + n] == b[j:j + n]).all():
                free_a[i:i + n] = free_b[j:j + n] = False
                out.append((i, j, n))
        most = n - 1
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, key, item_id, coverage, tiles`` for each document and item leaked into it.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.  ``key`` (a hash
    of the text) tells apart rows that share an id.
    """
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item"))
             .dropna().distinct().withColumn("item_key", F.xxhash64("item")))

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(plain_words(t.as_py())) for t in b["item"]]
            each = [seeds(t.as_py(), (min(k, SEED),) if k else ()) for t, k in zip(b["item"], n)]
            rep = np.repeat(np.arange(len(n)), [len(x) for x in each])
            yield pa.RecordBatch.from_arrays(
                [b["item_id"].take(pa.array(rep)), b["item_key"].take(pa.array(rep)), pa.array(np.array(n, np.int64)[rep]),
                 pa.array(np.concatenate([np.arange(len(x)) for x in each] + [np.empty(0, np.int64)]).astype(np.int64)),
                 pa.array(np.concatenate([*each, np.empty(0, np.int64)]))],
                ["item_id", "item_key", "item_words", "at", "seed"])

    def rarer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """The seeds of an item without the most common ones, which cover too little."""
        words = group["item_words"][0].as_py()
        size, need = min(words, SEED), int(np.ceil(words * min_coverage - 1e-9))
        seed, at, many = (group[c].to_numpy() for c in ("seed", "at", "many"))
        covered, kept = np.zeros(words, bool), []
        for k in np.lexsort((seed, -many)):
            if not kept or kept[-1] != seed[k]:
                trial = covered.copy()
                for p in at[seed == seed[k]]:
                    trial[p:p + size] = True
                if kept or trial.sum() >= need:
                    kept.append(seed[k])
                else:
                    covered = trial
        return pa.table({"item_id": pa.array([key[0].as_py()] * len(kept), pa.int64()),
                         "item_key": pa.array([key[1].as_py()] * len(kept), pa.int64()),
                         "seed": pa.array(np.array(kept, np.int64))})

    of_items = cut(items.mapInArrow(item_seeds, "item_id long, item_key long, item_words long, at long, seed long"))
    many = of_items.groupBy("seed").agg(F.count_distinct("item_id", "item_key").alias("many"))
    joining = cut(of_items.join(many, "seed").groupBy("item_id", "item_key")
                  .applyInArrow(rarer, "item_id long, item_key long, seed long"))
    lengths = tuple(sorted(r[0] for r in of_items.select(F.least("item_words", F.lit(SEED))).distinct().collect()))
    power = min(MAX_BITMAP_BITS, max(MIN_BITMAP_BITS, (16 * joining.count()).bit_length()))
    # The bitmap is made by Spark, 4 KB a block, and is at most 2**MAX_BITMAP_BITS bits.
    low = F.lit((1 << power) - 1)
    bits = joining.select(F.explode(F.array(
        F.col("seed").bitwiseAND(low), F.shiftrightunsigned("seed", 32).bitwiseAND(low))).alias("bit"))
    blocks = bits.groupBy(F.expr("bitmap_bucket_number(bit + 1)").alias("block")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(bit + 1))").alias("bits")).collect()
    bitmap = np.zeros((1 << power) // 8, np.uint8)
    for b in blocks:
        bitmap[(b["block"] - 1) * 4096:b["block"] * 4096] = np.frombuffer(b["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = shared.value
        for b in batches:
            texts, rows, found = b["text"], [], []
            for i in range(len(texts)):
                s = seeds(texts[i].as_py(), lengths)
                one, two = _bits(s, power)
                hit = (has[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8)) & 1
                hit &= (has[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8)) & 1
                if hit.any():
                    rows.append(i)
                    found.append(np.unique(s[hit.astype(bool)]))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(rows, pa.int64())), texts.take(pa.array(rows, pa.int64())),
                 pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text", "seeds"])

    near = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .mapInArrow(survivors, "doc_id long, text string, seeds array<long>")
               .withColumn("row", F.monotonically_increasing_id()))
    pairs = (near.select("row", F.explode("seeds").alias("seed")).join(joining, "seed")
             .select("row", "item_id", "item_key").distinct())
    # A document travels once, with the items it may hold.
    held = (pairs.join(items, ["item_id", "item_key"]).groupBy("row")
            .agg(F.collect_list(F.struct("item_id", "item")).alias("items")))
    both = near.select("row", "doc_id", "text").join(held, "row")

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_at", "text_at", "words")]))
        for b in batches:
            rows, ids, cover, found = [], [], [], []
            for k, (t, candidates) in enumerate(zip(b["text"], b["items"])):
                text = plain_words(t.as_py())
                for c in candidates.as_py():
                    item = plain_words(c["item"])
                    marked = tiles(item, text, min(SEED, len(item)))
                    rows.append(k)
                    ids.append(c["item_id"])
                    cover.append(sum(n for _, _, n in marked) / len(item))
                    found.append([{"item_at": x, "text_at": y, "words": n} for x, y, n in marked])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(at), b["key"].take(at), pa.array(ids, pa.int64()), pa.array(cover, pa.float64()),
                 pa.array(found, place)], ["doc_id", "key", "item_id", "coverage", "tiles"])

    return (both.select("doc_id", F.xxhash64("text").alias("key"), "text", "items").mapInArrow(
        tiled, "doc_id long, key long, item_id long, coverage double, "
               "tiles array<struct<item_at: long, text_at: long, words: long>>")
        .filter(F.col("coverage") >= min_coverage - 1e-9))


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``docs`` without the rows into which a benchmark item leaked; all columns are kept."""
    bad = leaks(docs, benchmark, min_coverage).select(
        F.col("doc_id").alias("leaked_id"), F.col("key").alias("leaked_key")).distinct()
    on = (docs["doc_id"].cast("long").eqNullSafe(bad["leaked_id"])
          & (F.xxhash64(docs["text"].cast("string")) == bad["leaked_key"]))
    return docs.join(bad, on, "left_anti")
