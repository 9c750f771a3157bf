"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

Documents are linked if the Jaccard similarity of their sets of word shingles
reaches a threshold.  A set is kept as 64-bit hashes; documents with equal sets are
one *node*.  A node's signature has ``CHUNKS * WIDTH`` minima of ``BITS`` bits.

**Join.**  Signatures that differ in at most ``MAX_DIFFERENCES`` values have, by the
pigeonhole principle, at most ``ERRORS`` = 1 of them in some chunk.  The allowed
errors of a chunk are enumerated: for each value of the chunk in turn the others
are a key, so two nodes whose chunks agree but for one value meet under the key
without it.  Every pair under the signature distance meets under some key.  At a
similarity of 0.85 a pair lies above that distance with a probability of 1.1e-5.

**Hot keys.**  A key's nodes are never paired with each other outright.

1. Each key has one head per chunk order (the node least by a hash that differs
   between chunks); its other nodes are compared with the head only, so a key of any
   size gives as many pairs as it has nodes.  Pairs within the signature distance
   are confirmed on the full sets, and the links give components.
2. Keys whose nodes lie in one component, and keys of two nodes, are done.  In the
   others the nodes of the largest component, and the rest, are dealt into blocks
   of about ``BLOCK_NODES`` nodes and ``BLOCK_SHINGLES`` shingles.  Each pair of blocks
   is one group of rows, except that blocks of the largest component do not meet:
   its nodes are linked already.  A task compares the signatures of a group, skips
   pairs in one component (as far as the task knows), pairs that the first step has
   compared under this key and pairs whose first common key is another, and
   confirms the others on the full sets, nearest signatures first.

No link between different components is left out by any of these rules, so the
components are those of all links under the signature distance.

Defined results: a null or empty text has no set, is linked with nothing and is a
component of its own; fewer words than a shingle are one shingle; equal rows are
linked like any copies; a null id is never the component id of others while the
component holds an id, and stays null in a component without one; ``kept`` is true
where the ids are equal, nulls included; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import cut, word_hashes
from adinsight.llm.components import components

#: A signature: seven chunks of four 16-bit values; a chunk is one long.
CHUNKS, WIDTH, BITS = 7, 4, 16
#: Errors enumerated in a chunk, and the signature distance they promise.
ERRORS = 1
MAX_DIFFERENCES = CHUNKS * (ERRORS + 1) - 1
#: Bounds of a block of nodes that meets others in a task.
BLOCK_NODES, BLOCK_SHINGLES = 1_000, 500_000
#: Shingles whose minima are taken at once.
HASHES_AT_ONCE = 16_384

_rng = np.random.default_rng(1301)
_FACTORS = (_rng.integers(1, 1 << 63, CHUNKS * WIDTH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, CHUNKS * WIDTH, dtype=np.uint64)
_PLACES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNATURE = [f"s{c}" for c in range(CHUNKS)]
_LONG = ", ".join(f"{s} long" for s in SIGNATURE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` lower-cased words as ascending 64-bit hashes."""
    if not text:
        return np.empty(0, np.uint64)
    h = word_hashes(text.encode("utf-8").lower())  # bytes.lower changes A-Z only
    if not len(h):
        return h
    k = min(size, len(h))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        x += h[j:len(h) - k + 1 + j] * _PLACES[j % len(_PLACES)]
    return np.unique(_mixed(x))


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit number of the set, signed."""
    total = _mixed(shingles * _PLACES[0] + np.uint64(len(shingles))).sum(dtype=np.uint64)
    return int(_mixed(np.array([total]))[0].view(np.int64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each minimum, four to a signed long."""
    low = np.full(CHUNKS * WIDTH, ~np.uint64(0))
    for a in range(0, len(shingles), HASHES_AT_ONCE):
        part = shingles[a:a + HASHES_AT_ONCE]
        for j in range(CHUNKS * WIDTH):
            low[j] = min(low[j], (part * _FACTORS[j] + _SHIFTS[j]).min())
    return _mixed(low).astype(np.uint16).view(np.int64)


def _jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for ascending distinct hashes."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def signed_rows(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, row, n_shingles, node`` and the signature of every row; no shingle: null from ``node`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node, signs = [], [], []
            for t in b["text"]:
                s = shingle_set(t.as_py(), size)
                n.append(len(s))
                node.append(node_of(s) if len(s) else None)
                signs.append(signature(s) if len(s) else None)
            none = pa.array([x is None for x in node])
            table = np.array([np.zeros(CHUNKS, np.int64) if s is None else s for s in signs]).reshape(-1, CHUNKS)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["row"], pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                 *(pa.array(table[:, c], mask=none.to_numpy(zero_copy_only=False)) for c in range(CHUNKS))],
                ["doc_id", "row", "n_shingles", "node", *SIGNATURE])
    return _texts(docs).mapInArrow(run, f"doc_id long, row long, n_shingles long, node long, {_LONG}")


def _texts(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("row"))


def sets_of(docs: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of the documents named by ``rows`` (row, node), each node once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), size).view(np.int64) for t in b["text"]]
            ends = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate([np.empty(0, np.int64), *sets])
            yield pa.RecordBatch.from_arrays(
                [b["node"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["node", "shingles"])
    # Rows equal in id and text are named alike; one of them is enough.
    one = _texts(docs).join(rows, "row").select("node", "text").dropDuplicates(["node"])
    return one.mapInArrow(run, "node long, shingles array<long>")


def _all_but(v: int) -> int:
    """Mask of the values of a chunk but the ``v``-th, as a signed long."""
    return int(np.uint64(~(((1 << BITS) - 1) << (BITS * v)) % (1 << 64)).astype(np.int64))


def _keys() -> Column:
    """All keys of a node: chunk and left-out value (``tag``), and the other values' hash."""
    out = []
    for c, s in enumerate(SIGNATURE):
        for v in range(WIDTH):
            tag = F.lit(c * WIDTH + v)
            others = F.col(s).bitwiseAND(F.lit(_all_but(v)).cast("long"))
            out.append(F.struct(tag.alias("tag"), F.xxhash64(tag, others).alias("key")))
    return F.explode(F.array(*out))


def _values(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Signatures as rows of 16-bit values."""
    longs = np.stack([batch[s].to_numpy(zero_copy_only=False).astype(np.int64) for s in names], 1)
    return np.ascontiguousarray(longs).view(np.uint16)


def _shingles(column: pa.Array) -> list[np.ndarray]:
    """The lists of a batch as arrays without copies of their elements."""
    flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
    return [flat[a:z] for a, z in zip(ends[:-1], ends[1:])]


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` (a, b, their signatures and sets) under the distance whose sets are alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = (_values(b, [f"a_{s}" for s in SIGNATURE]) != _values(b, [f"b_{s}" for s in SIGNATURE])).sum(1)
            x, y = _shingles(b["a_shingles"]), _shingles(b["b_shingles"])
            ok = pa.array([d <= MAX_DIFFERENCES and _jaccard_at_least(x[i], y[i], percent) for i, d in enumerate(near)],
                          pa.bool_())
            yield pa.RecordBatch.from_arrays([b["a"].filter(ok), b["b"].filter(ok)], ["a", "b"])
    return pairs.mapInArrow(run, "a long, b long")


def _renamed(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_shingles"),
                       *[F.col(s).alias(f"{name}_{s}") for s in SIGNATURE])


class _Classes:
    """Components of the nodes of one group, as far as the task knows them."""

    def __init__(self, labels: list[int]):
        self.up = {x: x for x in labels}

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def _linked(rows: pa.Table, percent: int) -> list[tuple[int, int]]:
    """New links within one group of rows: two blocks of a key, or one with itself."""
    rows = rows.combine_chunks()
    batch = rows.to_batches()[0]
    node, root, head = (batch[c].to_numpy(zero_copy_only=False) for c in ("node", "root", "head"))
    block, tag = batch["block"].to_numpy(), int(batch["tag"][0].as_py())
    lo, hi = int(batch["lo"][0].as_py()), int(batch["hi"][0].as_py())
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    values, sets = _values(batch, SIGNATURE), _shingles(batch["shingles"])
    classes, out = _Classes(root.tolist()), []
    found_x, found_y, found_d = [], [], []
    for i in left:
        j = right[right > i] if lo == hi else right
        if not len(j):
            continue
        differ = (values[i] != values[j]).reshape(len(j), CHUNKS, WIDTH)
        total = differ.sum((1, 2))
        # The first key that both have: the first chunk with at most one error, without that value.
        chunk = (differ.sum(2) <= ERRORS).argmax(1)
        place = differ[np.arange(len(j)), chunk].argmax(1)
        todo = ((total <= MAX_DIFFERENCES) & (chunk * WIDTH + place == tag) & (root[j] != root[i])
                & (node[j] != head[i]) & (node[i] != head[j]))
        found_x.append(np.full(int(todo.sum()), i))
        found_y.append(j[todo])
        found_d.append(total[todo])
    if not found_x:
        return out
    x, y, d = map(np.concatenate, (found_x, found_y, found_d))
    for k in np.argsort(d, kind="stable"):
        i, j = x[k], y[k]
        if classes.root(root[i]) != classes.root(root[j]) and _jaccard_at_least(sets[i], sets[j], percent):
            classes.join(root[i], root[j])
            out.append((int(node[i]), int(node[j])))
    return out


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows that agree in ``names`` (all longs), from batches sorted by them, a group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        g = np.stack([b[c].to_numpy(zero_copy_only=False) for c in names], 1)
        edges = [0, *(np.flatnonzero((g[1:] != g[:-1]).any(1)) + 1).tolist(), len(g)]
        for a, z in zip(edges, edges[1:]):
            now = tuple(g[a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _blocks(members: DataFrame, nodes: DataFrame, block_nodes: int) -> DataFrame:
    """Rows ``key, tag, lo, hi, block, node, root, head``: every node once for each pair of blocks it is in.

    ``members`` (key, tag, node, root, head) of unfinished keys; the nodes of a key's
    largest component come first, in ``b1`` blocks that meet the other ``b2`` only.
    """
    sized = members.join(nodes.select("node", "n_shingles"), "node")
    part = sized.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    whole = part.groupBy("key").agg(F.max(F.struct("n", "size", "root")).alias("most"),
                                    F.sum("n").alias("n"), F.sum("size").alias("size"))

    def parts(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / block_nodes), F.ceil(size / BLOCK_SHINGLES)).cast("long")

    whole = whole.select("key", F.col("most.root").alias("largest"), parts(F.col("most.n"), F.col("most.size")).alias("b1"),
                         parts(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("b2"))
    dealt = sized.drop("n_shingles").join(whole, "key")
    deal = F.xxhash64("node", F.lit(5))
    block = F.when(F.col("root") == F.col("largest"), F.pmod(deal, "b1")).otherwise(F.col("b1") + F.pmod(deal, "b2"))
    others = F.sequence(F.when(F.col("block") < F.col("b1"), F.col("b1")).otherwise(F.lit(0).cast("long")),
                        F.col("b1") + F.col("b2") - 1)
    met = dealt.withColumn("block", block).withColumn("other", F.explode(others))
    return met.select("key", "tag", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                      "block", "node", "root", "head")


def links(docs: DataFrame, each: DataFrame, shingle: int, percent: int, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """``a, b``: links whose components are those of all links between the nodes of ``each`` (``signed_rows``)."""
    nodes = cut(each.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("row").alias("row"), F.first("n_shingles").alias("n_shingles"), *[F.first(s).alias(s) for s in SIGNATURE]))
    keyed = nodes.select("node", _keys().alias("k")).select("node", "k.tag", "k.key")
    order = F.struct(F.xxhash64("node", F.floor(F.col("tag") / WIDTH)).alias("o"), "node")
    shared = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("least"))
                 .filter("n > 1").select("key", "n", F.col("least.node").alias("head")))
    members = cut(keyed.join(shared, "key"))
    named = members.select("node").distinct().join(nodes, "node")
    sets = cut(sets_of(docs, named.select("row", "node"), shingle).join(nodes.select("node", *SIGNATURE), "node"))

    # 1. Every node with the heads of its keys.
    pairs = members.filter("node <> head").select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    found = cut(confirmed(pairs.join(_renamed(sets, "b"), "b").join(_renamed(sets, "a"), "a"), percent))

    # 2. Nodes of different components under a key of more than two.
    roots = components(found)
    placed = cut(members.filter("n > 2").join(roots.withColumnRenamed("node", "v"), F.col("node") == F.col("v"), "left")
                 .select("key", "tag", "node", "head", F.coalesce("root", "node").alias("root")))
    open_keys = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
    groups = _blocks(cut(placed.join(open_keys, "key")), nodes, block_nodes).join(sets, "node")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["key", "lo", "hi"]):
            new = _linked(rows, percent)
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*new)], ["a", "b"])

    more = (groups.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
            .mapInArrow(search, "a long, b long"))
    return found.unionByName(more)


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text)."""
    each = cut(signed_rows(docs, shingle))
    roots = components(links(docs, each, shingle, percent, block_nodes))
    least = cut(each.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
                .join(roots.withColumnRenamed("node", "v"), F.col("node") == F.col("v"), "left")
                .select("node", "least", F.coalesce("root", "node").alias("root")))
    named = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    out = each.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    return out.select("doc_id", "n_shingles",
                      F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")) \
              .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
