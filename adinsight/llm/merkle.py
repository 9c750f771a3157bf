"""Merkle manifest of a table by a cogrouped exchange of subtrees.

Rows of a group (a source) are leaves in the order of their id.  A node is the
SHA-256 of the hex digests of up to ``ARITY`` consecutive nodes of the level below;
a group's last node is its subroot, and the subroots, in the order of their
groups, are reduced alike to the root.

A superblock is ``ARITY ** LEVELS`` consecutive leaves of a group, so a hot group
is spread over as many tasks as it has superblocks.  On the way up each superblock
is reduced to one node; those are numbered by superblock and reduced again, until
a group has one node.  On the way down the nodes of a superblock are cogrouped with
what its outer tree has for them (subroot, root and the siblings above): one
``applyInPandas`` finishes the local reduction, joins local and outer siblings to
whole proofs, and, at the leaves, folds every (tampered) leaf up to a root.  A task
holds one superblock and one path.

Defined results: nulls count as ``-`` in a leaf; a null group is the first; null
ids come before others; rows with equal group and id are ordered by their digests,
so equal rows are leaves of their own with interchangeable places; a group of one
leaf has this leaf as its subroot and an empty proof below it, likewise the root
over one group; an empty table gives an empty result; columns that are not named
are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import cut
from adinsight.operators.rownum import number_rows

ARITY = 3
#: Levels within a superblock: 3 ** 7 = 2,187 leaves.
LEVELS = 7

PATH = "array<struct<left: string, right: string>>"
NODE = "grp string, at long, node string"
OUTER = f"grp string, at long, subroot string, root string, path {PATH}"
PROVED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """Hex SHA-256 of the columns, each as its length in bytes, a colon and its text, or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")),
                        F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def group_key(group: Column) -> Column:
    """The group as a text whose order is that of the groups, null first."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), group.cast("string")))


def levels_of(nodes: list[str], first: bool, depth: int) -> list[list[str]]:
    """The levels of one superblock from ``nodes`` up, the last with one node.

    A group that ends within its first superblock is reduced until one node is
    left; a later superblock reaches the level of its neighbours, ``depth``, however
    few nodes it has.
    """
    out = [nodes]
    while len(out[-1]) > 1 or (not first and len(out) <= depth):
        below = out[-1]
        out.append([sha256_hex("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def path_of(levels: list[list[str]], i: int) -> list[dict[str, str]]:
    """The siblings of node ``i`` left and right, level by level, as hex texts."""
    out = []
    for nodes in levels[:-1]:
        a = i - i % ARITY
        out.append({"left": "".join(nodes[a:i]), "right": "".join(nodes[i + 1:a + ARITY])})
        i //= ARITY
    return out


def folded(leaf: str, path: list) -> str:
    """The root that ``leaf`` and its siblings give."""
    for step in path:
        leaf = sha256_hex(step["left"] + leaf + step["right"])
    return leaf


def _superblock(depth: int) -> Column:
    return F.expr(f"at div {ARITY ** depth}").alias("block")


def _reduced(nodes: DataFrame, depth: int) -> DataFrame:
    """``grp, at, node``: one node per superblock of ``nodes`` (grp, at, node)."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        grp, block = key
        top = levels_of(rows.sort_values("at")["node"].tolist(), block == 0, depth)[-1][0]
        return pd.DataFrame({"grp": [grp], "at": [block], "node": [top]})
    return nodes.groupBy("grp", _superblock(depth)).applyInPandas(run, NODE)


def _tower(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """``nodes`` and the layers above, each a superblock smaller, up to one node per group."""
    out = [nodes]
    while True:
        out.append(cut(_reduced(out[-1], depth)))
        if not out[-1].filter("at > 0").head(1):
            return out


def _handed_down(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """``OUTER`` of every node, from that of its superblock.

    A node without a subroot above it is one itself (the layers over the groups).
    """
    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({c: [] for c in ("grp", "at", "subroot", "root", "path")})
        rows, top = rows.sort_values("at"), above.iloc[0]
        levels = levels_of(rows["node"].tolist(), rows["at"].iloc[0] < ARITY ** depth, depth)
        return pd.DataFrame({
            "grp": rows["grp"], "at": rows["at"], "subroot": top["subroot"], "root": top["root"],
            "path": [path_of(levels, i) + list(top["path"]) for i in range(len(rows))]})
    return (nodes.groupBy("grp", _superblock(depth))
            .cogroup(outer.groupBy("grp", "at")).applyInPandas(run, OUTER))


def _proved(leaves: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """``PROVED`` of every leaf: local reduction, proof joining and folding of a superblock at a time."""
    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        if rows.empty:
            return pd.DataFrame({c: [] for c in names})
        rows, top = rows.sort_values("at"), above.iloc[0]
        levels = levels_of(rows["node"].tolist(), rows["at"].iloc[0] < ARITY ** depth, depth)
        outside = list(top["path"])
        outside_text = "".join(s["left"] + s["right"] for s in outside)
        proofs, roots = [], []
        for i, leaf in enumerate(rows["tampered"]):
            local = path_of(levels, i)
            proofs.append(sha256_hex("".join(s["left"] + s["right"] for s in local) + outside_text))
            roots.append(folded(leaf, local + outside))
        return pd.DataFrame({
            "doc_id": rows["doc_id"].astype("Int64"), "leaf": rows["node"], "subroot": top["subroot"],
            "root": top["root"], "proof_sha256": proofs, "folded_root": roots,
            "verified": [r == top["root"] for r in roots]})[names]
    return (leaves.groupBy("grp", _superblock(depth))
            .cogroup(outer.groupBy("grp", "at")).applyInPandas(run, PROVED))


def prove(leaves: DataFrame, depth: int = LEVELS) -> DataFrame:
    """``PROVED`` for every row of ``leaves`` (doc_id, grp, node, tampered).

    ``grp`` is a ``group_key``, ``node`` a leaf's digest and ``tampered`` the digest
    that is folded with the proof of the original leaf.  A superblock has ``depth``
    levels; the result does not depend on it.
    """
    first = [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("tampered")]
    # Written first: dealing by ranges reads its input twice, texts and digests included.
    numbered = number_rows(cut(leaves), ["grp"], first, "at").withColumn("at", F.col("at") - 1)
    leaves = cut(numbered.select("doc_id", "grp", "at", "node", "tampered"))
    layers = _tower(leaves.select("grp", "at", "node"), depth)
    # The subroots in the order of their groups are a group of their own.
    subroots = layers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("source"), "node")
    subroots = cut(number_rows(subroots, ["grp"], [F.col("source")], "at").withColumn("at", F.col("at") - 1))
    over = _tower(subroots.select("grp", "at", "node"), depth)
    outer = over[-1].select("grp", "at", F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"),
                            F.array().cast(PATH).alias("path"))
    for layer in reversed(over[:-1]):
        outer = _handed_down(layer, outer, depth)
    # What was handed down to the subroot at a place belongs to the group of that place.
    outer = outer.select("at", "root", "path").join(subroots.select("at", "source", "node"), "at").select(
        F.col("source").alias("grp"), F.lit(0).cast("long").alias("at"), F.col("node").alias("subroot"), "root", "path")
    for layer in reversed(layers[1:-1]):
        outer = _handed_down(layer, outer, depth)
    return _proved(leaves, outer, depth)


def manifest(docs: DataFrame, depth: int = LEVELS) -> DataFrame:
    """Proofs of all ``docs`` (doc_id, source, lang, n_chars, text) with every second text tampered with.

    Where 2 divides the CRC-32 of the decimal id, the folded leaf has a text
    without its line feeds; a null id or text stays as it is.
    """
    doc_id, source, text = F.col("doc_id").cast("long"), F.col("source"), F.col("text").cast("string")
    odd = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 1
    tampered = F.when(F.coalesce(odd, F.lit(True)), text).otherwise(F.replace(text, F.lit("\n"), F.lit("")))
    columns = [doc_id, source, F.col("lang"), F.col("n_chars")]
    return prove(docs.select(doc_id.alias("doc_id"), group_key(source).alias("grp"),
                             leaf_digest([*columns, text]).alias("node"),
                             leaf_digest([*columns, tampered]).alias("tampered")), depth)
