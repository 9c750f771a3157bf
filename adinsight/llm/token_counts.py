"""Edit-aware token counts: a segment tree over each document's pre-tokens.

The leaves of a document's tree are runs of pre-tokens that end at blanks; every
node holds the characters and tokens below it.  An edit finds its leaves by
descending on characters, re-encodes only these, and updates the sums on their
paths to the root.  Two characters of context before the edit decide which leaf
it begins in, and the pre-tokens at the far end must meet the old boundary: if
they do not (an edit can join or split words and runs of white space there), the
next leaf is taken in too.

The pattern that cuts pre-tokens looks at most two characters past the end of a
pre-token and never back, so a boundary stays one as long as the two characters
after it do; this makes the counts those of encoding the edited text anew.

Defined results: a null or empty text has no tokens, and edits apply to the
empty text; null edits are none; a null position or length is 0, a null
insertion is empty; positions and lengths beyond the text are cut to it;
repeated rows are counted each; an empty table gives an empty result; ids may be
null and other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adinsight.llm.tokens import PieceEncoder, encoder

#: Pieces (words with their blanks) in a leaf of a new tree, and its characters after edits, at most.
LEAF_PIECES, LEAF_CHARS = 32, 2_000
LOOK_AHEAD = 2
#: Texts are counted this many characters at a time.
CHARS_AT_ONCE = 500_000
MEMO_PIECES = 100_000

ADDED = "tokens_before long, counts array<long>, chars_encoded long"


class PreTokens(dict):
    """Pre-token to its number of tokens."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encode = encoder(ranks_path).encoding.encode_ordinary

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMO_PIECES:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n

    def cut(self, text: str) -> list[str]:
        return self.pattern.findall(text)


class TokenTree:
    """Segment tree over leaves of text; ``tokens`` is the count of the whole."""

    def __init__(self, leaves: list[tuple[str, int]], pre: PreTokens):
        self.pre, self.encoded = pre, 0
        self._build(leaves)

    def _build(self, leaves: list[tuple[str, int]]) -> None:
        self.texts = [t for t, _ in leaves] or [""]
        self.size = 1 << (len(self.texts) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (t, n) in enumerate(leaves):
            self.chars[self.size + i], self.sums[self.size + i] = len(t), n
        for i in range(self.size - 1, 0, -1):
            self._pull(i)

    def _pull(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def _leaf_at(self, pos: int) -> tuple[int, int]:
        """Leaf that holds the character ``pos`` (the last leaf with text, for the end), and its start."""
        i, start = 1, 0
        while i < self.size:
            left = self.chars[2 * i]
            if pos < left or not self.chars[2 * i + 1]:
                i = 2 * i
            else:
                i, pos, start = 2 * i + 1, pos - left, start + left
        return i - self.size, start

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        i = self.size + leaf
        self.chars[i], self.sums[i] = len(text), tokens
        while i > 1:
            i //= 2
            self._pull(i)

    def _head(self, leaf: int, n: int) -> str:
        """The first ``n`` characters from ``leaf`` on."""
        out = ""
        while leaf < len(self.texts) and len(out) < n:
            out += self.texts[leaf][:n - len(out)]
            leaf += 1
        return out

    def edit(self, start: int, removed: int, inserted: str) -> None:
        start = min(max(start, 0), self.length)
        end = min(start + max(removed, 0), self.length)
        first, at = self._leaf_at(max(0, start - LOOK_AHEAD))
        last, last_at = self._leaf_at(end)
        old = "".join(self.texts[first:last + 1])
        new = old[:start - at] + inserted + old[end - at:]
        while True:
            ahead = self._head(last + 1, LOOK_AHEAD + 2)
            pieces, reach, n = self.pre.cut(new + ahead), 0, 0
            while reach < len(new):
                reach, n = reach + len(pieces[n]), n + 1
            if reach == len(new):
                break
            last += 1
            new += self.texts[last]
        self.encoded += len(new)
        pieces = pieces[:n]
        if len(new) <= LEAF_CHARS:
            self._set(first, new, sum(map(self.pre.__getitem__, pieces)))
            for leaf in range(first + 1, last + 1):
                if self.texts[leaf]:
                    self._set(leaf, "", 0)
            return
        # Too much for a leaf: the tree is built anew from its leaves.
        leaves = [(t, self.sums[self.size + i]) for i, t in enumerate(self.texts)]
        fresh = []
        for k in range(0, len(pieces), LEAF_PIECES):
            part = pieces[k:k + LEAF_PIECES]
            fresh.append(("".join(part), sum(map(self.pre.__getitem__, part))))
        self._build([x for x in leaves[:first] if x[0]] + fresh + [x for x in leaves[last + 1:] if x[0]])


def trees_of(texts: list[str | None], pieces: PieceEncoder, pre: PreTokens) -> list[TokenTree]:
    out = []
    for text, counts in zip(texts, pieces.counts(texts)):
        if counts is None:  # white space around a blank: cut by the pattern
            cut = pre.cut(text)
            leaves = [("".join(cut[k:k + LEAF_PIECES]), sum(map(pre.__getitem__, cut[k:k + LEAF_PIECES])))
                      for k in range(0, len(cut), LEAF_PIECES)]
        else:
            words = (text or "").split(" ")
            sums = np.add.reduceat(counts, np.arange(0, len(words), LEAF_PIECES)).tolist() if text else [0]
            leaves = [((" " if k else "") + " ".join(words[k:k + LEAF_PIECES]), n)
                      for k, n in zip(range(0, len(words), LEAF_PIECES), sums)]
        out.append(TokenTree(leaves, pre))
    return out


def count_edited(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``docs`` (text, edits and others) with its token counts before and after each edit.

    ``edits`` is an array of (start, removed, inserted) in code points, each
    applied to the text as the earlier ones left it.  ``counts`` has the tokens
    after each; ``chars_encoded`` the characters encoded for all of them.
    """
    added = [c.split()[0] for c in ADDED.split(", ")]
    carried = [c for c in docs.columns if c not in ("text", "edits", *added)]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried], F.lit(True).alias("_")).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.col("edits").cast("array<struct<start: long, removed: long, inserted: string>>").alias("edits"))
    schema = StructType([*rows.select("row").schema, *StructType.fromDDL(ADDED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, pieces = PreTokens(ranks_path), encoder(ranks_path)
        for b in batches:
            before, counts, encoded = [], [], []
            texts, edits = b["text"], b["edits"]
            sizes = np.cumsum([t.as_buffer().size if t.is_valid else 0 for t in texts])
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes // CHARS_AT_ONCE)) + 1):
                for i, tree in zip(part, trees_of([texts[int(i)].as_py() for i in part], pieces, pre)):
                    before.append(tree.tokens)
                    after = []
                    for e in edits[int(i)].as_py() or ():
                        e = e or {"start": 0, "removed": 0, "inserted": ""}
                        tree.edit(e["start"] or 0, e["removed"] or 0, e["inserted"] or "")
                        after.append(tree.tokens)
                    counts.append(after)
                    encoded.append(tree.encoded)
            yield pa.RecordBatch.from_arrays(
                [b["row"], pa.array(before, pa.int64()), pa.array(counts, pa.list_(pa.int64())), pa.array(encoded, pa.int64())],
                ["row", *added])

    return rows.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in carried], *added)


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with an ``edits`` column from rows (doc_id, seq, start, removed, inserted), by doc_id."""
    lists = edits.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.sort_array(F.collect_list(
        F.struct("seq", "start", "removed", "inserted"))).alias("_e"))
    return docs.drop("edits").join(lists, docs["doc_id"].cast("long") == lists["_id"], "left").select(
        *[docs[c] for c in docs.columns if c != "edits"],
        F.transform("_e", lambda e: F.struct(e["start"], e["removed"], e["inserted"])).alias("edits"))


def sample_edits(doc_id: Column, text: Column, n: int = 3) -> Column:
    """``n`` edits of each text, placed and chosen by hashes of its id: words cut, split, joined or added."""
    pick = lambda k, what, m: F.pmod(F.xxhash64(doc_id, F.lit(k), F.lit(what)), m)
    length = F.coalesce(F.char_length(text), F.lit(0)).cast("long") + 1
    kinds = F.array(*[F.lit(x) for x in ("", " ", "\n", "'s ", " edit", "  more\n words", "42", "é")])
    return F.array(*[F.struct(
        pick(k, "start", length).alias("start"), pick(k, "removed", F.lit(9)).cast("long").alias("removed"),
        F.element_at(kinds, (pick(k, "inserted", F.lit(8)) + 1).cast("int")).alias("inserted")) for k in range(n)])
