"""Byte-level BPE ids of many texts at once.

The vocabulary file is a parameter.  A text is cut at its single blanks; what
such a piece encodes to does not depend on its neighbours (unless white space
stands on both sides of a blank, when the whole text is encoded in one go), so
a task encodes each distinct piece once and looks the rest up, the distinct
pieces of many texts at a time.  The strings of
special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from functools import lru_cache
from itertools import compress, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

#: Distinct pieces and ids a task remembers; beyond that it forgets those it met once.
MEMO_PIECES, MEMO_IDS = 300_000, 2_500_000
#: Longer pieces are not remembered.
MEMO_CHARS = 60
_TIED = re.compile(r"\s (?:\s|\Z)")


@lru_cache(maxsize=2)
def encoding(ranks_path: str) -> tiktoken.Encoding:
    import public_tokenizers
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class PieceEncoder:
    def __init__(self, ranks_path: str):
        self.encoding = encoding(ranks_path)
        ranks = self.encoding._mergeable_ranks
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)  # bytes of each token
        for token, i in ranks.items():
            self.width[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        self._remember([])
        self.starts = self.lengths = self.ids = self.hits = np.empty(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces met more than once, at most half of what is remembered."""
        at = np.fromiter(self.place.values(), np.int64, len(self.place))
        often = self.hits[at] > 1
        kept = [*islice(compress(self.place, often), MEMO_PIECES // 2)]
        at = at[often][:len(kept)]
        lengths, ids = self.lengths[at], self._gather(at)
        self._clear()
        if len(ids) <= MEMO_IDS // 2:
            self._remember(kept)
            self._add(lengths, ids)

    def _remember(self, kept: list[str]) -> None:
        """Piece to its place; a piece not met before gets the next one and comes last."""
        self.place = defaultdict(count(len(kept)).__next__, zip(kept, range(len(kept))))

    def _add(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.hits = np.concatenate([self.hits, np.zeros(len(lengths), np.int64)])

    def _gather(self, at: np.ndarray) -> np.ndarray:
        """Ids of the pieces at the places ``at``, one after the other."""
        size = self.lengths[at]
        ends = np.cumsum(size)
        return self.ids[np.repeat(self.starts[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]

    def _encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def _learn(self, keys: list[str]) -> None:
        """Ids of ``keys`` in order: a piece, which follows a blank, or a piece and a blank, which begins a text."""
        plain = np.array([bool(k) and k.strip() == k for k in keys])
        joined = [k for k, p in zip(keys, plain) if p]
        ids = np.array(self._encode(" " + " ".join(joined) if joined else ""), np.int64)
        # Tokens do not cross pieces here, so byte lengths tell where each ends.
        size = np.fromiter(map(len, map(str.encode, joined)), np.int64, len(joined)) + 1
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(size)) + 1
        more = [self._encode(k[:-1] if k.endswith(" ") else " " + k) for k, p in zip(keys, plain) if not p]
        lengths = np.empty(len(keys), np.int64)
        lengths[plain] = np.diff(np.r_[0, ends]) if joined else []
        lengths[~plain] = [len(x) for x in more]
        every = np.empty(int(lengths.sum()), np.int64)
        of_plain = np.repeat(plain, lengths)
        every[of_plain], every[~of_plain] = ids, [i for x in more for i in x]
        self._add(lengths, every)

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pieces of ``texts``, one after the other, and their number by text; new ones get theirs.

        Pieces after the first are looked up once for each distinct one.
        """
        get, cuts = self.place.__getitem__, [t.partition(" ") for t in texts]
        rest = pa.array([r if blank else None for _, blank, r in cuts], pa.large_string())
        parts = pc.split_pattern(rest, " ")
        sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy().astype(np.int64)
        each = parts.flatten().dictionary_encode()
        distinct = each.dictionary.to_numpy(zero_copy_only=False)
        found = np.fromiter(map(get, distinct), np.int64, len(distinct))
        places = np.empty(len(texts) + len(each), np.int64)
        first = np.zeros(len(places), bool)
        first[np.cumsum(sizes + 1) - sizes - 1] = True
        places[first] = np.fromiter((get(f + " ") for f, _, _ in cuts), np.int64, len(cuts))
        places[~first] = found[each.indices.to_numpy()]
        return places, sizes + 1

    def _places(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The places of the pieces of each text in the memory; None where it must be encoded whole."""
        if len(self.place) > MEMO_PIECES or len(self.ids) > MEMO_IDS:
            self._forget()
        known, out = len(self.place), [np.empty(0, np.int64)] * len(texts)
        cut = []
        for i, t in enumerate(texts):
            if t and _TIED.search(t):
                out[i] = None
            elif t:
                cut.append(i)
        if cut:
            places, sizes = self._pieces([texts[i] for i in cut])
            for i, at in zip(cut, np.split(places, np.cumsum(sizes)[:-1])):
                out[i] = at
        new = [*islice(reversed(self.place), len(self.place) - known)][::-1]
        if new:
            self._learn(new)
        for i in cut:
            self.hits[out[i]] += 1  # once a text
        for k in new:
            if len(k) > MEMO_CHARS:
                del self.place[k]
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (int32) of each text; a null text has none."""
        places = self._places(texts)
        at = np.concatenate([np.empty(0, np.int64), *(p for p in places if p is not None)])
        ids, ends = self._gather(at).astype(np.int32), np.r_[0, np.cumsum(self.lengths[at])]
        out, done = [], 0
        for text, p in zip(texts, places):
            if p is None:
                out.append(np.array(self._encode(text), np.int32))
            else:
                out.append(ids[ends[done]:ends[done + len(p)]])
                done += len(p)
        return out

    def counts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Number of ids of each blank-separated piece of each text; None where pieces depend on each other."""
        return [None if at is None else self.lengths[at] for at in self._places(texts)]


_encoders: dict[str, PieceEncoder] = {}


def encoder(ranks_path: str) -> PieceEncoder:
    """One per worker and vocabulary."""
    if ranks_path not in _encoders:
        _encoders[ranks_path] = PieceEncoder(ranks_path)
    return _encoders[ranks_path]
