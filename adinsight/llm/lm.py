"""LM scoring: a gated recurrent language model in numpy with a class-factored softmax.

Corpus counts.  Documents are dealt into chunks of a few MB.  A chunk sends the
keys (hashes) of its distinct words with their training counts, packed, to hash
buckets; a bucket sums them and answers each chunk with the corpus count of
each of its words.  A word in every document is one entry per chunk.  Nothing
of this grows on the driver, which receives sums and the ``HEAD`` most frequent
keys.  Each chunk is then written once as numbers: two bytes a word, and the
sums of each document that need the counts.  Training and scoring read these.

Model.  The ``HEAD`` most frequent training words lie in classes of
``MEMBERS`` by rank, all others in ``TAILS`` classes by their last letters.  A
GRU reads the words; a softmax gives the class and, for frequent words, a second
one the member.  Within a tail class a word has its smoothed share of the
class's counts, which leaves room for unseen words, so the probabilities of all
words sum to one.  Output biases begin at the corpus frequencies.

Training.  Weights are fitted by truncated backpropagation (windows of
``TRAIN_STEPS`` words, state carried on) on all training documents, whole texts.
A hash of a document deals it to one of ``ROUNDS`` rounds and, within it, to a
group of about ``GROUP_TOKENS`` words; equal rows are numbered first, so they are
dealt like different ones.  In a round each group trains its own copy from the
shared weights, reading its documents in the order of their ids, a segment at a
time; the copies are averaged, weighted by their words, in groups of
``AVERAGED``.  Groups depend on the documents alone, so the scores do not depend
on how files or tasks are cut.

Scoring.  Documents run side by side in lanes; a document's state is carried
from its first word to its end, whatever its length.  The softmax takes the states
of many steps at once, more of them where few lanes are left.

Defined results: a null or empty text is its end alone; equal rows are separate
documents and both count; without training documents all words are unseen; an
empty table gives an empty result; ids may be null (their fold is that of the
empty text) and other columns are ignored.  The documents must be the same each
time they are read, as files are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adinsight.llm.common import _INSIDE, cut, hashed_words, parts, text_bytes

CHUNK_BYTES, BUCKET_BYTES = 6_000_000, 10_000_000
#: Fixed values of the base score.
SMOOTHING = 0.1

HEAD, MEMBERS, TAILS = 2048, 64, 32
HIDDEN = 16
LANES, STEPS = 512, 16
TRAIN_LANES, TRAIN_STEPS = 512, 16
ROUNDS, GROUP_TOKENS = 2, 2_000_000
#: Words trained on, and words scored, at once: of many documents the longest holds few lanes up.
SEGMENT_TOKENS, SCORED_TOKENS = 400_000, 4_000_000
RATE = 0.15
AVERAGED = 64
LOG10 = float(np.log(10.0))

ENCODED = ("doc_id long, row long, train boolean, n_tokens long, n_known long, base_score double, "
           "tail_score double, ids binary")
RESULT = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _tail_classes() -> np.ndarray:
    """The tail class of every pair of last bytes (a word of one byte has 0 before it)."""
    x = np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(40)) % np.uint64(TAILS)


_TAIL_OF = _tail_classes()
#: The class of every id, in one byte (sorted by radix), and the member of every frequent word.
_CLASS_OF = np.r_[np.arange(HEAD) // MEMBERS, HEAD // MEMBERS + np.arange(TAILS)].astype(np.uint8)
_MEMBER_OF = np.arange(HEAD + TAILS) % MEMBERS
END = np.uint64(0x5E17_AB1E_0000_0000)  # key of a text's end


def keys_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the lower-cased words and the end of each text, and their number by text.

    A key is a hash of the word whose low bits are its tail class.
    """
    each = [t.encode("utf-8").lower() if t else b"" for t in texts]
    data = b"\n".join(each)
    h, start = hashed_words(data)
    text = np.searchsorted(np.cumsum([len(x) + 1 for x in each]), start, side="right")
    b = np.frombuffer(data, np.uint8)
    inside = _INSIDE[b]
    last = np.flatnonzero(inside & ~np.append(inside[1:], False))
    before = np.where(last > start, b[last - 1], np.uint8(0)).astype(np.int64)
    tails = np.uint64(TAILS)
    sizes = np.bincount(text, minlength=len(texts)) + 1
    out = np.empty(len(h) + len(texts), np.uint64)
    out[np.cumsum(sizes) - 1] = END
    out[np.arange(len(h)) + text] = h // tails * tails + _TAIL_OF[before << 8 | b[last]]
    return out, sizes


class Chunk:
    """The words of the documents of one chunk, in a fixed order."""

    def __init__(self, group: pa.Table, buckets: int):
        rows = sorted(zip(group["doc_id"].to_pylist(), group["text"].to_pylist(), group["train"].to_pylist(),
                          group["row"].to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        self.ids, self.row = [r[0] for r in rows], [r[3] for r in rows]
        self.train = np.array([r[2] for r in rows], bool)
        every, self.sizes = keys_of([r[1] for r in rows])
        distinct, place = np.unique(every, return_inverse=True)
        bucket = (distinct ^ (distinct >> np.uint64(29))) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        self.keys, self.bucket, self.word = distinct[order], bucket[order], rank[place]

    def training_counts(self) -> np.ndarray:
        return np.bincount(self.word[np.repeat(self.train, self.sizes)], minlength=len(self.keys))

    def by_bucket(self) -> Iterator[tuple[int, int, int]]:
        starts = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1]])
        for a, z in zip(starts, [*starts[1:], len(self.keys)]):
            yield int(self.bucket[a]), int(a), int(z)


@dataclass
class Vocabulary:
    """The frequent words and the sums of the tail classes; fixed size."""

    keys: np.ndarray       # of the frequent words, by rank
    counts: np.ndarray
    tail_n: np.ndarray     # training words of each tail class, without the frequent ones
    tail_v: np.ndarray     # and their distinct number
    n: int                 # training words
    v: int                 # distinct ones

    def __post_init__(self):
        self.order = np.argsort(self.keys)
        self.classes = -(-len(self.keys) // MEMBERS)

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Rank of a frequent word, or ``HEAD`` plus the tail class."""
        out = HEAD + (keys % np.uint64(TAILS)).astype(np.int64)
        if len(self.keys):
            at = np.searchsorted(self.keys, keys, sorter=self.order)
            rank = self.order[np.minimum(at, len(self.keys) - 1)]
            out = np.where(self.keys[rank] == keys, rank, out)
        return out


class Gru:
    """The model's weights and its forward and backward passes."""

    NAMES = ("inputs", "recurrent", "class_w", "class_b", "member_w", "member_b")

    def __init__(self, vocabulary: Vocabulary):
        v, rng = vocabulary, np.random.default_rng(7)
        n_class = HEAD // MEMBERS + TAILS
        draw = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        self.inputs = draw(HEAD + TAILS, 3 * HIDDEN)
        self.recurrent = draw(HIDDEN, 3 * HIDDEN)
        self.class_w = np.zeros((HIDDEN, n_class), np.float32)
        self.member_w = np.zeros((HEAD // MEMBERS, HIDDEN, MEMBERS), np.float32)
        member = np.full(HEAD, -30.0)  # places without a word
        member[:len(v.counts)] = np.log(v.counts)
        self.member_b = member.reshape(-1, MEMBERS).astype(np.float32)
        mass = np.zeros(HEAD)
        mass[:len(v.counts)] = v.counts
        mass = np.r_[mass.reshape(-1, MEMBERS).sum(1), v.tail_n + SMOOTHING * (v.tail_v + 1)]
        self.class_b = np.log(np.maximum(mass, 1e-12) / max(mass.sum(), 1e-12)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> "Gru":
        at = 0
        for n in self.NAMES:
            x = getattr(self, n)
            setattr(self, n, flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return self

    def halved(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of inputs and states, those of the gates halved: what the logistic function asks for, and exact."""
        half = np.where(np.arange(3 * HIDDEN) < 2 * HIDDEN, np.float32(0.5), np.float32(1))
        return self.inputs * half, self.recurrent * half

    def calm(self) -> bool:
        """Whether no state (between -1 and 1) can give a logit of 80."""
        most = lambda w, b: float((np.abs(w).sum(-2) + b).max(initial=0))
        return max(most(self.class_w, self.class_b), most(self.member_w, self.member_b)) < 79

    def step(self, h: np.ndarray, ids: np.ndarray, halved: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
        """The next state after reading ``ids``, and what the backward pass needs."""
        inputs, recurrent = halved or (self.inputs, self.recurrent)
        x, g = inputs.take(ids, 0), h @ recurrent
        zr = x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN]
        if not halved:
            zr *= np.float32(0.5)
        np.tanh(zr, out=zr)  # the logistic function by way of tanh
        zr *= np.float32(0.5)
        zr += np.float32(0.5)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = r * g[:, 2 * HIDDEN:]
        n += x[:, 2 * HIDDEN:]
        np.tanh(n, out=n)
        return n + z * (h - n), z, r, n, g[:, 2 * HIDDEN:]

    @staticmethod
    def _softmax(e: np.ndarray, rows: np.ndarray, want: np.ndarray, calm: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of ``want`` in each row of logits, which become exponents in place, and their sums."""
        picked = e[rows, want]
        if not calm and e.max(initial=0) > 80:  # exponents of float32 end soon after
            top = e.max(1, keepdims=True)
            e -= top
            picked = picked - top[:, 0]
        np.exp(e, out=e)
        total = e.sum(1)
        return picked - np.log(total), total

    def log_probs(self, h: np.ndarray, ids: np.ndarray, grads: dict | None = None, calm: bool = False) -> np.ndarray:
        """Natural log-probability of class and member of ``ids`` from states ``h``.

        With ``grads`` it adds the gradients of the mean loss and leaves that of
        ``h`` under "h".
        """
        cls = _CLASS_OF[ids]
        rows = np.arange(len(ids))
        e = h @ self.class_w
        e += self.class_b
        out, total = self._softmax(e, rows, cls, calm)
        if grads is not None:
            e /= total[:, None]
            e[rows, cls] -= 1
            e /= len(ids)
            grads["class_w"], grads["class_b"] = h.T @ e, e.sum(0)
            grads["h"] = e @ self.class_w.T
            grads["member_w"], grads["member_b"] = np.zeros_like(self.member_w), np.zeros_like(self.member_b)
        at = np.argsort(cls, kind="stable")  # those of tail classes come last
        bounds = np.r_[0, np.cumsum(np.bincount(cls, minlength=HEAD // MEMBERS)[:HEAD // MEMBERS])]
        member = _MEMBER_OF[ids]
        for c in np.flatnonzero(np.diff(bounds)):
            own = at[bounds[c]:bounds[c + 1]]
            hc, want, k = h.take(own, 0), member[own], rows[:len(own)]
            e = hc @ self.member_w[c]
            e += self.member_b[c]
            more, total = self._softmax(e, k, want, calm)
            out[own] += more
            if grads is not None:
                e /= total[:, None]
                e[k, want] -= 1
                e /= len(ids)
                grads["member_w"][c], grads["member_b"][c] = hc.T @ e, e.sum(0)
                grads["h"][own] += e @ self.member_w[c].T
        return out

    def train(self, streams: np.ndarray, starts: np.ndarray) -> None:
        """Truncated backpropagation over ``streams`` (steps x lanes) with Adagrad."""
        memory = {n: np.full_like(getattr(self, n), 1e-6) for n in self.NAMES}
        h = np.zeros((streams.shape[1], HIDDEN), np.float32)
        for t0 in range(0, len(streams), TRAIN_STEPS):
            ids, new = streams[t0:t0 + TRAIN_STEPS], starts[t0:t0 + TRAIN_STEPS]
            before, kept = [], []
            resets = new.any(1)
            for t in range(len(ids)):
                if resets[t]:
                    h = np.where(new[t][:, None], np.float32(0), h)
                before.append(h)
                h, *rest = self.step(h, ids[t])
                kept.append(rest)
            grads: dict = {}
            self.log_probs(np.concatenate(before), ids.ravel(), grads)
            d_out = grads.pop("h").reshape(len(ids), -1, HIDDEN)
            grads["recurrent"] = np.zeros_like(self.recurrent)
            d_in = np.empty((len(ids), ids.shape[1], 3 * HIDDEN), np.float32)
            dh = np.zeros_like(h)
            z, r, n, gn = (np.stack(x) for x in zip(*kept))
            hb = np.stack(before)
            by_n, by_z, by_r = (1 - z, 1 - n * n), (hb - n, z * (1 - z)), r * (1 - r)
            for t in reversed(range(len(ids))):
                dz, dr, dn = d_in[t, :, :HIDDEN], d_in[t, :, HIDDEN:2 * HIDDEN], d_in[t, :, 2 * HIDDEN:]
                np.multiply(dh * by_n[0][t], by_n[1][t], out=dn)
                np.multiply(dh * by_z[0][t], by_z[1][t], out=dz)
                np.multiply(dn * gn[t], by_r[t], out=dr)
                d_g = d_in[t].copy()
                d_g[:, 2 * HIDDEN:] *= r[t]
                grads["recurrent"] += hb[t].T @ d_g
                dh = dh * z[t] + d_g @ self.recurrent.T + d_out[t]
                if resets[t]:
                    dh = np.where(new[t][:, None], np.float32(0), dh)
            flat = ids.ravel().astype(np.uint16)
            order = np.argsort(flat, kind="stable")
            flat = flat[order]
            at = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
            seen = flat[at]
            rows = np.add.reduceat(d_in.reshape(-1, 3 * HIDDEN).take(order, 0), at, axis=0)
            memory["inputs"][seen] += rows * rows
            self.inputs[seen] -= RATE * rows / np.sqrt(memory["inputs"][seen])
            for n, g in grads.items():
                memory[n] += g * g
                getattr(self, n)[...] -= RATE * g / np.sqrt(memory[n])

    def score(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum of the natural log-probabilities of each of the documents that ``ids`` holds in turn."""
        first = np.cumsum(sizes) - sizes
        # Longest first, each to the lane that is shortest so far.
        lanes = [(0, b, []) for b in range(min(LANES, len(sizes)))]
        for d in np.argsort(-sizes, kind="stable"):
            length, b, docs = heapq.heappop(lanes)
            docs.append(d)
            heapq.heappush(lanes, (length + int(sizes[d]), b, docs))
        lanes.sort(key=lambda x: (-x[0], x[1]))
        order = np.array([d for _, _, docs in lanes for d in docs])
        small = np.int32 if len(ids) < 1 << 31 else np.int64
        flat_doc = np.repeat(order.astype(small), sizes[order])
        shift = first[order] - (np.cumsum(sizes[order]) - sizes[order])
        flat = ids[np.repeat(shift.astype(small), sizes[order]) + np.arange(len(flat_doc), dtype=small)]
        begins = np.r_[True, flat_doc[1:] != flat_doc[:-1]]
        length = np.array([x[0] for x in lanes])
        at0 = np.cumsum(length) - length
        active = np.searchsorted(-length, -np.arange(length[0]), side="left").tolist()
        total = np.zeros(len(sizes))
        h = np.zeros((len(lanes), HIDDEN), np.float32)
        halved, calm = self.halved(), self.calm()
        states, places, held = [], [], 0
        for t, n in enumerate(active):
            at = at0[:n] + t
            h = h[:n]
            new = begins[at]
            if new.any():
                h = np.where(new[:, None], np.float32(0), h)
            states.append(h)
            places.append(at)
            held += n
            h = self.step(h, flat[at], halved)[0]
            if held >= LANES * STEPS or t + 1 == len(active):  # few lanes wait for more steps
                at = np.concatenate(places)
                got = self.log_probs(np.concatenate(states), flat[at], calm=calm)
                total += np.bincount(flat_doc[at], got, minlength=len(sizes))
                states, places, held = [], [], 0
        return total


def streams_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents end to end, cut into ``TRAIN_LANES`` equal streams; where documents start.

    When the words do not divide evenly, neighbouring streams share a word, so none is left out.
    """
    ids = np.concatenate(texts)
    start = np.zeros(len(ids), bool)
    start[np.cumsum([0, *(len(x) for x in texts[:-1])])] = True
    lanes = min(TRAIN_LANES, len(ids))
    steps = -(-len(ids) // lanes)
    at = np.arange(lanes) * (len(ids) - steps) // max(lanes - 1, 1) + np.arange(steps)[:, None]
    return ids[at], start[at]


def averaged(copies: DataFrame) -> np.ndarray | None:
    """Mean of the weights in ``copies`` (place, words, weights), weighted by words."""
    def mean(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        words = np.array(group["words"].to_pylist(), np.float64)
        total = sum(w * np.frombuffer(x.as_py(), np.float32).astype(np.float64) for w, x in zip(words, group["weights"]))
        return pa.table({"place": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([int(words.sum())], pa.int64()),
                         "weights": pa.array([(total / words.sum()).astype(np.float32).tobytes()], pa.binary())})

    schema = "place long, words long, weights binary"
    most = copies.agg(F.max("place")).first()[0]
    while most:
        most //= AVERAGED
        copies = cut(copies.withColumn("place", F.floor(F.col("place") / AVERAGED).cast("long"))
                     .groupBy("place").applyInArrow(mean, schema))
    row = copies.first()
    return None if row is None else np.frombuffer(row["weights"], np.float32)


def training_rows(encoded: DataFrame) -> DataFrame:
    """``doc_id, row, copy, ids`` of the training documents, equal rows numbered by ``copy``."""
    rows = encoded.filter("train").select("doc_id", "row", "ids")
    often = rows.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    once = rows.join(often, "row", "left_anti").withColumn("copy", F.lit(0).cast("long"))
    again = (rows.join(often, "row").dropDuplicates(["row"])
             .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))))
    return once.unionByName(again.select(*once.columns))


def fit(encoded: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Weights of the model after all rounds; ``encoded`` as in ``ENCODED``."""
    spark = encoded.sparkSession
    weights = Gru(vocabulary).flat()
    groups = parts(vocabulary.n, GROUP_TOKENS * ROUNDS)
    dealt = training_rows(encoded).withColumn("deal", F.pmod(F.xxhash64("row", "copy"), F.lit(groups * ROUNDS)))
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocabulary, weights))  # HEAD words and the weights: fixed size

        def train(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, weights = shared.value
            model, group, words, held, size = None, None, 0, [], 0

            def learn() -> None:
                nonlocal words, held, size
                if held:
                    model.train(*streams_of(held))
                words, held, size = words + size, [], 0

            def result() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([group], pa.int64()), pa.array([words], pa.int64()),
                     pa.array([model.flat().tobytes()], pa.binary())], ["place", "words", "weights"])

            for b in batches:
                for g, ids in zip(b["g"], b["ids"]):
                    if g.as_py() != group:  # groups arrive one after the other
                        if model is not None:
                            learn()
                            yield result()
                        model, group, words = Gru(vocabulary).load(weights), g.as_py(), 0
                    held.append(np.frombuffer(ids.as_py(), np.uint16).astype(np.int64))
                    size += len(held[-1])
                    if size >= SEGMENT_TOKENS:
                        learn()
            if model is not None:
                learn()
                yield result()

        mine = dealt.filter(F.col("deal") % ROUNDS == k).withColumn("g", F.floor(F.col("deal") / ROUNDS).cast("long"))
        copies = (mine.repartition(groups, "g").sortWithinPartitions("g", "doc_id", "row", "copy")
                  .select("g", "ids").mapInArrow(train, "place long, words long, weights binary"))
        mean = averaged(cut(copies))
        weights = weights if mean is None else mean
    return weights


def score_texts(docs: DataFrame, is_training: Column) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its counts and scores, and ``train_tokens``.

    ``is_training`` marks the rows learned from; log-probabilities are to base 10.
    """
    total = text_bytes(docs)
    n_chunks, buckets = parts(total, CHUNK_BYTES), parts(total, BUCKET_BYTES)
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), is_training.alias("train"),
                       F.xxhash64(doc_id, text).alias("row"))
    # Equal rows go to different chunks; which chunk a row is in does not show in the results.
    # The deal is made twice, over the same files in the same order.
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("row", F.monotonically_increasing_id()), F.lit(n_chunks)))

    def send(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        c = Chunk(group, buckets)
        counts = c.training_counts().astype(np.int32)
        out = [(b, key[0].as_py(), c.keys[a:z].tobytes(), counts[a:z].tobytes()) for b, a, z in c.by_bucket()]
        cols = list(zip(*out))
        return pa.table({"bucket": pa.array(cols[0], pa.int64()), "chunk": pa.array(cols[1], pa.int64()),
                         "keys": pa.array(cols[2], pa.binary()), "counts": pa.array(cols[3], pa.binary())})

    def count(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        each = [np.frombuffer(x.as_py(), np.uint64) for x in group["keys"]]
        own = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in group["counts"]])
        distinct, place = np.unique(np.concatenate(each), return_inverse=True)
        sums = np.bincount(place, own, minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(x) for x in each])
        back = [sums[place[z - len(x):z]].tobytes() for x, z in zip(each, ends)]
        tail = (distinct % np.uint64(TAILS)).astype(np.int64)
        top = np.lexsort((distinct, -sums))[:HEAD]
        top = top[sums[top] > 0]
        first = lambda x: [x] + [None] * (len(each) - 1)
        longs = pa.list_(pa.int64())
        return pa.table({
            "chunk": group["chunk"], "bucket": group["bucket"], "counts": pa.array(back, pa.binary()),
            "tail_n": pa.array(first(np.bincount(tail, sums, TAILS).astype(np.int64)), longs),
            "tail_v": pa.array(first(np.bincount(tail, sums > 0, TAILS).astype(np.int64)), longs),
            "top_key": pa.array(first(distinct[top].view(np.int64)), longs),
            "top_count": pa.array(first(sums[top]), longs)})

    sent = dealt.groupBy("chunk").applyInArrow(send, "bucket long, chunk long, keys binary, counts binary")
    counted = cut(sent.groupBy("bucket").applyInArrow(
        count, "chunk long, bucket long, counts binary, tail_n array<long>, tail_v array<long>, "
               "top_key array<long>, top_count array<long>"))
    vocabulary = vocabulary_of(counted)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(group: pa.Table, answers: pa.Table) -> pa.Table:
        v, c = known.value, Chunk(group, buckets)
        found = dict(zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist()))
        counts = np.concatenate([np.frombuffer(found[b], np.int64) for b, _, _ in c.by_bucket()])
        if len(counts) != len(c.keys):
            raise RuntimeError("the documents changed between two reads")
        ids = v.ids(c.keys)
        base = np.log10((counts + SMOOTHING) / (v.n + SMOOTHING * (v.v + 1)))
        tail = np.maximum(ids - HEAD, 0)
        in_tail = np.where(ids < HEAD, 0.0, np.log10((counts + SMOOTHING) / (v.tail_n[tail] + SMOOTHING * (v.tail_v[tail] + 1))))
        first = np.cumsum(c.sizes) - c.sizes
        add = lambda x: np.add.reduceat(x[c.word], first)
        flat = ids.astype(np.uint16)[c.word]
        return pa.table({
            "doc_id": pa.array(c.ids, pa.int64()), "row": pa.array(c.row, pa.int64()), "train": pa.array(c.train),
            "n_tokens": pa.array(c.sizes, pa.int64()), "n_known": pa.array(add((counts > 0).astype(np.int64)), pa.int64()),
            "base_score": pa.array(add(base)), "tail_score": pa.array(add(in_tail)),
            "ids": pa.array([flat[a:a + n].tobytes() for a, n in zip(first, c.sizes)], pa.binary())})

    encoded = cut(dealt.groupBy("chunk").cogroup(counted.select("chunk", "bucket", "counts").groupBy("chunk"))
                  .applyInArrow(encode, ENCODED))
    weights = fit(encoded, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shared.value
        model = Gru(v).load(w)
        for b in batches:
            sizes = b["n_tokens"].to_numpy()
            part = (np.cumsum(sizes) - sizes) // SCORED_TOKENS
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                ids = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in b["ids"].slice(a, z - a)])
                got = model.score(ids.astype(np.int32), sizes[a:z]) / LOG10
                yield pa.RecordBatch.from_arrays(
                    [*(b[c].slice(a, z - a) for c in ("doc_id", "n_tokens", "n_known", "base_score")),
                     pa.array(got + b["tail_score"].slice(a, z - a).to_numpy())],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return (encoded.select("doc_id", "n_tokens", "n_known", "base_score", "tail_score", "ids").mapInArrow(score, RESULT)
            .withColumn("train_tokens", F.lit(vocabulary.n).cast("long")))


def vocabulary_of(counted: DataFrame) -> Vocabulary:
    """Sums of the tail classes and the ``HEAD`` most frequent words of the corpus."""
    sums = {}
    for c in ("tail_n", "tail_v"):
        sums[c] = np.zeros(TAILS, np.int64)
        for r in counted.select(F.posexplode(c).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect():
            sums[c][r["at"]] = r["x"]
    top = (counted.select(F.explode(F.arrays_zip("top_key", "top_count")).alias("t")).select("t.*")
           .orderBy(F.desc("top_count"), "top_key").limit(HEAD).collect())
    keys = np.array([r["top_key"] for r in top], np.int64).view(np.uint64)
    counts = np.array([r["top_count"] for r in top], np.int64)
    tail = (keys % np.uint64(TAILS)).astype(np.int64)
    return Vocabulary(keys, counts, sums["tail_n"] - np.bincount(tail, counts, TAILS).astype(np.int64),
                      sums["tail_v"] - np.bincount(tail, minlength=TAILS), int(sums["tail_n"].sum()), int(sums["tail_v"].sum()))
