"""Chat formatting by columnar byte assembly.

A turn is written as ``<s>role``, a line end, the text and ``</s>``.  Control
strings inside roles and texts are escaped reversibly.  Rows are dealt by ranges
of (conversation, turn), so a conversation of any length is spread over tasks;
each batch of rows is assembled without a loop over rows: the lengths of all
segments give cumulative offsets, headers and contents are scattered into one
preallocated buffer, and that buffer becomes the Arrow strings of the
conversations' parts.  The parts of a conversation in the order of ``part``,
put together, are its formatted text.

``loss`` lists the assistant texts as half-open spans of code points in the part.

Defined results: a null text or role is empty; equal (conversation, turn) rows
are separate turns, ordered by role and text; null conversation ids form one
conversation and null turns come first; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, MIDDLE, CLOSE = b"<s>", b"\n", b"</s>"
#: Control strings of common templates and what stands for each inside texts.
ESCAPES = {"\\": "\\\\", "<s>": "\\b", "</s>": "\\e", "[INST]": "\\i", "[/INST]": "\\j",
           "<<SYS>>": "\\y", "<</SYS>>": "\\z"}
LINE_END = ("\n", "\\n")  # in roles only
_BACK = {v[1]: k for k, v in [*ESCAPES.items(), LINE_END]}
LEARNED_ROLE = "assistant"

RESULT = "conv_id long, part long, n_turns long, formatted string, loss array<struct<start: long, end: long>>"


def _escaped(column: pa.Array, role: bool = False) -> pa.Array:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    for plain, code in [*ESCAPES.items(), *([LINE_END] * role)]:
        column = pc.replace_substring(column, pattern=plain, replacement=code)
    return pa.concat_arrays([column])  # offsets from 0


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.DOTALL) if "\\" in text else text


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start and length of each value of a large_string column."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), at[:-1], np.diff(at)


def assemble(conv: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted parts of runs of equal ``conv``; first row of each, and each text's span of code points."""
    n = len(conv)
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
    segments = [BEGIN, _bytes(roles), MIDDLE, _bytes(texts), CLOSE]
    lengths = np.stack([np.full(n, len(s)) if isinstance(s, bytes) else s[2] for s in segments], 1)
    ends = np.cumsum(lengths.ravel()).reshape(n, -1)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]), np.uint8)
    for k, s in enumerate(segments):
        if isinstance(s, bytes):
            out[begins[:, k, None] + np.arange(len(s))] = np.frombuffer(s, np.uint8)
        else:
            data, at, size = s
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            out[np.repeat(begins[:, k], size) + step] = data[np.repeat(at, size) + step]
    offsets = np.r_[begins[first, 0], len(out)].astype(np.int64)
    parts = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out)])
    # The same sums in code points, from the start of each part.
    chars = np.stack([np.full(n, len(BEGIN)), pc.utf8_length(roles).to_numpy(), np.full(n, len(MIDDLE)),
                      pc.utf8_length(texts).to_numpy(), np.full(n, len(CLOSE))], 1)
    ends = np.cumsum(chars.ravel()).reshape(n, -1)
    base = np.repeat((ends - chars)[first, 0], np.diff(np.r_[first, n]))
    return parts, first, (ends - chars)[:, 3] - base, ends[:, 3] - base


def format_chats(turns: DataFrame) -> DataFrame:
    """Formatted parts of ``turns`` (conv_id, turn, role, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            if not b.num_rows:
                continue
            # A null id has its own number beside the ids' ranks.
            conv = b["conv_id"].dictionary_encode(null_encoding="encode").indices.to_numpy()
            parts, first, start, end = assemble(conv, _escaped(b["role"], role=True), _escaped(b["text"]))
            learned = pc.fill_null(pc.equal(b["role"], LEARNED_ROLE), False).to_numpy(zero_copy_only=False)
            own = np.flatnonzero(learned)
            spans = pa.StructArray.from_arrays([pa.array(start[own]), pa.array(end[own])], ["start", "end"])
            loss = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(own, np.r_[first, len(conv)]).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"].take(pa.array(first)), pa.array(task + done + np.arange(len(first))),
                 pa.array(np.diff(np.r_[first, len(conv)])), parts.cast(pa.string()), loss],
                ["conv_id", "part", "n_turns", "formatted", "loss"])
            done += len(first)

    order = ["conv_id", "turn", "role", "text"]
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
            .repartitionByRange("conv_id", "turn").sortWithinPartitions(*order).mapInArrow(run, RESULT))


_TURN = re.compile("<s>(.*?)\n(.*?)</s>", re.DOTALL)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted parts alone.

    Parts stream through in order; a task holds one conversation's running
    digests and one batch, whatever the conversation's length.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        now = None

        def row() -> list:
            return [now["id"], now["turns"], now["all"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["size"]]

        for b in batches:
            done = []
            for conv, text, loss in zip(b["conv_id"].to_pylist(), b["formatted"], b["loss"]):
                if now is None or now["id"] != conv:
                    if now is not None:
                        done.append(row())
                    now = {"id": conv, "turns": 0, "chars": 0, "size": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
                text = text.as_py()
                now["size"] += len(text)
                for m in _TURN.finditer(text):
                    now["turns"] += 1
                    now["all"].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                for s in loss.as_py():
                    own = unescape(text[s["start"]:s["end"]])
                    now["chars"] += len(own)
                    now["loss"].update(own.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done], schema=_READ)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row()))], schema=_READ)

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
