"""Helpers shared by the operators: table access, words, lineage cuts, sizes."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight.session import checkpoint_dir

#: Java form of one run of separators; words are what is left between them.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` cuts at exactly these six bytes."""
    return text.encode("utf-8").split() if text else []


def words_column(text: Column) -> Column:
    """The same words as an array of strings; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Later steps start from the files, so a lost executor costs no recomputation
    of what came before, and a frame used twice is computed once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/adinsight-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of all texts; sizes the numbers of chunks and buckets."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0)).cast("long")).first()[0]


def parts(total: int, each: int) -> int:
    """How many parts of about ``each`` hold ``total``; always at least one."""
    return max(1, -(-int(total) // each))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


#: Bytes hashed at once, and the place in a word from which the factors repeat.
_BLOCK, _FACTORS = 1 << 17, np.random.default_rng(11).integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INSIDE = np.array([b not in b" \t\n\x0b\x0c\r" for b in range(256)])


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word of UTF-8 text: a sum over its bytes with a factor for each place."""
    return hashed_words(data)[0]


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the byte it begins at."""
    hashes, starts, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(data):
        # Cut where a word has ended, so that memory stays that of a block.
        end = at + _BLOCK
        while end < len(data) and _INSIDE[data[end]]:
            end += 1
        x, first = _block_hashes(np.frombuffer(data[at:end], np.uint8))
        hashes.append(x)
        starts.append(first + at)
        at = end
    return np.concatenate(hashes), np.concatenate(starts)


def _block_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = _INSIDE[b]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0] * bool(inside[0]), edges, [len(b)] * bool(inside[-1])]).astype(np.int64)
    size = edges[1::2] - edges[::2]
    if not len(size):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.cumsum(size) - size
    place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
    x = np.add.reduceat((b[inside].astype(np.uint64) + np.uint64(1)) * _FACTORS[place & 4095], first)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x, edges[::2]
