"""Corpus pipeline: five stages over ``documents``, each one of the operators of ``adinsight.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
docs.  All but the last return the columns of ``documents``.  ``run`` does the
same within one call, cutting the lineage between stages by tables in the shared
checkpoint folder.

Defined results of all stages: an empty table stays empty; rows with equal ids or
texts are rows of their own, except where a stage keeps one of a group; ids,
sources and languages may be null; columns besides those of ``documents``, of
whatever name, are carried unchanged by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight.llm.common import cut, table
from adinsight.llm.decontaminate import decontaminate
from adinsight.llm.line_dedup import remove_spread_lines
from adinsight.llm.packing import pack
from adinsight.llm.quality_rules import judged, labelled_rows, learn
from adinsight.llm.queries import packed_pieces, ranks_path
from adinsight.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned list keep; null and empty texts go."""
    rules = learn(labelled_rows(docs, table(spark, sf_dir, "labels")))
    return judged(docs, rules).filter("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without repeats of cross-site lines; ``n_chars`` follows the text, null for a null one."""
    used = ("doc_id", "source", "text")
    others = [c for c in docs.columns if c not in used]
    held = docs.select(*used, F.struct(F.lit(0), *[F.col(f"`{c}`") for c in others]).alias("others"))
    out = remove_spread_lines(held)
    return out.select(*[
        F.char_length("text").cast("long").alias(c) if c == "n_chars" else
        F.col(c) if c in used else F.col("others").getField(c).alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates; all texts without words are one."""
    return one_of_each(docs, shingle=4, max_bits=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked; null and empty texts stay."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens; a null or empty text is its end id."""
    return packed_pieces(pack(docs, ranks_path()))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("retrieval_packing", retrieval_packing),
]

#: Fingerprint components, learned rules, tiling and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
