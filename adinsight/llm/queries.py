"""The registered queries: each operator over its whole table, with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adinsight.llm import merkle, minhash, toxicity
from adinsight.llm.chat_format import format_chats, read_back
from adinsight.llm.common import crc_fold, table
from adinsight.llm.decontaminate import leaks
from adinsight.llm.line_dedup import BLANKS, MIN_SITES, remove_spread_lines
from adinsight.llm.lm import score_texts
from adinsight.llm.oracles import OP4_SQL, OP11_SQL, OP12_SQL, OP13_SQL
from adinsight.llm.packing import pack
from adinsight.llm.periodic_runs import periodic_runs, planted, strongest
from adinsight.llm.quality_rules import judged, labelled_rows, learn
from adinsight.llm.simhash import near_duplicates
from adinsight.llm.substring_dedup import remove_repeats
from adinsight.llm.token_counts import count_edited, sample_edits


def ranks_path() -> str:
    """Where this installation keeps the vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaked documents only: a row per document and benchmark item leaked into it."""
    out = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "coverage", F.size("tiles").cast("long").alias("n_tiles"),
                      F.lit(True).alias("contaminated"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_spread_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


OP3_SQL = f"""
WITH split AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line FROM documents),
bare AS (SELECT *, trim(line, {" || ".join(f"chr({ord(c)})" for c in BLANKS)}) AS b FROM split),
spread AS (SELECT b FROM bare WHERE b <> '' GROUP BY b HAVING count(DISTINCT source) >= {MIN_SITES}),
ranked AS (
  SELECT bare.*, spread.b IS NOT NULL AS hit,
         row_number() OVER (PARTITION BY bare.b ORDER BY doc_id, pos) AS nth
  FROM bare LEFT JOIN spread ON bare.b = spread.b)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE hit AND nth > 1) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT (hit AND nth > 1)), '')) AS text_sha256
FROM ranked GROUP BY doc_id
"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), window=35)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"),
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_fold(F.col("doc_id"), 10) == 0
    out = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def packed_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(pack(table(spark, sf_dir, "documents"), ranks_path()))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_edited(docs.withColumn("edits", sample_edits(F.col("doc_id"), F.col("text"))), ranks_path())
    return out.select("doc_id", F.size("counts").cast("long").alias("n_edits"), "tokens_before",
                      F.element_at("counts", -1).alias("tokens_after"), "chars_encoded")


#: A conversation of control strings, formatted beside the table's.
CONTROL_TURNS = """SELECT * FROM VALUES
  (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
  AS t(conv_id, turn, role, text)"""


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(turns.unionByName(spark.sql(CONTROL_TURNS))))


OP8_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(
    text, '\\', '\\\\'), '<s>', '\\b'), '</s>', '\\e'), '[INST]', '\\i'), '[/INST]', '\\j'),
    '<<SYS>>', '\\y'), '<</SYS>>', '\\z') AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(escaped) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = learn(labelled_rows(docs, table(spark, sf_dir, "labels")))
    return judged(docs.select("doc_id", "text"), rules).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(planted(table(spark, sf_dir, "documents"))).withColumn("best", strongest(F.col("runs")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_benchmark_decontamination": op2_benchmark_decontamination,
        "op3_line_dedup": op3_line_dedup,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_retrieval_packing": op6_retrieval_packing,
        "op7_token_counts": op7_token_counts,
        "op8_chat_formatting": op8_chat_formatting,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_quality_rules": op10_quality_rules,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_minhash_near_dedup": op13_minhash_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op4_substring_dedup": OP4_SQL, "op8_chat_formatting": OP8_SQL,
            "op11_periodic_runs": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_minhash_near_dedup": OP13_SQL}
