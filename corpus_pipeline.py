"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next stage's documents.  All but the last
return the columns of ``documents`` (``n_chars`` follows the text).

Defined results: documents with a null or empty text go in the first stage (no
language); repeated rows are documents of their own until the near-duplicate
stage; null ids are ids; no documents give no rows; columns beside those of
``documents`` are dropped, whatever their names.

A SQL oracle can't express the stages (a trained model, XXH64 fingerprints
and their components, packing), so the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import langid
from tierline.llm.common import drop_written, written
from tierline.llm.line_chunks import dedup_passages
from tierline.llm.packing import pack
from tierline.llm.simhash import keep_first
from tierline.llm.suffix_index import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose predicted language is less certain is rejected, and one whose
#: n-grams are more than twice as far from that language as the worst held-out one.
MIN_SCORE, NOT_TYPICAL = 0.4, -1.0
#: One line in so many ends a chunk of lines.
CHUNK_DIVISOR = 3
#: The shortest repeated passage that is cut, in bytes: passages of over 50
#: words.  51 words of prose take 315 bytes in the middle, 235 or more in 99 %
#: of the places of the sample documents; anything longer than this also goes.
REPEAT_BYTES = 200


def _documents(df: DataFrame, text) -> DataFrame:
    return (df.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint"))
            .filter(F.length("text") > 0).select(*COLUMNS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; text without a letter goes, and
    text that is not typical of the language it is taken for."""
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"))
    judged = langid.predict(docs, model, lang_out="__lang", score_out="__score", typical_out="__typical")
    sure = (F.col("__lang") != "und") & (F.col("__score") >= MIN_SCORE) & (F.col("__typical") >= NOT_TYPICAL)
    return judged.filter(sure).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines, cut where the rolling hash over the lines says
    (as in op4), go; an exact check of every two neighbouring lines takes what
    those cuts miss.  What is left empty goes."""
    return _documents(dedup_passages(docs.select(*COLUMNS), divisor=CHUNK_DIVISOR), F.col("text"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_first(docs.select(*COLUMNS), shingle=4, radius=4)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of ``REPEAT_BYTES`` that stand twice are cut out; what is
    left empty goes.  Half characters at a cut become U+FFFD."""
    return _documents(remove_repeats(docs.select(*COLUMNS), min_match=REPEAT_BYTES),
                      F.make_valid_utf8(F.col("kept").cast("string")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of every document in the training sequences."""
    return pack(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("suffix_array_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's input is dropped once its
    output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_written(spark, before)
        before = path
    return docs
