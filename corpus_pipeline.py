"""The corpus pipeline: documents through language, line, near-duplicate and benchmark filters to tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import bpe, common, decontaminate, language, line_dedup, neardup
from barlake.llm.queries import held_out, table, token_digests, tokenizer_path

# A document is kept when its language is known and its profile is this near.
MIN_SCORE = 0.2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of unknown language, or whose text fits no learned profile."""
    profiles = language.fit_profiles(docs.where(~held_out()))
    found = docs.withColumn("__l", language.predict_column(profiles, F.col("text")))
    good = (F.col("__l.lang") != language.UNKNOWN) & (F.col("__l.score") >= MIN_SCORE)
    return found.where(good).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated passages of three lines or more; drop documents of which nothing is left."""
    out = line_dedup.dedup_lines(docs).where("n_removed = 0 OR n_removed < n_lines")
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return neardup.keep_one(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain benchmark passages."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left. The ids are written between encoding and decoding, so
    that an executor holds the Python workers and Arrow batches of one of the two at a time."""
    path = tokenizer_path()
    encoded = bpe.encode(docs.select("doc_id", "text"), path).select("doc_id", "tokens")
    return token_digests(bpe.decode(common.Scratch(spark).write(encoded), path))


STAGES = [
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

# The near-duplicate stage draws weighted samples and iterates: not SQL. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written and read back."""
    scratch = common.Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        last, docs = docs, scratch.write(stage(spark, docs, sf_dir))
        scratch.drop(last)
    return docs
