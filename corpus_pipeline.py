"""Corpus pipeline: quality, lines, near-duplicates, repeated passages, packing.

Each stage is a function of (spark, docs, sf_dir) that works on all that its predecessor kept.
All but the last return the columns of ``documents``; where a stage changes a text, ``n_chars``
follows it.  The last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm.common import materialise, whole_text
from tidefold.llm.line_dedup import drop_lines, line_bitmaps
from tidefold.llm.minhash import near_groups
from tidefold.llm.packing import pack
from tidefold.llm.quality import fit_quality, keep_good
from tidefold.llm.queries import vocabulary
from tidefold.llm.substring_dedup import substring_dedup

QUALITY_THRESHOLD = 0.5
LINE_MIN_DOCS = 10
SHINGLE_WORDS, NEAR_PERCENT = 5, 75
REPEAT_WORDS = 50
SEQUENCE_TOKENS = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, rejects go."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_good(docs, model, QUALITY_THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose key stands in ten or more documents go from all of them."""
    out = drop_lines(docs, line_bitmaps(docs, min_docs=LINE_MIN_DOCS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    kept = near_groups(docs, shingle=SHINGLE_WORDS, percent=NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more stay in the document with the least id only."""
    changed = substring_dedup(docs, length=REPEAT_WORDS).where("new_text is not null")
    changed = changed.select(F.col("doc_id").alias("r_id"), F.col("row").alias("r_row"), "new_text").dropDuplicates(["r_id", "r_row"])
    same = (docs["doc_id"] == F.col("r_id")) & (F.xxhash64(whole_text("text")) == F.col("r_row"))
    text = F.coalesce("new_text", "text")
    return docs.join(changed, same, "left").withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token sequences, packed best-fit; the capacities besides tokens only take part in the choice."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), max_tokens=SEQUENCE_TOKENS, max_docs=SEQUENCE_TOKENS, max_cost=SEQUENCE_TOKENS**2)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", repeats),
    ("best_fit_packing", packing),
]

#: The classifier has no SQL form; a test follows the stages with brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
