"""From documents to packed training sequences: quality, line dedup, near-duplicates, decontamination, packing.

Each stage takes what the one before kept and returns a DataFrame; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from onsetlake.llm import common, decontam, linechunks, packing, quality, simhash

CAPACITY = 2048


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents, and boilerplate lines from the others.

    Null and empty texts have too few words and go; a null source is a host of its own; repeated rows share a
    verdict and stay or go together; null ids are rows like any other; an empty table gives an empty one.
    """
    return quality.cleaned(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops line chunks that came before, and documents of which nothing else is left.

    Before means at a smaller doc_id (nulls last); rows that agree in id and text share the outcome, so repeated
    rows stay together.  Null and empty texts stay as they are; an empty table gives an empty one.
    """
    found = linechunks.deduplicated(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return found.where(~F.coalesce(emptied, F.lit(False))) \
        .withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates.

    Texts without words (null and empty ones) are near-duplicates of each other; of several rows with the smallest
    doc_id all stay; an empty table gives an empty one.
    """
    return simhash.deduplicated(docs, distance=3, shingle=3, seed=42)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that share a twentieth of their words or more with benchmark items.

    Null and empty texts share none and stay, as do all repeated rows of a clean document; null benchmark texts have
    no words; an empty table, or no benchmark, changes nothing.
    """
    return decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences; one row a piece.

    Null and empty texts are the end id alone; repeated rows and null ids are packed like any other; equal lengths
    are placed in order of their ids; an empty table gives no rows.
    """
    return packing.pack(docs, common.tokenizer_path(), end_id=0, capacity=CAPACITY)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

#: SQL can express neither the tokenizer nor the packing; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to scratch and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
