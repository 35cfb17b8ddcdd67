"""From documents to a training mix in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run``
writes to the shared folder and reads back as the next stage's documents. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront.llm import decontaminate, line_dedup, mixing, quality_lm, simhash
from storefront.llm.shared import column, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above their language's threshold go."""
    return quality_lm.classify(docs, _table(spark, sf_dir, "labels")).filter("keep").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that 10 or more documents share go; n_chars follows the text."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    carried = docs.select("doc_id", "text", F.struct(*[column(docs, c) for c in others]).alias("row"))  # names may clash
    out = line_dedup.dedup_lines(carried, min_docs=10, keep=("row",))
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"),
            "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return out.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a test item go."""
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"), shingle=5, share=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: words taken of every remaining document."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, most=2)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing", mixed),
]

# The quality model and XXH64 fingerprints are out of SQL's reach; the stages
# are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
