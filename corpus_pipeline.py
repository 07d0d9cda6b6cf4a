"""The training-data pipeline: stages over ``documents``, each written and read again by the next.

Defined cases, the same in every stage: a null or empty text is a document without words, which the quality
score alone may reject; a document without an id is never taken for a copy of another one; rows that repeat id and
text are decided alike and stay together; columns besides ``doc_id``, ``text``, ``source`` and ``n_chars`` pass through
whatever their names are, and ``n_chars`` may be missing; an empty table stays empty.
"""

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, jaccard_join, line_runs, mixing, quality
from ledgerline.session import shared_dir


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold go; the labels are those of the whole tables."""
    return quality.without_low(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``n_chars``, where there is one, follows the text (null for a null text)."""
    kept = line_runs.without_frequent_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the smallest id stays."""
    return jaccard_join.keep_one(docs, words=5, similarity=Fraction(4, 5))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item (all words of a shorter one) go."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy taken."""
    return mixing.emit(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mix", mix_sources),
]

#: Quality scores and near-duplicates have no SQL equivalent; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written below the shared folder before the next reads them."""
    folder = shared_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
