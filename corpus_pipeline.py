"""A training corpus from raw documents: five stages of the library's operators.

Each stage function takes ``(spark, docs, sf_dir)``, works on all rows of ``docs``
and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from txlens.llm.common import shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field, fitted on the labels, does not score as toxic."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    columns = docs.columns
    row = F.struct(*[docs[c] for c in columns]).alias("row")
    scored = docs.select(row, model.result(docs["text"]).alias("found"))
    return scored.where(F.col("found.score") < 0.5).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five-word shingles, similarity 0.8): the smallest id."""
    return jaccard_join.drop_near_copies(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Stages 1, 3, 4 and 5 (a trained field, link components, rounding, packing) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
