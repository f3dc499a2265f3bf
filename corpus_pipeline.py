"""A corpus cleaned and packed in stages.

Every stage reads what the one before it wrote, the whole of it. All but the last
return the columns of ``documents``; a stage without rows hands an empty table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from neoflow.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from neoflow.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect (five-word shingles, similarity 0.8) the least doc_id stays."""
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one word in twenty from benchmark windows go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences are written; returned are the pieces read back from them, with sequence and offset."""
    import public_tokenizers

    return packing.packed_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]

#: Classifier, near duplicates and tokenizer are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
