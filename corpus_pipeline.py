"""From raw documents to packed training sequences.

Each stage works on all that its predecessor has kept, and its output is stored
before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, jaccard, line_dedup, packing, toxicity
from tidemark.llm.common import BLANKS
from tidemark.session import written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below 0.3 under a model of the labelled documents."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model, threshold=0.3)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the three-line passages of earlier ones, and without those of which nothing else is left.

    n_chars follows the text where lines were removed.
    """
    count = "_" * max(map(len, docs.columns)) + "removed"  # no input column has so long a name
    done = line_dedup.drop_repeated_lines(docs, added=count)
    kept = done.where((F.col(count) == 0) | (F.btrim("text", F.lit(BLANKS)) != ""))
    length = F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", length).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles have a similarity of 0.8 or more."""
    return jaccard.one_of_each_group(docs, words=5, least=80)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even one with a fifth of its words changed."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in sequences of 2048."""
    import public_tokenizers

    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("ngram_jaccard", keep_one_of_near_copies),
    ("decontamination", remove_contaminated),
    ("packing", pack_sequences),
]

#: SQL can express neither the model nor the tokenizer; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
