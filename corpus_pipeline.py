"""Corpus pipeline: toxic documents go, copies go, near copies go, repeated
passages go, the rest is packed into sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from credlake.llm import exact_dedup, packing, simhash_dedup, suffix_dedup, toxicity
from credlake.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go; it learns from the labelled rows of docs."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z the largest doc_id stays."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 4-word shingles at 4 bits or fewer, the smallest doc_id stays."""
    return simhash_dedup.drop_near_copies(docs, shingle=4, max_bits=4)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a smaller doc_id holds are cut out of texts; all documents stay."""
    return suffix_dedup.strip_repeats(docs, 50)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", strip_repeats),
    ("packing", pack),
]

#: No SQL form: classifier, component search and tokenizer are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
