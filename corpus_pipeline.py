"""A corpus pipeline: quality, near-duplicates, repeated passages, mixing, tokens.

Each stage takes all rows its predecessor kept. All but the last return the columns of the documents, any further
columns among them. Null and empty texts pass the stages as texts without words; rows with equal id and text are one
document after the near-dedup; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, passages, quality, simhash
from tidemark.scratch import stored

#: No SQL expresses a fitted classifier; the stages behind it are tested against plain versions on small tables.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labels of the given documents.

    Without a usable label it has learned nothing, scores all alike, and all documents stay.
    """
    machine = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not machine.learned:
        return docs
    return docs.filter(quality.score_column(docs, machine) >= quality.ACCEPT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group that SimHash links connect.

    Fingerprints are of three-word shingles and link at two or fewer differing bits, as in the operator itself.
    """
    return simhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that repeated windows cover."""
    others = tuple(c for c in docs.columns if c != "text")
    cleaned = passages.remove_repeats(docs, passages.cleaned, "text string", others)
    return _measured(cleaned.select(*docs.columns))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and at the cut as far, as the mix takes their words."""
    return _measured(mixing.mixed(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of the ids and of what they decode to."""
    keep = ("doc_id", "lang", "source")
    encoded = bpe.encode_texts(docs, public_tokenizers.path(bpe.VOCABULARY), keep, decoded=True)
    return bpe.digests(encoded, (*keep, "ids"))


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("source mix", source_mix),
    ("bpe tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents; between stages they are Parquet in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, "stage-" + name.replace(" ", "-"))
    return docs
