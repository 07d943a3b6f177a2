"""A corpus pipeline of four stages; each is written as Parquet and reread as the next one's documents.

Every stage works on all rows it gets. Columns of other names pass through the first three. Rows with a null id pass as
rows of their own; an empty table stays empty. Null, empty and letterless texts go in the language stage; where rows
repeat an id, the near-copy stage keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriflume.llm import jaccard, langid, packing, toxicity
from veriflume.llm.common import scratch_path, table
from veriflume.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones.

    What has no letters, or scores under the threshold that 0.998 of rightly named calibration texts reach, goes.
    """
    judged, name = langid.with_language(docs, langid.fit_documents(docs))
    return judged.where(~F.col(f"{name}.rejected")).drop(name)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, learned from the labels table, doesn't find toxic."""
    judged, name = toxicity.with_toxicity(docs, toxicity.fit_from_labels(docs, table(spark, sf_dir, "labels")))
    return judged.where(~F.col(f"{name}.toxic")).drop(name)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts link; the smallest doc_id stays.

    SimHash fingerprints of 5-word shingles that meet within two bits, then an exact set join for pairs further apart in
    bits; either way a link is a Jaccard similarity of 0.8 or more on whole texts.
    """
    return jaccard.representatives(docs, width=5, least=0.8)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, packed into sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [("language", language), ("toxicity", toxic), ("near_copies", near_copies), ("packing", pack)]

#: Trained models, fingerprints and tokens have no SQL form; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
