"""Extracted text by digest, whichever way a row names it, and the sentences an index is built on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.segment import sentences
from ..functions.text import basename


def chosen_text(rows: DataFrame, by_sha: DataFrame, by_path: DataFrame, path_cols: list[str]) -> DataFrame:
    """Adds ``text``: by digest, else by each path column in turn, and for each by its path, then by its base name.

    ``by_path``: path, text; of files with one base name the first path counts.
    """
    out = rows.join(by_sha.select("source_sha256", F.col("text").alias("_t")), "source_sha256", "left")
    found: list[Column] = [F.col("_t")]
    by_name = by_path.groupBy(basename(F.col("path")).alias("_name")).agg(F.min_by("text", "path").alias("text"))
    for i, c in enumerate(path_cols):
        out = out.join(by_path.select(F.col("path").alias(c), F.col("text").alias(f"_p{i}")), c, "left")
        names = by_name.select(F.col("_name").alias(f"_n{i}"), F.col("text").alias(f"_b{i}"))
        out = out.withColumn(f"_n{i}", basename(F.col(c))).join(names, f"_n{i}", "left")
        found += [F.col(f"_p{i}"), F.col(f"_b{i}")]
    gone = [f"_{x}{i}" for x in "pnb" for i in range(len(path_cols))]
    return out.withColumn("text", F.coalesce(*found)).drop("_t", *gone)


def index_sentences(rows: DataFrame, tei_col: str = "tei_sentences", text_col: str = "text") -> DataFrame:
    """Adds ``sents``: those of the TEI document if it has any, else of the plain text, else none."""
    plain = sentences(F.col(text_col))
    empty = F.array().cast("array<string>")
    return rows.withColumn("sents", F.when(F.size(tei_col) > 0, F.col(tei_col)).when(F.size(plain) > 0, plain).otherwise(empty))
