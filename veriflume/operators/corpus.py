"""The content-addressed corpus: identities, deduplication, merging and missing pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(rows: DataFrame, key: str, order: list[str], path: str) -> DataFrame:
    """One row per key, that of the first ``order``; ``all_paths`` is the sorted set of its paths.

    Aggregates combine before the shuffle, so a key that many rows share costs little.
    """
    others = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("first")
    return rows.groupBy(key).agg(first, F.array_sort(F.collect_set(path)).alias("all_paths")).select(key, "first.*", "all_paths")


def _merged_paths() -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list("all_paths")))).alias("all_paths")


def merge_sources(old: DataFrame, new: DataFrame, rule: str = "first") -> DataFrame:
    """Union of two source tables, one row per digest.

    ``first``: the first non-null value of each column, old before new. ``last``: first_seen_path keeps the first,
    extract_ok holds if either does, other columns keep the last non-null. all_paths is the union. Columns that only
    one side has are null on the other. Rows without a digest form one group.
    """
    both = old.withColumn("_seq", F.lit(0)).unionByName(new.withColumn("_seq", F.lit(1)), allowMissingColumns=True)
    out = []
    for c in both.columns:
        if c in ("_seq", "source_sha256"):
            continue
        if c == "all_paths":
            out.append(_merged_paths())
        elif rule == "last" and c == "extract_ok":
            out.append(F.bool_or(F.coalesce(c, F.lit(False))).alias(c))
        else:
            pick = F.min_by if rule == "first" or c == "first_seen_path" else F.max_by
            out.append(pick(c, F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(c))
    return both.groupBy("source_sha256").agg(*out)


def missing_sidecars(pairs: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Cited digests without any extracted text, one row each, in order."""
    cited = pairs.where(F.coalesce(F.trim("source_sha256"), F.lit("")) != "")
    gone = cited.join(sidecars.select("source_sha256").distinct(), "source_sha256", "left_anti")
    first = gone.groupBy("source_sha256").agg(F.min(F.struct("group_id", "file_name_raw")).alias("r"))
    return first.select("r.group_id", "r.file_name_raw", "source_sha256").orderBy("group_id", "file_name_raw", "source_sha256")


def uncovered(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of ``left`` that ``right`` lacks."""
    return left.select(key).where(F.col(key).isNotNull()).distinct().join(right.select(key).distinct(), key, "left_anti")


def extraction_status(expected: DataFrame, artifacts: DataFrame, sources: DataFrame) -> DataFrame:
    """Per group: files expected, those extracted, the paths that aren't, and a mark.

    ``expected``: group_id, path, source_sha256. A file is fine if its digest has an artifact or any source row that
    lists its path is.
    """
    by_path = sources.select(F.explode("all_paths").alias("path"), "extract_ok").groupBy("path").agg(F.bool_or("extract_ok").alias("ok_by_path"))
    have = artifacts.select("source_sha256").distinct().withColumn("has", F.lit(True))
    rows = expected.join(have, "source_sha256", "left").join(by_path, "path", "left").withColumn("ok", F.coalesce("has", F.lit(False)) | F.coalesce("ok_by_path", F.lit(False)))
    missing = F.count_if(~F.col("ok"))
    return rows.groupBy("group_id").agg(
        F.count("*").alias("expected"),
        F.count_if("ok").alias("ok"),
        F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("path")))).alias("missing"),
        F.when(missing == 0, "✅").when(missing <= 3, "⚠️").otherwise("❌").alias("mark"),
    )


def new_artifacts(extracted: DataFrame, existing: DataFrame, reextract: bool = False) -> DataFrame:
    """Rows to append to the text store: only unseen digests, unless all are to be written again."""
    return extracted if reextract else extracted.join(existing.select("source_sha256").distinct(), "source_sha256", "left_anti")


def included_groups(spec: str, column: Column) -> Column:
    """Filter of a comma-separated list: a number means ``group N`` inside the name, other words match inside it too."""
    wanted = [t.strip().lower() for t in (spec or "").split(",") if t.strip()]
    out = F.lit(not wanted)
    for t in wanted:
        out = out | (F.lower(column) == t) | F.contains(F.lower(column), F.lit(f"group {t}" if t.isdigit() else t))
    return out


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
