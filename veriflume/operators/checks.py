"""Invariants of the produced tables, as DataFrames of violations and one combined report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import group_key, sha_loose
from .corpus import uncovered


def require_columns(df: DataFrame, *names: str) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1")


def invariants(pairs: DataFrame, sources: DataFrame, report: DataFrame, summary: DataFrame) -> DataFrame:
    """``check, violations, warn``: 0 violations means that the check holds."""
    group = "group" if "group" in summary.columns else "group_id"
    summary = summary.withColumnRenamed(group, "group")
    require_columns(pairs, "source_sha256", "source_ref_type", "source_ref", "resolved_source_path")
    require_columns(report, "group_id", "nonempty_rows", "resolved_count", "extract_ok_count", "extract_success_ratio", "graph_like_count")
    require_columns(summary, "success_ratio", "total", "hits", "misses")
    p = pairs.withColumn("sha", sha_loose(F.col("source_sha256")))
    s = sources.select(sha_loose(F.col("source_sha256")).alias("sha"))
    count = lambda df, name, warn=False: df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations", F.lit(warn).alias("warn"))
    total = report.agg(F.sum("nonempty_rows").alias("a"), F.sum("extract_ok_count").alias("b"))
    mine, theirs = report.select(group_key(F.col("group_id")).alias("group")), summary.select(group_key(F.col("group")).alias("group"))
    parts = [
        count(total.where("coalesce(a, 0) <= 0 or coalesce(b, 0) <= 0"), "tables_not_empty"),
        count(duplicates(s, "sha"), "source_sha_unique"),
        count(p.where("resolved_source_path is not null and sha is null"), "resolved_has_sha"),
        count(uncovered(p, s, "sha"), "pair_shas_in_sources"),
        count(p.where(~F.coalesce(F.col("source_ref_type").isin("sha256", "url", "unresolved"), F.lit(False))), "ref_type_domain"),
        count(p.where("source_ref_type = 'sha256' and not (source_ref <=> concat('sha256:', sha))"), "ref_matches_sha"),
        count(uncovered(mine, theirs, "group"), "groups_in_summary"),
        count(uncovered(theirs, mine, "group"), "extra_groups", True),
        count(summary.where("not coalesce(success_ratio between 0 and 1, false)"), "ratio_in_range"),
        count(report.agg(F.countDistinct("group_id").alias("a"), F.countDistinct(group_key(F.col("group_id"))).alias("b")).where("b > a"), "group_names_stable"),
    ]
    return reduce(DataFrame.unionByName, parts)


def group_bounds(summary: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Groups whose ratio lies outside the bounds set for their (normalised) name."""
    group = "group" if "group" in summary.columns else "group_id"
    rows = [F.when(group_key(F.col(group)) == g.lower(), ~F.col("success_ratio").between(lo, hi)) for g, (lo, hi) in bounds.items()]
    return summary.where(F.coalesce(*rows, F.lit(False))) if rows else summary.limit(0)


