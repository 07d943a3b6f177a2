"""Sinks: Parquet, the CSV dialects, JSON per group, append-only logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """Plain CSV, or every field quoted with backslash escapes. Arrays and structs become JSON text."""
    flat = df.select(*[F.to_json(F.col(f"`{c}`")).alias(c) if t.startswith(("array", "struct", "map")) else F.col(f"`{c}`") for c, t in df.dtypes])
    w = flat.write.mode("overwrite").option("header", True)
    (w.option("quoteAll", True).option("escape", "\\") if quote_all else w.option("escape", '"')).csv(path)


def write_group_json(reports: DataFrame, path: str, group: str = "group") -> None:
    """One folder per group holding its JSON text."""
    reports.select(group, F.col("report").alias("value")).write.mode("overwrite").partitionBy(group).text(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.select(*[c for c in ("timestamp", "url", "saved_as", "group_id") if c in rows.columns]).write.mode("append").option("header", True).csv(path)


def append_texts(new: DataFrame, path: str) -> None:
    new.write.mode("append").parquet(path)
