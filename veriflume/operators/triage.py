"""Passages near a citation that qualify or contradict it: candidates, cues, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TriageConfig
from ..functions.segment import sentences_abbrev, truncated, windows
from ..functions.similarity import partial_ratio_udf, token_cosine
from ..functions.text import bm25_tokens, candidate_id, marker_count, shorten, squeeze
from . import retrieve
from .corpus import top_per_group


def skip_reason(sha: Column, query: Column, text: Column, min_chars: int) -> Column:
    """Why a row isn't searched; null if it is."""
    return F.when(sha.isNull(), "missing_sha").when(F.length(squeeze(query)) < min_chars, "short_query").when(text.isNull(), "missing_text")


def skip_counts(rows: DataFrame) -> DataFrame:
    names = ("missing_sha", "short_query", "missing_text")
    return rows.agg(F.count("*").alias("rows"), *[F.count_if(F.col("skip_reason") == n).alias(n) for n in names])


def doc_windows(texts: DataFrame, cfg: TriageConfig = TriageConfig()) -> DataFrame:
    """``sha, unit_idx, window, tokens`` of each text once, whatever number of rows cite it."""
    sents = sentences_abbrev(truncated(F.col("text"), cfg.max_source_chars))
    rows = texts.select("sha", F.posexplode(windows(sents, cfg.window_sentences, cfg.window_stride)).alias("unit_idx", "window"))
    return rows.withColumn("tokens", bm25_tokens(F.col("window")))


def recommended(cfg: TriageConfig) -> Column:
    out = (F.col("limitation_hits") >= cfg.recommend_nli_if_limitation_hits) | (F.col("negation_hits") >= cfg.recommend_nli_if_negation_hits)
    return (F.col("contrast_hits") > 0) | out if cfg.recommend_nli_if_any_contrast else out


def cues(c: Column, cfg: TriageConfig) -> dict[str, Column]:
    return {"contrast_hits": marker_count(c, cfg.contrast_markers), "limitation_hits": marker_count(c, cfg.limitation_markers), "negation_hits": marker_count(c, cfg.negation_markers)}


def candidates(pairs: DataFrame, texts: DataFrame, cfg: TriageConfig = TriageConfig(), cosine: Column | None = None) -> DataFrame:
    """The candidate table of 20 columns.

    ``pairs``: cohort_id, group_id, row_id, source_sha256, resolved_source_path, quote_from_report, quote_from_source;
    ``texts``: sha, text. Windows are ranked by BM25 within the source, the best by cosine (columns ``query_text`` and
    ``window``), then floored, cued and given ids. The fuzzy score, in Python, runs on what is left only.
    """
    rows = pairs.join(texts.select(F.col("sha").alias("source_sha256"), F.lit(True).alias("has_text")), "source_sha256", "left")
    rows = rows.withColumn("query_text", squeeze(F.col(cfg.query_field)))
    rows = rows.where(skip_reason(F.col("source_sha256"), F.col("query_text"), F.col("has_text"), cfg.min_claim_chars).isNull()).drop("has_text")
    rows = rows.withColumn("query_id", F.xxhash64("cohort_id", "group_id", "row_id"))
    cited = texts.join(rows.select(F.col("source_sha256").alias("sha")).distinct(), "sha", "left_semi")
    units = doc_windows(cited, cfg)
    queries = rows.select("query_id", F.col("source_sha256").alias("sha"), bm25_tokens(F.col("query_text")).alias("tokens"))
    hits = retrieve.bm25_top(units, queries, cfg.bm25_topk, digits=9).join(units.select("sha", "unit_idx", "window"), ["sha", "unit_idx"])
    hits = hits.join(rows.select("query_id", "query_text"), "query_id")
    score = cosine if cosine is not None else token_cosine(bm25_tokens(F.col("query_text")), bm25_tokens(F.col("window")))
    top = retrieve.reranked(hits.withColumn("embed_cosine", score), "embed_cosine", cfg.embed_rerank_topk).where(F.col("embed_cosine") >= cfg.min_embed_cosine)
    out = top.drop("query_text", "sha").join(rows, "query_id").withColumns(cues(F.col("window"), cfg))
    cited_quote = F.lower(squeeze(F.col("quote_from_source")))
    out = out.withColumn("fuzzy", F.when(cited_quote == "", 0).otherwise(partial_ratio_udf(cited_quote, F.lower("window"))))
    ident = candidate_id(*[F.col(c) for c in ("cohort_id", "group_id", "row_id", "source_sha256", "window", "embed_rank")])
    return out.select(
        ident.alias("candidate_id"), "cohort_id", "group_id", "row_id", "source_sha256", F.col("resolved_source_path").alias("source_path"), F.lit(cfg.query_field).alias("query_field"), "query_text",
        "quote_from_report", "quote_from_source", F.col("window").alias("candidate_window"), "bm25_rank", F.col("score").alias("bm25_score"), "embed_rank", "embed_cosine",
        "contrast_hits", "limitation_hits", "negation_hits", F.col("fuzzy").alias("fuzzy_to_cited_quote"), recommended(cfg).alias("recommend_nli"),
    )


def summary(cands: DataFrame) -> DataFrame:
    """Per group (null kept): pairs, candidates, recommendations, mean cosine and whether any cue occurs."""
    flag = lambda c: F.max((F.col(c) > 0).cast("int")).alias(f"any_{c.removesuffix('_hits')}")
    out = cands.groupBy("group_id").agg(
        F.countDistinct("row_id").alias("pairs"), F.count("candidate_window").alias("candidates"), F.sum(F.col("recommend_nli").cast("long")).alias("recommend_nli"), F.avg("embed_cosine").alias("avg_cosine"),
        flag("contrast_hits"), flag("limitation_hits"), flag("negation_hits"),
    )
    return out.orderBy(F.desc("recommend_nli"), F.desc("avg_cosine"), "group_id")


def empty_summary(rows: DataFrame) -> DataFrame:
    """The diagnostic row when no candidate was found: how many rows were skipped and why."""
    return skip_counts(rows).select(F.lit("NO_CANDIDATES").alias("group_id"), "rows", F.lit(0).alias("candidates"), "missing_sha", "short_query", "missing_text", F.lit("no candidates generated").alias("note"))


def teacher_view(cands: DataFrame, n: int = 3) -> DataFrame:
    """The best ``n`` windows per (group, row), with shortened texts."""
    order = [F.desc("recommend_nli"), F.desc("embed_cosine"), F.desc("bm25_score"), F.asc("candidate_id")]
    top = top_per_group(cands, ["group_id", "row_id"], order, n)
    short = {"quote_from_report": 240, "quote_from_source": 240, "candidate_window": 320}
    return top.select(
        "group_id", "row_id", *[shorten(F.col(c), k).alias(c) for c, k in short.items()], "recommend_nli", "embed_cosine", "bm25_score",
        "contrast_hits", "limitation_hits", "negation_hits", "fuzzy_to_cited_quote", "candidate_id", "source_sha256", "source_path", "cohort_id",
    )


def nested_report(cands: DataFrame) -> DataFrame:
    """``group_id, report``: JSON of rows with their claims and windows, in order of rank."""
    window = F.struct("embed_rank", "candidate_id", "candidate_window", "bm25_rank", "bm25_score", "embed_cosine", "contrast_hits", "limitation_hits", "negation_hits", "fuzzy_to_cited_quote", "recommend_nli")
    rows = cands.groupBy("group_id", "row_id").agg(
        F.first("query_text").alias("claim"), F.first("quote_from_source").alias("cited"), F.first("source_sha256").alias("source_sha256"),
        F.array_sort(F.collect_list(window)).alias("candidates"),
    )
    return rows.groupBy("group_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("row_id", "claim", "cited", "source_sha256", "candidates")))).alias("report"))
