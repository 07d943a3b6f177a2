"""Inference scores over flagged candidates: scoring by a pluggable model, merging back, reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import truthy
from .corpus import top_per_group

#: premise and hypothesis lists to one dict of raw label to probability each
Scorer = Callable[[list[str], list[str]], list[dict[str, float]]]
ALIASES = {"candidate_text": "candidate_window", "recommended_nli": "recommend_nli"}
COLUMNS = ("nli_label", "nli_score", "nli_entailment", "nli_neutral", "nli_contradiction")


def load_candidates(cands: DataFrame) -> DataFrame:
    """Legacy column names renamed; the flag defaults to false, the id to null; other required columns must be there."""
    for old, new in ALIASES.items():
        if old in cands.columns and new not in cands.columns:
            cands = cands.withColumnRenamed(old, new)
    missing = {"candidate_window", "query_text"} - set(cands.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    if "recommend_nli" not in cands.columns:
        cands = cands.withColumn("recommend_nli", F.lit(False))
    return cands if "candidate_id" in cands.columns else cands.withColumn("candidate_id", F.lit(None).cast("string"))


def selected(cands: DataFrame, flagged_only: bool = True) -> DataFrame:
    return cands.where(truthy(F.col("recommend_nli"))) if flagged_only else cands


def normal_label(raw: dict[str, float]) -> tuple[str | None, float | None, float | None, float | None, float | None]:
    """Label, its score and the three probabilities. Without the full trio: the largest raw label, no probabilities."""
    trio = {}
    for name, p in raw.items():
        for stem, label in (("entail", "entailment"), ("neutral", "neutral"), ("contrad", "contradiction")):
            if stem in name.lower():
                trio[label] = p
    if len(trio) == 3:
        label = max(("entailment", "neutral", "contradiction"), key=lambda k: trio[k])
        return label, trio[label], trio["entailment"], trio["neutral"], trio["contradiction"]
    if not raw:
        return None, None, None, None, None
    label = max(raw, key=raw.get)
    return label, raw[label], None, None, None


def lexical_scorer(premises: list[str], hypotheses: list[str]) -> list[dict[str, float]]:
    """Deterministic offline stand-in for a model: overlap of words, turned by a negation on one side only."""
    out = []
    for p, h in zip(premises, hypotheses, strict=True):
        a, b = set(p.lower().split()), set(h.lower().split())
        share = len(a & b) / max(1, len(b))
        negated = bool({"not", "no", "never"} & a) != bool({"not", "no", "never"} & b)
        yes, no = (0.1 * share, 0.9 * share) if negated else (0.9 * share, 0.1 * share)
        out.append({"ENTAILMENT": yes, "NEUTRAL": 1 - share, "CONTRADICTION": no})
    return out


def score(cands: DataFrame, scorer: Scorer = lexical_scorer, batch: int = 8, max_length: int | None = None) -> DataFrame:
    """Adds the label and probabilities; premise is the window, hypothesis the query. ``max_length`` cuts premises to so
    many words (a model's scorer may cut by its own tokens instead)."""

    def cut(text: str) -> str:
        return text if max_length is None else " ".join(text.split()[:max_length])

    @F.pandas_udf("nli_label string, nli_score double, nli_entailment double, nli_neutral double, nli_contradiction double")
    def udf(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for premise, hypothesis in parts:
            p, h, rows = [cut(x) for x in premise.fillna("")], hypothesis.fillna("").tolist(), []
            for i in range(0, len(p), batch):
                rows += [normal_label(r) for r in scorer(p[i : i + batch], h[i : i + batch])]
            yield pd.DataFrame(rows, columns=list(COLUMNS))

    return cands.withColumn("_nli", udf("candidate_window", "query_text")).select("*", "_nli.*").drop("_nli")


def merge_scores(cands: DataFrame, scored: DataFrame) -> DataFrame:
    """All candidates with the scores of those that have some; a new score wins over an old one.

    Of scores that repeat a candidate the one with the largest score counts, as a whole row.
    """
    have = [c for c in COLUMNS if c in scored.columns]
    given = F.struct(*[F.col(c).alias(f"_{c}") for c in have])
    order = F.struct(*[F.col(c) for c in ("nli_score", "nli_label") if c in have], F.xxhash64(*have))
    known = scored.where(F.col("candidate_id").isNotNull() & F.coalesce(*[F.col(c).cast("string") for c in have]).isNotNull())
    new = known.groupBy("candidate_id").agg(F.max_by(given, order).alias("g")).select("candidate_id", "g.*")
    out = cands.join(new, "candidate_id", "left")
    return out.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) if c in cands.columns else F.col(f"_{c}") for c in have}).drop(*[f"_{c}" for c in have])


def summary(merged: DataFrame) -> DataFrame:
    """``group, candidates, nli_scored, contradictions, contradiction_rate``; the rate is 0 where nothing was scored."""
    scored, against = F.count("nli_label"), F.count_if(F.lower("nli_label") == "contradiction")
    return merged.groupBy(F.col("group_id").alias("group")).agg(F.count("*").alias("candidates"), scored.alias("nli_scored"), against.alias("contradictions"), F.when(scored > 0, against / scored).otherwise(0.0).alias("contradiction_rate"))


def top_by_pair(merged: DataFrame, k: int = 3) -> DataFrame:
    """Per pair contradictions first, then by their probability (score where that is missing, else -1), then cosine."""
    against = F.coalesce((F.lower("nli_label") == "contradiction").cast("int"), F.lit(0))
    order = [F.desc(against), F.desc(F.coalesce("nli_contradiction", "nli_score", F.lit(-1.0))), F.desc("embed_cosine"), F.asc("candidate_id")]
    return top_per_group(merged, ["group_id", "row_id"], order, k)


def top_contradictions(merged: DataFrame, k: int = 50) -> DataFrame:
    return top_per_group(merged.where(F.lower("nli_label") == "contradiction"), ["group_id"], [F.desc("nli_score"), F.asc("candidate_id")], k)


def report(merged: DataFrame, k: int = 3) -> DataFrame:
    """``group, report``: JSON of each pair's top windows."""
    item = F.struct("candidate_id", "candidate_window", *COLUMNS, "embed_cosine")
    pairs = top_by_pair(merged, k).groupBy("group_id", "row_id").agg(F.collect_list(item).alias("windows"))
    return pairs.groupBy(F.col("group_id").alias("group")).agg(F.to_json(F.array_sort(F.collect_list(F.struct("row_id", "windows")))).alias("report"))
