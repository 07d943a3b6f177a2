"""Retrieval inside one source: BM25 as relational algebra, ranks, spans and reranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import match_form

K1, B, EPSILON = 1.5, 0.75, 0.25


def cited(sources: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows of ``sources`` (sha, ...) whose source a query (sha) asks for: before texts are cut and tokens explode."""
    return sources.join(queries.select("sha").distinct(), "sha", "left_semi")


def _filled(units: DataFrame) -> DataFrame:
    """``sha, unit_idx, tokens, dl``; a unit without tokens has one empty term."""
    tokens = F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))
    return units.select("sha", "unit_idx", tokens.alias("tokens")).withColumn("dl", F.size("tokens"))


def term_weights(units: DataFrame, asked: DataFrame) -> DataFrame:
    """``sha, term, idf, avgdl`` of the terms in ``asked`` (sha, term).

    The mean idf of a source, of which a negative idf becomes a share, is over all its terms; these meet only in counts.
    """
    full = _filled(units)
    size = full.groupBy("sha").agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    df = full.select("sha", F.explode(F.array_distinct("tokens")).alias("term")).groupBy("sha", "term").agg(F.count("*").alias("df"))
    raw = df.join(size, "sha").withColumn("raw", F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = raw.groupBy("sha").agg(F.avg("raw").alias("mean"))
    idf = F.when(F.col("raw") < 0, EPSILON * F.col("mean")).otherwise(F.col("raw"))
    wanted = asked.select("sha", "term").distinct()
    return raw.join(wanted, ["sha", "term"], "left_semi").join(mean, "sha").select("sha", "term", idf.alias("idf"), "avgdl")


def bm25(units: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, sha, unit_idx, score`` of units that share a term with a query of their source.

    ``units``: sha, unit_idx, tokens; ``queries``: query_id, sha, tokens (repeats count). Other units score 0; see
    :func:`bm25_all` and :func:`bm25_top`. Only postings of terms that a query of the source has are counted and joined.
    """
    units = cited(units, queries)
    terms = queries.select("query_id", "sha", F.explode("tokens").alias("term"))
    asked = terms.groupBy("query_id", "sha", "term").agg(F.count("*").alias("qtf"))
    rows = _filled(units).select("sha", "unit_idx", "dl", F.explode("tokens").alias("term"))
    posts = rows.join(asked.select("sha", "term").distinct(), ["sha", "term"], "left_semi")
    posts = posts.groupBy("sha", "unit_idx", "dl", "term").agg(F.count("*").alias("tf"))
    tf, norm = F.col("tf"), 1 - B + B * F.col("dl") / F.col("avgdl")
    hits = asked.join(term_weights(units, asked), ["sha", "term"]).join(posts, ["sha", "term"])
    part = F.col("qtf") * F.col("idf") * tf * (K1 + 1) / (tf + K1 * norm)
    return hits.groupBy("query_id", "sha", "unit_idx").agg(F.sum(part).alias("score"))


def bm25_all(units: DataFrame, queries: DataFrame) -> DataFrame:
    """Scores of every unit of a query's source, zeros included: for rankings that are to be whole."""
    every = queries.select("query_id", "sha").join(units.select("sha", "unit_idx"), "sha")
    scored = every.join(bm25(units, queries), ["query_id", "sha", "unit_idx"], "left")
    return scored.withColumn("score", F.coalesce("score", F.lit(0.0)))


def bm25_top(units: DataFrame, queries: DataFrame, k: int, digits: int | None = None) -> DataFrame:
    """``query_id, sha, unit_idx, score, bm25_rank``: the best ``k`` units of each query's source, ties to the smaller.

    Only units that share a term are scored. Where fewer than ``k`` of them score above zero, the smallest other units
    (which score zero) fill up; these are reckoned from the number of units, so no query meets all units of its source.
    Unit numbers run from 0 without gaps. ``digits`` rounds scores before they rank.
    """
    hits = bm25(units, queries)
    score = F.col("score") if digits is None else F.round("score", digits)
    found = hits.groupBy("query_id", "sha").agg(F.collect_list(F.struct((-score).alias("s"), F.col("unit_idx").cast("int").alias("unit_idx"))).alias("found"))
    sizes = cited(units, queries).groupBy("sha").agg(F.count("*").cast("int").alias("n"))
    rows = queries.select("query_id", "sha").join(sizes, "sha").join(found, ["query_id", "sha"], "left")
    rows = rows.withColumn("found", F.coalesce("found", F.array().cast("array<struct<s:double,unit_idx:int>>")))
    few = F.size(F.filter("found", lambda x: x["s"] < 0)) < k
    low = F.sequence(F.lit(0), F.least("n", F.size("found") + k) - 1)
    pad = F.slice(F.array_except(low, F.transform("found", lambda x: x["unit_idx"])), 1, k)
    pad = F.transform(pad, lambda i: F.struct(F.lit(0.0).alias("s"), i.alias("unit_idx")))
    best = F.slice(F.array_sort(F.when(few, F.concat("found", pad)).otherwise(F.col("found"))), 1, k)
    out = rows.select("query_id", "sha", F.posexplode(best).alias("bm25_rank", "b"))
    return out.select("query_id", "sha", F.col("b.unit_idx").alias("unit_idx"), (-F.col("b.s")).alias("score"), "bm25_rank")


def ranked(scores: DataFrame, k: int | None = None) -> DataFrame:
    """Adds ``bm25_rank`` from 0 per query, ties to the smaller unit; keeps ``k``."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "unit_idx")
    out = scores.withColumn("bm25_rank", F.row_number().over(order) - 1)
    return out if k is None else out.where(F.col("bm25_rank") < k)


def spans(hits: DataFrame, units: DataFrame, max_size: int = 3) -> DataFrame:
    """Runs of sentences round each hit: forward and backward, up to as many as the query has (``q_sentences``).

    ``hits``: query_id, sha, unit_idx, bm25_rank, q_sentences. ``units``: sha, sents (array). Candidates are in match
    form; empty ones are dropped, of equal ones of a query the first stays. Gives ``query_id, pos, candidate, start,
    end`` with both ends inclusive. Hits fetch the few sentences they need; no row carries a document.
    """
    size = F.least(F.greatest("q_sentences", F.lit(1)), F.lit(max_size))
    near = F.sequence(F.greatest(F.col("unit_idx") - size + 1, F.lit(0)), F.col("unit_idx") + size - 1)
    wanted = hits.select("query_id", "sha", F.explode(near).alias("at")).distinct()
    rows = units.join(hits.select("sha").distinct(), "sha", "left_semi").select("sha", F.size("sents").alias("n"), F.posexplode("sents").alias("at", "sent"))
    texts = wanted.join(rows, ["sha", "at"]).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "sent"))).alias("texts"), F.first("n").alias("n"))
    asked = hits.groupBy("query_id").agg(F.first(size).alias("size"), F.array_sort(F.collect_list(F.struct("bm25_rank", "unit_idx"))).alias("hits"))

    def runs(h):
        def both(s):
            ahead = F.struct(h["unit_idx"].alias("start"), (F.least(F.col("n"), h["unit_idx"] + s) - 1).alias("end"))
            return F.array(ahead, F.struct(F.greatest(F.lit(0), h["unit_idx"] - s + 1).alias("start"), h["unit_idx"].alias("end")))

        return F.flatten(F.transform(F.sequence(F.lit(1), F.col("size")), both))

    def form(r):
        return match_form(F.array_join(F.transform(F.sequence(r["start"], r["end"]), lambda i: F.element_at("texts", i)), " "))

    out = asked.join(texts, "query_id").withColumn("runs", F.flatten(F.transform("hits", runs)))
    out = out.withColumn("forms", F.transform("runs", form))
    once = F.array_distinct(F.filter("forms", lambda x: x != ""))
    placed = F.transform(once, lambda x: F.struct(x.alias("candidate"), F.element_at("runs", F.array_position("forms", x).cast("int")).alias("run")))
    out = out.select("query_id", F.posexplode(placed).alias("pos", "c"))
    return out.select("query_id", "pos", "c.candidate", "c.run.start", "c.run.end")


def reranked(hits: DataFrame, cosine: str, k: int) -> DataFrame:
    """Second stage: ``embed_rank`` from 0 by falling cosine, ties to the better BM25 rank; keeps ``k``."""
    order = Window.partitionBy("query_id").orderBy(F.desc(cosine), "bm25_rank")
    return hits.withColumn("embed_rank", F.row_number().over(order) - 1).where(F.col("embed_rank") < k)
