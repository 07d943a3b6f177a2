"""Quote verification: the best candidate per quote, its class, and reports per source and group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import VerifyConfig
from ..functions.segment import sentence_count
from ..functions.similarity import char_jaccard, char_stretches, literal_bonus, partial_ratio_udf, token_cosine
from ..functions.text import basename, bm25_tokens, match_form, quote_intent, strip, word_tokens
from ..llm.common import materialise, sendable
from . import retrieve

#: Rows with a quote's text that are sent to every task; more are joined by a shuffle.
SENT_QUOTES = 200_000


def display_name(resolved: Column, raw: Column) -> Column:
    """Base name of the resolved path, else the raw name, else UNRESOLVED."""
    return F.coalesce(F.nullif(basename(resolved), F.lit("")), F.nullif(strip(raw), F.lit("")), F.lit("UNRESOLVED"))


def best_candidates(scored: DataFrame) -> DataFrame:
    """Per query the candidate of the largest cosine (first position on ties) and the runner-up's position and cosine.

    ``scored``: query_id, pos, candidate, start, end, cosine. A single window ranks once for both.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "pos")
    top = scored.withColumn("place", F.row_number().over(order)).where("place <= 2")
    one = F.col("place") == 1
    pick = lambda c: F.max(F.when(one, F.col(c))).alias(c)
    return top.groupBy("query_id").agg(*[pick(c) for c in ("candidate", "start", "end", "cosine")], F.max(F.when(~one, F.col("pos"))).alias("alt_idx"), F.max(F.when(~one, F.col("cosine"))).alias("alt_cosine"))


def decided(best: DataFrame, cfg: VerifyConfig = VerifyConfig()) -> DataFrame:
    """Thresholds by quote length, hit or miss, class, reason and note. ``best`` has q, candidate, cosine, fuzzy, jaccard5, bonus."""
    n = F.length("q")
    fuzzy_thr = F.when(n < cfg.short_len, F.greatest(F.lit(cfg.fuzzy_thresh), F.lit(cfg.short_fuzzy))).otherwise(cfg.fuzzy_thresh)
    cos_thr = F.when(n < cfg.short_len, F.greatest(F.lit(cfg.cos_thresh), F.lit(cfg.short_cos))).when(n > cfg.long_len, F.least(F.lit(cfg.cos_thresh), F.lit(cfg.long_cos))).otherwise(cfg.cos_thresh)
    out = best.withColumns({"cos_thresh_used": cos_thr.cast("double"), "fuzzy_thresh_used": fuzzy_thr.cast("int"), "jaccard5_thresh_used": F.lit(cfg.jaccard_thresh)})
    cos, fuzzy, jac = F.col("cosine") + F.col("bonus") >= F.col("cos_thresh_used"), F.col("fuzzy") >= F.col("fuzzy_thresh_used"), F.col("jaccard5") >= cfg.jaccard_thresh
    hit = cos | fuzzy | jac
    near = (F.col("fuzzy") >= cfg.near_exact) | F.contains(match_form(F.col("candidate")), F.col("q"))
    hint = quote_intent(F.col("q")) == "non_textual_hint"
    kind = F.when(hit & near, "exact_or_near_exact").when(hit & jac & ~cos & ~fuzzy, "weak_match").when(hit, "semantic_match").when(hint, "non_textual_reference").otherwise("no_match")
    why = F.when(~hit & hint, "quote_points_to_figure_table_graph").when(~hit, "below_thresholds")
    parts = F.concat_ws("+", F.when(cos, "cos"), F.when(fuzzy, "fuzzy"), F.when(jac, "jaccard5"))
    note = F.when(hit, F.concat(parts, F.lit(" (bonus="), F.format_string("%.2f", "bonus"), F.lit(")"))).otherwise("below thresholds")
    return out.withColumns({"hit": hit, "verification_class": kind, "failure_reason": why, "note": note})


def verify_quotes(quotes: DataFrame, texts: DataFrame, cfg: VerifyConfig = VerifyConfig(), cosine: Column | None = None) -> DataFrame:
    """Evidence for every quote: retrieval, spans, similarity, decision.

    ``quotes``: query_id, sha, quote; ``texts``: sha, sents (array of sentences). Quotes that are empty or trivial, or
    whose source has no sentences, get their class without any retrieval. ``cosine`` compares columns ``q`` and
    ``candidate``; the default counts tokens, a sentence encoder can be put in its place. Fuzzy matching, the one
    Python step, runs on one candidate per quote.
    """
    # quotes are put in form once, in as many tasks as there is work, and so are the sentences of sources that are asked for
    asked = quotes.select("query_id", "sha", "quote").repartition("query_id").select("query_id", "sha", match_form(F.col("quote")).alias("q"))
    asked = materialise(asked.withColumns({"intent": quote_intent(F.col("q")), "q_tokens": word_tokens(F.col("q")), "q_sentences": sentence_count(F.col("q"))}), "quotes")
    texts = materialise(retrieve.cited(texts, asked).select("sha", "sents"), "cited")
    live = asked.where(~F.col("intent").isin("empty", "non_verifiable_trivial")).join(texts.where(F.size("sents") > 0).select("sha"), "sha", "left_semi")
    used = retrieve.cited(texts, live)
    units = used.select("sha", F.posexplode("sents").alias("unit_idx", "sent")).select("sha", "unit_idx", word_tokens(F.col("sent")).alias("tokens"))
    asked_tokens = live.select("query_id", "sha", F.col("q_tokens").alias("tokens"))
    hits = retrieve.bm25_top(units, asked_tokens, cfg.bm25_topk, digits=9)
    hits = hits.join(live.select("query_id", "q_sentences"), "query_id")
    cands = retrieve.spans(hits, used, cfg.max_window).join(live.select("query_id", "q", "q_tokens"), "query_id")
    score = cosine if cosine is not None else token_cosine(F.col("q_tokens"), word_tokens(F.col("candidate")))
    best = best_candidates(cands.withColumn("cosine", score))
    top = hits.groupBy("query_id").agg(F.max("score").alias("bm25"))
    best = best.join(top, "query_id").join(live.select("query_id", "q"), "query_id")
    best = best.withColumns({"jaccard5": char_jaccard(F.col("q"), F.col("candidate")), "bonus": literal_bonus(F.col("q"), F.col("candidate"), cfg.bonus), "fuzzy": partial_ratio_udf("q", "candidate")})
    found = decided(best, cfg).drop("q")
    out = asked.drop("q_tokens", "q_sentences").join(found, "query_id", "left")
    sentences = texts.select("sha", (F.size("sents") > 0).alias("has_text"))
    out = out.join(sentences, "sha", "left")
    no_text = ~F.coalesce("has_text", F.lit(False))
    say = lambda c, r, n: F.struct(F.lit(c).alias("c"), F.lit(r).alias("r"), F.lit(n).alias("n"))
    early = F.when(F.col("intent") == "empty", say("empty", "empty_quote_from_source", "empty quote_from_source"))
    early = early.when(F.col("intent") == "non_verifiable_trivial", say("non_verifiable", "trivial_or_non_verifiable", "non-verifiable (generic: figure/table/N.A.)"))
    early = early.when(no_text, say("no_text_index", "no_sentences_in_source", "no sentences in source"))
    early = early.when(F.col("candidate").isNull(), say("no_candidates", "no_valid_candidates_after_windowing", "no valid candidates after windowing"))
    out = out.withColumn("early", early)
    return out.select(
        "query_id", "sha", "q", "intent", F.coalesce("hit", F.lit(False)).alias("hit"),
        F.coalesce("early.c", "verification_class").alias("verification_class"), F.coalesce("early.r", "failure_reason").alias("failure_reason"), F.coalesce("early.n", "note").alias("note"),
        "candidate", F.when(F.col("candidate").isNotNull(), F.struct("start", "end")).alias("span"), "cosine", "bm25", "fuzzy", "jaccard5", "bonus",
        F.when(~F.coalesce("hit", F.lit(False)), F.col("alt_idx")).alias("alt_idx"), F.when(~F.coalesce("hit", F.lit(False)), F.col("alt_cosine")).alias("alt_cosine"),
        "cos_thresh_used", "fuzzy_thresh_used", "jaccard5_thresh_used",
    )


def by_source(evidence: DataFrame) -> DataFrame:
    """``group_id, source_filename, hits, misses, by_class, misses_detail`` from evidence with group_id and source_filename."""
    counted = evidence.groupBy("group_id", "source_filename", "verification_class").agg(F.count("*").alias("n"), F.count_if("hit").alias("h"))
    classes = counted.groupBy("group_id", "source_filename").agg(F.sum("h").alias("hits"), (F.sum("n") - F.sum("h")).alias("misses"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("verification_class", "n")))).alias("by_class"))
    detail = [c for c in evidence.columns if c not in ("group_id", "source_filename", "hit")]
    missed = evidence.where(~F.col("hit")).groupBy("group_id", "source_filename").agg(F.collect_list(F.struct(*detail)).alias("misses_detail"))
    return classes.join(missed, ["group_id", "source_filename"], "left")


def summary(evidence: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``group, success_ratio, total, hits, misses, checked``; a group with nothing checked has total 1 and ratio 0."""
    rows = evidence.groupBy(F.col("group_id").alias("group")).agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))
    if groups is not None:
        rows = groups.select(F.col("group_id").alias("group")).distinct().join(rows, "group", "left").fillna(0, ["hits", "misses"])
    checked = F.col("hits") + F.col("misses")
    total = F.greatest(F.lit(1), checked)
    return rows.select("group", F.bround(F.col("hits") / total, 4).alias("success_ratio"), total.alias("total"), "hits", "misses", checked.alias("checked"))


def group_report(evidence: DataFrame, cfg: VerifyConfig = VerifyConfig()) -> DataFrame:
    """``group, filename, report``: one JSON text per group, sources in case-insensitive order of their names."""
    sources = by_source(evidence)
    listed = F.array_sort(F.collect_list(F.struct(F.lower("source_filename").alias("k"), "source_filename", "hits", "misses", F.to_json("misses_detail").alias("d"), F.to_json("by_class").alias("c"))))
    per_group = sources.groupBy(F.col("group_id").alias("group")).agg(listed.alias("s"))


    def one(x: Column) -> Column:
        name = F.to_json(F.array(x["source_filename"]))  # the name as JSON, in brackets that go
        parts = [
            ("source_filename", name.substr(F.lit(2), F.length(name) - 2)), ("hits", x["hits"].cast("string")), ("misses", x["misses"].cast("string")),
            ("misses_detail", F.coalesce(x["d"], F.lit("[]"))), ("by_class", x["c"]),
        ]
        return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in parts]), F.lit("}"))

    body = F.transform("s", one)
    head = F.to_json(F.struct("group", "success_ratio", "total", "hits", "misses"))
    params = F.to_json(F.struct(F.lit(cfg.encoder).alias("encoder"), F.lit(cfg.bm25_topk).alias("bm25_topk"), F.lit(cfg.cos_thresh).alias("cos_thresh"), F.lit(cfg.fuzzy_thresh).alias("fuzzy_thresh")))
    report = F.concat(F.substring(head, 1, 1), F.expr("substring(head, 2, length(head) - 2)"), F.lit(',"by_source":['), F.array_join(body, ","), F.lit('],"params":'), params, F.lit("}"))
    return summary(evidence).join(per_group, "group").withColumn("head", head).select("group", F.concat(F.lit("Group_"), F.translate("group", "/ ", "__"), F.lit("_supplemental_information.json")).alias("filename"), report.alias("report"))


def exact_tier(docs: DataFrame, quotes: DataFrame) -> DataFrame:
    """Quotes found word for word: ``quote_id, sha, sent_idx, sentence``.

    Quote and sentence meet on a key that any sentence with the quote must have, never as a nested loop: the rarest of
    the quote's whole tokens (the runs at its ends may be parts of longer ones), or, where it has none, its rarest pair
    of characters (its only character, if it is one). Only ids and keys move before the match; the text comes then.
    Sentences are put in form and written once; keys of quotes and what they met are written too, so that few of them are
    sent to the sentences, which then don't move.
    ``docs``: sha, sents; ``quotes``: quote_id, q (in match form; empty ones are found nowhere).
    """
    sents = docs.select("sha", F.posexplode("sents").alias("sent_idx", "sentence"))
    other = F.nullif(match_form(F.col("sentence")), F.col("sentence"))  # most sentences are in form already
    sents = materialise(sents.withColumn("form", other), "sentences").withColumn("form", F.coalesce("form", "sentence"))
    inner = F.array_distinct(bm25_tokens(F.regexp_replace(F.lower("q"), "^[a-z0-9]+|[a-z0-9]+$", "")))
    asked = quotes.where("q <> ''").select("quote_id", "q", inner.alias("inner"), F.least(F.lit(2), F.length("q")).alias("g"))
    tier = F.when(F.size("inner") > 0, 0).otherwise(F.col("g"))
    keys = F.when(F.size("inner") > 0, F.col("inner")).when(F.col("g") == 2, char_stretches(F.col("q"), 2)).otherwise(F.array("q"))
    wanted = materialise(asked.select("quote_id", "q", tier.alias("tier"), F.explode(keys).alias("key")), "quote-keys")
    made = {0: F.array_distinct(bm25_tokens(F.col("form"))), 1: char_stretches(F.col("form"), 1), 2: char_stretches(F.col("form"), 2)}
    live = [r["tier"] for r in wanted.select("tier").distinct().orderBy("tier").collect()]  # at most three; others' keys aren't made
    tag = lambda i: F.transform(made[i], lambda k: F.struct(F.lit(i).alias("tier"), k.alias("key")))
    tagged = [tag(i) for i in live]
    keyed = F.flatten(F.array(*tagged)) if tagged else F.array().cast("array<struct<tier:int,key:string>>")
    rows = sents.select("sha", "sent_idx", F.inline(keyed))
    df = rows.join(sendable(materialise(wanted.select("tier", "key").distinct(), "keys")), ["tier", "key"], "left_semi").groupBy("tier", "key").agg(F.count("*").alias("df"))
    rare = wanted.join(df, ["tier", "key"], "left").groupBy("quote_id", "q", "tier").agg(F.min_by("key", F.struct(F.coalesce("df", F.lit(0)), "key")).alias("key"))
    rare = materialise(rare, "rarest")
    met = rows.join(sendable(rare.select("quote_id", "q", "tier", "key"), SENT_QUOTES), ["tier", "key"]).select("quote_id", "q", "sha", "sent_idx")
    met = sendable(materialise(met, "met"), SENT_QUOTES)
    return sents.join(met, ["sha", "sent_idx"]).where(F.contains("form", F.col("q"))).select("quote_id", "sha", "sent_idx", "sentence")
