"""Registry of the engine's queries over the driver's tables, and of the SQL that each must equal.

documents play the sources (group: source, path: source/doc_id, digest: sha256 of the text), benchmark the claimed
quotes, pages the HTML files, conversations the pairs (a turn and the next), embeddings the encoded passages, labels
the partial scores, events the append-only log. Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import TriageConfig, VerifyConfig
from .functions import segment, similarity, text
from .operators import checks, corpus, nli, retrieve, tables, triage, verify
from .sources.extract import html_udf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Cue terms that the driver's invented texts do have.
CUES = TriageConfig(contrast_markers=("and", "that"), limitation_markers=("the", "of"), negation_markers=("no ", "with"))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c, name: str):
    return F.round(c, 6).alias(name)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as files: source_sha256, group_id, path, text."""
    d = t(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2("text", 256).alias("source_sha256"), F.col("source").alias("group_id"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text", "lang", "n_chars")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with the next one of its conversation: claim and evidence."""
    c = t(spark, sf_dir, "conversations")
    later = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("evidence"))
    return c.select("conv_id", "turn", F.col("text").alias("claim")).join(later, ["conv_id", "turn"])


FILES = "f AS (SELECT doc_id, sha256(text) AS source_sha256, source AS group_id, source || '/' || CAST(doc_id AS VARCHAR) AS path, text, lang, n_chars FROM documents)"
TURNS = "p AS (SELECT a.conv_id, a.turn, a.text AS claim, b.text AS evidence FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)"
SENTS = r"list_filter(list_transform(string_split(regexp_replace({c}, '([.?!])\s+([A-Z(])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '')"
TOKENS = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"
MATCH = r"trim(regexp_replace(regexp_replace({c}, '\s+', ' ', 'g'), '\(\s*[A-Za-z]+(?: et al\.)?,?\s*\d{{4}}[a-z]?\s*\)', '', 'g'))"


GRAMS = "CASE WHEN length({c}) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(length({c}) - 4, 1) + 1), lambda i: substr(lower({c}), i, 5))) END"


@query(f"WITH {FILES} SELECT source_sha256, min(doc_id) AS first_doc, count(*) AS copies, array_to_string(list_sort(list_distinct(list(path))), ',') AS all_paths FROM f GROUP BY 1")
def content_dedup(spark, sf_dir):
    f = files(spark, sf_dir)
    n = f.groupBy("source_sha256").agg(F.count("*").alias("copies"))
    d = corpus.dedup(f.select("source_sha256", F.col("doc_id").alias("first_doc"), "path"), "source_sha256", ["first_doc"], "path")
    return d.join(n, "source_sha256").select("source_sha256", "first_doc", "copies", F.array_join("all_paths", ",").alias("all_paths"))


def _old_new(spark, sf_dir):
    f = files(spark, sf_dir)
    one = f.groupBy("source_sha256").agg(F.min(F.struct("doc_id", "path", "lang", "n_chars")).alias("r")).select("source_sha256", "r.*")
    base = one.select("source_sha256", "path", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"), "n_chars", (F.col("doc_id") % 4 == 0).alias("extract_ok"))
    old = base.where("n_chars % 5 <> 0").select("source_sha256", F.array("path").alias("all_paths"), F.col("path").alias("first_seen_path"), "lang", "extract_ok")
    new = base.where("n_chars % 2 = 0").select("source_sha256", F.array(F.concat("path", F.lit("#2"))).alias("all_paths"), F.concat("path", F.lit("#2")).alias("first_seen_path"), F.upper("lang").alias("lang"), (~F.col("extract_ok")).alias("extract_ok"))
    return old, new


OLD_NEW = f"""{FILES}, o AS (SELECT source_sha256, arg_min(struct_pack(d := doc_id, p := path, l := lang, n := n_chars), doc_id) AS r FROM f GROUP BY 1),
    b AS (SELECT source_sha256, r.p AS path, CASE WHEN r.d % 3 <> 0 THEN r.l END AS lang, r.n AS n_chars, r.d % 4 = 0 AS ok FROM o),
    u AS (SELECT 0 AS seq, source_sha256, path, lang, ok FROM b WHERE n_chars % 5 <> 0 UNION ALL SELECT 1, source_sha256, path || '#2', upper(lang), NOT ok FROM b WHERE n_chars % 2 = 0)"""


@query(f"WITH {OLD_NEW} SELECT source_sha256, array_to_string(list_sort(list(path)), ',') AS all_paths, arg_min(path, seq) AS first_seen_path, arg_min(lang, seq) FILTER (lang IS NOT NULL) AS lang, arg_min(ok, seq) AS extract_ok FROM u GROUP BY 1")
def source_merge_first_nonnull(spark, sf_dir):
    return corpus.merge_sources(*_old_new(spark, sf_dir), rule="first").withColumn("all_paths", F.array_join("all_paths", ","))


@query(f"WITH {OLD_NEW} SELECT source_sha256, array_to_string(list_sort(list(path)), ',') AS all_paths, arg_min(path, seq) AS first_seen_path, arg_max(lang, seq) FILTER (lang IS NOT NULL) AS lang, bool_or(ok) AS extract_ok FROM u GROUP BY 1")
def source_merge_last_nonnull(spark, sf_dir):
    return corpus.merge_sources(*_old_new(spark, sf_dir), rule="last").withColumn("all_paths", F.array_join("all_paths", ","))


@query(f"WITH {FILES} SELECT group_id, source_sha256, array_to_string(list_sort(list_distinct(list(path))), ',') AS all_paths FROM f GROUP BY 1, 2")
def all_paths_union(spark, sf_dir):
    return files(spark, sf_dir).groupBy("group_id", "source_sha256").agg(F.array_join(F.array_sort(F.collect_set("path")), ",").alias("all_paths"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE sha256(text) END AS sha FROM documents")
def sha_normalize(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    sha, k = F.sha2("text", 256), F.col("doc_id") % 4
    raw = F.when(k == 0, F.concat(F.lit("\t "), F.upper(sha), F.lit(" "))).when(k == 3, F.when(F.col("doc_id") % 8 == 3, "None").otherwise(F.substring(sha, 1, 63))).otherwise(sha)
    return d.select("doc_id", text.sha_normal(raw).alias("sha"))


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS norm FROM documents")
def text_normalize(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.squeeze(F.col("text")).alias("norm"))


@query("SELECT doc_id, " + MATCH.format(c="text || ' (Smith et al., 2020) more'") + " AS form FROM documents")
def match_normalize(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.match_form(F.concat("text", F.lit(" (Smith et al., 2020) more"))).alias("form"))


@query(r"WITH n AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s FROM documents) SELECT doc_id, CASE WHEN length(s) > 240 THEN substr(s, 1, 239) || '…' ELSE s END AS short FROM n")
def shorten(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.shorten(F.col("text"), 240).alias("short"))


@query("SELECT doc_id, array_to_string(" + TOKENS.format(c="text") + ", ' ') AS tokens FROM documents")
def bm25_tokenize(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.array_join(text.bm25_tokens(F.col("text")), " ").alias("tokens"))


@query("WITH s AS (SELECT doc_id, unnest(" + SENTS.format(c="text") + ") AS sentence, generate_subscripts(" + SENTS.format(c="text") + ", 1) - 1 AS sent_idx FROM documents) SELECT doc_id, CAST(sent_idx AS INTEGER) AS sent_idx, sentence FROM s")
def sentence_split(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.posexplode(segment.sentences(F.col("text"))).alias("sent_idx", "sentence"))


_ABBREV = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
for _a in segment.ABBREVIATIONS:
    _ABBREV = f"replace({_ABBREV}, '{_a}', '{_a.replace('.', segment.HOLD)}')"
_ABBREV = rf"regexp_replace({_ABBREV}, '(^|[^\pL\pN_])([A-Z])\.\s', '\1\2{segment.HOLD} ', 'g')"
ABBREV_SENTS = rf"list_filter(list_transform(string_split(regexp_replace({_ABBREV}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(replace(x, '{segment.HOLD}', '.'))), lambda x: x <> '')"


@query(f"SELECT doc_id, CAST(len({ABBREV_SENTS}) AS INTEGER) AS n, array_to_string({ABBREV_SENTS}, '|') AS sentences FROM documents")
def sentence_split_abbrev(spark, sf_dir):
    s = segment.sentences_abbrev(F.col("text"))
    return t(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", F.size("s").alias("n"), F.array_join("s", "|").alias("sentences"))


@query(f"""WITH s AS (SELECT doc_id, {ABBREV_SENTS} AS l FROM documents),
    w AS (SELECT doc_id, unnest(range(0, greatest(len(l) - 2, 0) + 1)) AS i, l FROM s WHERE len(l) > 0)
    SELECT doc_id, CAST(i AS INTEGER) AS unit_idx, array_to_string(list_slice(l, i + 1, i + 2), ' ') AS w FROM w""")
def sentence_windows(spark, sf_dir):
    w = segment.windows(segment.sentences_abbrev(F.col("text")), 2, 1)
    return t(spark, sf_dir, "documents").select("doc_id", F.posexplode(w).alias("unit_idx", "w"))


def _units(spark, sf_dir) -> DataFrame:
    """Sentences of each distinct text: sha, unit_idx, tokens."""
    d = files(spark, sf_dir).groupBy(F.col("source_sha256").alias("sha")).agg(F.first("text").alias("text"))
    return d.select("sha", segment.sentences(F.col("text")).alias("sents"))


def _cited(spark, sf_dir, asked: DataFrame) -> DataFrame:
    """Sentences of the texts that queries ask for: others are not cut."""
    return retrieve.cited(_units(spark, sf_dir), asked)


def _asked(spark, sf_dir) -> DataFrame:
    """A query per source that several turns could cite: turns are dealt to the distinct texts by number."""
    shas = t(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"))
    c = t(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("query_id"), "conv_id", F.col("text").alias("quote"))
    return c.join(shas, c["conv_id"] == shas["doc_id"]).select("query_id", "sha", "quote")


ASKED = "s AS (SELECT sha256(text) AS sha, min(doc_id) AS doc_id, any_value(text) AS text FROM documents GROUP BY 1), q AS (SELECT conv_id * 100 + turn AS query_id, sha, c.text AS quote FROM conversations c JOIN s ON c.conv_id = s.doc_id)"


def bm25_sql(tokens: str, quote: str = "quote", units: str = "") -> str:
    """SQL of the scores, tokens made by ``tokens`` of a unit (by default a sentence) and of ``quote``."""
    units = units or f"l AS (SELECT sha, {SENTS.format(c='text')} AS sents FROM s), u AS (SELECT sha, unnest(sents) AS sent, generate_subscripts(sents, 1) - 1 AS unit_idx FROM l)"
    sent, asked = tokens.format(c="sent"), tokens.format(c=quote)
    return (
        f"WITH {ASKED}, {units}, "
        f"k AS (SELECT sha, unit_idx, CASE WHEN len({sent}) > 0 THEN {sent} ELSE [''] END AS tk FROM u), "
        "x AS (SELECT sha, unit_idx, len(tk) AS dl, unnest(tk) AS term FROM k), "
        "po AS (SELECT sha, unit_idx, dl, term, count(*) AS tf FROM x GROUP BY ALL), "
        "sz AS (SELECT sha, count(*) AS n, avg(len(tk)) AS avgdl FROM k GROUP BY 1), df AS (SELECT sha, term, count(*) AS df FROM po GROUP BY 1, 2), "
        "rw AS (SELECT df.sha, term, ln(n - df + 0.5) - ln(df + 0.5) AS raw, avgdl FROM df JOIN sz USING (sha)), "
        "mn AS (SELECT sha, avg(raw) AS mean FROM rw GROUP BY 1), "
        "tw AS (SELECT rw.sha, term, CASE WHEN raw < 0 THEN 0.25 * mean ELSE raw END AS idf, avgdl FROM rw JOIN mn USING (sha)), "
        f"a AS (SELECT query_id, sha, unnest({asked}) AS term FROM q), qa AS (SELECT query_id, sha, term, count(*) AS qtf FROM a GROUP BY ALL), "
        "hits AS (SELECT query_id, qa.sha, unit_idx, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score "
        "FROM qa JOIN tw USING (sha, term) JOIN po USING (sha, term) GROUP BY ALL)"
    )


RANKED = (
    ", ev AS (SELECT query_id, q.sha, u.unit_idx FROM q JOIN u USING (sha)), "
    "al AS (SELECT ev.*, coalesce(round(score, 9), 0) AS score FROM ev LEFT JOIN hits USING (query_id, sha, unit_idx)), "
    "rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, unit_idx) - 1 AS bm25_rank FROM al)"
)
BM25 = bm25_sql(TOKENS)
#: Case-sensitive words and single punctuation marks.
WORDS_SQL = r"list_filter(regexp_extract_all({c}, '[\pL\pN_]+|[^\s\pL\pN_]'), lambda x: x <> '')"


def _bm25(spark, sf_dir, everything: bool = False) -> DataFrame:
    asked = _asked(spark, sf_dir)
    docs = _cited(spark, sf_dir, asked)
    units = docs.select("sha", F.posexplode("sents").alias("unit_idx", "sent")).select("sha", "unit_idx", text.bm25_tokens(F.col("sent")).alias("tokens"))
    asked = asked.select("query_id", "sha", text.bm25_tokens(F.col("quote")).alias("tokens"))
    return retrieve.bm25_all(units, asked) if everything else retrieve.bm25(units, asked)


@query(BM25 + " SELECT query_id, sha, CAST(unit_idx AS INTEGER) AS unit_idx, round(score, 6) AS score FROM hits")
def bm25_scores(spark, sf_dir):
    return _bm25(spark, sf_dir).select("query_id", "sha", "unit_idx", r6("score", "score"))


BM25_ALL = BM25 + RANKED


def _top(spark, sf_dir, k) -> DataFrame:
    asked = _asked(spark, sf_dir)
    docs = _cited(spark, sf_dir, asked)
    units = docs.select("sha", F.posexplode("sents").alias("unit_idx", "sent")).select("sha", "unit_idx", text.bm25_tokens(F.col("sent")).alias("tokens"))
    asked = asked.select("query_id", "sha", text.bm25_tokens(F.col("quote")).alias("tokens"))
    return retrieve.bm25_top(units, asked, k, digits=9)


@query(BM25_ALL + " SELECT query_id, sha, CAST(unit_idx AS INTEGER) AS unit_idx, round(score, 6) AS score, CAST(bm25_rank AS INTEGER) AS bm25_rank FROM rk WHERE bm25_rank < 20")
def bm25_topk(spark, sf_dir):
    return _top(spark, sf_dir, 20).select("query_id", "sha", "unit_idx", r6("score", "score"), "bm25_rank")


@query(BM25_ALL + " SELECT query_id, sha, CAST(unit_idx AS INTEGER) AS unit_idx, round(score, 6) AS score, CAST(bm25_rank AS INTEGER) AS bm25_rank FROM rk")
def bm25_rank(spark, sf_dir):
    scores = _bm25(spark, sf_dir, True).withColumn("score", F.round("score", 9))
    return retrieve.ranked(scores).select("query_id", "sha", "unit_idx", r6("score", "score"), "bm25_rank")


def spans_sql(quote: str, k: int) -> str:
    """SQL of the candidates round the best ``k`` sentences, up to as long as ``quote`` has sentences."""
    count = rf"len(list_filter(string_split(regexp_replace({quote}, '([.?!])\s+([A-Z(])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda x: trim(x) <> ''))"
    return (
        f", zs AS (SELECT query_id, least(greatest({count}, 1), 3) AS size FROM q), "
        "ze AS (SELECT query_id, bm25_rank, s, d, sents, CASE WHEN d = 0 THEN unit_idx ELSE greatest(0, unit_idx - s + 1) END AS st, "
        "CASE WHEN d = 0 THEN least(len(sents), unit_idx + s) - 1 ELSE unit_idx END AS en "
        "FROM rk JOIN zs USING (query_id) JOIN l USING (sha), (SELECT unnest([1, 2, 3]) AS s), (SELECT unnest([0, 1]) AS d) "
        f"WHERE bm25_rank < {k} AND s <= size), "
        f"zf AS (SELECT *, {MATCH.format(c="array_to_string(list_slice(sents, st + 1, en + 1), ' ')")} AS candidate FROM ze), "
        "zo AS (SELECT query_id, candidate, min([bm25_rank, s, d, st, en]) AS f FROM zf WHERE candidate <> '' GROUP BY 1, 2), "
        "sp AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY f[1], f[2], f[3]) - 1 AS INTEGER) AS pos, candidate, "
        'CAST(f[4] AS INTEGER) AS "start", CAST(f[5] AS INTEGER) AS "end" FROM zo)'
    )


@query(BM25_ALL + spans_sql("quote", 20) + " SELECT * FROM sp")
def span_candidates(spark, sf_dir):
    asked = _asked(spark, sf_dir)
    docs = _cited(spark, sf_dir, asked)
    sizes = asked.select("query_id", segment.sentence_count(F.col("quote")).alias("q_sentences"))
    return retrieve.spans(_top(spark, sf_dir, 20).join(sizes, "query_id"), docs)


MARK = "CAST((length({t}) - length(replace({t}, 'no ', ''))) / 3 AS INTEGER)"
WORDS = r"regexp_split_to_array({t}, '[^\pL\pN_]+')"


def _word_count(*words: str) -> str:
    return "CAST(" + " + ".join(f"len(list_filter(w, lambda x: x = '{w}'))" for w in words) + " AS INTEGER)"


MARKED = rf"n AS (SELECT doc_id, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS t FROM documents), m AS (SELECT doc_id, t, {WORDS.format(t='t')} AS w FROM n), c AS (SELECT doc_id, {_word_count('and', 'that')} AS contrast_hits, {_word_count('the', 'of')} AS limitation_hits, {MARK.format(t='t')} + {_word_count('with')} AS negation_hits FROM m)"


@query(f"WITH {MARKED} SELECT * FROM c")
def marker_counts(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", *[c.alias(k) for k, c in triage.cues(F.col("text"), CUES).items()])


@query(f"WITH {MARKED} SELECT doc_id, contrast_hits > 0 OR limitation_hits >= 2 OR negation_hits >= 1 AS recommend_nli FROM c")
def recommend_flag(spark, sf_dir):
    return marker_counts(spark, sf_dir).select("doc_id", triage.recommended(CUES).alias("recommend_nli"))


_TOKS = " ".join(f"WHEN contains(lower(s), '{x}') THEN 'token:{x}'" for x in text.GRAPH_TOKENS)


@query(f"""WITH {TURNS}, z AS (SELECT conv_id, turn, trim(regexp_replace(evidence, '^\\s+|\\s+$', '', 'g')) AS s, trim(regexp_replace(claim, '^\\s+|\\s+$', '', 'g')) AS r FROM p)
    SELECT conv_id, turn, CASE WHEN length(s) < 40 AND length(r) > 0 AND length(r) / greatest(1, length(s) + 1) >= 3 THEN 'short_source_vs_long_report' {_TOKS} WHEN length(s) = 0 AND length(r) >= 80 THEN 'empty_source_long_report' ELSE '' END AS graph_reason FROM z""")
def graph_like(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", "turn", text.graph_reason(F.col("evidence"), F.col("claim")).alias("graph_reason"))


@query(r"""WITH n AS (SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS q FROM conversations)
    SELECT conv_id, turn, CASE WHEN q = '' THEN 'empty' WHEN regexp_matches(q, '(?i)^(?:table|figure|fig\.?\s*\d+|graph|chart|content|n\.?a\.?|na)$') THEN 'non_verifiable_trivial'
      WHEN regexp_matches(q, '(?i)\b(?:figure|fig\.?|table|graph|chart|diagram|plot)\b|\bshown\s+in\b|\bsee\s+(?:figure|fig\.?|table)\b') THEN 'non_textual_hint' ELSE 'textual' END AS intent FROM n""")
def quote_intent(spark, sf_dir):
    return t(spark, sf_dir, "conversations").select("conv_id", "turn", text.quote_intent(F.col("text")).alias("intent"))




@query(f"WITH {TURNS}, g AS (SELECT conv_id, turn, {GRAMS.format(c='claim')} AS a, {GRAMS.format(c='evidence')} AS b FROM p) SELECT conv_id, turn, round(CASE WHEN len(a) + len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard5 FROM g")
def char5_jaccard(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", "turn", r6(similarity.char_jaccard(F.col("claim"), F.col("evidence")), "jaccard5"))


@query(f"WITH {TURNS} SELECT conv_id, turn, CASE WHEN length(claim) >= 12 AND contains(evidence, substr(claim, 1, 12)) THEN 0.02 ELSE 0.0 END AS bonus FROM p")
def literal_bonus(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", "turn", similarity.literal_bonus(F.col("claim"), F.col("evidence")).alias("bonus"))


@query()
def partial_ratio(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", "turn", similarity.partial_ratio_udf("claim", "evidence").alias("fuzzy"))


COS = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
NEAR = f"WITH m AS (SELECT label, min(vec_id) AS first_id FROM embeddings GROUP BY 1), x AS (SELECT a.vec_id AS query_id, b.vec_id, round({COS}, 9) AS c FROM m JOIN embeddings a ON a.vec_id = m.first_id JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)"


def _near(spark, sf_dir) -> DataFrame:
    """The first vector of each label as the query, the others of the label as its passages."""
    e = t(spark, sf_dir, "embeddings")
    first = e.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("q"))
    rows = e.join(first, "label").where("vec_id <> q.vec_id")
    return rows.select(F.col("q.vec_id").alias("query_id"), "vec_id", F.round(similarity.cosine(F.col("q.embedding"), F.col("embedding")), 9).alias("c"))


@query(NEAR + ", r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) - 1 AS embed_rank FROM x) SELECT query_id, vec_id, round(c, 6) AS cosine, CAST(embed_rank AS INTEGER) AS embed_rank FROM r WHERE embed_rank < 10")
def embed_cosine_topk(spark, sf_dir):
    hits = _near(spark, sf_dir).withColumn("bm25_rank", F.col("vec_id"))
    return retrieve.reranked(hits, "c", 10).select("query_id", "vec_id", r6("c", "cosine"), "embed_rank")


@query(
    BM25_ALL + f", rc AS (SELECT query_id, unit_idx, bm25_rank, list_distinct({TOKENS.format(c='quote')}) AS ta, list_distinct({TOKENS.format(c='sent')}) AS tb "
    "FROM rk JOIN u USING (sha, unit_idx) JOIN q USING (query_id) WHERE bm25_rank < 30), "
    "rs AS (SELECT *, CASE WHEN len(ta) * len(tb) > 0 THEN len(list_intersect(ta, tb)) / sqrt(CAST(len(ta) AS DOUBLE) * len(tb)) ELSE 0.0 END AS c FROM rc), "
    "rr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, bm25_rank) - 1 AS embed_rank FROM rs) "
    "SELECT query_id, CAST(unit_idx AS INTEGER) AS unit_idx, CAST(bm25_rank AS INTEGER) AS bm25_rank, CAST(embed_rank AS INTEGER) AS embed_rank, "
    "round(c, 6) AS cosine FROM rr WHERE embed_rank < 10 AND c >= 0.05"
)
def rerank_cascade(spark, sf_dir):
    """The best 30 sentences by BM25, of these the best 10 by the cosine of token sets, then the floor."""
    asked = _asked(spark, sf_dir)
    sents = _cited(spark, sf_dir, asked).select("sha", F.posexplode("sents").alias("unit_idx", "sent"))
    hits = _top(spark, sf_dir, 30).join(sents, ["sha", "unit_idx"]).join(asked.select("query_id", "quote"), "query_id")
    score = similarity.token_cosine(text.bm25_tokens(F.col("quote")), text.bm25_tokens(F.col("sent")))
    best = retrieve.reranked(hits.withColumn("c", score), "c", 10).where("c >= 0.05")
    return best.select("query_id", "unit_idx", "bm25_rank", "embed_rank", r6("c", "cosine"))


def _exact(spark, sf_dir) -> DataFrame:
    quotes = t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), text.match_form(F.col("text")).alias("q"))
    return verify.exact_tier(_units(spark, sf_dir), quotes)


EXACT = f"WITH s AS (SELECT sha256(text) AS sha, any_value(text) AS text FROM documents GROUP BY 1), l AS (SELECT sha, {SENTS.format(c='text')} AS sents FROM s), u AS (SELECT sha, unnest(sents) AS sentence, generate_subscripts(sents, 1) - 1 AS sent_idx FROM l), b AS (SELECT item_id, {MATCH.format(c='text')} AS q FROM benchmark), h AS (SELECT item_id, sha, min(sent_idx) AS sent_idx FROM b JOIN u ON contains({MATCH.format(c='sentence')}, q) WHERE q <> '' GROUP BY 1, 2)"


@query(EXACT + f", {FILES}, g AS (SELECT DISTINCT source_sha256 AS sha, group_id FROM f) SELECT group_id, count(DISTINCT item_id) AS hits, CAST((SELECT count(*) FROM benchmark) AS BIGINT) - count(DISTINCT item_id) AS misses, round(count(DISTINCT item_id) / (SELECT count(*) FROM benchmark), 4) AS success_ratio FROM g LEFT JOIN h USING (sha) GROUP BY 1")
def quote_verify_exact(spark, sf_dir):
    """Per group: benchmark quotes found word for word in one of its documents, and those that aren't."""
    groups = files(spark, sf_dir).select(F.col("source_sha256").alias("sha"), "group_id").distinct()
    n = t(spark, sf_dir, "benchmark").agg(F.count("*").alias("n"))
    found = groups.join(_exact(spark, sf_dir).select("sha", "quote_id").distinct(), "sha", "left").groupBy("group_id").agg(F.countDistinct("quote_id").alias("hits"))
    rows = found.join(F.broadcast(n))  # one row
    return rows.select("group_id", "hits", (F.col("n") - F.col("hits")).alias("misses"), F.round(F.col("hits") / F.col("n"), 4).alias("success_ratio"))


def _evidence(spark, sf_dir) -> DataFrame:
    out = verify.verify_quotes(_asked(spark, sf_dir), _units(spark, sf_dir), VerifyConfig())
    return out.withColumn("group_id", F.concat(F.lit("g"), F.pmod("query_id", F.lit(7)))).withColumn("source_filename", F.col("sha"))


_Q = MATCH.format(c="quote")
_INTENT = """CASE WHEN q = '' THEN 'empty' WHEN regexp_matches(q, '(?i)^(?:table|figure|fig\\.?\\s*\\d+|graph|chart|content|n\\.?a\\.?|na)$') THEN 'non_verifiable'
      WHEN regexp_matches(q, '(?i)\\b(?:figure|fig\\.?|table|graph|chart|diagram|plot)\\b|\\bshown\\s+in\\b|\\bsee\\s+(?:figure|fig\\.?|table)\\b') THEN 'hint' ELSE 'textual' END"""


@query(
    bm25_sql(WORDS_SQL, _Q) + RANKED + spans_sql(_Q, 20) + f""", qm AS (SELECT query_id, sha, {_Q} AS q FROM q), qi AS (SELECT *, {_INTENT} AS intent FROM qm),
    vc AS (SELECT sp.*, q, list_distinct({WORDS_SQL.format(c="q")}) AS ta, list_distinct({WORDS_SQL.format(c="candidate")}) AS tb FROM sp JOIN qi USING (query_id) WHERE intent IN ('hint', 'textual')),
    vs AS (SELECT *, CASE WHEN len(ta) * len(tb) > 0 THEN len(list_intersect(ta, tb)) / sqrt(CAST(len(ta) AS DOUBLE) * len(tb)) ELSE 0.0 END AS c FROM vc),
    vr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, pos) AS place FROM vs),
    vb AS (SELECT query_id, candidate, "start", "end", c, {GRAMS.format(c="q")} AS ga, {GRAMS.format(c="candidate")} AS gb, CASE WHEN length(q) >= 12 AND contains(candidate, substr(q, 1, 12)) THEN 0.02 ELSE 0.0 END AS bonus FROM vr WHERE place = 1),
    vj AS (SELECT *, CASE WHEN len(ga) + len(gb) = 0 THEN 0.0 ELSE len(list_intersect(ga, gb)) / len(list_distinct(list_concat(ga, gb))) END AS j FROM vb),
    top AS (SELECT query_id, max(score) AS bm25 FROM rk WHERE bm25_rank < 20 GROUP BY 1)
    SELECT qi.query_id, sha, CASE WHEN intent IN ('empty', 'non_verifiable') THEN intent WHEN sha NOT IN (SELECT sha FROM l WHERE len(sents) > 0) THEN 'no_text_index' WHEN candidate IS NULL THEN 'no_candidates' ELSE 'judged' END AS outcome,
      candidate, "start", "end", round(c, 6) AS cosine, round(j, 6) AS jaccard5, bonus, CASE WHEN candidate IS NOT NULL THEN round(bm25, 6) END AS bm25,
      CASE WHEN candidate IS NULL THEN NULL WHEN length(q) < 60 THEN 0.84 WHEN length(q) > 200 THEN 0.78 ELSE 0.82 END AS cos_thresh_used FROM qi LEFT JOIN vj USING (query_id) LEFT JOIN top USING (query_id)"""
)
def quote_verify_full(spark, sf_dir):
    """All evidence but the fuzzy ratio and the verdict that hangs on it, which SQL lacks (tests cover these)."""
    e = _evidence(spark, sf_dir)
    early = F.col("verification_class").isin("empty", "non_verifiable", "no_text_index", "no_candidates")
    outcome = F.when(early, F.col("verification_class")).otherwise("judged")
    return e.select(
        "query_id", "sha", outcome.alias("outcome"), "candidate", F.col("span.start").alias("start"), F.col("span.end").alias("end"), r6("cosine", "cosine"),
        r6("jaccard5", "jaccard5"), "bonus", r6("bm25", "bm25"), "cos_thresh_used",
    )


@query(
    f"WITH v AS ({ORACLE_SQL['quote_verify_full']}) SELECT 'g' || (query_id % 7) AS \"group\", 'Group_g' || (query_id % 7) || '_supplemental_information.json' AS filename, "
    "count(*) AS total, count(DISTINCT sha) AS sources, true AS sums_agree FROM v GROUP BY query_id % 7"
)
def verification_report_json(spark, sf_dir):
    """The reports' JSON, read back: totals, and whether hits, misses, classes and listed misses add up to them."""
    made = verify.group_report(_evidence(spark, sf_dir))
    source = "struct<source_filename:string,hits:bigint,misses:bigint,misses_detail:array<struct<query_id:bigint>>,by_class:map<string,bigint>>"
    r = made.withColumn("r", F.from_json("report", f"success_ratio double, total bigint, hits bigint, misses bigint, by_source array<{source}>"))
    total = lambda f: F.aggregate(F.transform("r.by_source", f), F.lit(0).cast("bigint"), lambda x, y: x + y)
    listed = total(lambda s: F.size(s["misses_detail"]).cast("bigint"))
    classes = total(lambda s: F.aggregate(F.map_values(s["by_class"]), F.lit(0).cast("bigint"), lambda x, y: x + y))
    agree = (F.col("r.hits") + F.col("r.misses") == F.col("r.total")) & (listed == F.col("r.misses")) & (classes == F.col("r.total"))
    ratio = F.col("r.success_ratio") == F.bround(F.col("r.hits") / F.col("r.total"), 4)
    return r.select("group", "filename", "r.total", F.size("r.by_source").cast("bigint").alias("sources"), (agree & ratio).alias("sums_agree"))


def _judged(spark, sf_dir) -> DataFrame:
    """Cheap evidence of the same shape: a turn whose text and the next one's share n-grams."""
    p = turns(spark, sf_dir).withColumn("j", similarity.char_jaccard(F.col("claim"), F.col("evidence")))
    hit = F.col("j") >= 0.03
    return p.select(F.concat(F.lit("g"), F.pmod("conv_id", F.lit(5)).cast("string")).alias("group_id"), F.concat(F.lit("s"), F.pmod("turn", F.lit(3)).cast("string")).alias("source_filename"), hit.alias("hit"), F.when(hit & (F.length("claim") > 200), "semantic_match").when(hit, "weak_match").otherwise("no_match").alias("verification_class"), "conv_id", "turn")


JUDGED = f"WITH {TURNS}, z AS (SELECT conv_id, turn, claim, {GRAMS.format(c='claim')} AS a, {GRAMS.format(c='evidence')} AS b FROM p), y AS (SELECT *, CASE WHEN len(a) + len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END >= 0.03 AS hit FROM z), e AS (SELECT 'g' || (conv_id % 5) AS group_id, 's' || (turn % 3) AS source_filename, hit, CASE WHEN hit AND length(claim) > 200 THEN 'semantic_match' WHEN hit THEN 'weak_match' ELSE 'no_match' END AS verification_class FROM y)"


@query(JUDGED + ", k AS (SELECT group_id, source_filename, verification_class, count(*) AS n, count(*) FILTER (hit) AS h FROM e GROUP BY ALL) SELECT group_id, source_filename, CAST(sum(h) AS BIGINT) AS hits, CAST(sum(n) - sum(h) AS BIGINT) AS misses, string_agg(verification_class || ':' || n, ',' ORDER BY verification_class) AS by_class FROM k GROUP BY 1, 2")
def verification_by_source(spark, sf_dir):
    b = verify.by_source(_judged(spark, sf_dir))
    classes = F.array_join(F.transform(F.array_sort(F.map_entries("by_class")), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")
    return b.select("group_id", "source_filename", "hits", "misses", classes.alias("by_class"))


@query(JUDGED + ' SELECT group_id AS "group", round(count(*) FILTER (hit) / count(*), 4) AS success_ratio, count(*) AS total, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, count(*) AS checked FROM e GROUP BY 1')
def verification_summary(spark, sf_dir):
    return verify.summary(_judged(spark, sf_dir))


def _pairs(spark, sf_dir) -> DataFrame:
    """documents as citation rows of a table per group; some parts missing by rule."""
    f, k = files(spark, sf_dir), F.col("doc_id")
    rows = f.select(
        F.lit("cohort-1").alias("cohort_id"), "group_id", F.concat("group_id", F.lit("/t.csv")).alias("table_path"), F.lit("CSV").alias("sheet_name"),
        F.when(k % 7 != 0, F.col("text")).otherwise("").alias("quote_from_report"), F.when(k % 5 != 0, F.col("path")).alias("file_name_raw"), F.when(k % 3 == 1, F.col("text")).when(k % 3 == 2, F.col("path")).alias("quote_from_source"),
        F.when(k % 11 == 0, F.lit("http://x")).alias("source_uri"), F.when(k % 2 == 0, F.col("path")).alias("resolved_source_path"), (k % 2 == 0).alias("extract_ok"), F.when(k % 13 == 0, "bad").alias("extract_error"),
    )
    return tables.with_graph_flag(rows)


PAIRS = f"""{FILES}, r AS (SELECT group_id, group_id || '/t.csv' AS table_path, CASE WHEN doc_id % 7 <> 0 THEN text ELSE '' END AS qr, CASE WHEN doc_id % 5 <> 0 THEN path END AS fn, CASE WHEN doc_id % 3 = 1 THEN text WHEN doc_id % 3 = 2 THEN path END AS qs,
      CASE WHEN doc_id % 11 = 0 THEN 'http://x' END AS uri, CASE WHEN doc_id % 2 = 0 THEN path END AS rp, doc_id % 2 = 0 AS ok, doc_id % 13 = 0 AS bad FROM f),
    z AS (SELECT *, regexp_replace(coalesce(qs, ''), '^\\s+|\\s+$', '', 'g') AS s, regexp_replace(qr, '^\\s+|\\s+$', '', 'g') AS rr FROM r),
    w AS (SELECT *, (length(s) < 40 AND length(rr) > 0 AND length(rr) / greatest(1, length(s) + 1) >= 3) OR {" OR ".join(f"contains(lower(s), '{x}')" for x in text.GRAPH_TOKENS)} AS gl FROM z),
    rep AS (SELECT 'cohort-1' AS cohort_id, group_id, table_path, 'CSV' AS sheet_name, count(*) AS total_rows, count(*) FILTER (rr <> '' OR fn IS NOT NULL OR s <> '') AS nonempty_rows, count(*) FILTER (s <> '') AS nonempty_qsource,
      count(*) FILTER (fn IS NOT NULL) AS nonempty_filename, count(uri) AS url_count, count(rp) AS resolved_count, count(*) FILTER (ok) AS extract_ok_count, count(*) FILTER (bad) AS extract_error_count, count(*) FILTER (gl) AS graph_like_count FROM w GROUP BY ALL),
    tr AS (SELECT *, round(CASE WHEN nonempty_filename > 0 THEN resolved_count / nonempty_filename ELSE 0.0 END, 6) AS resolved_ratio, round(extract_ok_count / greatest(1, nonempty_rows), 6) AS extract_success_ratio, round(graph_like_count / greatest(1, total_rows), 6) AS graph_like_ratio FROM rep)"""


@query(f"WITH {PAIRS} SELECT * FROM tr")
def tables_report(spark, sf_dir):
    r = tables.tables_report(_pairs(spark, sf_dir))
    return r.withColumns({c: F.round(c, 6) for c in ("resolved_ratio", "extract_success_ratio", "graph_like_ratio")})


@query(f"WITH {PAIRS} SELECT * FROM tr WHERE nonempty_rows > 0 ORDER BY extract_success_ratio, resolved_ratio, group_id LIMIT 10")
def worst_tables_topk(spark, sf_dir):
    return tables.worst_tables(tables_report(spark, sf_dir))


_STEM = r"regexp_replace({c}, '([^.])\.[^.]+$', '\1')"
_SQUASH = "regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"


@query(
    f"WITH {FILES}, r AS (SELECT doc_id AS \"key\", group_id, coalesce(lang, 'none') || ' ' || (n_chars % 40) || ' ' || (doc_id % 300) || '.pdf' AS raw FROM f), "
    "g AS (SELECT group_id, path || '_' || coalesce(lang, 'x') || '-' || (n_chars % 40) || '.PDF' AS path FROM f), h AS (SELECT DISTINCT group_id, path, regexp_extract(path, '([^/]*)$', 1) AS name FROM g), "
    f"m AS (SELECT \"key\", raw, path, name, list_distinct({TOKENS.format(c=_STEM.format(c='raw'))}) AS a, list_distinct({TOKENS.format(c=_STEM.format(c='name'))}) AS b, "
    f"{_SQUASH.format(c='raw')} AS sr, {_SQUASH.format(c='name')} AS sn, {_SQUASH.format(c=_STEM.format(c='raw'))} AS tr, {_SQUASH.format(c=_STEM.format(c='name'))} AS tn FROM r JOIN h USING (group_id)), "
    "z AS (SELECT *, lower(name) = lower(raw) AS exact, len(list_intersect(a, b)) / greatest(1, len(a)) + CASE WHEN sr <> '' AND contains(sn, sr) THEN 0.5 ELSE 0.0 END + CASE WHEN tr <> '' AND contains(tn, tr) THEN 0.25 ELSE 0.0 END AS score FROM m), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY \"key\" ORDER BY exact DESC, score DESC, path) AS n FROM z WHERE exact OR score > 0) "
    'SELECT r."key", path, round(score, 6) AS name_score FROM r LEFT JOIN (SELECT * FROM w WHERE n = 1) AS w ON w."key" = r."key"'
)
def filename_resolve(spark, sf_dir):
    """Raw names of language and numbers, resolved among the files of a group that are named in another way."""
    f = files(spark, sf_dir)
    size, number = (F.col("n_chars") % 40).cast("string"), (F.col("doc_id") % 300).cast("string")
    rows = f.select(F.col("doc_id").alias("key"), "group_id", F.concat(F.coalesce("lang", F.lit("none")), F.lit(" "), size, F.lit(" "), number, F.lit(".pdf")).alias("file_name_raw"))
    named = f.select("group_id", F.concat("path", F.lit("_"), F.coalesce("lang", F.lit("x")), F.lit("-"), size, F.lit(".PDF")).alias("path"))
    return tables.resolve_names(rows, named).select("key", "path", r6("name_score", "name_score"))


@query(r"""SELECT page_id, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(url, '(?i)\bhttps?://[^\s<>''"]+'), regexp_extract_all(html, '(?i)\bhttps?://[^\s<>''"]+')))), ' ') AS urls FROM pages""")
def url_extract(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("k"), "page_id", "url", "html")
    found = tables.urls_of_tables(p.select("k", "url", "html"), ["k"])
    return p.select("k", "page_id").join(found, "k", "left").select("page_id", F.coalesce(F.array_join("urls", " "), F.lit("")).alias("urls"))


@query("SELECT CAST(user_id AS BIGINT) AS group_id, event_type AS url, arg_max(props, event_id) AS saved_as FROM events GROUP BY 1, 2")
def url_latest_manifest(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return tables.latest_manifest(e.select(F.col("user_id").alias("group_id"), F.col("event_type").alias("url"), F.col("props").alias("saved_as"), F.col("event_id").alias("seq")))


@query(r"""SELECT page_id, coalesce(nullif(trim(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[\\:*?"<>|]+', '_', 'g')), ''), 'download.bin') AS name FROM pages""")
def sanitize_filename(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", text.sanitize_filename(F.col("url")).alias("name"))


@query()
def html_text(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", html_udf("html").alias("text"))


IDS = f"WITH {TURNS} SELECT sha256('c|g' || (conv_id % 5) || '|' || conv_id || '|' || sha256(evidence) || '|' || claim || '|' || turn) AS candidate_id, conv_id, turn FROM p"


@query(IDS)
def candidate_ids(spark, sf_dir):
    p = turns(spark, sf_dir)
    return p.select(text.candidate_id(F.lit("c"), F.concat(F.lit("g"), F.pmod("conv_id", F.lit(5)).cast("string")), F.col("conv_id"), F.sha2("evidence", 256), F.col("claim"), F.col("turn")).alias("candidate_id"), "conv_id", "turn")


def _cands(spark, sf_dir) -> DataFrame:
    """Sentence-like candidates from documents: group is the source, row a language, with real cue counts."""
    d = marker_counts(spark, sf_dir).join(files(spark, sf_dir), "doc_id")
    return d.select("group_id", F.col("lang").alias("row_id"), F.col("doc_id").cast("string").alias("candidate_id"), F.col("text").alias("candidate_window"), triage.recommended(CUES).alias("recommend_nli"), (F.col("n_chars") % 100 / 100.0).alias("embed_cosine"), (F.col("n_chars") % 7).cast("double").alias("bm25_score"), "contrast_hits", "limitation_hits", "negation_hits", F.col("doc_id"))


CANDS = f"WITH {MARKED}, {FILES}, k AS (SELECT f.group_id, f.lang AS row_id, CAST(f.doc_id AS VARCHAR) AS candidate_id, f.text, contrast_hits > 0 OR limitation_hits >= 2 OR negation_hits >= 1 AS rec, f.n_chars % 100 / 100.0 AS cos, f.n_chars % 7 AS bm, c.* FROM c JOIN f USING (doc_id))"


@query(CANDS + " SELECT group_id, count(DISTINCT row_id) AS pairs, count(text) AS candidates, CAST(sum(rec::INT) AS BIGINT) AS recommend_nli, round(avg(cos), 6) AS avg_cosine, max((contrast_hits > 0)::INT) AS any_contrast, max((limitation_hits > 0)::INT) AS any_limitation, max((negation_hits > 0)::INT) AS any_negation FROM k GROUP BY 1")
def candidate_summary(spark, sf_dir):
    return triage.summary(_cands(spark, sf_dir)).withColumn("avg_cosine", F.round("avg_cosine", 6))


@query(CANDS + ", r AS (SELECT *, row_number() OVER (PARTITION BY group_id, row_id ORDER BY rec DESC, cos DESC, bm DESC, candidate_id) AS n FROM k) SELECT group_id, row_id, candidate_id FROM r WHERE n <= 3")
def teacher_top3(spark, sf_dir):
    order = [F.desc("recommend_nli"), F.desc("embed_cosine"), F.desc("bm25_score"), F.asc("candidate_id")]
    return corpus.top_per_group(_cands(spark, sf_dir), ["group_id", "row_id"], order, 3).select("group_id", "row_id", "candidate_id")


@query(CANDS + """ SELECT group_id, '[' || string_agg('{"doc_id":' || doc_id || ',"recommend_nli":' || rec || '}', ',' ORDER BY doc_id) || ']' AS report FROM k GROUP BY 1""")
def report_json(spark, sf_dir):
    return _cands(spark, sf_dir).groupBy("group_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("doc_id", "recommend_nli")))).alias("report"))


_WINDOWS = (
    f"l AS (SELECT sha, {ABBREV_SENTS} AS sents FROM s), "
    "u AS (SELECT sha, unit_idx, array_to_string(list_slice(sents, unit_idx + 1, unit_idx + 2), ' ') AS sent "
    "FROM (SELECT sha, sents, unnest(range(0, greatest(len(sents) - 2, 0) + 1)) AS unit_idx FROM l WHERE len(sents) > 0))"
)
_CLAIM = r"trim(regexp_replace(quote, '\s+', ' ', 'g'))"


@query(
    bm25_sql(TOKENS, _CLAIM, _WINDOWS) + RANKED + f", tc AS (SELECT query_id, sha, unit_idx, score, bm25_rank, sent, list_distinct({TOKENS.format(c=_CLAIM)}) AS ta, list_distinct({TOKENS.format(c='sent')}) AS tb "
    f"FROM rk JOIN u USING (sha, unit_idx) JOIN q USING (query_id, sha) WHERE bm25_rank < 30 AND length({_CLAIM}) >= 20), "
    "ts AS (SELECT *, CASE WHEN len(ta) * len(tb) > 0 THEN len(list_intersect(ta, tb)) / sqrt(CAST(len(ta) AS DOUBLE) * len(tb)) ELSE 0.0 END AS c FROM tc), "
    "tr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, bm25_rank) - 1 AS embed_rank FROM ts), "
    r"tg AS (SELECT *, trim(regexp_replace(lower(sent), '\s+', ' ', 'g')) AS t FROM tr WHERE embed_rank < 10 AND c >= 0.25), "
    f"tv AS (SELECT *, {WORDS.format(t='t')} AS w FROM tg), "
    f"th AS (SELECT *, {_word_count('and', 'that')} AS contrast_hits, {_word_count('the', 'of')} AS limitation_hits, {MARK.format(t='t')} + {_word_count('with')} AS negation_hits FROM tv) "
    "SELECT sha256('c|g' || (query_id % 5) || '|' || query_id || '|' || sha || '|' || sent || '|' || embed_rank) AS candidate_id, 'g' || (query_id % 5) AS group_id, query_id AS row_id, sent AS candidate_window, "
    "CAST(bm25_rank AS INTEGER) AS bm25_rank, round(score, 6) AS bm25_score, CAST(embed_rank AS INTEGER) AS embed_rank, round(c, 6) AS embed_cosine, contrast_hits, limitation_hits, negation_hits, "
    "contrast_hits > 0 OR limitation_hits >= 2 OR negation_hits >= 1 AS recommend_nli FROM th"
)
def triage_candidates(spark, sf_dir):
    """The whole candidate stage over turns that cite the document of their number; every column but the fuzzy ratio,
    which SQL lacks."""
    asked, group = _asked(spark, sf_dir), F.concat(F.lit("g"), F.pmod("query_id", F.lit(5)).cast("string"))
    pairs = asked.select(
        F.lit("c").alias("cohort_id"), group.alias("group_id"), F.col("query_id").alias("row_id"), F.col("sha").alias("source_sha256"),
        F.lit(None).cast("string").alias("resolved_source_path"), F.col("quote").alias("quote_from_report"), F.col("quote").alias("quote_from_source"),
    )
    texts = files(spark, sf_dir).groupBy(F.col("source_sha256").alias("sha")).agg(F.first("text").alias("text"))
    c = triage.candidates(pairs, texts, CUES)
    hits = ["contrast_hits", "limitation_hits", "negation_hits", "recommend_nli"]
    return c.select("candidate_id", "group_id", "row_id", "candidate_window", "bm25_rank", r6("bm25_score", "bm25_score"), "embed_rank", r6("embed_cosine", "embed_cosine"), *hits)


def _merged(spark, sf_dir) -> DataFrame:
    f = files(spark, sf_dir)
    old = F.when(F.col("doc_id") % 9 == 0, F.lit("neutral"))
    cands = f.select("group_id", F.col("lang").alias("row_id"), F.col("doc_id").cast("string").alias("candidate_id"), old.alias("nli_label"), (F.col("n_chars") % 100 / 100.0).alias("embed_cosine"))
    scored = t(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("candidate_id"), F.when(F.col("toxic") == 1, "contradiction").otherwise("entailment").alias("nli_label"), ((F.col("quality") * 2 + F.col("toxic")) / 4).alias("nli_score"))
    return nli.merge_scores(cands, scored)


MERGED = f"WITH {FILES}, m AS (SELECT group_id, lang AS row_id, CAST(f.doc_id AS VARCHAR) AS candidate_id, CASE WHEN toxic = 1 THEN 'contradiction' WHEN l.doc_id IS NOT NULL THEN 'entailment' WHEN f.doc_id % 9 = 0 THEN 'neutral' END AS nli_label, n_chars % 100 / 100.0 AS embed_cosine, (quality * 2 + toxic) / 4 AS nli_score FROM f LEFT JOIN labels l ON l.doc_id = f.doc_id)"


@query(MERGED + " SELECT * FROM m")
def nli_merge_coalesce(spark, sf_dir):
    return _merged(spark, sf_dir)


@query(MERGED + """ SELECT group_id AS "group", count(*) AS candidates, count(nli_label) AS nli_scored, count(*) FILTER (nli_label = 'contradiction') AS contradictions, round(CASE WHEN count(nli_label) > 0 THEN count(*) FILTER (nli_label = 'contradiction') / count(nli_label) ELSE 0.0 END, 6) AS contradiction_rate FROM m GROUP BY 1""")
def nli_summary(spark, sf_dir):
    return nli.summary(_merged(spark, sf_dir)).withColumn("contradiction_rate", F.round("contradiction_rate", 6))


@query(MERGED + ", r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY nli_score DESC, candidate_id) AS n FROM m WHERE nli_label = 'contradiction') SELECT group_id, candidate_id, nli_score FROM r WHERE n <= 50")
def nli_top_contradictions(spark, sf_dir):
    return nli.top_contradictions(_merged(spark, sf_dir)).select("group_id", "candidate_id", "nli_score")


@query(MERGED + ", r AS (SELECT *, row_number() OVER (PARTITION BY group_id, row_id ORDER BY coalesce((nli_label = 'contradiction')::INT, 0) DESC, coalesce(nli_score, -1.0) DESC, embed_cosine DESC, candidate_id) AS n FROM m) SELECT group_id, row_id, candidate_id FROM r WHERE n <= 3")
def nli_top_by_pair(spark, sf_dir):
    m = _merged(spark, sf_dir).withColumn("nli_contradiction", F.lit(None).cast("double"))
    return nli.top_by_pair(m).select("group_id", "row_id", "candidate_id")


_SPLIT = r"list_distinct(list_filter(regexp_split_to_array(lower({c}), '\s+'), lambda x: x <> ''))"


@query(
    f"WITH {TURNS}, n AS (SELECT conv_id, turn, {_SPLIT.format(c='evidence')} AS a, {_SPLIT.format(c='claim')} AS b FROM p), "
    "m AS (SELECT *, len(list_intersect(a, b)) / greatest(1, len(b)) AS share, list_has_any(a, ['not', 'no', 'never']) <> list_has_any(b, ['not', 'no', 'never']) AS neg FROM n), "
    "s AS (SELECT *, CASE WHEN neg THEN 0.1 ELSE 0.9 END * share AS yes, CASE WHEN neg THEN 0.9 ELSE 0.1 END * share AS no FROM m) "
    "SELECT conv_id, turn, CASE WHEN yes >= 1 - share AND yes >= no THEN 'entailment' WHEN 1 - share >= no THEN 'neutral' ELSE 'contradiction' END AS nli_label, "
    "round(greatest(yes, 1 - share, no), 6) AS nli_score FROM s"
)
def nli_score(spark, sf_dir):
    p = turns(spark, sf_dir)
    return nli.score(p.select("conv_id", "turn", F.col("evidence").alias("candidate_window"), F.col("claim").alias("query_text"))).select("conv_id", "turn", "nli_label", r6("nli_score", "nli_score"))


MISSING = f"WITH {FILES}, h AS (SELECT DISTINCT source_sha256 FROM f WHERE doc_id % 3 = 0)"


@query(MISSING + ", g AS (SELECT source_sha256, min(struct_pack(group_id := group_id, path := path)) AS r FROM f WHERE source_sha256 NOT IN (SELECT source_sha256 FROM h) GROUP BY 1) SELECT r.group_id AS group_id, r.path AS file_name_raw, source_sha256 FROM g")
def missing_sidecars_anti(spark, sf_dir):
    f = files(spark, sf_dir)
    return corpus.missing_sidecars(f.select("group_id", F.col("path").alias("file_name_raw"), "source_sha256"), f.where("doc_id % 3 = 0"))


@query(MISSING + " SELECT DISTINCT source_sha256 FROM f WHERE source_sha256 NOT IN (SELECT source_sha256 FROM h)")
def sha_coverage_anti(spark, sf_dir):
    f = files(spark, sf_dir)
    return corpus.uncovered(f, f.where("doc_id % 3 = 0"), "source_sha256")


@query("WITH a AS (SELECT DISTINCT source FROM documents), b AS (SELECT DISTINCT source FROM documents WHERE lang = 'es' AND n_chars % 4 = 0) SELECT source, source NOT IN (SELECT source FROM b) AS missing FROM a")
def group_coverage(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    gone = corpus.uncovered(d, d.where("lang = 'es' and n_chars % 4 = 0"), "source").withColumn("missing", F.lit(True))
    return d.select("source").distinct().join(gone, "source", "left").select("source", F.coalesce("missing", F.lit(False)).alias("missing"))


@query(f"""WITH {FILES}, a AS (SELECT DISTINCT source_sha256 FROM f WHERE doc_id % 5 > 1), e AS (SELECT f.*, (f.source_sha256 IN (SELECT source_sha256 FROM a)) OR doc_id % 10 = 0 AS ok FROM f)
    SELECT group_id, count(*) AS expected, count(*) FILTER (ok) AS ok, coalesce(string_agg(path, ',' ORDER BY path) FILTER (NOT ok), '') AS missing, CASE WHEN count(*) FILTER (NOT ok) = 0 THEN '✅' WHEN count(*) FILTER (NOT ok) <= 3 THEN '⚠️' ELSE '❌' END AS mark FROM e GROUP BY 1""")
def extraction_status(spark, sf_dir):
    f = files(spark, sf_dir)
    listed = f.where("doc_id % 10 = 0").select(F.array("path").alias("all_paths"), F.lit(True).alias("extract_ok"))
    s = corpus.extraction_status(f.select("group_id", "path", "source_sha256"), f.where("doc_id % 5 > 1"), listed)
    return s.withColumn("missing", F.array_join("missing", ","))


@query("SELECT doc_id, source FROM documents WHERE lower(source) = 'src1' OR contains(lower(source), 'src1') OR contains(lower(source), 'group 5') OR contains(lower(source), 'rc7')")
def include_groups(spark, sf_dir):
    return t(spark, sf_dir, "documents").where(corpus.included_groups("SRC1, 5, rc7", F.col("source"))).select("doc_id", "source")


@query(r"""WITH c AS (SELECT 'role' AS col, trim(role) AS v FROM conversations UNION ALL SELECT 'text', trim(text) FROM conversations)
    SELECT col, round(avg(CASE WHEN length(v) > 0 THEN length(v) END), 6) AS length, round(avg(regexp_matches(v, '[.!?]')::INT), 6) AS punct, round(avg((regexp_matches(v, '(?i)\.pdf(?:[?#].*)?$') OR regexp_matches(v, '(?i)\bhttps?://[^\s<>''"]+'))::INT), 6) AS fileish, round(avg((length(v) > 50 AND regexp_matches(v, '[.!?]'))::INT), 6) AS quotey FROM c GROUP BY 1""")
def header_inference_stats(spark, sf_dir):
    stats = tables.column_stats(t(spark, sf_dir, "conversations").select("role", "text"))  # a row of numbers per column
    rows = [(c, *[None if v is None else round(float(v), 6) for v in s.values()]) for c, s in stats.items()]
    return spark.createDataFrame(rows, "col string, length double, punct double, fileish double, quotey double")


@query(f"WITH {FILES}, d AS (SELECT source_sha256, count(*) AS n FROM f GROUP BY 1) SELECT source_sha256, n FROM d WHERE n > 1")
def duplicate_shas(spark, sf_dir):
    return checks.duplicates(files(spark, sf_dir), "source_sha256").select("source_sha256", F.col("count").alias("n"))
