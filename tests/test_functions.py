"""Golden cases of the scalar functions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veriflume.config import TriageConfig
from veriflume.functions import segment, similarity, text
from veriflume.operators import corpus, nli, retrieve, tables, triage, verify
from veriflume.sources import extract, fetch, tabular


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def L(v):
    return F.lit(v)


@pytest.mark.parametrize(
    "column,want",
    [
        (lambda: text.match_form(L("text (Smith et al., 2020) more")), "text  more"),
        (lambda: text.match_form(L(" a“b”’ –­ x- \n y ")), "a\"b\"' - xy"),
        (lambda: text.squeeze(L(" a \t b\n")), "a b"),
        (lambda: text.shorten(L("abcdef"), 4), "abc…"),
        (lambda: text.bm25_tokens(L("Éa-b C3, été")), ["a", "b", "c3", "t"]),
        (lambda: text.quote_intent(L("fig. 3")), "non_verifiable_trivial"),
        (lambda: text.quote_intent(L("table 3")), "non_textual_hint"),
        (lambda: text.quote_intent(L("N.A.")), "non_verifiable_trivial"),
        (lambda: text.quote_intent(L(" ")), "empty"),
        (lambda: text.graph_reason(L(""), L("abc")), "short_source_vs_long_report"),
        (lambda: text.graph_reason(L("see the suitable approach described in full detail here"), L("x")), "token:table"),
        (lambda: text.sha_normal(L(" " + "AB" * 32 + " ")), "ab" * 32),
        (lambda: text.sha_normal(L("None")), None),
        (lambda: text.unhyperlink(L('=hyperlink("http://x", "seen")')), "seen"),
        (lambda: text.sanitize_filename(L("a/b:c?.pdf")), "b_c_.pdf"),
        (lambda: text.sanitize_filename(L("a/")), "download.bin"),
        (lambda: text.urls_in(L("see HTTP://a.b/c. and https://d")), ["HTTP://a.b/c.", "https://d"]),
        (lambda: text.truthy(L(" Yes ")), True),
        (lambda: text.whitespace_normal(L(" a \t b\r\n")), "a b"),
        (lambda: segment.sentences(L("One. Two? (Three) x. four! Five")), ["One.", "Two?", "(Three) x. four!", "Five"]),
        (lambda: segment.sentences_abbrev(L("See Fig. 2 by A. Smith et al. now. then! Done")), ["See Fig. 2 by A. Smith et al. now.", "then!", "Done"]),
        (lambda: similarity.char_jaccard(L("hello world"), L("hello")), pytest.approx(1 / 7)),
        (lambda: similarity.literal_bonus(L("0123456789abXX"), L("x 0123456789ab")), 0.02),
        (lambda: similarity.partial_ratio_udf(L("Table 3"), L("as presented in Table 4.")), 85),
    ],
)
def test_golden(spark, column, want):
    assert value(spark, column()) == want


def test_markers(spark):
    cfg, c = TriageConfig(), F.lit("I know piano music but no one may")
    got = {k: value(spark, v) for k, v in triage.cues(c, cfg).items()}
    assert got == {"contrast_hits": 1, "limitation_hits": 1, "negation_hits": 2}


@pytest.mark.parametrize("n,want", [(0, 0), (1, 1), (2, 1), (3, 2), (4, 3)])
def test_windows(spark, n, want):
    units = F.array(*[L(str(i)) for i in range(n)]).cast("array<string>")
    assert len(value(spark, segment.windows(units, 2, 1))) == want
    assert value(spark, segment.windows(units, 0, 1)) == []


def test_bm25(spark):
    units = spark.createDataFrame([("s", 0, "the cat sat".split()), ("s", 1, "the dog".split()), ("s", 2, "a bird flew away".split())], "sha string, unit_idx int, tokens array<string>")
    asked = spark.createDataFrame([(1, "s", ["cat", "the"])], "query_id int, sha string, tokens array<string>")
    got = {r.unit_idx: round(r.score, 6) for r in retrieve.bm25_all(units, asked).collect()}
    assert got == {0: 0.606605, 1: 0.112682, 2: 0.0}


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=8), st.text("abc", max_size=20))
def test_partial_ratio_brute_force(a, b):
    def best(s, t):
        return int(100 * max((2 * _lcs(s, w) / (len(s) + len(w)) for i in range(1 - len(s), len(t)) for w in [t[max(0, i) : i + len(s)]]), default=0))

    s, t = sorted((a, b), key=len)
    want = 100 if not t else 0 if not s else max(best(s, t), best(t, s)) if len(s) == len(t) else best(s, t)
    assert similarity.partial_ratio(a, b) == want == similarity.partial_ratio(b, a)


def test_verify_classes(spark):
    texts = spark.createDataFrame([("s", ["The quick brown fox jumps over the lazy dog near the river bank.", "Other words."]), ("e", [])], "sha string, sents array<string>")
    quotes = spark.createDataFrame([(1, "s", "quick brown fox jumps over the lazy dog"), (2, "s", ""), (3, "s", "fig. 3"), (4, "e", "some long quote"), (5, "s", "zzzz qqqq xxxx vvvv completely unrelated"), (6, "zz", "missing source"), (7, "s", "shown in table nothing alike whatsoever")], "query_id int, sha string, quote string")
    got = {r.query_id: (r.hit, r.verification_class) for r in verify.verify_quotes(quotes, texts).collect()}
    assert got == {1: (True, "exact_or_near_exact"), 2: (False, "empty"), 3: (False, "non_verifiable"), 4: (False, "no_text_index"), 5: (False, "no_match"), 6: (False, "no_text_index"), 7: (False, "non_textual_reference")}


def test_summary_of_nothing(spark):
    rows = spark.createDataFrame([], "group_id string, hit boolean")
    groups = spark.createDataFrame([("g",)], "group_id string")
    assert verify.summary(rows, groups).first().asDict() == {"group": "g", "success_ratio": 0.0, "total": 1, "hits": 0, "misses": 0, "checked": 0}


def test_name_resolution(spark):
    rows = spark.createDataFrame([(1, "g", "Smith 2020 flood.pdf"), (2, "g", "http://x/y.pdf"), (3, "g", "B.PDF"), (4, "g", "nothing")], "key int, group_id string, file_name_raw string")
    files = spark.createDataFrame([("g", "g/smith_2020_flood_risk.pdf"), ("g", "g/b.pdf"), ("h", "h/nothing.pdf")], "group_id string, path string")
    got = {r.key: (r.path, r.name_score) for r in tables.resolve_names(rows, files).collect()}
    assert got[1] == ("g/smith_2020_flood_risk.pdf", 1.25) and got[2] == (None, None) and got[3][0] == "g/b.pdf" and got[4] == (None, None)


def test_headers_and_collapse(spark):
    assert tables.canonical_headers(["  Text in\treport ", "File", "In-tekst ref", "Other"]) == ["quote_from_report", "file_name", "quote_from_source", "Other"]
    assert tables.canonical_headers(["In-tekst ref", "X Y"], preview=True) == ["in-tekst ref", "x y"]
    long = "This is a long sentence that has more than fifty characters in it."
    df = spark.createDataFrame([("Intro", long, "paper.pdf", long + " b", None)], "s string, c1 string, c2 string, c3 string, `Unnamed: 4` string")
    assert tables.collapse(df).first().asDict() == {"quote_from_report": long, "file_name": "paper.pdf", "quote_from_source": long + " b"}
    two = tables.collapse(spark.createDataFrame([("a", "b")], "x string, y string")).first()
    assert tuple(two) == ("a", "b", "")
    assert tables.collapse(spark.createDataFrame([], "x string, file string")).columns == list(tables.CANON)


def test_tables_of_any_kind():
    assert tabular.parse_csv("a;b\n1;2\n3\n4;5;6\n".encode("utf-16")) == [["a", "b"], ["1", "2"], ["3", None]]
    assert tabular.parse_csv("a,b\nd\xe9j\xe0,x\n".encode("cp1252"))[1] == ["déjà", "x"]
    assert tabular.hyperlinks(b"nothing") == {}
    assert tabular.extensions(".pdf, DOCX") == {".pdf", ".docx"}


def test_extractors():
    assert extract.html_text("<title>T</title><nav>n</nav><p>a  b<!-- c --></p><script>x</script>") == "T\na b"
    assert extract.html_text(None) is None
    ns = 'xmlns="http://www.tei-c.org/ns/1.0"'
    assert extract.tei_parts(f"<TEI {ns}><p><s>One <i>two</i></s></p></TEI>")[0] == ["One two"]
    assert extract.tei_parts("<broken") == ([], [])
    waits = []
    out, m = extract.with_retries(lambda: (_ for _ in ()).throw(extract.ServiceError(503)), 2, waits.append, lambda: 0.0)
    assert out is None and m == {"attempts": 3, "last_status": "503"} and waits == [1, 2]
    assert extract.should_ocr("", ["", " "], False) and not extract.should_ocr("", ["x", ""], False)
    assert fetch.download_name("http://a/b?c", {"Content-Disposition": "attachment; filename*=UTF-8''x%20y.pdf"}) == "x y.pdf"
    assert fetch.download_name("http://a/b", {}) == "download.bin"


def test_labels():
    assert nli.normal_label({"Entailment": 0.4, "NEUTRAL": 0.4, "contradiction": 0.2})[0] == "entailment"
    assert nli.normal_label({"LABEL_0": 0.1, "LABEL_1": 0.9}) == ("LABEL_1", 0.9, None, None, None)


def test_group_filter(spark):
    df = spark.createDataFrame([("Group 5",), ("group 50",), ("other",)], "g string")
    assert df.where(corpus.included_groups("5", F.col("g"))).count() == 2
    assert df.where(corpus.included_groups("", F.col("g"))).count() == 3


def test_merge_is_idempotent(spark):
    rows = spark.createDataFrame([("a", ["p"], "x", True), ("b", ["q", "r"], None, False)], "source_sha256 string, all_paths array<string>, lang string, extract_ok boolean")
    once = corpus.merge_sources(rows, rows)
    assert sorted(map(tuple, once.select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))


def test_html_elements_end_with_their_parent():
    assert extract.html_text("<div><header>x</div><p>body text</p>") == "body text"
    assert extract.html_text("<p>a<br>b<img src=x>c</p><nav>m</nav>d") == "a\nb\nc\nd"


def test_verbatim_quotes(spark):
    """Typographic quotes, citations, line breaks, parts of words and scripts without spaces."""
    flood = "The “flood” risk rises (Smith et al., 2020) quickly"
    texts = spark.createDataFrame([("s", [flood + ".", "Other words here."]), ("c", ["漢字は難しい。", "仮名"])], "sha string, sents array<string>")
    quotes = spark.createDataFrame([(1, "s", flood), (2, "s", "flood” risk rises (Smith et al., 2020) qui"), (3, "c", "漢字は"), (4, "c", "仮名")], "query_id int, sha string, quote string")
    got = {r.query_id: r for r in verify.verify_quotes(quotes, texts).collect()}
    assert {k: r.verification_class for k, r in got.items()} == dict.fromkeys(got, "exact_or_near_exact")
    assert got[1].candidate == 'The "flood" risk rises  quickly.' and got[1].fuzzy == 100 and (got[1].span.start, got[1].span.end) == (0, 0)
    docs = spark.createDataFrame([("a", ["The reading comprehension test"]), ("b", ["書く漢字を"]), ("c", ["x漢"])], "sha string, sents array<string>")
    parts = spark.createDataFrame([(1, "ading comprehension tes"), (2, "漢字"), (3, "漢"), (4, ""), (5, "ading"), (6, "reading  test")], "quote_id int, q string")
    found = sorted((r.quote_id, r.sha) for r in verify.exact_tier(docs, parts).collect())
    assert found == [(1, "a"), (2, "b"), (3, "b"), (3, "c"), (5, "a")]


def test_no_candidate_after_windowing(spark):
    texts = spark.createDataFrame([("s", ["(Smith, 2020)"])], "sha string, sents array<string>")
    got = verify.verify_quotes(spark.createDataFrame([(1, "s", "some quote of enough length")], "query_id int, sha string, quote string"), texts).first()
    assert (got.verification_class, got.failure_reason) == ("no_candidates", "no_valid_candidates_after_windowing")


def test_top_units_fill_up(spark):
    """The best units equal a full ranking, zero and negative scores included."""
    import random

    rnd = random.Random(3)
    units = [(f"s{s}", i, [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 4))]) for s in range(6) for i in range(rnd.choice([1, 2, 3, 25]))]
    asked = [(q, f"s{q % 6}", [rnd.choice("abcdexyz") for _ in range(rnd.randint(0, 3))]) for q in range(24)]
    u = spark.createDataFrame(units, "sha string, unit_idx int, tokens array<string>")
    q = spark.createDataFrame(asked, "query_id int, sha string, tokens array<string>")
    whole = retrieve.ranked(retrieve.bm25_all(u, q).withColumn("score", F.round("score", 9)), 5)
    want = sorted((r.query_id, r.bm25_rank, r.unit_idx) for r in whole.collect())
    assert sorted((r.query_id, r.bm25_rank, r.unit_idx) for r in retrieve.bm25_top(u, q, 5, digits=9).collect()) == want


def test_names_by_brute_force(spark):
    import random
    import re

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abé1") for _ in range(rnd.randint(1, 3)))
    name = lambda: rnd.choice(" _-").join(word() for _ in range(rnd.randint(1, 3))) + rnd.choice([".pdf", ".PDF", ".txt"])
    files, rows = [("g", f"g/{name()}") for _ in range(40)], [(i, "g", name()) for i in range(60)]
    stem = lambda s: re.sub(r"(?<=[^.])\.[^.]+$", "", s)
    split, flat = (lambda s: {x for x in re.split("[^a-z0-9]+", s.lower()) if x}), (lambda s: re.sub("[^a-z0-9]+", "", s.lower()))
    got = {r.key: (r.path, r.name_score) for r in tables.resolve_names(spark.createDataFrame(rows, "key int, group_id string, file_name_raw string"), spark.createDataFrame(files, "group_id string, path string")).collect()}
    for key, _, raw in rows:
        best = []
        for _, path in files:
            base = path.rsplit("/", 1)[-1]
            score = len(split(stem(raw)) & split(stem(base))) / max(1, len(split(stem(raw))))
            score += 0.5 * (flat(raw) != "" and flat(raw) in flat(base)) + 0.25 * (flat(stem(raw)) != "" and flat(stem(raw)) in flat(stem(base)))
            if score > 0 or raw.lower() == base.lower():
                best.append((raw.lower() != base.lower(), -score, path))
        assert got[key] == ((min(best)[2], pytest.approx(-min(best)[1])) if best else (None, None)), raw


def test_scores_of_repeated_candidates_stay_together(spark):
    cands = spark.createDataFrame([("a",), ("b",), (None,)], "candidate_id string")
    scored = spark.createDataFrame([("a", "neutral", 0.4), ("a", "contradiction", 0.9), ("a", None, None)], "candidate_id string, nli_label string, nli_score double")
    got = {r.candidate_id: (r.nli_label, r.nli_score) for r in nli.merge_scores(cands, scored).collect()}
    assert got == {"a": ("contradiction", 0.9), "b": (None, None), None: (None, None)}


def test_missing_cells():
    assert tabular.parse_csv(b"a,b\n1,\nNA,x\n") == [["a", "b"], ["1", None], [None, "x"]]
