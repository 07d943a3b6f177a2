"""What findings of the third round were about."""

import random
import time

from pyspark.sql import functions as F

from veriflume.functions import segment, similarity
from veriflume.operators import retrieve, tables


def best_name(raw, paths):
    """Every file of the group tried, one after the other."""
    words = lambda s: {w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in s.lower()).split()}
    flat = lambda s: "".join(c for c in s.lower() if c.isascii() and c.isalnum())
    stem = lambda s: s.rsplit(".", 1)[0]
    best = None
    for path in paths:
        name = path.rsplit("/", 1)[-1]
        asked = words(stem(raw))
        score = len(asked & words(stem(name))) / max(1, len(asked))
        score += 0.5 * bool(flat(raw) and flat(raw) in flat(name)) + 0.25 * bool(flat(stem(raw)) and flat(stem(raw)) in flat(stem(name)))
        exact = name.lower() == raw.lower()
        if exact or score > 0:
            best = min(best or (2,), (not exact, -score, path))
    return None if best is None else (best[2], round(-best[1], 9))


def test_names_fit_as_by_brute_force(spark):
    r = random.Random(5)
    made = lambda sep: sep.join(r.choice(("a", "b1", "ab", "1a", "2", "x")) for _ in range(r.randint(1, 3)))
    rows = [(i, f"g{i % 3}", made(r.choice((" ", "-", ""))) + ".pdf") for i in range(300)]
    files = [(f"g{i % 4}", f"d{i % 7}/{made(r.choice(('_', '')))}.{r.choice(('pdf', 'PDF', 'txt'))}") for i in range(200)]
    got = tables.resolve_names(spark.createDataFrame(rows, "key int, group_id string, file_name_raw string"), spark.createDataFrame(files, "group_id string, path string"))
    want = {k: best_name(raw, {p for h, p in files if h == g}) for k, g, raw in rows}
    assert {x.key: x.path and (x.path, round(x.name_score, 9)) for x in got.collect()} == want


def test_names_meet_files_by_classes(spark):
    """Thousands of rows and files that share a word don't meet one by one (they made 16 million pairs)."""
    rows = spark.range(4000).select(F.col("id").alias("key"), F.lit("g").alias("group_id"), F.concat(F.lit("report "), F.col("id") + 10000, F.lit(".pdf")).alias("file_name_raw"))
    files = spark.range(4000).select(F.lit("g").alias("group_id"), F.concat(F.lit("d/report_"), F.col("id"), F.lit(".pdf")).alias("path"))
    found = tables.resolve_names(rows, files)
    assert {(x.path, x.name_score) for x in found.select("path", "name_score").distinct().collect()} == {("d/report_0.pdf", 0.5)}
    joins = [m for m in joined_rows(spark, found)]
    assert max(joins) <= 40000


def joined_rows(spark, df):
    """Rows that each join of a plan made, once it has run."""
    run = df._jdf.queryExecution()
    run.executedPlan().executeCollect()
    plan, out = run.executedPlan().toString(), []
    assert "isFinalPlan=true" in plan
    todo = [run.executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.nodeName()
        if kind == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in kind:
            todo.append(node.plan())
            continue
        if "Join" in kind and node.metrics().contains("numOutputRows"):
            out.append(node.metrics().apply("numOutputRows").value())
        todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return out


def slow_partial_ratio(a, b):
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            row = _next(row, c, y)
        return row[-1]

    def _next(row, c, y):
        new = [0]
        for j, d in enumerate(y):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[j]))
        return new

    def one(a, b):
        m = len(a)
        return max((int(100 * (2 * lcs(a, p) / (m + len(p)))) for p in (b[max(0, i) : i + m] for i in range(1 - m, len(b)))), default=0)

    a, b = sorted((a, b), key=len)
    if not a:
        return 100 if not b else 0
    return max(one(a, b), one(b, a)) if len(a) == len(b) else one(a, b)


def test_partial_ratios_equal_all_stretches():
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcé😀 ") for _ in range(n))
    pairs = [(word(r.randint(0, 12)), word(r.randint(0, 30))) for _ in range(400)] + [(word(n), word(n)) for n in range(20)]
    assert similarity.partial_ratios(*zip(*pairs)) == [slow_partial_ratio(a, b) for a, b in pairs]


def test_partial_ratio_of_long_texts_is_quick():
    """A stretch after the other took about a minute for these."""
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    a, b = [word(1500) for _ in range(60)], [word(1900) for _ in range(60)]
    start = time.time()
    assert all(40 < x < 90 for x in similarity.partial_ratios(a, b))
    assert time.time() - start < 15


def test_only_cited_sources_are_counted(spark):
    """Units of sources that no query asks for leave before their tokens explode (they were counted and joined)."""
    units = spark.createDataFrame([(f"s{i}", 0, ["a", "b", f"w{i}"]) for i in range(200)], "sha string, unit_idx int, tokens array<string>")
    asked = spark.createDataFrame([(1, "s7", ["a", "w7"])], "query_id long, sha string, tokens array<string>")
    assert [r.sha for r in retrieve.cited(units, asked).collect()] == ["s7"]
    assert [(r.query_id, r.unit_idx) for r in retrieve.bm25(units, asked).collect()] == [(1, 0)]


def test_initials_as_in_sql(spark):
    """An initial behind a letter that isn't ASCII is none; the blank behind one initial doesn't open the next."""
    df = spark.createDataFrame([("Said \u00e9A. Then J. K. Row.",)], "t string")
    assert df.select(segment.sentences_abbrev(F.col("t")).alias("s")).first().s == ["Said \u00e9A.", "Then J. K.", "Row."]


def test_jaccard_of_ngrams_by_sets(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("aBcé😀İ") for _ in range(r.randint(0, 14)))
    rows = [(i, word(), word()) for i in range(200)] + [(200, None, "abc"), (201, None, None)]
    df = spark.createDataFrame(rows, "k int, a string, b string").select("k", F.lower(F.coalesce("a", F.lit(""))).alias("x"), F.lower(F.coalesce("b", F.lit(""))).alias("y"), similarity.char_jaccard(F.col("a"), F.col("b")).alias("j"))
    for row in df.collect():
        p, q = ({s[i : i + 5] for i in range(max(1, len(s) - 4))} if s else set() for s in (row.x, row.y))
        assert row.j == (len(p & q) / len(p | q) if p or q else 0.0)
