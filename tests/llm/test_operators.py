"""Operators against brute force, exact round trips or held-out accuracy, and on odd tables."""

import hashlib
import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriflume.llm import ann, bpe, editfp, jaccard, langid, lm, packing, sharding, simhash, toxicity, warc
from veriflume.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def rows(df):
    return [tuple(r) for r in df.collect()]


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_bpe_equals_library(spark, name):
    from tokenizers import Tokenizer

    path = tokenizer_path(name)
    mine, library = bpe.BpeTokenizer(bpe.load_spec(path)), Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    alphabet = list("aabİΣeé ßÄ 12'sdt\n\x1c漢🙂nthering")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(1500)] + ["a" * k for k in range(60)] + ["<|endoftext|>a", "the international unbelievable"]
    for t in texts + [r.text for r in docs(spark).limit(50).collect()]:
        want = library.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == want
        assert mine.decode(want) == library.decode(want, skip_special_tokens=False)


def test_bpe_rows(spark, odd, none):
    got = {r.doc_id: r for r in bpe.encode_digests(odd, tokenizer_path(WORD)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[3].n_tokens == got[4].n_tokens == got[8].n_tokens == 0 and got[3].ids_sha256 == got[4].decoded_sha256 == empty
    assert bpe.encode_digests(odd, tokenizer_path(WORD)).count() == 11
    assert bpe.encode_digests(none, tokenizer_path(WORD)).count() == 0


def test_language_held_out(spark):
    d = docs(spark)
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    total, right = got.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert right >= 0.97 * total
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_rejects_junk(spark):
    """Foreign script, random letters and text without letters are rejected; of clean documents nearly none is."""
    base = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit_documents(base)
    rng = np.random.default_rng(1)
    clean = base.where("doc_id % 10 = 3")
    texts = [r.text for r in clean.where("n_chars > 60").limit(150).collect()]
    foreign = ["".join(chr(0x430 + ord(c) * 7 % 32) if c.isalpha() else c for c in t) for t in texts]
    mashed = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz     "), len(t))) for t in texts]
    junk = spark.createDataFrame([(t,) for t in [*foreign, *mashed, "12 34 !!", ""]], "text string")
    judge = lambda d: (lambda out, name: out.agg(F.avg(F.col(f"{name}.rejected").cast("int"))).first()[0])(*langid.with_language(d, model))
    assert judge(junk) >= 0.95 and judge(clean) <= 0.01


def test_language_forward_pass():
    """Scores against a plain sum over n-grams, one after the other."""
    rng = np.random.default_rng(3)
    size = 1 << langid.BUCKET_BITS
    m = langid.LanguageModel(["a", "b", "c"], rng.normal(size=(size, 3)), rng.normal(size=3), 0.7)
    for text in ("été à Noël, 12 mots", "a", "Ab cd" * 9, "x" * 50):
        codes = [0]
        for c in text.lower():
            if c.isalpha() or codes[-1]:
                codes.append(ord(c) if c.isalpha() else 0)
        codes += [0] * (codes[-1] != 0)
        buckets = []
        for n in langid.ORDERS:
            for i in range(len(codes) - n + 1):
                gram = codes[i : i + n]
                if (n == 1 and not gram[0]) or 0 in gram[1:-1]:
                    continue
                h = 0
                for g in gram:
                    h = (h * 0x100000001B3 + g + 1) % (1 << 64)
                buckets.append((h ^ n) * 0x9E3779B97F4A7C15 % (1 << 64) >> (64 - langid.BUCKET_BITS))
        z = (m.table[buckets].mean(axis=0) + m.bias) / m.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert m.predict(text) == (m.langs[int(p.argmax())], pytest.approx(float(p.max())))


def test_language_one_text_in_many_rows(spark):
    """Copies of one text neither crowd out the others nor reach the driver."""
    rows_ = [(i, "alpha beta gamma " + "xyz"[i % 3] * (i % 50 + 1), "en") for i in range(200)] + [(1000 + i, "un deux trois", "fr") for i in range(400)]
    d = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    assert len(langid._sample(d.select("lang", "text", F.xxhash64("text").alias("rank")), 600)) == d.select("text").distinct().count()


def test_language_odd(odd, none):
    rows_ = langid.identify(odd).collect()
    got = {r.doc_id: r for r in rows_}
    assert len(rows_) == 11 and got[3].lang_pred == got[4].lang_pred == got[8].lang_pred == "und" and got[3].score == 0 and got[3].rejected
    assert got[7].lang_pred == "en" and not got[7].rejected and langid.identify(none).count() == 0


def brute_components(fps, distance):
    first = {}
    for doc, fp in fps:
        first.setdefault(fp, []).append(doc)
    parent = {f: f for f in first}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in combinations(first, 2):
        if (a ^ b).bit_count() <= distance:
            parent[root(a)] = root(b)
    least = {}
    for f, ids in first.items():
        least[root(f)] = min([*ids, least.get(root(f), 1 << 70)])
    return {doc: least[root(fp)] for doc, fp in fps}


def test_simhash_brute_force(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    fps = [(r.doc_id, int(r.fingerprint, 16)) for r in got]
    assert {r.doc_id: r.component_id for r in got} == brute_components(fps, 2)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_simhash_links(spark, distance):
    rng = np.random.default_rng(distance)
    base = [int(x) for x in rng.integers(0, 1 << 62, 20)]
    fps = sorted({b ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(0, 5), replace=False)) for b in base for _ in range(12)})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = dict(rows(simhash.components(simhash.links(frame, distance))))
    want = brute_components([(f, f) for f in fps], distance)
    assert {f: roots.get(f, f) for f in fps} == want


def test_simhash_odd(odd, none):
    got = simhash.near_duplicates(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 11 and by[3].fingerprint == by[4].fingerprint == by[8].fingerprint == "0" * 16
    assert by[8].component_id == 3 and by[2].component_id == 1
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 1, 3, 5, 6, 10}
    assert simhash.near_duplicates(none).count() == 0


def recall(found, ids, v, is_query, k):
    out = []
    for i in np.flatnonzero(is_query):
        score = (v * v[i]).sum(axis=1)
        score[i] = -np.inf
        want = ids[np.lexsort((ids, -score))[:k]]
        mine = found[found.query_id == ids[i]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, k + 1)) and ids[i] not in mine.vec_id.tolist()
        assert np.allclose(mine.score, [(v[np.flatnonzero(ids == x)[0]] * v[i]).sum() for x in mine.vec_id])
        out.append(len(set(want) & set(mine.vec_id)) / k)
    return np.mean(out)


@pytest.mark.parametrize("kind", ["table", "isotropic", "clustered"])
def test_ann_recall(spark, monkeypatch, kind):
    """Default settings against brute force, with visits that leave entries out."""
    rng = np.random.default_rng(6)
    if kind == "table":
        e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
        x = e.toPandas()
        v, ids = np.stack([np.asarray(a, dtype=float) for a in x.embedding]), x.vec_id.to_numpy()
    else:
        v = rng.normal(size=(4000, 12))
        if kind == "clustered":
            v = 0.2 * v + rng.normal(size=(40, 12))[np.arange(4000) % 40]
        ids = np.arange(4000)
        e = spark.createDataFrame([(i, a) for i, a in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    visits, measured = [], ann.measured_visit
    monkeypatch.setattr(ann, "measured_visit", lambda *a: visits.append(measured(*a)) or visits[-1])
    found = ann.nearest(e, F.col("vec_id") % 20 == 0, k=20).toPandas()
    assert recall(found, ids, v, ids % 20 == 0, 20) >= 0.9
    assert 20 < visits[0] < (0.3 if kind == "clustered" else 0.9) * len(ids)


def test_ann_mixed_lengths(spark):
    """Vectors of each length are searched among themselves."""
    data = [(i, [float(i % 7 + 1), 1.0 * i]) for i in range(30)] + [(100 + i, [1.0, float(i), 2.0]) for i in range(6)]
    e = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = ann.nearest(e, F.col("vec_id") % 20 == 0, k=3).toPandas()
    assert got[got.query_id == 100].vec_id.tolist() == [101, 102, 103]  # ties
    assert got[got.query_id == 20].vec_id.tolist() == [29, 27, 28]


def test_ann_measured_visit(spark):
    """Clustered vectors: the default reaches the recall, with visits far below all entries."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16))
    v = centres[np.arange(9000) % 60] + 0.15 * rng.normal(size=(9000, 16))
    e = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    found = ann.nearest(e, F.col("vec_id") % 100 == 0, k=10).groupBy("query_id").agg(F.collect_set("vec_id").alias("ids")).collect()
    hits = []
    for r in found:
        s = v @ v[r.query_id]
        s[r.query_id] = -np.inf
        hits.append(len(set(np.argsort(-s)[:10].tolist()) & set(r.ids)) / 10)
    assert len(found) == 90 and np.mean(hits) >= 0.9
    celled = e.selectExpr("embedding", "array(vec_id) AS ids", "cast(vec_id % 60 AS int) AS cell")
    assert 150 <= ann.measured_visit(celled, e.where("vec_id % 100 = 0"), [centres[:, :8].mean(0, keepdims=True), centres[:, 8:]], np.full(60, 150), 10) <= 4500


def test_ann_odd(spark):
    data = [(i, [1.0, 0.0, 0.5, 0.0], i) for i in range(40)] + [(40, None, 0), (41, [0.0] * 4, 0), (42, [float("nan"), 1.0, 0.0, 0.0], 0), (43, [None, 1.0, 0.0, 0.0], 0), (60, [0.0, 1.0, 0.0, 0.0], 0), (60, [0.0, 1.0, 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0, 0.0], 0)]
    e = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int")
    got = ann.nearest(e, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 0] == list(range(1, 21))
    assert [r.vec_id for r in got if r.query_id == 20] == list(range(20))
    assert {r.query_id for r in got} == {0, 20, 60} and len([r for r in got if r.query_id == 60]) == 20
    assert ann.nearest(e.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_lm_base_scores(spark):
    d = docs(spark)
    got = {r.doc_id: r for r in lm.score_documents(d, lm.training_rows(F.col("doc_id"))).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    texts = {r.doc_id: [*r.text.encode().lower().split(), None] for r in d.collect()}
    c = Counter(w for i, ws in texts.items() if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in texts.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), abs=1e-6)
        assert r.score < 0


def small_mixer(rng, corpus):
    """A mixer with counts of a small corpus and weights of no special kind."""
    seen = Counter(w for t in corpus for w in [*t, b"\n"])
    cells = [np.zeros(2 << b, dtype=np.float32) for b in lm.TABLE_BITS]
    words, n = list(seen), np.array(list(seen.values()))
    lm.add_words(cells, words, n, n >= 2)
    m = lm.Mixer(cells)
    m.layer.weights = rng.normal(0.25, 0.1, m.layer.weights.shape).astype(np.float32)
    m.layer.refine = rng.normal(0, 0.02, m.layer.refine.shape).astype(np.float32)
    m.first = rng.normal(0.4, 0.1, 2).astype(np.float32)
    m.rate = 1e-3
    return m, seen


def lm_corpus(rng, n=60):
    word = lambda: bytes(rng.choice(list(b"abc"), rng.integers(1, 9)))
    pool = [word() for _ in range(150)]
    return [[pool[int(rng.integers(150) * rng.random())] for _ in range(rng.integers(0, 90))] for _ in range(n)]


def test_lm_equals_plain_loops(monkeypatch):
    """Token scores, online steps included, against dictionaries keyed by the contexts themselves, bit by bit."""
    monkeypatch.setattr(lm, "TABLE_BITS", (24,) * lm.HASHED)  # next to no shared cells
    rng = np.random.default_rng(4)
    corpus = lm_corpus(rng)
    m, seen = small_mixer(rng, corpus)

    def contexts(spelt, i, bits):
        return [(k, spelt[max(0, i - k) : i], i >= k, bits) for k in lm.ORDERS] + [("word", spelt[:i], True, bits)]

    bits_of = lambda byte: format(byte, "08b")
    counts: Counter = Counter()
    for w, n in seen.items():
        spelt = lm.spelled(w)
        for i, byte in enumerate(spelt):
            for j, bit in enumerate(bits_of(byte)):
                for c in contexts(spelt, i, bits_of(byte)[:j]):
                    counts[c, bit] += n if c[0] != "word" or n >= 2 else 0
    odds = lambda one, zero: max(-127, min(127, round(math.log((one + 0.4) / (zero + 0.4)) * 16))) / 16
    texts = [*corpus[:12], [b"zz", b"abcabcabcabc"] * 40]
    lexicon = lm.Lexicon(m)
    got, apart = lm.token_scores(lexicon, lexicon.lookup(texts)), []
    for t, scores in zip(texts, got, strict=True):
        own, move, want = np.zeros(2), np.zeros(2), []
        for k, w in enumerate([*t, b"\n"]):
            if k % lm.STEP == 0:
                own, move = own + m.rate * move, np.zeros(2)
            spelt, total = lm.spelled(w), 0.0
            for i, byte in enumerate(spelt):
                for j, bit in enumerate(bits_of(byte)):
                    cs = contexts(spelt, i, bits_of(byte)[:j])
                    x = np.array([odds(counts[c, "1"], counts[c, "0"]) for c in cs] + [0.25])
                    level = int(np.digitize(counts[cs[-1], "1"] + counts[cs[-1], "0"], lm.LEVELS))
                    gate = level + (i == 0) * (len(lm.LEVELS) + 1)
                    v = float(np.clip(x @ m.layer.weights[gate], -15.9, 15.9))
                    z = [v + m.layer.refine[gate * lm.BUCKETS + int(v * 2 + lm.BUCKETS // 2)], x[-2]]
                    s = np.array(z) if bit == "1" else -np.array(z)
                    margin = float(np.clip((m.first + own) @ s, -17, 17))
                    total -= math.log10(1 + math.exp(-margin))
                    move += s / (1 + math.exp(margin))
            want.append(total)
        assert len(scores) == len(want)
        apart += np.abs(scores - want).tolist()
    # single precision, and now and then two contexts share a cell
    assert len(apart) > 300 and np.mean(apart) < 6e-3 and np.quantile(apart, 0.95) < 0.02


def test_lm_is_a_distribution():
    """Whatever came before, the chances of all 256 next bytes sum to one."""
    rng = np.random.default_rng(2)
    corpus = lm_corpus(rng)
    m, _ = small_mixer(rng, corpus)
    for start in (b"", b"a", b"abcab", b"zzzzzzz"):
        s = lm.Spelling.of([start + bytes([b]) + b"x" for b in range(256)])
        z = m.margins(s).reshape(2, len(s.length), -1, 8)[:, :, len(start)] / lm.FINE
        z = np.tensordot(m.first + [0.05, -0.1], z, 1)
        assert (1 / (1 + np.exp(-z))).prod(axis=1).sum() == pytest.approx(1, abs=0.02)


def test_lm_learns_order():
    """Weights learned on a sample code it better than the first ones."""
    rng = np.random.default_rng(5)
    corpus = lm_corpus(rng, 200)
    m, _ = small_mixer(rng, corpus[:150])

    def cost():
        lexicon = lm.Lexicon(m)
        return -sum(s.sum() for s in lm.token_scores(lexicon, lexicon.lookup(corpus[150:])))

    before = cost()
    lm.learn(m, corpus[150:])
    assert cost() < 0.95 * before


def test_lm_counts_the_words_it_scores(spark):
    """Words counted in Arrow are those of the tokens, whatever lies between them, in slices too."""
    import pyarrow as pa

    texts = ["", None, "  A bÀ ", "\x1c\x1d\x85À\u00a0É x y \x0b\x0c\x00Z\r", "\t", "İı ẞ\u2003x" * 3, "Ab aB"]
    want = [[w.decode() for w in lm.tokens(t)] for t in texts]
    for at in range(len(texts)):
        assert lm.split(pa.array(texts)[at:]).to_pylist() == [w for t in want[at:] for w in t]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.word: r.n for r in lm.count_words(d).collect()} == Counter([*(w for t in want for w in t), *["\n"] * len(texts)])
    assert lm.count_words(d.limit(0)).count() == 0


def test_lm_learns_from_every_training_row(spark):
    """Weights follow from all training rows, so no row counts for more by its id."""
    rng = np.random.default_rng(6)
    texts = [" ".join(w.decode() for w in t) for t in lm_corpus(rng, 600)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = F.col("doc_id") % 10 != 0
    one = {r.doc_id: r.score for r in lm.score_documents(d, held).collect()}
    other = {r.doc_id - 7000: r.score for r in lm.score_documents(d.selectExpr("doc_id + 7000 AS doc_id", "text"), held).collect()}
    assert other == pytest.approx(one, rel=1e-6)


def test_lm_leaves_out_what_it_forecasts():
    """Outcomes by the counts less one occurrence are those by tables that lack it."""
    rng = np.random.default_rng(3)
    words = [bytes(rng.permutation(list(b"abcdefgh"))[: rng.integers(1, 8)]) for _ in range(60)]
    words = [*dict.fromkeys(words), b"\n"]
    times = rng.integers(1, 6, len(words))
    cells = [np.zeros(2 << b, dtype=np.float32) for b in lm.TABLE_BITS]
    lm.add_words(cells, words, times, times >= 2)
    got, want = np.zeros(lm.OUTCOMES), np.zeros(lm.OUTCOMES)
    lm.add_left_out(got, cells, words, times, times >= 2)
    for w, n in zip(words, times, strict=True):
        lm.add_words(cells, [w], -np.ones(1), np.array([n >= 2]))
        s = lm.Spelling.of([w])
        x, gate = lm.Mixer(cells).inputs(s)
        lm.add_outcomes(want, x, gate, lm.BITS[s.data].ravel(), np.full(len(gate), n))
        lm.add_words(cells, [w], np.ones(1), np.array([n >= 2]))
    assert got.sum() == sum(8 * n * len(lm.spelled(w)) for w, n in zip(words, times, strict=True))
    assert np.abs(got - want).sum() <= 0.02 * got.sum()


def test_lm_scores_with_few_steps(monkeypatch):
    """A word is looked up once a block of texts, not once a token, and a logarithm serves four bits."""

    class Counting(dict):
        asked = 0

        def get(self, *args):
            Counting.asked += 1
            return super().get(*args)

    rng = np.random.default_rng(9)
    corpus = lm_corpus(rng)
    m, _ = small_mixer(rng, corpus)
    lexicon = lm.Lexicon(m)
    lexicon.slots = Counting()
    slots = lexicon.lookup(corpus)
    assert Counting.asked <= len({w for t in corpus for w in t}) + 1 < sum(map(len, slots)) / 4
    taken, log = [], np.log
    monkeypatch.setattr(np, "log", lambda x, *args, **more: taken.append(np.size(x)) or log(x, *args, **more))
    lm.token_scores(lexicon, slots)
    n_bits = sum(8 * len(lm.spelled(w)) for t in corpus for w in [*t, b"\n"])
    assert sum(taken) <= n_bits / 4 + 8


def test_lm_scores_whatever_lies_beside(monkeypatch):
    """What a worker tells of a text doesn't depend on how texts are dealt into blocks, and holds the text's own words."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    corpus = lm_corpus(rng)
    m, seen = small_mixer(rng, corpus)
    base = {w: -1.0 - i / 100 for i, (w, _) in enumerate(seen.most_common(40))}
    texts = [" ".join(w.decode() for w in t) for t in corpus] + ["", None, " \t\n ", "  \u00c9t\u00e9 \u00e9T\u00c9 ABC abc", "x" * 3000, "a b " * 900]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "train": [i % 3 > 0 for i in range(len(texts))]})

    def told():
        lexicon = lm.Lexicon(m, base)
        return [r for part in lm.blocks(batch) for r in lm.scored_rows(lexicon, part).to_pylist()]

    one = told()
    monkeypatch.setattr(lm, "BLOCK", 300)
    monkeypatch.setattr(lm, "SIDE", 3)
    monkeypatch.setattr(lm, "REMEMBERED", (800, 1600))
    assert len(list(lm.blocks(batch))) > 10 and sum(map(len, lm.blocks(batch))) == len(texts)
    for i, (a, b) in enumerate(zip(one, told(), strict=True)):
        words = [*lm.tokens(texts[i]), b"\n"]
        assert a["opening"] == pytest.approx(b.pop("opening"), rel=1e-5) and a["spelled"] == pytest.approx(b.pop("spelled"), rel=1e-5)
        assert {k: a[k] for k in b} == b
        assert (a["n_tokens"], a["held_out"], a["n_bytes"]) == (len(words), i % 3 == 0, len((texts[i] or "").encode()))
        assert a["rare"] == [w.decode() for w in words if w not in base] and a["n_known"] == sum(w in base for w in words)
        assert a["base"] == pytest.approx(sum(base.get(w, 0) for w in words))


def test_lm_match_model(spark):
    """Forecasts by the most frequent stretch in the other training texts, against dictionaries."""
    rng = np.random.default_rng(8)
    pool = [rng.integers(0, 1 << 62, rng.integers(40, 200)).astype(np.uint64) for _ in range(6)]
    texts = [np.concatenate([pool[i] for i in rng.integers(0, 6, rng.integers(0, 4))] + [rng.integers(0, 1 << 62, 30).astype(np.uint64)]) for _ in range(40)]
    texts += [texts[3], texts[3], texts[0][:2], texts[0][:4]]
    held, cut = [i % 5 == 0 for i in range(len(texts))], []
    starts, opening, *rest = lm.stretches(np.concatenate(texts), np.array([len(t) for t in texts]))
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[starts]
    for i, t in enumerate(texts):
        mine = [r[text[~opening] == i] for r in rest]
        alone = lm.stretches(t, np.array([len(t)]))
        assert all((a == b).all() for a, b in zip(mine, alone[2:], strict=True))  # whatever lies beside it
        assert len(alone[0]) == len(mine[0]) + 1 and (len(t) <= lm.CONTEXT or alone[0][1] == lm.CONTEXT)
        cut.append(mine)
    data = [(i, bool(h), c.tolist(), b.tolist(), o.tolist(), [-1.0] * len(c)) for i, (h, (c, b, o)) in enumerate(zip(held, cut, strict=True))]
    scored = spark.createDataFrame(data, "row long, held_out boolean, context array<long>, body array<long>, once array<boolean>, spelled array<double>")
    got = {(r.row, r.state, r.hit): r.n for r in lm._matched(scored).collect()}
    want: Counter = Counter()
    for i, (context, body, _) in enumerate(cut):
        others = Counter(x for j, (c, b, _) in enumerate(cut) if not held[j] and j != i for x in set(zip(c.tolist(), b.tolist(), strict=True)))
        for c, b in zip(context.tolist(), body.tolist(), strict=True):
            after = sorted((-n, x) for (k, x), n in others.items() if k == c)
            state = min(-after[0][0], 7) * 8 + min(-after[1][0] if after[1:] else 0, 7) if after else 0
            want[i, state, bool(after) and after[0][1] == b] += 1
    assert got == dict(want)


def test_lm_scores_copies_apart(spark):
    """A text that occurs twice costs far fewer bits than one that occurs once; held-out texts beat the base."""
    d = docs(spark).select("doc_id", "text")
    words = "' '"
    once = d.where("length(text) between 600 and 5000").orderBy("doc_id").limit(12).selectExpr("doc_id + 100000 AS doc_id", f"array_join(shuffle(split(text, {words}), 7), {words}) AS text")
    got = lm.score_documents(d.unionByName(once).unionByName(once.selectExpr("doc_id + 1000 AS doc_id", "text")), lm.training_rows(F.col("doc_id"))).toPandas()
    twice = got[got.doc_id >= 100_000].bits_per_byte
    assert twice.median() < 0.5 * got[got.doc_id < 100_000].bits_per_byte.median()


def test_lm_odd(odd, none):
    rows_ = lm.score_documents(odd, F.col("doc_id") != 5).collect()
    got = {r.doc_id: r for r in rows_}
    assert len(rows_) == 11 and got[None].held_out and got[5].held_out and not got[1].held_out
    assert got[3].n_tokens == got[4].n_tokens == got[8].n_tokens == 1
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) and r.score < 0 for r in rows_)
    assert lm.score_documents(none, F.col("doc_id") != 5).count() == 0
    assert lm.score_documents(odd, F.lit(False)).where("held_out and n_known = 0").count() == 11


def test_toxicity_held_out(spark):
    base = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = toxicity.fit_from_labels(d, labels.where("doc_id % 3 <> 0"))
    got = toxicity.classify(d, labels, model).join(labels.where("doc_id % 3 = 0"), "doc_id").select(labels["toxic"].alias("y"), "p_toxic").toPandas()
    said = got.p_toxic >= model.thresholds[-1]
    assert (said == (got.y == 1)).mean() >= 0.95 and (said & (got.y == 0)).sum() <= 0.005 * (got.y == 0).sum()


def test_toxicity_chain_forward_pass():
    """A prediction is the logistic of the words' weights and of the chances before it."""
    texts = [f"word{i % 7} word{i % 11} {'scum' if i % 5 == 0 else 'fine'} {'poor' if i % 3 == 0 else 'good'}" for i in range(240)]
    labels = np.array([[i % 3 == 0, i % 5 == 0] for i in range(240)], dtype=int)
    m = toxicity.fit_chain([toxicity.words(t) for t in texts], labels, ["low", "toxic"])
    for t in texts[:20] + ["", "nothing known"]:
        present, before = set(toxicity.words(t).tolist()), []
        for link in m.links:
            z = link.bias + sum(w for f, w in zip(link.features.tolist(), link.weights, strict=True) if f in present) + float(np.dot(link.earlier, before))
            before.append(1 / (1 + math.exp(-z)))
        assert m.predict(t) == pytest.approx(before)
    assert m.predict("scum")[1] > m.thresholds[1] > m.predict("fine")[1]


def test_toxicity_contradicting_labels(spark):
    """Of labels that contradict each other, and of equal texts', the worse ones count; copies are one text."""
    d = spark.createDataFrame([(i, "scum here" if i % 2 else f"fine words {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(i, 0, 1) for i in range(1, 60, 2)], "doc_id long, quality int, toxic int")
    seen = {}
    keep = toxicity.fit_chain
    toxicity.fit_chain = lambda rows, y, c: seen.update(y=y) or keep(rows, y, c)
    try:
        toxicity.fit_from_labels(d, labels)
    finally:
        toxicity.fit_chain = keep
    assert len(seen["y"]) == 31 and seen["y"].sum(axis=0).tolist() == [1, 1]


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, None, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(odd, labels).count() == 11
    assert toxicity.classify(none, labels).count() == 0
    assert toxicity.classify(odd, labels.limit(0)).where("toxic").count() == 0


@pytest.mark.parametrize("runs", [0, 3])
def test_shards(spark, runs):
    d = docs(spark)
    copies = d.unionByName(d.limit(1).crossJoin(spark.range(200)).withColumn("doc_id", F.col("id") + 100_000).drop("id"))
    got = sharding.shards(copies, runs_per_shard=runs).toPandas()
    assert len(got) == copies.count() and set(got.shard) == set(range(8))
    size = got.groupby("shard")["size"].sum()
    assert size.max() - size.min() <= 2 * got["size"].max()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_shards_odd(odd, none):
    got = sharding.shards(odd).toPandas()
    assert len(got) == 11 and sorted(got[got.doc_id.isin([3, 4])]["size"]) == [1, 1] and got.grown_shard.isna().all()
    assert sharding.shards(none).count() == 0


def check_packing(items):
    for _, part in items.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.offset.tolist() == (part.length.cumsum() - part.length).tolist() and part.length.sum() <= packing.CAPACITY


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(BYTE))
    d = docs(spark).select("doc_id", "text").unionByName(odd.where("doc_id <> 2").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    got = packing.pack_documents(d, tokenizer_path(BYTE)).toPandas()
    check_packing(got)
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / packing.CAPACITY) + 1
    for r in d.collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        mine = got[got.doc_id == r.doc_id].sort_values("piece")
        assert mine.piece.tolist() == list(range(len(mine))) and mine.length.sum() == len(ids)
        for p in mine.itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        assert all(x == packing.CAPACITY for x in mine.length[1:]) and (len(ids) > packing.CAPACITY or len(mine) == 1)
    assert packing.pack_documents(none, tokenizer_path(BYTE)).count() == 0


def test_slack_is_least():
    """The first bin is as full as brute force can make one that holds the longest item."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        capacity = int(rng.integers(5, 30))
        items = rng.integers(1, capacity + 1, int(rng.integers(1, 9)))
        counts = np.bincount(items, minlength=capacity + 1)
        combo = packing._fullest(counts, capacity)
        rest = sorted(items)[:-1]
        best = max(max(items) + s for k in range(len(rest) + 1) for c in combinations(rest, k) if (s := sum(c)) + max(items) <= capacity)
        assert sum(k * n for k, n in combo.items()) == best
        used = sum((np.bincount([k], minlength=capacity + 1) * n * t for c, t in packing.patterns(counts, capacity) for k, n in c.items()), np.zeros(capacity + 1, int))
        assert (used == counts).all()


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é</p>" * 300
    data = [(1, "http://a", big), (2, "http://b", big), (3, None, None), (4, "http://c\r\nX: y", "small"), (5, "http://d", "small"), (2, "http://b", big), (None, "http://e", big)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    folder = f"file://{tmp_path}"
    index = warc.write_archives(warc.with_revisits(pages), folder)
    got = warc.read_records(index, folder).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [(0, "response", 0), (1, "revisit", 2), (2, "response", 0), (2, "response", 0), (3, "response", 0), (4, "response", 0), (5, "response", 0)]
    assert {r.payload_bytes for r in got if r.page_id == 1} == {len(big.encode())}
    assert {bytes(r.payload) for r in got if r.page_id == 2} == {big.encode()}
    one = warc.read_records(index.where("url = 'http://d'"), folder).collect()
    assert [r.page_id for r in one] == [5] and bytes(one[0].payload) == b"small"
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_odd(spark):
    """Columns of the operator's own names, a very long page, one page in a third of the rows, empty pages."""
    big, long = "<p>x</p>" * 200, "long é " * 400_000
    data = [(i, "u", big if i % 3 == 0 else "" if i % 3 == 1 else f"page {i} " * 200, "d", 1, 2) for i in range(300)] + [(1000, "u", long, "d", 1, 2)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, digest string, n_bytes int, largest int")
    got = {r.page_id: r for r in warc.archive_pages(pages).collect()}
    assert len(got) == 301 and got[1000].payload_bytes == len(long.encode())
    for i in range(300):
        want = ("revisit", 297) if i % 3 == 0 and i != 297 else ("response", None)
        assert (got[i].record_type, got[i].refers_to, got[i].payload_digest) == (*want, hashlib.sha1(data[i][2].encode()).hexdigest())


def test_ranges():
    assert warc.ranges([(0, 10), (10, 5), (100, 10)], gap=0) == [(0, 15, 2), (100, 10, 1)]
    assert warc.ranges([(0, 10), (12, 5)], gap=5, window=15) == [(0, 10, 1), (12, 5, 1)]


def test_warc_equals_sql(spark):
    import oracle
    from veriflume.llm.queries import ORACLE_SQL

    assert oracle.difference(spark, SF, QUERIES["op9_warc"], ORACLE_SQL["op9_warc"]) is None


def test_fingerprints_brute_force(spark):
    d = docs(spark)
    got = {r.doc_id: r for r in editfp.fingerprint_documents(d, run_rows=30).collect()}
    data = sorted((r.doc_id, r.text) for r in d.collect())
    assert len(got) == len(data)
    for (i, text), (_, following) in zip(data, [*data[1:], data[0]], strict=True):
        new, r = editfp.edited(text, following), got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (editfp.fingerprint(text), editfp.fingerprint(new))
        assert r.near_edited == editfp.likeness(r.fingerprint, r.edited_fingerprint) and r.near_next == editfp.likeness(r.fingerprint, editfp.fingerprint(following))
    fine = editfp.fingerprint_documents(d, run_rows=3, run_chars=4000)
    assert {r.doc_id: r for r in fine.collect()} == got and fine.rdd.getNumPartitions() > 30
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.3


def test_joined_ranges():
    assert editfp.joined_ranges([5, 5, 5, 5], run_chars=10, fewest=1) == [0, 2]
    assert editfp.joined_ranges([1, 50, 1, 1], run_chars=10, fewest=1) == [0, 1, 2]
    assert editfp.joined_ranges([1] * 32, run_chars=1000, fewest=16) == list(range(0, 32, 2)) and editfp.joined_ranges([], 10) == []


def test_fingerprints_odd(odd, none):
    assert editfp.fingerprint_documents(odd).count() == 11
    assert editfp.fingerprint_documents(none).count() == 0
    alone = editfp.fingerprint_documents(odd.where("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_near_classes(spark):
    text = docs(spark).orderBy(F.desc("n_chars")).first().text[:4000]
    near = text[:1000] + "!" + text[1000:2500] + text[2504:]
    d = spark.createDataFrame([(5, text), (3, near), (9, text), (7, text[::-1]), (8, "")], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in editfp.near_classes(d).collect()}
    assert got[5] == got[3] == got[9] == 3 and got[7] == 7 and got[8] == 8


def test_near_classes_brute_force(spark, odd, none):
    """Graded chains and texts that share their ends, at the default threshold: the classes of all pairs that share a band."""
    rng = np.random.default_rng(11)
    texts, tail = [], "the same end of many texts " * 12
    for _ in range(12):
        t = "".join(rng.choice(list("abcdefgh "), 700))
        for _ in range(8):
            texts.append(t + tail if rng.random() < 0.3 else t)
            for _ in range(rng.integers(1, 12)):
                i = int(rng.integers(len(t)))
                t = t[:i] + str(rng.choice(list("xyz"))) + t[i + 1 :]
    fps = [editfp.fingerprint(t) for t in texts]
    chosen = np.random.default_rng(editfp.SEED + 99).permutation(editfp.SAMPLES).reshape(16, -1)

    def bands(fp):
        raw = np.frombuffer(bytes.fromhex(fp), dtype=np.uint8)
        parts = ((raw[0] + i, b, tuple(raw[1 + i * 64 :][:64][at])) for i in (0, 1) for b, at in enumerate(chosen))
        return {x for x in parts if any(x[2])}

    keys, root = [bands(f) for f in fps], list(range(len(fps)))
    for i, j in combinations(range(len(fps)), 2):
        if fps[i] == fps[j] or (keys[i] & keys[j] and editfp.likeness(fps[i], fps[j]) >= 0.8):
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in editfp.near_classes(d).collect()} == dict(enumerate(root))
    rows_ = editfp.near_classes(odd).collect()
    by = {r.doc_id: r for r in rows_}
    assert len(rows_) == 11 and by[3].class_id == by[4].class_id == 3 and by[3].n_copies == 2 and by[2].class_id == 1 and by[2].n_copies == 3
    assert editfp.near_classes(none).count() == 0


def test_scratch(spark):
    """Only a session in one process may do without a shared folder; scratch goes when it is cleared."""
    from types import SimpleNamespace

    from veriflume.llm import common

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_root(far)
    path = common.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    common.clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_packing_of_one_length(spark):
    """A length that most rows have, odd column names and repeats."""
    rng = np.random.default_rng(2)
    length = np.where(rng.random(3000) < 0.6, 700, rng.integers(1, 2049, 3000))
    d = spark.createDataFrame([(int(n), i % 50, "x", i, 1.0) for i, n in enumerate(length)], "length int, row int, len string, tie int, grp double")
    got = packing.pack(d).toPandas()
    assert sorted(got.columns) == sorted([*d.columns, "sequence_id", "offset"]) and sorted(got.length) == sorted(length.tolist())
    check_packing(got)
    assert got.sequence_id.nunique() <= 1.25 * math.ceil(length.sum() / packing.CAPACITY)


def test_shards_against_plain_sizes(spark, odd):
    """Sizes, checksums, equal texts together, null ids spread."""
    texts = {r.doc_id: r.text for r in docs(spark).collect()}
    for r in sharding.shards(docs(spark)).collect():
        assert (r.size, r.text_crc32) == (len((texts[r.doc_id] or "").encode()) + 1, zlib.crc32((texts[r.doc_id] or "").encode()))
    many = spark.createDataFrame([(None, "same text")] * 400, "doc_id long, text string")
    assert sharding.shards(many).groupBy("shard").count().agg(F.max("count")).first()[0] <= 60
    clash = odd.selectExpr("doc_id", "text", "1 AS h", "2 AS d", "3 AS size", "4 AS run")
    assert sharding.shards(clash).columns == sharding.shards(odd).columns


def test_simhash_fingerprint_by_plain_loop():
    import xxhash

    for text in ("One two\tTHREE four five", "a", "", "é É x y z w", "w " * 50):
        words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").split(" ") if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_copies_brute_force(spark, odd, none):
    """The pipeline's stage against all pairs: edits that simhash misses, graded chains, a line that many texts share."""
    import corpus_pipeline

    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    line, texts = " ".join(word() for _ in range(15)), []
    for _ in range(25):
        base = [word() for _ in range(rng.integers(30, 200))]
        for _ in range(rng.integers(1, 8)):
            texts.append(" ".join([*base, line] if rng.random() < 0.4 else base))
            base = list(base)
            for _ in range(rng.integers(0, 6)):
                base[rng.integers(len(base))] = word()
    texts += ["", " ", "one two", "One two", "one three", line]
    sets = [set(jaccard.shingle_set(t).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.near_copies(d).collect()} == dict(enumerate(root))
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, d, SF).collect()} == set(root)
    kept = jaccard.representatives(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {None, 1, 3, 5, 6, 10}
    assert jaccard.near_copies(none).count() == 0


def test_near_copies_of_one_text_cost_no_square(spark, monkeypatch):
    """Many edited forms of one text, of which few are alike: no more pairs meet, verified or not, than members."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    base, texts = [word() for _ in range(150)], []
    for _ in range(300):
        own = list(base)
        for i in rng.choice(150, rng.integers(0, 7), replace=False):
            own[i] = word()
        texts.append(" ".join(own))
    sets = [set(jaccard.shingle_set(t).tolist()) for t in texts]
    alike = [(i, j) for i, j in combinations(range(len(texts)), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = list(range(len(texts)))
    for i, j in alike:
        a, b = sorted((root[i], root[j]))
        root = [a if r == b else r for r in root]
    assert 0.1 < len(alike) / math.comb(len(texts), 2) < 0.9 and len(set(root)) > 10
    asked, verified = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, of: asked.append(pairs.count()) or verified(pairs, of))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.near_copies(d).collect()} == dict(enumerate(root))
    assert sum(asked) <= 10 * len(texts), asked


def test_pipeline(spark):
    import corpus_pipeline

    d = docs(spark)
    at = d
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, at, SF)
        assert after.columns == d.columns, name
        assert after.exceptAll(at).count() == 0
        at = after
    assert at.count() >= 0.7 * d.count()
    packed = corpus_pipeline.run(spark, SF).toPandas()
    check_packing(packed)
    assert set(packed.doc_id) == {r.doc_id for r in at.collect()}
