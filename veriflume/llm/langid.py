"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

A text is the mean of the embeddings of its hashed character n-grams (runs of other characters than letters count as
one boundary). The classifier is fitted on the driver from a bounded sample of labelled rows, whose texts arrive as
bounded sparse count vectors; the softmax is calibrated by a temperature on rows that training left out, and there the
score is read off under which a set share of rightly named texts lies: what scores less is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, free_name, need

ORDERS = (1, 2, 3)
BUCKET_BITS = 13
#: Bound of the sample of labelled rows for training, and of those for calibration.
TRAIN_ROWS, CALIBRATION_ROWS = 2400, 1200
#: Characters handled at once; longer texts go through in blocks that share the context of an n-gram.
BLOCK = 1 << 19


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of non-letters as one 0, with a 0 at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def subwords(text: str):
    """Blocks of bucket numbers, n-grams of one order each; an n-gram may start or end, but not lie across, a boundary."""
    codes = _codes(text)
    if len(codes) < 3:
        return
    for start in range(0, len(codes), BLOCK):
        part = codes[start : start + BLOCK + max(ORDERS) - 1]
        h = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, max(ORDERS) + 1):
            h = (h[: len(part) - n + 1] if n > 1 else h) * np.uint64(0x100000001B3) + part[n - 1 :] + np.uint64(1)
            if n not in ORDERS or not len(h):
                continue
            mixed = (h ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            b = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)[:BLOCK]
            inner = part[1 : len(part) - 1]
            if n == 1:
                b = b[part[: len(b)] != 0]
            elif n > 2:
                b = b[inner[: len(b)] != 0]
            yield b


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for b in subwords(text):
        total += np.bincount(b, minlength=1 << BUCKET_BITS)
    idx = np.flatnonzero(total)
    return idx, total[idx]


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # per bucket, its part of the logits: embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def probabilities(self, mean_logits: np.ndarray) -> np.ndarray:
        z = (mean_logits + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def mean_logits(self, text: str | None) -> np.ndarray | None:
        if not text:
            return None
        total, n = np.zeros(len(self.langs)), 0
        for b in subwords(text):
            total += self.table[b].sum(axis=0)
            n += len(b)
        return total / n if n else None

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 for null texts and texts without letters."""
        z = self.mean_logits(text)
        if z is None or not self.langs:
            return "und", 0.0
        p = self.probabilities(z)
        return self.langs[int(p.argmax())], float(p.max())


def _sample(labelled: DataFrame, rows: int) -> pd.DataFrame:
    """At most ``rows`` distinct texts by hash, each language an equal share of them; count vectors only.

    Copies fall together and the bound is set before anything is collected, so a text that many rows repeat is one.
    """
    n = labelled.groupBy("lang").count().collect()
    share = max(1, rows // max(1, len(n)))
    keep = F.lit(False)
    for r in n:
        part = min(1.0, 1.3 * share / r["count"] + 20 / r["count"])
        keep = keep | ((F.col("lang") == r["lang"]) & (F.pmod(F.col("rank"), F.lit(1 << 30)) < int(part * (1 << 30))))

    def run(batches):
        for pdf in batches:
            got = [counts(t) for t in pdf.text]
            yield pd.DataFrame({"lang": pdf.lang, "rank": pdf["rank"], "idx": [g[0].astype(np.int32).tobytes() for g in got], "n": [g[1].astype(np.float32).tobytes() for g in got]})

    found = labelled.where(keep).mapInPandas(run, "lang string, rank long, idx binary, n binary").where("length(idx) > 0")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))
    few = found.dropDuplicates(["lang", "rank"]).withColumn("place", place).where(F.col("place") <= share).drop("place")
    return few.toPandas().sort_values(["lang", "rank"], kind="stable")


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    x = np.zeros((len(pdf), 1 << BUCKET_BITS), dtype=np.float32)
    for i, (idx, n) in enumerate(zip(pdf.idx, pdf.n, strict=True)):
        c = np.frombuffer(n, dtype=np.float32)
        x[i, np.frombuffer(idx, dtype=np.int32)] = c / c.sum()
    return x


def fit(labelled: DataFrame, calibration: DataFrame, dim: int = 16, epochs: int = 12, seed: int = 7, keep_share: float = 0.998) -> LanguageModel:
    """Train on ``text, lang, rank`` rows (rank: any hash) and calibrate on others.

    reject_below is the score under which ``1 - keep_share`` of the rightly named calibration texts lie: so many clean
    documents go, and whatever looks less like a learned language than they do. Where these texts are too few to tell,
    it is half of their least score.
    """
    train, held = _sample(labelled, TRAIN_ROWS), _sample(calibration, CALIBRATION_ROWS)
    langs = sorted(set(train.lang))
    if not langs:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0)), np.zeros(0))
    number = {v: i for i, v in enumerate(langs)}
    x, y = _matrix(train), np.array([number[v] for v in train.lang])
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (x.shape[1], dim)).astype(np.float32)
    soft, bias = rng.normal(0, 0.1, (dim, len(langs))).astype(np.float32), np.zeros(len(langs), dtype=np.float32)
    g_emb, g_soft, g_bias = np.full_like(emb, 1e-8), np.full_like(soft, 1e-8), np.full_like(bias, 1e-8)  # AdaGrad step sizes
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 32):
            rows = order[i : i + 32]
            h = x[rows] @ emb
            z = h @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            for w, acc, g in ((emb, g_emb, x[rows].T @ (p @ soft.T)), (soft, g_soft, h.T @ p), (bias, g_bias, p.sum(axis=0))):
                acc += g * g
                w -= 0.2 * g / np.sqrt(acc)
    model = LanguageModel(langs, (emb @ soft).astype(np.float64), bias.astype(np.float64))
    held = held[held.lang.isin(langs)]
    if len(held):
        z, t = _matrix(held) @ model.table.astype(np.float32), np.array([number[v] for v in held.lang])

        def loss(temperature: float) -> float:
            model.temperature = temperature
            return float(-np.log(model.probabilities(z)[np.arange(len(t)), t] + 1e-12).mean())

        model.temperature = min(np.geomspace(0.1, 8, 51), key=loss)
        p = model.probabilities(z)
        right = p.max(axis=1)[p.argmax(axis=1) == t]
        if len(right):
            enough = len(right) * (1 - keep_share) >= 1
            model.reject_below = float(np.quantile(right, 1 - keep_share) if enough else right.min() / 2)
    return model


def fit_documents(docs: DataFrame, learn: Column | None = None) -> LanguageModel:
    """Fit on the labelled rows of a documents table: two thirds of the ``learn`` rows train, a third calibrates."""
    need(docs, "text", "lang")
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = (rows.where(learn) if learn is not None else rows).select("lang", "text", F.xxhash64("text").alias("rank"))
    part = F.pmod(F.xxhash64("rank"), F.lit(3))
    return fit(rows.where(part > 0), rows.where(part == 0))


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus a column (its name is returned) ``struct<lang_pred string, score double, rejected boolean>``.

    Rejected: no letters, null text, or a score under the model's threshold. All other columns stay, names included.
    """
    need(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = free_name(docs, "_language")

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def udf(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        got = [m.predict(t) for t in texts]
        return pd.DataFrame({"lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[0] == "und" or g[1] < m.reject_below for g in got]})

    return docs.withColumn(name, udf(F.col(f"`{text_col}`"))), name


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every whole text.

    Without a model one is learned from the rows with crc32(doc_id) mod 3 other than 1 and a language. held_out marks
    the rest. An empty table, or no labelled row, gives ``und`` throughout.
    """
    need(docs, "doc_id", "text")
    held = crc_mod(F.col("doc_id"), 3) == 1
    model = model or fit_documents(docs, ~held)
    out, name = with_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), f"{name}.lang_pred", f"{name}.score", f"{name}.rejected")
