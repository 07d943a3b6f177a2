"""Toxicity by a classifier chain over hashed words.

Categories are predicted in order. The linear model of a category sees the words of the text and the probabilities of
the categories before it; in training these are out-of-fold predictions, so that a later model does not trust an
earlier one more than it deserves. The models are fitted on the driver from a bounded sample of labelled rows, which
arrive as bounded sets of hashed words.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, need

#: Bound of the labelled sample, and of the features of a model.
SAMPLE_ROWS, FEATURES = 8000, 4096
MIN_ROWS, FOLDS = 4, 4
_BASE = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 20


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse."""
    inverse, n = pow(_BASE, -1, 1 << 64), BLOCK + 1
    out = []
    for b in (_BASE, inverse):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def words(text: str) -> np.ndarray:
    """Distinct 64-bit hashes of the lower-cased letter runs of a whole text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    found, start = [], 0
    while start < len(codes):
        stop = min(len(codes), start + BLOCK)
        if stop < len(codes):  # end a block behind a non-letter, where there is one
            gaps = np.flatnonzero(~_letters()[codes[start:stop]])
            stop = start + int(gaps[-1]) + 1 if len(gaps) else stop
        part = codes[start:stop]
        inside = np.concatenate([[False], _letters()[part], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges):
            up, down = _powers()
            sums = np.concatenate([[np.uint64(0)], np.add.accumulate((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)])])
            h = (sums[edges[1::2]] - sums[edges[::2]]) * down[edges[::2]]
            found.append(np.unique(h ^ (h >> np.uint64(29))))
        start = stop
    if not found:
        return np.empty(0, dtype=np.uint64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


@dataclass
class Link:
    """Linear model of one category over chosen word hashes and the earlier probabilities."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def score(self, present: np.ndarray, before: np.ndarray) -> float:
        at = np.searchsorted(self.features, present)
        at[at == len(self.features)] = 0
        hit = at[self.features[at] == present] if len(self.features) else at[:0]
        return 1 / (1 + np.exp(-np.clip(self.bias + self.weights[hit].sum() + self.earlier @ before, -40, 40)))


@dataclass
class ChainModel:
    categories: list[str]
    links: list[Link] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def predict(self, text: str | None) -> np.ndarray:
        present, out = words(text or ""), np.zeros(len(self.links))
        for i, link in enumerate(self.links):
            out[i] = link.score(present, out[:i])
        return out


def _choose(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Words in several rows whose share of positive rows differs from the mean by more than chance."""
    every, n = np.unique(np.concatenate([*rows, np.empty(0, np.uint64)]), return_counts=True)
    every, n = every[n >= MIN_ROWS], n[n >= MIN_ROWS]
    if not len(every):
        return every
    pos = np.zeros(len(every))
    for r, label in zip(rows, y, strict=True):
        if label:
            at = np.searchsorted(every, r)
            at[at == len(every)] = 0
            pos[at[every[at] == r]] += 1
    mean = y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.nan_to_num(pos * np.log(pos / (n * mean))) + np.nan_to_num((n - pos) * np.log((n - pos) / (n * (1 - mean))))
    # twice the gain is a likelihood ratio; chance alone would pass less than one word in five
    kept = gain >= np.log(5.0 * len(every))
    every, gain = every[kept], gain[kept]
    return np.sort(every[np.argsort(-gain, kind="stable")[:FEATURES]])


def _fit_link(rows: list[np.ndarray], before: np.ndarray, y: np.ndarray, rounds: int = 150, l2: float = 2e-4) -> Link:
    """Logistic regression by accelerated gradient steps; rare positives are not reweighted, so scores stay calibrated."""
    k = before.shape[1]
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-6  # nothing learned: nothing is found
        return Link(np.empty(0, np.uint64), np.zeros(0), np.zeros(k), float(np.log(rate / (1 - rate))))
    features = _choose(rows, y)
    hits = []
    for r in rows:
        at = np.searchsorted(features, r) if len(features) else np.empty(0, np.int64)
        at[at == len(features)] = 0
        hits.append(at[features[at] == r] if len(features) else at)
    row = np.repeat(np.arange(len(rows)), [len(h) for h in hits])
    col = np.concatenate([*hits, np.empty(0, np.int64)]).astype(np.int64)
    n_f, n = len(features), len(rows)
    w, b = np.zeros(n_f + k), float(np.log(y.mean() / (1 - y.mean())))
    scale = 1 / np.sqrt(np.bincount(col, minlength=n_f) / n + 1e-3) if n_f else np.zeros(0)  # rare words learn faster
    scale = np.concatenate([scale, np.ones(k)])
    step_w, acc = np.zeros_like(w), np.full_like(w, 1e-8)
    acc_b = 1e-8
    for _ in range(rounds):
        z = np.bincount(row, weights=w[col], minlength=n) + before @ w[n_f:] + b
        err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        g = np.concatenate([np.bincount(col, weights=err[row], minlength=n_f), before.T @ err]) + l2 * w / scale
        acc += g * g
        step_w = 0.7 * step_w - 0.5 * g / np.sqrt(acc)
        w = w + step_w
        gb = err.sum()
        acc_b += gb * gb
        b -= 0.5 * gb / np.sqrt(acc_b)
    return Link(features, w[:n_f], w[n_f:], float(b))


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, categories: list[str]) -> ChainModel:
    """``labels``: one column of 0/1 per category. Thresholds maximise F1 of the out-of-fold predictions."""
    model, n = ChainModel(categories), len(rows)
    fold = np.arange(n) % FOLDS
    before = np.zeros((n, 0))
    for c in range(len(categories)):
        y = labels[:, c].astype(float)
        out_of_fold = np.zeros(n)
        for f in range(FOLDS):
            inside = np.flatnonzero(fold != f)
            link = _fit_link([rows[i] for i in inside], before[inside], y[inside])
            for i in np.flatnonzero(fold == f):
                out_of_fold[i] = link.score(rows[i], before[i])
        model.links.append(_fit_link(rows, before, y))
        grid = np.linspace(0.1, 0.9, 33)
        f1 = [2 * ((out_of_fold >= t) & (y == 1)).sum() / max(1, (out_of_fold >= t).sum() + (y == 1).sum()) for t in grid]
        best = grid[np.asarray(f1) >= max(f1) - 1e-9] if n else np.array([0.5])
        model.thresholds.append(float(np.median(best)))
        before = np.column_stack([before, out_of_fold])
    return model


def fit(labelled: DataFrame, categories: list[str]) -> ChainModel:
    """Fit on rows with ``text`` and one 0/1 column per category; rows without one of them are left out.

    At most SAMPLE_ROWS distinct texts are used, by hash; of equal texts with several labels the larger ones count. The
    bound is set before anything is collected.
    """
    need(labelled, "text", *categories)
    rows = labelled.where(F.col("text").isNotNull())
    for c in categories:
        rows = rows.where(F.col(f"`{c}`").isNotNull())
    rows = rows.select("text", F.array(*[F.col(f"`{c}`").cast("int") for c in categories]).alias("y"), F.xxhash64("text").alias("rank"))
    total = rows.count()
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(1, total))
    rows = rows.where(F.pmod("rank", F.lit(1 << 30)) <= int(share * (1 << 30)))

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"rank": pdf["rank"], "y": pdf.y, "words": [words(t).tobytes() for t in pdf.text]})

    found = rows.mapInPandas(run, "rank long, y array<int>, words binary")
    worst = F.array(*[F.max(F.col("y")[i]) for i in range(len(categories))]).alias("y")
    found = found.groupBy("rank").agg(worst, F.first("words").alias("words"))
    pdf = found.orderBy("rank").limit(SAMPLE_ROWS).toPandas()
    sets = [np.frombuffer(w, dtype=np.uint64) for w in pdf.words]
    labels = np.array([list(y) for y in pdf.y]).reshape(len(pdf), len(categories))
    return fit_chain(sets, labels, categories)


def with_toxicity(docs: DataFrame, model: ChainModel, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` plus a column (its name is returned) ``struct<p_<category> double..., toxic boolean>``.

    toxic: the last category's probability reaches its threshold. Null texts have no words and are judged so.
    """
    need(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = free_name(docs, "_toxicity")
    fields = [f"p_{c}" for c in model.categories]

    @F.pandas_udf(", ".join(f"`{f}` double" for f in fields) + ", toxic boolean")
    def udf(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        p = np.array([m.predict(t) for t in texts]).reshape(len(texts), len(fields))
        return pd.DataFrame({f: p[:, i] for i, f in enumerate(fields)} | {"toxic": p[:, -1] >= m.thresholds[-1]})

    return docs.withColumn(name, udf(F.col(f"`{text_col}`"))), name


def fit_from_labels(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("low_quality", "toxic")) -> ChainModel:
    """Fit from a labels table ``doc_id, quality, toxic``: the chain predicts low quality first, then toxicity.

    Of labels that contradict each other the worse ones count.
    """
    y = labels.groupBy("doc_id").agg((1 - F.min("quality")).alias("low_quality"), F.max("toxic").alias("toxic"))
    return fit(docs.select("doc_id", "text").join(y, "doc_id"), list(categories))


def classify(docs: DataFrame, labels: DataFrame, model: ChainModel | None = None) -> DataFrame:
    """``doc_id, p_low_quality, p_toxic, toxic`` of every whole text (repeated rows included)."""
    need(docs, "doc_id", "text")
    model = model or fit_from_labels(docs, labels)
    out, name = with_toxicity(docs.select("doc_id", "text"), model)
    return out.select("doc_id", *[F.col(f"{name}.p_{c}") for c in model.categories], F.col(f"{name}.toxic"))
