"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in halves, and each half is quantised by its own k-means; a cell is a pair of centroids. A query visits
cells by the sum of its two half distances, smallest first, which a heap finds without sorting all pairs, until the
cells visited hold the wanted number of entries; these are reranked by the exact inner product. How many are wanted is
measured: the true neighbours of a fixed number of probe queries come from one pass over all entries, and the visit is
made as long as the aimed share of them needs. So clustered vectors get short visits, and isotropic ones long visits.

Equal vectors are one entry that carries its smallest ids: beyond ``k + 1`` of them no id can be among the nearest.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, need

#: Vectors that the quantisers are fitted on, at most; centroids per half, at most.
SAMPLE, MAX_CENTROIDS = 20_000, 256
#: Recall that visits aim at, and the queries it is measured on.
AIM, PROBES = 0.95, 128
#: Entries of one block and queries of one block that meet in a task; queries whose visits one task plans.
ENTRY_BLOCK, QUERY_BLOCK, PLAN_BLOCK = 16_384, 8192, 64


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding array<double>`` of rows whose vector is not null, empty, zero or non-finite anywhere."""
    need(vectors, "vec_id", "embedding")
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("embedding", lambda x: x != 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmin((c * c).sum(axis=1) - 2 * x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)] or [np.empty(0, np.int64)])


def visit(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, want: int) -> list[int]:
    """Cells by rising ``d1[i] + d2[j]`` until they hold ``want`` entries (multi-sequence traversal)."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b, k = d1[o1].tolist(), d2[o2].tolist(), len(d2)
    o1, o2 = o1.tolist(), o2.tolist()
    heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
    # row i is entered when the first cell of row i - 1 leaves the heap; then it moves right cell by cell
    while heap and held < want:
        _, i, j = heapq.heappop(heap)
        cell = o1[i] * k + o2[j]
        if counts[cell]:
            out.append(cell)
            held += counts[cell]
        if j + 1 < k:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in one fixed order whatever stands beside a vector."""
    return (q * x).sum(axis=1)


def measured_visit(celled: DataFrame, queries: DataFrame, halves: list[np.ndarray], counts: np.ndarray, k: int, aim: float = AIM) -> int:
    """Entries that a visit must hold to meet ``aim`` of the true ``k`` nearest of the probes (smallest hashes first).

    Each task keeps the best ``k`` of each probe, so what is ranked is bounded by the number of tasks.
    """
    probes = queries.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").limit(PROBES).toPandas()
    if not len(probes):
        return 0
    q = np.stack([np.asarray(v) for v in probes.embedding])
    shared = celled.sparkSession.sparkContext.broadcast((q, probes.vec_id.to_numpy()))

    def best(batches):
        q_, own = shared.value
        kept = pd.DataFrame({"probe": np.empty(0, np.int32), "score": np.empty(0), "cell": np.empty(0, np.int32)})
        for pdf in batches:
            if not len(pdf):
                continue
            scores = q_ @ np.stack([np.asarray(v) for v in pdf.embedding]).T
            first, lone = np.array([i[0] for i in pdf.ids]), np.array([len(i) == 1 for i in pdf.ids])
            scores[(own[:, None] == first) & lone] = -np.inf
            top = min(k, len(pdf))
            at = np.argpartition(-scores, top - 1, axis=1)[:, :top]
            found = pd.DataFrame({"probe": np.repeat(np.arange(len(q_), dtype=np.int32), top), "score": np.take_along_axis(scores, at, axis=1).ravel(), "cell": pdf.cell.to_numpy()[at.ravel()]})
            kept = pd.concat([kept, found[np.isfinite(found.score)]]).sort_values("score", ascending=False).groupby("probe").head(k)
        yield kept

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "cell")
    near = celled.mapInPandas(best, "probe int, score double, cell int").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    near, half, reach = near.select("probe", "cell").toPandas(), halves[0].shape[1], []
    for i, cells in near.groupby("probe")["cell"]:
        far = -((halves[0] @ q[i][:half])[:, None] + (halves[1] @ q[i][half:])[None, :]).ravel()
        by = np.argsort(far, kind="stable")
        held = np.empty(len(far), dtype=np.int64)
        held[by] = np.cumsum(counts[by])
        reach += held[cells.to_numpy()].tolist()
    return int(np.quantile(reach, aim, method="higher")) if reach else 0


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, visit_share: float | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query row, by largest inner product.

    Ties go to the smaller vec_id. Vectors that are null, zero or hold null or non-finite values take no part, nor do
    rows without an id. Rows that repeat id and vector count once. With fewer candidates than k all are returned (the
    visit then covers every cell). Vectors of another length have no inner product with a query, so each length is
    searched by itself. ``visit_share`` fixes the share of all entries that a visit holds; by default it is measured.
    """
    rows = materialise(usable(vectors), "vectors")
    found = [_nearest_of(rows.where(F.size("embedding") == r["n"]), is_query, k, visit_share, r["n"]) for r in rows.groupBy(F.size("embedding").alias("n")).count().collect()]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _nearest_of(rows: DataFrame, is_query: Column, k: int, visit_share: float | None, dim: int) -> DataFrame:
    spark = rows.sparkSession
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("place", F.dense_rank().over(by_vector)).where(F.col("place") <= k + 1)
    entries = materialise(few.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "entries")
    n = entries.count()
    share = min(1.0, SAMPLE / n)
    rank = F.xxhash64("embedding")
    fitted = entries.where(F.pmod(rank, F.lit(1 << 30)) <= int(share * (1 << 30))).select("embedding", rank.alias("rank")).toPandas().sort_values("rank")
    x = np.stack([np.asarray(v) for v in fitted.embedding])
    half = dim // 2
    n_cells = max(1, min(MAX_CENTROIDS, len(x), 1 << max(0, round(np.log2(max(1.0, n**0.5 / 2))))))
    halves = [kmeans(x[:, :half], n_cells), kmeans(x[:, half:], n_cells)] if half else [np.zeros((1, 0)), kmeans(x, n_cells)]
    model = spark.sparkContext.broadcast(halves)
    n_cells_all = len(halves[0]) * len(halves[1])

    def assign(batches):
        h1, h2 = model.value
        for pdf in batches:
            v = np.stack([np.asarray(e) for e in pdf.embedding]) if len(pdf) else np.zeros((0, dim))
            yield pdf.assign(cell=(_nearest(v[:, :half], h1) * len(h2) + _nearest(v[:, half:], h2)).astype(np.int32))

    celled = materialise(entries.mapInPandas(assign, "embedding array<double>, ids array<long>, cell int"), "cells")
    sizes = celled.groupBy("cell").agg(F.count("*").alias("n")).toPandas()  # at most one row per pair of centroids
    counts = np.zeros(n_cells_all, dtype=np.int64)
    counts[sizes["cell"].to_numpy()] = sizes["n"].to_numpy()
    # cells go to groups of about ENTRY_BLOCK entries; a larger cell is cut by hash into several blocks
    groups, group_of, blocks_of = 0, np.zeros(n_cells_all, dtype=np.int64), np.ones(n_cells_all, dtype=np.int64)
    held = 0
    for c in range(n_cells_all):
        if counts[c] > ENTRY_BLOCK:
            groups += held > 0
            blocks_of[c], group_of[c] = -(-counts[c] // ENTRY_BLOCK), groups
            groups, held = groups + int(blocks_of[c]), 0
        else:
            if held + counts[c] > ENTRY_BLOCK:
                groups, held = groups + 1, 0
            group_of[c] = groups
            held += counts[c]
    queries = rows.where(is_query).select("vec_id", "embedding")
    wanted = measured_visit(celled, queries, halves, counts, k) if visit_share is None else visit_share * n
    want = int(min(n, max(wanted, k + 2)))
    first_cell = np.searchsorted(group_of, group_of, "left")  # of the group that a cell lies in
    plan = spark.sparkContext.broadcast((counts, group_of, blocks_of, first_cell))

    def spread_entries(batches):
        _, group_of_, blocks_of_, _ = plan.value
        for pdf in batches:
            cell = pdf.cell.to_numpy()
            salt = np.array([int(i[0]) for i in pdf.ids], dtype=np.int64)
            yield pdf.assign(grp=(group_of_[cell] + (salt * 0x9E3779B1 >> 7) % blocks_of_[cell]).astype(np.int64))

    def spread_queries(batches):
        counts_, group_of_, blocks_of_, first_ = plan.value
        h1, h2 = model.value
        for pdf in batches:
            out = []
            for vec_id, e in zip(pdf.vec_id, pdf.embedding, strict=True):
                q = np.asarray(e)
                cells = np.sort(np.array(visit(-(h1 @ q[:half]), -(h2 @ q[half:]), counts_, want), dtype=np.int64))
                for part in np.split(cells, np.flatnonzero(np.diff(group_of_[cells])) + 1):
                    first = int(first_[part[0]])
                    bits = np.zeros(int(part[-1]) - first + 1, dtype=np.uint8)  # the cells of the group that are visited
                    bits[part - first] = 1
                    packed = np.packbits(bits).tobytes()
                    for b in range(int(blocks_of_[part].max())):
                        out.append((int(group_of_[part[0]]) + b, vec_id, e, first, packed))
            yield pd.DataFrame(out, columns=["grp", "query_id", "q", "first", "cells"])

    # adaptive execution would plan all visits in one task, so small is their input
    tasks = max(1, min(20_000, -(-queries.count() // PLAN_BLOCK)))
    planned = queries.repartition(tasks, "vec_id", "embedding").distinct()
    visits = materialise(planned.mapInPandas(spread_queries, "grp long, query_id long, q array<double>, first int, cells binary"), "visits")
    # a group's entries are repeated once per block of the queries that come to it; where none comes they go nowhere
    loads = visits.groupBy("grp").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    left = celled.mapInPandas(spread_entries, "embedding array<double>, ids array<long>, cell int, grp long").join(loads, "grp")
    left = left.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    right = visits.join(loads, "grp").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).drop("blocks")

    def meet(entry: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(entry) or not len(query):
            return pd.DataFrame(columns=columns)
        first = int(query["first"].iloc[0])
        span = int(entry.cell.max()) - first + 1  # no visited cell that holds an entry of this block lies beyond
        e, cell, ids = np.stack([np.asarray(v) for v in entry.embedding]), entry.cell.to_numpy() - first, entry.ids.to_list()
        out = []
        for i in range(0, len(query), 256):
            part = query.iloc[i : i + 256]
            q = np.stack([np.asarray(v) for v in part.q])
            scores = q @ e.T
            for r, (query_id, cells) in enumerate(zip(part.query_id, part.cells, strict=True)):
                marks = np.zeros(span, dtype=bool)
                bits = np.unpackbits(np.frombuffer(cells, dtype=np.uint8))[:span]
                marks[: len(bits)] = bits
                seen = np.flatnonzero(marks[cell])
                if not len(seen):
                    continue
                s = scores[r, seen]
                top = min(len(s), k + 1)
                edge = np.partition(s, len(s) - top)[len(s) - top]
                best = seen[s >= edge - 1e-9 * (1 + abs(edge))]  # the exact sums below decide among near ties
                found = [(-v, int(x)) for v, b in zip(exact_scores(q[r], e[best]).tolist(), best.tolist(), strict=True) for x in ids[b] if x != query_id]
                out += [(query_id, x, -v) for v, x in sorted(found)[:k]]
        return pd.DataFrame(out, columns=columns)

    found = left.groupBy("grp", "qb").cogroup(right.groupBy("grp", "qb")).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
