"""Balanced shards by histogram sort.

Rows are ordered by a key (hash of the text, then id), so equal texts lie together and a huge group of copies can still
be cut. Splitters between shards are found by counting: each round sums, across all partitions, the exact bytes below
a set of probe keys, and the next probes close in on the targets, until each splitter is within tolerance or no key
lies between its bounds. Only then are the rows exchanged, once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, need

#: Probes per open splitter and round; at most so many rounds (each narrows an interval by the number of probes).
PROBES, ROUNDS = 24, 40
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _as_number(h: int, d: int) -> int:
    """A key (two signed 64-bit parts) as one number, in key order."""
    return ((h - LOW) << 64) | (d - LOW)


def _as_key(x: int) -> tuple[int, int]:
    return (x >> 64) + LOW, (x & ((1 << 64) - 1)) + LOW


def place(h: np.ndarray, d: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """How many of the ascending ``probes`` are at or below each key."""
    ph, pd_ = np.array([p[0] for p in probes], dtype=np.int64), np.array([p[1] for p in probes], dtype=np.int64)
    at, upto = np.searchsorted(ph, h, "left"), np.searchsorted(ph, h, "right")
    for a, b in {(a, b) for a, b in zip(at[at < upto].tolist(), upto[at < upto].tolist(), strict=True)}:
        same = (at == a) & (upto == b)
        upto[same] = a + np.searchsorted(pd_[a:b], d[same], "right")
    return upto


def _below(keys: DataFrame, probes: list[tuple[int, int]]) -> np.ndarray:
    """Exact bytes whose key is below each probe: one small row per partition and probe goes to the driver's sum."""

    def run(batches):
        total = np.zeros(len(probes) + 1, dtype=np.int64)
        for pdf in batches:
            at = place(pdf.h.to_numpy(), pdf.d.to_numpy(), probes)
            total += np.bincount(at, weights=pdf["size"].to_numpy(), minlength=len(probes) + 1).astype(np.int64)
        yield pd.DataFrame({"at": np.flatnonzero(total), "n": total[total > 0]})

    rows = keys.select("h", "d", "size").mapInPandas(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(len(probes) + 1, dtype=np.int64)
    for r in rows:
        total[r["at"]] = r["n"]
    return np.cumsum(total)[:-1]


def splitters(keys: DataFrame, parts: int, total: int, tolerance: float) -> list[tuple[int, int]]:
    """``parts - 1`` keys; the bytes below the i-th are within ``tolerance * total / parts`` of ``i * total / parts``, or
    as near as whole keys allow."""
    slack = tolerance * total / parts
    targets = [total * i / parts for i in range(1, parts)]
    low, high = [0] * len(targets), [1 << 128] * len(targets)  # keys as numbers, and the bytes below them
    low_n, high_n = [0] * len(targets), [total] * len(targets)
    done: list[int | None] = [None] * len(targets)
    for _ in range(ROUNDS):
        wanted: set[int] = set()
        for i, t in enumerate(targets):
            if done[i] is None:
                width = high[i] - low[i]
                if width <= 1:
                    done[i] = low[i] if t - low_n[i] <= high_n[i] - t else min(high[i], (1 << 128) - 1)
                    continue
                # around the interpolated place, and evenly over the interval in case the keys lie unevenly
                at = (t - low_n[i]) / max(1, high_n[i] - low_n[i])
                near = [at + (j - PROBES // 4) * 0.5 / PROBES for j in range(PROBES // 2 + 1)]
                even = [j / (PROBES // 2 + 1) for j in range(1, PROBES // 2 + 1)]
                for f in near + even:
                    if 0 < f < 1:
                        wanted.add(low[i] + max(1, min(width - 1, int(f * (1 << 60)) * width >> 60)))
        if not wanted:
            break
        probes = sorted(wanted)
        below = _below(keys, [_as_key(x) for x in probes])
        for i, t in enumerate(targets):
            if done[i] is None:
                k = int(np.argmin(np.abs(below - t)))
                if abs(below[k] - t) <= slack:
                    done[i] = probes[k]
                    continue
                at = int(np.searchsorted(below, t, "right"))
                if at and probes[at - 1] > low[i]:
                    low[i], low_n[i] = probes[at - 1], int(below[at - 1])
                if at < len(probes) and probes[at] < high[i]:
                    high[i], high_n[i] = probes[at], int(below[at])
    return [_as_key(d if d is not None else low[i]) for i, d in enumerate(done)]


def shards(docs: DataFrame, n_shards: int = 8, tolerance: float = 0.001, runs_per_shard: int = 0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row; law is ``bytes``.

    size: UTF-8 bytes of the text (null: none) plus 1. Shards are near equal in bytes: within ``tolerance`` of the mean
    at each splitter, or one row where rows are coarser. slot counts each shard's rows gaplessly from 0 in key order.
    Null ids are spread among equal texts. Rows that repeat one id and text share a key, so a splitter cannot part
    them. grown_shard is null: this law moves rows freely when shards are added.

    Every shard is cut into ``runs_per_shard`` runs by the same histogram (0: as many as the input's size asks for), so
    the one exchange and the sort spread over the cluster, not over eight tasks.
    """
    need(docs, "doc_id", "text")
    source = docs.select(F.col("doc_id"), F.col("text"))
    keys = materialise(
        source.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
            F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.monotonically_increasing_id())).alias("d"),
        ),
        "keys",
    )
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    runs = runs_per_shard or max(1, min(256, -(-rows // (n_shards * 100_000))))
    cuts = splitters(keys, n_shards, total, tolerance)
    fine = cuts
    if runs > 1:
        fine = sorted({*cuts, *splitters(keys, n_shards * runs, total, 0.2)})
    shard_of = [sum(1 for c in cuts if c <= fine[r - 1]) if r else 0 for r in range(len(fine) + 1)]

    def number(batches):
        for pdf in batches:
            yield pdf.assign(run=place(pdf.h.to_numpy(), pdf.d.to_numpy(), fine).astype(np.int32))

    placed = keys.mapInPandas(number, "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", size long, text_crc32 long, h long, d long, run int")
    # rows of each run: counted before the exchange, at most n_shards * runs numbers
    per_run = {r["run"]: r["n"] for r in placed.groupBy("run").agg(F.count("*").alias("n")).collect()}
    start, seen = [], dict.fromkeys(range(n_shards), 0)
    for r in range(len(fine) + 1):
        start.append(seen[shard_of[r]])
        seen[shard_of[r]] += per_run.get(r, 0)

    def slots(batches):
        run, at = -1, 0
        for pdf in batches:
            r = pdf.run.to_numpy()
            new = np.flatnonzero(np.concatenate([[len(r) > 0 and r[0] != run], r[1:] != r[:-1]]))
            offset = np.arange(len(r)) + at
            for i in new:
                offset[i:] = np.arange(len(r) - i)
            if len(r):
                run, at = int(r[-1]), int(offset[-1]) + 1
            slot = offset + np.array([start[x] for x in r], dtype=np.int64)
            found = {"doc_id": pdf.doc_id, "size": pdf["size"], "text_crc32": pdf.text_crc32, "law": "bytes", "shard": [shard_of[x] for x in r], "slot": slot}
            yield pd.DataFrame(found | {"grown_shard": pd.Series([None] * len(r), dtype="Int32")})

    ordered = placed.repartitionById(max(1, len(fine) + 1), "run").sortWithinPartitions("run", "h", "d", "size")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return ordered.mapInPandas(slots, f"doc_id {id_type}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
