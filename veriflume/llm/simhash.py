"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within distance r share a value within r/2 of both. So each distinct fingerprint emits every value
within that radius, rows shuffle on the value, and whoever meets there is a candidate. Copies fall together before:
only distinct fingerprints take part, hence one value meets at most 1 + 64 of them (radius 1), whatever the data.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, need, sendable
from .components import components

SEED = 42
BITS = 64
#: Fingerprints whose balls one task emits.
BALL_ROWS = 8192
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16


def fingerprint(text: str, width: int = 3) -> int:
    """Bit i is set if over half the shingle hashes have it. No words: 0. Fewer than ``width`` words: one shingle."""
    words = text.encode().lower().split()  # bytes: only A-Z change, and only 0x20, 0x09-0x0D separate
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    counts, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_digest
    for i in range(0, len(shingles), BLOCK):
        part = b"".join([digest(s, SEED) for s in shingles[i : i + BLOCK]])
        bits = np.unpackbits(np.frombuffer(part, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) of whole texts; null text counts as empty."""
    need(docs, id_col, text_col)

    def run(batches):
        for pdf in batches:
            fps = np.array([fingerprint(t or "", width) for t in pdf.text], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf.doc_id, "fp": fps.view(np.int64)})

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(run, f"doc_id {id_type}, fp long")


def ball_masks(radius: int) -> list[int]:
    """Signed masks of all bit sets up to ``radius``, the empty one first."""
    out = []
    for r in range(radius + 1):
        for bits in combinations(range(BITS), r):
            m = sum(1 << b for b in bits)
            out.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    return out


def links(distinct_fps: DataFrame, distance: int = 2) -> DataFrame:
    """Verified pairs ``a < b`` of distinct fingerprints that connect all within ``distance``.

    At each meeting value the smallest fingerprint is paired with the others there, as many rows as meet. For an even
    distance these stars join the same components as all pairs do, since all who meet are within it. For an odd one
    the radius is rounded up, whoever meets may be one too far, so all pairs there are formed (a bounded number: the
    ball's size) and verified.
    """
    radius = (distance + 1) // 2
    tasks = max(1, min(20_000, -(-distinct_fps.count() // BALL_ROWS)))  # a few bytes a row would all be read by one
    near = (
        distinct_fps.select("fp").repartition(tasks, "fp").select("fp", F.explode(F.array(*[F.lit(m) for m in ball_masks(radius)])).alias("mask"))
        .select("fp", F.expr("fp ^ mask").alias("meet"))
        .groupBy("meet")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )
    if distance % 2 == 0:
        pairs = near.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    else:
        pairs = near.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b"))
    return pairs.where("a < b").distinct().where(F.bit_count(F.expr("a ^ b")) <= distance)


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id, n_copies`` of every row.

    Fingerprints within ``distance`` bits link, also those of empty texts (zero); component_id is the smallest doc_id
    reachable. Null ids stay as rows but never name a component unless all its ids are null (then null). Repeated rows
    are kept. n_copies counts the rows with this very fingerprint.
    """
    prints = materialise(fingerprints(docs, width, id_col, text_col), "fingerprints")
    groups = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies")), "groups")
    roots = components(links(groups.select("fp"), distance)).withColumnRenamed("node", "fp")
    rooted = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id", "n_copies")
    out = prints.join(by_fp, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies")


def representatives(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component: one document of each group of near-copies.

    Rows with a null id are kept (nothing identifies them). Of rows that repeat the same id, one stays: see
    :func:`rows_named`.
    """
    return rows_named(docs, near_duplicates(docs, width, distance))


def rows_named(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of ``docs`` per component of ``classes`` (doc_id, component_id), and all with a null id.

    Of rows that repeat an id that of the smallest text stays, then of the smallest rest. Texts move only to ids that
    are too many to send to every task, and then once.
    """
    ids = materialise(classes.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")), "kept")
    kept = docs.join(sendable(ids.where("n = 1").select("doc_id")), "doc_id", "left_semi").select(*docs.columns)
    again = materialise(ids.where("n > 1").select("doc_id"), "repeated")
    if again.limit(1).count():
        columns = docs.columns
        rows = docs.join(sendable(again), "doc_id", "left_semi").select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "doc_id", "text")
        order = F.struct(F.coalesce("text", F.lit("")), F.to_json("row"))
        kept = kept.unionByName(rows.groupBy("doc_id").agg(F.min_by("row", order).alias("row")).select("row.*"))
    return kept.unionByName(docs.where("doc_id is null"))
