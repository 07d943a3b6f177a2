"""Document fingerprints by a randomised edit embedding.

A random walk reads a text: at each step it emits the character it stands on, and a shared random bit, drawn for that
step and character, says whether it moves on. Walks on two texts that differ by an edit soon run in step again, so a
small edit distance becomes a small Hamming distance of what they emit. The fingerprint samples the emitted string at
fixed steps, in two scales that follow the text's length; likeness is the share of agreeing samples. Candidates for
near texts come from bands of samples; they are verified by likeness.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, need
from .components import components, linked

SAMPLES, CLASSES, PERIOD = 64, 64, 1 << 14
SEED = 20240229
END = 0  # sample behind the end of a text
#: Characters that one task fingerprints (unless one range of ids holds more), and the most ranges that are weighed.
RUN_CHARS, MAX_RANGES = 16 << 20, 20_000


@cache
def _walk() -> list[list[int]]:
    """Per character class and step (modulo the period): steps until the walk leaves the character."""
    moves = np.random.default_rng(SEED).random((CLASSES, PERIOD)) < 0.5
    moves[:, -1] = True
    out = np.zeros((CLASSES, PERIOD), dtype=np.int64)
    wait = np.zeros(CLASSES, dtype=np.int64)
    for j in range(PERIOD - 1, -1, -1):
        wait = np.where(moves[:, j], 1, wait + 1)
        out[:, j] = wait
    return out.tolist()


def _times(scale: int) -> np.ndarray:
    """Sampled steps of a scale: even over twice the largest length, with a random shift each."""
    top = 2 << scale
    shift = np.random.default_rng(SEED + 1 + scale).random(SAMPLES)
    return np.sort(((np.arange(SAMPLES) + shift) * top / SAMPLES).astype(np.int64))


def _classes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def arrivals(codes: np.ndarray, start: int = 0) -> np.ndarray:
    """Step at which the walk comes to each character, and behind the last."""
    walk, mask = _walk(), PERIOD - 1
    kinds = ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).tolist()
    return np.fromiter(accumulate(kinds, lambda j, c: j + walk[c][j & mask], initial=start), dtype=np.int64, count=len(kinds) + 1)


def scale_of(n: int) -> int:
    return max(3, int(n).bit_length())


def sample(codes: np.ndarray, came: np.ndarray) -> str:
    """Scale, then a byte per sample of this scale and of the next, in hex."""
    scale = scale_of(len(codes))
    out = bytearray([scale])
    symbols = np.concatenate([1 + (codes.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) >> np.uint64(32)) % np.uint64(255), [END]]).astype(np.uint8)
    for s in (scale, scale + 1):
        at = np.minimum(np.searchsorted(came, _times(s), "right") - 1, len(codes))
        out += symbols[at].tobytes()
    return out.hex()


def fingerprint(text: str | None) -> str:
    """Fixed-length hex; equal texts have equal fingerprints. Null counts as empty."""
    codes = _classes(text or "")
    return sample(codes, arrivals(codes))


def likeness(a: str, b: str) -> float:
    """Share of agreeing samples at the scales both have, places behind both ends left out; 1 for two empty texts."""
    x, y = np.frombuffer(bytes.fromhex(a), dtype=np.uint8), np.frombuffer(bytes.fromhex(b), dtype=np.uint8)
    if a == b:
        return 1.0
    agree = used = 0
    for i in (0, 1):
        j = int(x[0]) + i - int(y[0])
        if j in (0, 1):
            p, q = x[1 + i * SAMPLES :][:SAMPLES], y[1 + j * SAMPLES :][:SAMPLES]
            inside = (p != END) | (q != END)
            agree += int((p == q)[inside].sum())
            used += int(inside.sum())
    return agree / used if used else 0.0


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the characters replaced by as many (or all) first ones of the text that follows."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def _range_of(cuts: list[int]) -> Column:
    """Number of the range of ids that a row lies in; null ids lie in the first."""
    doc_id = F.col("doc_id")
    if len(cuts) > 200:  # a binary search instead of a scan of the bounds
        edges = np.array(cuts, dtype=np.int64)

        @F.pandas_udf("int")
        def find(x: pd.Series) -> pd.Series:
            return pd.Series(np.where(x.isna(), 0, np.searchsorted(edges, x.fillna(0).to_numpy(dtype=np.int64), "right")).astype(np.int32))

        return find(doc_id)
    place = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= doc_id)) if cuts else F.lit(0)
    return F.when(doc_id.isNull(), 0).otherwise(place).cast("int")


def joined_ranges(chars: list[int], run_chars: int, fewest: int = 16) -> list[int]:
    """First range of each run: neighbouring ranges are joined while they hold at most ``run_chars`` characters, or
    the share of one in ``fewest`` runs if that is less."""
    room = max(1, min(run_chars, -(-sum(chars) // fewest)))
    out, held = [], 0
    for i, n in enumerate(chars):
        if not out or held + n > room:
            out.append(i)
            held = 0
        held += n
    return out


def fingerprint_documents(docs: DataFrame, run_rows: int = 256, run_chars: int = RUN_CHARS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every whole text.

    The next document is the next doc_id upwards, after the last the first; rows that repeat an id follow each other by
    text, null ids come first. Null text is empty. A table of one row follows itself.

    Ids are cut into ranges of about ``run_rows`` rows, and these are joined to runs of about ``run_chars`` characters,
    each read by a task of its own; each run also gets the first row of the next one. So texts move once, each run is
    read in order with one row of foresight, long texts don't gather in one task, and nothing is ordered in one.
    """
    need(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.where("doc_id is not null")
    n = rows.count()
    ranges = max(1, min(MAX_RANGES, n // run_rows), min(128, n // 8))
    cuts = ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 and n else []
    cuts = sorted({int(c) for c in cuts})
    # weight and first row of each range: its smallest id (null before all)
    weighed = rows.withColumn("range", _range_of(cuts)).groupBy("range")
    weighed = weighed.agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("has_null"), F.sum(F.length("text") + 1).alias("chars"))
    heads = sorted(weighed.collect())  # one row per range
    starts = joined_ranges([r["chars"] for r in heads], run_chars)
    leasts = [None if heads[i]["has_null"] else heads[i]["least"] for i in starts]
    cuts = [cuts[heads[i]["range"] - 1] for i in starts[1:]]  # run j lies between the cuts j - 1 and j
    placed = rows.withColumn("run", _range_of(cuts)).withColumn("closing", F.lit(False))
    if leasts:
        closing = docs.sparkSession.createDataFrame([((i - 1) % len(leasts), least) for i, least in enumerate(leasts)], "to_run int, least long")
        # the first row of a run, of rows with its smallest id that with the smallest text, closes the run before
        texts = rows.join(F.broadcast(closing), F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("to_run").agg(F.min("text").alias("text"))
        last = texts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("to_run").alias("run"), F.lit(True).alias("closing"))
        placed = placed.unionByName(last)

    def work(batches):
        held = None  # the row that waits for the one after it

        def finish(row, codes, came, text):
            doc_id, own, own_codes, own_came, own_fp = row
            k = len(own) // 2
            keep = len(own_codes) - k
            new = edited(own, text)
            rest = codes[:k]
            both = np.concatenate([own_codes[:keep], rest])
            walked = np.concatenate([own_came[:keep], arrivals(rest, int(own_came[keep]))])
            fp, next_fp = sample(both, walked), sample(codes, came)
            return doc_id, len(own), hashlib.sha256(new.encode()).hexdigest(), own_fp, fp, likeness(own_fp, fp), likeness(own_fp, next_fp)

        for pdf in batches:
            out = []
            for doc_id, text, closing in zip(pdf.doc_id, pdf.text, pdf.closing, strict=True):
                codes = _classes(text)
                came = arrivals(codes)
                if held is not None:
                    out.append(finish(held, codes, came, text))
                held = None if closing else (None if pd.isna(doc_id) else int(doc_id), text, codes, came, sample(codes, came))
            yield pd.DataFrame(
                {c: [r[i] for r in out] for i, c in enumerate(("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))}
            ).astype({"doc_id": "Int64"})

    ordered = placed.repartitionById(len(cuts) + 1, "run").sortWithinPartitions("run", "closing", F.col("doc_id").asc_nulls_first(), "text")
    return ordered.mapInPandas(work, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def near_classes(docs: DataFrame, bands: int = 16, min_likeness: float = 0.8) -> DataFrame:
    """``doc_id, fingerprint, class_id, n_copies``: texts whose fingerprints are at least ``min_likeness`` alike.

    Distinct fingerprints emit bands of randomly chosen samples (per scale); those that share a band are candidates,
    verified by likeness, and joined to classes: the same as if all pairs that share a band were compared. class_id is
    the smallest doc_id of a class, n_copies the number of rows with this very fingerprint. A band without a sample
    inside the text says nothing and is left out. Null text is empty; rows that repeat stay; null ids name no class
    unless all its ids are null.
    """
    need(docs, "doc_id", "text")

    def prints(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "fp": [fingerprint(t) for t in pdf.text]})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    fps = materialise(docs.select("doc_id", "text").mapInPandas(prints, f"doc_id {id_type}, fp string"), "edit-prints")
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"))
    groups = materialise(groups.withColumn("node", F.monotonically_increasing_id()), "edit-groups")
    chosen = np.random.default_rng(SEED + 99).permutation(SAMPLES).reshape(bands, -1)

    def emit(batches):
        for pdf in batches:
            keys, nodes = [], []
            for fp, node in zip(pdf.fp, pdf.node, strict=True):
                raw = np.frombuffer(bytes.fromhex(fp), dtype=np.uint8)
                for i in (0, 1):
                    part = raw[1 + i * SAMPLES :][:SAMPLES]
                    for b, at in enumerate(chosen):
                        if part[at].any():
                            keys.append(hash_of(bytes((raw[0] + i, b)) + part[at].tobytes()))
                            nodes.append(node)
            yield pd.DataFrame({"key": np.array(keys, dtype=np.int64), "node": np.array(nodes, dtype=np.int64), "n": 1})

    members = materialise(groups.select("fp", "node").mapInPandas(emit, "key long, node long, n int"), "edit-bands")

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)])

    def verified(pairs: DataFrame) -> DataFrame:
        one, other = (groups.select(F.col("node").alias(c), F.col("fp").alias(f"fp_{c}")) for c in ("a", "b"))
        return pairs.join(one, "a").join(other, "b").where(alike("fp_a", "fp_b") >= min_likeness).select("a", "b")

    roots = components(linked(members, verified))
    rooted = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return fps.join(rooted.join(named, "root").select("fp", "class_id", "n_copies"), "fp").select("doc_id", F.col("fp").alias("fingerprint"), "class_id", "n_copies")


def hash_of(key: bytes) -> int:
    """Signed 64-bit hash."""
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True)
