"""Near copies by SimHash ball hashing of word shingles, verified by their Jaccard similarity, and an exact join for
pairs that lie beyond the balls.

Fingerprints of five-word shingles within two bits meet in balls (see :mod:`.simhash`); whoever meets is verified on the
whole sets, and the links join copies and slightly edited texts to components. Texts that are 0.8 alike may differ in
ten bits, which no ball can reach, so an exact set-similarity join goes on from these components.

Of a set of n shingles one that is at least t alike lacks at most n - ceil(t * n). A first pass looks at the shingles in
one part of the hashes' range, the same for all texts: a text that has more than so many there that no other text has
links with nothing and drops out. Of the others all shingles are ordered by how many texts have them; whatever
the order, two that are alike share one of their first n - ceil(t * n) + 1, so they meet at these, and every link is
verified on the whole sets. At the first one that a pair shares, what either has from there on holds all that they have in
common, so pairs of which one has too little left there are not compared at it. Nothing is sampled or capped.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, need, sendable
from .components import components, linked
from .simhash import SEED, fingerprint, rows_named
from .simhash import links as ball_links

#: Keeps products such as 0.8 * 5 from being rounded up past a whole number.
EPS = 1e-9
#: The same for counts of shingles.
SLACK = 1e-6
#: End of the part of the hashes' range that the first pass looks at: 0.35 of it, as a text without near copies
#: must show there more than 0.2 of its shingles.
FIRST_END = np.int64(-(1 << 63) + int(0.35 * 2**64))


#: Rows whose shingles a worker holds before it hands them on.
HELD = 500


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. No words: empty. Fewer than ``width`` words: one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), dtype=np.int64))


def set_key(shingles: np.ndarray) -> str:
    return xxhash.xxh128_hexdigest(shingles.tobytes(), SEED)


def own_limit(n: int, least: float) -> int:
    """The most shingles that one of n can have and a set at least ``least`` alike can lack."""
    return n - math.ceil(least * n - EPS)


def set_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted distinct arrays; 1 for two empty ones."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) + len(b) else 1.0


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, sim`` of the pairs ``a, b``."""

    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([set_similarity(np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)) for x, y in zip(a, b, strict=True)])

    one = sets.select(F.col("fp").alias("a"), F.col("hashes").alias("of_a"))
    other = sets.select(F.col("fp").alias("b"), F.col("hashes").alias("of_b"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", similarity("of_a", "of_b").alias("sim"))


def near_in_bits(sets: DataFrame, least: float) -> DataFrame:
    """Verified pairs ``a, b`` of sets whose SimHash fingerprints (``sim``) meet in a ball of two bits."""
    one = materialise(sets.groupBy("sim").agg(F.min("fp").alias("fp")), "sims")
    met = ball_links(one.select(F.col("sim").alias("fp")), 2)
    a, b = one.select(F.col("sim").alias("a"), F.col("fp").alias("x")), one.select(F.col("sim").alias("b"), F.col("fp").alias("y"))
    apart = met.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    equal = sets.join(one.withColumnRenamed("fp", "a"), "sim").where("a < fp").select("a", F.col("fp").alias("b"))
    return _verified(apart.unionByName(equal), sets).where(F.col("sim") >= least - EPS).select("a", "b")


def links(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Verified pairs ``a, b`` that join the same components as all pairs at least ``least`` alike do.

    ``members`` has ``shingle, fp, n, pos``, a row per text and prefix shingle, ``pos`` how many of the text's shingles
    come before it in the one order of all; ``sets`` has ``fp, sim, hashes``. First come the links of
    :func:`near_in_bits`, then those of members that meet at a shingle.
    """
    share = least / (1 + least)  # of the two sizes: what a pair as alike as that has in common at least

    def possible(n, pos, m, pos_m):
        """At the first shingle that both have, no more is common than either has from there on."""
        n, pos, m, pos_m = map(F.col, (n, pos, m, pos_m))
        sizes = F.least(n, m) >= least * F.greatest(n, m) - EPS
        return sizes & (F.least(n - pos, m - pos_m) >= share * (n + m) - SLACK)

    def able(n, pos, smallest):
        """The partner that asks least is the smallest, or one as small as a partner may be, at its first shingle."""
        n, pos = F.col(n), F.col(pos)
        return n - pos >= share * (n + F.greatest(F.col(smallest).cast("double"), least * n)) - SLACK

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, sets).where(F.col("sim") >= least - EPS).select("a", "b")

    meet = members.select(F.col("shingle").alias("key"), F.col("fp").alias("node"), "n", "pos")
    return linked(meet, verified, near_in_bits(sets, least), possible, able)


def near_copies(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """``doc_id, component_id`` of every row: texts at least ``least`` alike link, also empty ones with each other.

    component_id is the smallest doc_id reachable; null ids name no component unless all its ids are null.
    """
    need(docs, "doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def first_pass(batches):
        for pdf in batches:
            for at in range(0, len(pdf), HELD):
                part = pdf.iloc[at : at + HELD]
                own = [shingle_set(t, width) for t in part.text]
                first = [s[: np.searchsorted(s, FIRST_END)] for s in own]
                yield pd.DataFrame({"doc_id": part.doc_id, "fp": [set_key(s) for s in own], "most": [own_limit(len(s), least) for s in own], "first": first})

    prints = materialise(docs.select("doc_id", "text").mapInPandas(first_pass, f"doc_id {id_type}, fp string, most long, first array<long>"), "shingle-prints")
    groups = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.first("most").alias("most"), F.xxhash64("fp").alias("key")), "shingle-groups")
    firsts = prints.select(F.xxhash64("fp").alias("key"), F.explode("first").alias("shingle"))
    met = firsts.groupBy("shingle").agg(F.min("key").alias("key"), F.max("key").alias("last"))
    alone = met.where("key = last").groupBy("key").agg(F.count("*").alias("alone"))
    left = groups.join(alone, "key", "left").where(F.coalesce("alone", F.lit(0)) <= F.col("most")).select("fp", "first_id")
    left = materialise(left, "left-over")

    def whole(batches):
        for pdf in batches:
            for at in range(0, len(pdf), HELD):
                texts = pdf.text.iloc[at : at + HELD]
                own = [shingle_set(t, width) for t in texts]
                sims = np.array([fingerprint(t or "", width) for t in texts], dtype=np.uint64).view(np.int64)
                yield pd.DataFrame({"fp": [set_key(s) for s in own], "sim": sims, "hashes": [s.tobytes() for s in own]})

    # one row per set: ids may be null or repeated, so the set itself is what is made distinct
    names = left.select("first_id").distinct()
    texts = docs.select("doc_id", "text").join(sendable(names), F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    sets = texts.mapInPandas(whole, "fp string, sim long, hashes binary").join(left, "fp", "left_semi")
    sets = sets.groupBy("fp").agg(F.min("sim").alias("sim"), F.first("hashes").alias("hashes"))
    named_sets = materialise(sets.withColumn("row", F.monotonically_increasing_id()), "shingle-sets")
    sets = named_sets.select(F.col("row").alias("fp"), "sim", "hashes")

    def exploded(batches):
        for pdf in batches:
            for at in range(0, len(pdf), HELD):
                part = pdf.iloc[at : at + HELD]
                own = [np.frombuffer(h, dtype=np.int64) for h in part.hashes]
                size = [len(h) for h in own]
                yield pd.DataFrame({"fp": np.repeat(part.fp.to_numpy(), size), "n": np.repeat(size, size), "shingle": np.concatenate(own)}).astype("int64")

    each = sets.select("fp", "hashes").mapInPandas(exploded, "fp long, n long, shingle long")
    had = each.groupBy("shingle").agg(F.count("*").alias("had")).where("had > 1")
    # of n shingles the n - m that no other text has come first; the others by how many have them
    ranked = each.join(had, "shingle").groupBy("fp", "n").agg(F.sort_array(F.collect_list(F.struct("had", "shingle"))).alias("own"))
    ranked = ranked.withColumn("take", F.size("own") - F.ceil(F.col("n") * least - EPS) + 1).where("take > 0")
    taken = ranked.select("fp", "n", (F.col("n") - F.size("own")).alias("alone"), F.posexplode(F.slice("own", 1, F.col("take").cast("int"))).alias("at", "s"))
    members = materialise(taken.select(F.col("s.shingle").alias("shingle"), "fp", "n", (F.col("alone") + F.col("at")).alias("pos")), "prefixes")

    names = named_sets.select("row", "fp")
    roots = components(links(members, sets, least)).join(names, F.col("node") == F.col("row")).select("fp", F.col("root").alias("root_row"))
    roots = roots.join(names.select(F.col("row").alias("root_row"), F.col("fp").alias("root")), "root_row").select("fp", "root")
    rooted = groups.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.select("doc_id", "fp").join(rooted.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "component_id")


def representatives(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component: one document of each group of near copies.

    Rows with a null id are kept. Of rows that repeat the same id, one stays: that with the smallest text.
    """
    return rows_named(docs, near_copies(docs, width, least))
