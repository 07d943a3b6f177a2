"""Packing of token sequences by minimum bin slack.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. There each bin is filled by the
subset-sum of the available lengths that leaves the least slack, found with bitsets; the combination is used as often
as the lengths allow before the next is sought, so the number of combinations is bounded by that of lengths, not of
documents. Pieces then find their place by their rank among those of equal length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, need

CAPACITY = 2048
#: Groups in which rows of a length are ranked: of at least so many rows, and (beside one per length) at most so many.
GROUP_ROWS, GROUPS = 64, 65_536


def _fullest(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The combination of available lengths, the longest one included, that fills a bin best.

    ``reach[s]`` tells by which length the sum s was first reached; a bitset of the sums reached so far grows length by
    length, in powers of two of each length's multiplicity. Long lengths come first, so ties leave the short ones.
    """
    lengths = [int(x) for x in np.flatnonzero(counts)[::-1]]
    longest = lengths[0]
    room = capacity - longest
    if room == 0:
        return {longest: 1}
    full = (1 << (room + 1)) - 1
    bits, layers = 1, []
    for length in lengths:
        if length > room:
            continue
        left, k = min(int(counts[length]) - (length == longest), room // length), 1
        while left > 0:
            take = min(k, left)
            grown = (bits | bits << (take * length)) & full
            layers.append((bits, length, take))
            bits, left, k = grown, left - take, k * 2
            if bits >> room & 1:
                break
        if bits >> room & 1:
            break
    sum_ = bits.bit_length() - 1
    chosen = {longest: 1}
    for before, length, take in reversed(layers):
        if not before >> sum_ & 1:
            chosen[length] = chosen.get(length, 0) + take
            sum_ -= take * length
    return chosen


def patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations with the number of bins that use them; together they use every length as often as it occurs."""
    left, out = counts.copy(), []
    while left.any():
        combo = _fullest(left, capacity)
        times = min(int(left[length]) // n for length, n in combo.items())
        if times > 64 and sum(k * n for k, n in combo.items()) < capacity:
            times = max(1, times // 2)  # an imperfect fit: look again while lengths are plenty
        for length, n in combo.items():
            left[length] -= n * times
        out.append((combo, times))
    return out


def layout(counts: np.ndarray, capacity: int = CAPACITY) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first ranks of its intervals, and their first sequence, copies in a sequence and place in it."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for combo, times in patterns(counts, capacity):
        place = 0
        for length, n in sorted(combo.items(), reverse=True):
            out.setdefault(length, []).append((used.get(length, 0), sequence, n, place))
            used[length] = used.get(length, 0) + n * times
            place += n * length
        sequence += times
    return {k: tuple(np.array(v, dtype=np.int64).T) for k, v in out.items()}


class Encoder:
    """Ids of a ``tokenizers`` file.

    If its ids are the ranks of its merges and it cuts texts in the byte-level way, ``tiktoken`` gives the same ids in a
    third of the time and does most texts; any text with special tokens, and any other file, goes to ``tokenizers``.
    """

    def __init__(self, spec: str):
        import json

        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec)
        self.model.no_truncation()
        self.model.no_padding()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        d = json.loads(spec)
        vocab, pre = d["model"]["vocab"], d["pre_tokenizer"] or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in d["model"]["merges"]]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and d["normalizer"] is None
        ranked = [vocab[u + v] for u, v in merges] == list(range(256, 256 + len(merges))) and len(vocab) == 256 + len(merges)
        self.fast = None
        if plain and ranked and not d["model"].get("end_of_word_suffix"):
            import tiktoken

            from .bpe import byte_alphabet

            to_byte = {c: b for b, c in enumerate(byte_alphabet())}
            ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items()}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except (ValueError, RuntimeError):  # its pattern engine gave up on a very long run
                pass
        return np.array(self.model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]


_encoders: dict[int, Encoder] = {}


def pieces(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` per piece of each document's ids with ``end_id`` behind them.

    Null text: empty, hence the end alone. Only documents over ``capacity`` are cut; their first piece takes what is
    over, the others are full. Rows that repeat are packed each.
    """
    need(docs, "doc_id", "text")
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        key = zlib.crc32(spec.value.encode())
        if key not in _encoders:
            _encoders[key] = Encoder(spec.value)
        encoder = _encoders[key]
        for pdf in batches:
            rows = []
            for doc_id, ids in zip(pdf.doc_id, encoder.encode_all([t or "" for t in pdf.text]), strict=True):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
                rows += [(doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``; each is used once.

    The rank of a row among those of its length is taken inside hashed groups of that length, whose sizes are added up
    before. A length gets groups in proportion to its rows: one that a third of the rows have is spread over many tasks,
    and there are at most ``capacity + GROUPS`` groups in all, whatever the input. Rows that repeat have a place each;
    columns of any name stay.
    """
    need(items, "length")
    columns = items.columns
    kept = materialise(items.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("length").cast("int").alias("len"), F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("tie")), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in kept.groupBy("len").agg(F.count("*").alias("n")).collect():  # at most one row per length
        counts[r["len"]] = r["n"]
    rows = int(counts.sum())
    groups = np.maximum(1, -(-counts // max(GROUP_ROWS, -(-rows // GROUPS))))
    opens = np.cumsum(groups) - groups  # number of a length's first group
    numbers = F.array(*[F.lit(int(x)) for x in opens]), F.array(*[F.lit(int(x)) for x in groups])
    of = lambda k: F.element_at(numbers[k], F.col("len") + 1)
    kept = kept.withColumn("grp", (of(0) + F.pmod("tie", of(1))).cast("int"))
    sizes = np.zeros(int(groups.sum()), dtype=np.int64)
    for r in kept.groupBy("grp").agg(F.count("*").alias("n")).collect():
        sizes[r["grp"]] = r["n"]
    before = np.cumsum(sizes) - sizes
    plan, first = layout(counts, capacity), before - np.repeat(before[opens], groups)
    shared = items.sparkSession.sparkContext.broadcast((plan, first))

    def run(batches):
        plan, first = shared.value
        key, at = None, 0
        for pdf in batches:
            length, grp = pdf["len"].to_numpy(), pdf["grp"].to_numpy()
            sequence, offset = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
            starts = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]])) if len(pdf) else []
            for i, j in zip(starts, [*starts[1:], len(pdf)], strict=True):
                at = at if grp[i] == key else int(first[grp[i]])
                key = grp[i]
                rank = np.arange(at, at + j - i)
                at += j - i
                from_, seq, n, place = plan[int(length[i])]
                k = np.searchsorted(from_, rank, "right") - 1
                within = rank - from_[k]
                sequence[i:j] = seq[k] + within // n[k]
                offset[i:j] = place[k] + within % n[k] * int(length[i])
            yield pd.DataFrame({"row": pdf["row"], "sequence_id": sequence, "offset": offset})

    # number of tasks follows the rows; a group never lies in two of them
    tasks = max(1, min(20_000, -(-rows // 10_000)))
    ordered = kept.repartition(tasks, "grp").sortWithinPartitions("grp", "tie")
    schema = f"row {kept.schema['row'].dataType.simpleString()}, sequence_id long, offset long"
    return ordered.mapInPandas(run, schema).select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: see :func:`pieces` and :func:`pack`."""
    return pack(pieces(docs, path, end_id, capacity), capacity)
