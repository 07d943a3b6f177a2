"""Language-model scoring by online logistic context mixing over the bits of bytes.

What is coded is a text's tokens: each word's bytes and a space, at the end a newline. Every bit of every byte is
predicted from hashed contexts: the last 2 and 4 bytes of the word, and the whole word so far. Each context gives the
log-odds of the counts it has seen; a mixer adds them with the weights of the gate that the bit's place in the word and
the word context's experience open, and a table refines the sum. Each text mixes this with the word context's own odds by
weights that its error moves as it goes on, from its first token to its last, in steps of a fixed size. Weights and
refinement are learned from every token of all training rows, each forecast by the counts of the others.

A match model stands before the mixer. Texts are cut where the hash of neighbouring words says so; after a cut the three
words before it name what followed there most often in the other training texts, and one more decision says whether
the text goes on like that up to its next cut. Its odds come from how often such forecasts held. Only a stretch that was
not forecast is spelled. These tables are exact, distributed, and grow with the corpus; so do the word counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, materialise, need

#: Words whose base counts workers look up themselves; other words' exact counts come by a join.
VOCABULARY = 196_608
#: Lengths of the byte contexts; the whole word so far comes behind them.
ORDERS = (2, 4)
HASHED = len(ORDERS) + 1
#: log2 of the cells of each hashed table. Each counts every word; contexts that fall on one cell share it.
TABLE_BITS = (19, 21, 22)
#: Log-odds are stored in 1/16.
UNIT = 16.0
#: How often the word context was seen, from which on a gate of its own opens; gates are doubled for first bytes.
LEVELS = (0.5, 1.5, 4.5, 32, 512)
BUCKETS = 64
#: Tokens after which a text's weights move, bytes of texts that a worker scores at once, and how many of these texts are
#: mixed side by side (as much as a core's cache holds).
STEP, BLOCK, SIDE = 64, 1_500_000, 40
#: How far a text's error moves its weights.
RATE = 3e-4
#: What weights are learned from: how often a bit was which, by gate and by the odds of each context, in 1/16 dealt into
#: classes of 8 (half a unit of log-odds).
COARSE, CLASSES = 8, 32
#: Bits of words whose margins a worker remembers: of frequent words, and of others for a while. Unit of margins.
REMEMBERED, FINE = (16_000_000, 4_000_000), 1024
#: Words whose margins are worked out at once.
FRESH = 4000
#: One pair of words in so many ends a stretch of the match model; its context is as many words as that.
CUT_EVERY, CONTEXT = 24, 3
END = "\n"  # no word contains white space
#: Bytes of words that a worker holds before it counts them.
MAX_PARTIAL = 40_000_000
FAN_IN = 256

_ODD = 0x9E3779B97F4A7C15
_BYTES = np.arange(256)
#: Per byte: its bits, and the node of each bit in the tree of its half of the byte.
BITS = ((_BYTES[:, None] >> (7 - np.arange(8))) & 1).astype(np.uint8)
HALF = np.concatenate([(1 << np.arange(4)) + (_BYTES[:, None] >> s + 4 - np.arange(4) & (1 << np.arange(4)) - 1) for s in (4, 0)], axis=1).astype(np.int32)
#: The same within both halves' cells side by side; 1 for bits that are set, -1 for others.
WITHIN, SIGN = HALF.astype(np.int64) + 16 * (np.arange(8) >= 4), BITS.astype(np.int16) * np.int16(2) - np.int16(1)
#: A type of 16 bytes, to move rows of cells or margins as a whole.
ROW = np.complex128


def tokens(text: str | None) -> list[bytes]:
    """Words between 0x20 and 0x09-0x0D, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def split(texts: pa.Array) -> pa.Array:
    """What :func:`tokens` finds in texts, one after the other."""
    return split_each(texts)[0]


def split_each(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What :func:`tokens` finds in texts, one after the other, and how many words each has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = parts.flatten()
    kept = pc.greater(pc.binary_length(words), 0)  # beside white space at either end there is an empty part
    upto = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return words.filter(kept), np.diff(upto[np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])])


#: What a worker keeps from task to task of one scoring; counting for the next lets go of it.
_lexicons: dict[str, object] = {}


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over the rows of ``docs``, each text with one end token; combined per partition before the shuffle."""

    def counted(words: list[pa.Array]) -> pa.RecordBatch:
        found = pa.chunked_array(words).value_counts()
        return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])

    def run(batches):
        _lexicons.clear()
        held: list[pa.Array] = []
        ends = 0
        for batch in batches:
            held.append(split(batch.column("text")))
            ends += len(batch)
            if sum(w.nbytes for w in held) > MAX_PARTIAL:
                yield counted(held)
                held = []
        if held:
            yield counted(held)
        yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends], pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def spelled(word: bytes) -> bytes:
    return word if word == b"\n" else word + b" "


@dataclass
class Spelling:
    """The bytes of words one after the other, and per byte the hashes of its contexts."""

    data: np.ndarray
    length: np.ndarray
    contexts: list[np.ndarray]
    hashes: np.ndarray  # of whole words

    @staticmethod
    def of(words: list[bytes]) -> Spelling:
        parts = [spelled(w) for w in words]
        data = np.frombuffer(b"".join(parts), dtype=np.uint8)
        length = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        start = np.cumsum(length) - length
        place = np.arange(len(data)) - np.repeat(start, length)
        h, out = np.zeros(len(data), dtype=np.uint64), []
        for j in range(1, max(ORDERS) + 1):
            before = np.zeros(len(data), dtype=np.uint64)
            before[j:] = data[:-j]
            h = h * np.uint64(0x100000001B3) + np.where(place >= j, before + np.uint64(1), np.uint64(0))
            if j in ORDERS:
                out.append(mixed(h + np.uint64(j)))
        # hash of the word so far: differences of running sums, brought to one scale by the inverse power
        n = len(data) + 1
        up, down = np.full(n, _ODD, dtype=np.uint64), np.full(n, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate((data.astype(np.uint64) + np.uint64(1)) * up[:-1])])
        first = np.repeat(start, length)
        out.append(mixed((sums[:-1] - sums[first]) * down[first] + np.uint64(9)))
        return Spelling(data, length, out, mixed((sums[start + length] - sums[start]) * down[start]) if len(parts) else np.empty(0, np.uint64))

    def halves(self, k: int) -> np.ndarray:
        """Per byte the rows of 16 cells that the bits of its halves have in table ``k``."""
        h, out, less = self.contexts[k], np.empty((len(self.data), 2), dtype=np.int64), np.uint64(68 - TABLE_BITS[k])
        out[:, 0] = h >> less
        out[:, 1] = mixed(h + (self.data >> 4).astype(np.uint64) * np.uint64(_ODD) + np.uint64(77)) >> less
        return out

    def cells(self, k: int) -> np.ndarray:
        """Cell of every bit (byte, bit) in table ``k``; the bits of half a byte lie side by side."""
        return np.repeat(self.halves(k).ravel() * 16, 4).reshape(-1, 8) + np.take(HALF, self.data, axis=0)

    def within(self) -> np.ndarray:
        """Place of every bit among the cells of all halves."""
        return np.repeat(np.arange(len(self.data)) * 32, 8) + np.take(WITHIN, self.data, axis=0).ravel()


def add_words(tables: list[np.ndarray], words: list[bytes], times: np.ndarray, whole: np.ndarray | None = None) -> None:
    """Add the bits of each word, as often as it occurs, to tables of (cell, bit); to the last, if ``whole`` is given,
    only where it holds (the query counts every word)."""
    whole = np.ones(len(words), dtype=bool) if whole is None else whole
    for at in range(0, len(words), 5000):
        s = Spelling.of(words[at : at + 5000])
        weight = np.repeat(np.repeat(times[at : at + 5000], s.length), 8).astype(np.float32)
        held = np.repeat(np.repeat(whole[at : at + 5000], s.length), 8)
        bit = BITS[s.data].ravel()
        for k in range(HASHED):
            cell = s.cells(k).ravel() * 2 + bit
            if k == HASHED - 1:
                cell, weight = cell[held], weight[held]
            np.add.at(tables[k], cell, weight)


def _packed(tables: list[np.ndarray], task: int) -> Iterable[pd.DataFrame]:
    """Cells that are not zero, in rows of one block of 65,536 cells each."""
    block = 0
    for t in tables:
        for at in range(0, len(t), 1 << 16):
            part = t[at : at + (1 << 16)]
            cell = np.flatnonzero(part)
            if len(cell):
                yield pd.DataFrame({"block": [block], "task": [task], "cells": [cell.astype(np.uint16).tobytes()], "n": [part[cell].astype(np.float32).tobytes()]})
            block += 1


PACKED = "block int, task int, cells binary, n binary"


def _fill(out: np.ndarray, cells: bytes, n: bytes) -> None:
    out[np.frombuffer(cells, dtype=np.uint16)] += np.frombuffer(n, dtype=np.float32)


def summed(parts: DataFrame, sizes: list[int]) -> list[np.ndarray]:
    """Tables of these sizes from packed parts, added up in a tree: no task reads more than ``FAN_IN`` parts a block."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << 16, dtype=np.float64)
        for cells, n in zip(rows.cells, rows.n, strict=True):
            _fill(total, cells, n)
        cell = np.flatnonzero(total)
        return pd.DataFrame({"block": [rows.block.iloc[0]], "task": [rows.task.iloc[0]], "cells": [cell.astype(np.uint16).tobytes()], "n": [total[cell].astype(np.float32).tobytes()]})

    tasks = parts.rdd.getNumPartitions()
    while True:
        tasks = -(-tasks // FAN_IN)
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("block", "task").applyInPandas(add, PACKED)
        if tasks <= 1:
            break
    out = [np.zeros(n, dtype=np.float32) for n in sizes]
    where = [(t, at) for t, n in enumerate(sizes) for at in range(0, n, 1 << 16)]
    for r in parts.toLocalIterator():  # as many bytes as the tables have
        t, at = where[r["block"]]
        _fill(out[t][at : at + (1 << 16)], r["cells"], r["n"])
    return out


def count_cells(counts: DataFrame, distinct: int) -> list[np.ndarray]:
    """Tables of (cell, bit) over all words of ``counts`` (word, n)."""

    def run(batches):
        tables = [np.zeros(2 << b, dtype=np.float32) for b in TABLE_BITS]
        for pdf in batches:
            add_words(tables, [w.encode() for w in pdf.word], pdf.n.to_numpy())
        yield from _packed(tables, TaskContext.get().partitionId())

    tasks = max(1, min(FAN_IN, -(-distinct // 120_000)))
    return summed(counts.select("word", "n").repartition(tasks).mapInPandas(run, PACKED), [2 << b for b in TABLE_BITS])


def _stored(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(np.log((ones + 0.4) / (zeros + 0.4)) * UNIT), -127, 127).astype(np.int8)


def _refined(z: np.ndarray, gate: np.ndarray, refine: np.ndarray) -> np.ndarray:
    np.clip(z, -15.9, 15.9, out=z)
    z += np.take(refine, gate * BUCKETS + (z * 2 + BUCKETS // 2).astype(np.int64))
    return z


def _seen(n: np.ndarray) -> np.ndarray:
    """The level of a word context that was seen so often."""
    out = np.zeros(n.shape, dtype=np.uint8)
    for level in LEVELS:
        out += n >= level
    return out


def add_outcomes(out: np.ndarray, x: Iterable[np.ndarray], gate: np.ndarray, bit: np.ndarray, times: np.ndarray) -> None:
    """Add bits, as often as they occur, to a table of (gate, class of each context's odds, bit)."""
    cell = gate.astype(np.int32)
    for odds in x:
        cell *= CLASSES
        cell += (odds.astype(np.int16) + 128) // COARSE
    cell *= 2
    cell += bit
    out += np.bincount(cell, times, len(out))


OUTCOMES = 2 * (len(LEVELS) + 1) * CLASSES**HASHED * 2


def add_left_out(out: np.ndarray, cells: list[np.ndarray], words: list[bytes], times: np.ndarray, whole: np.ndarray | None = None) -> None:
    """Add the bits of each word, as often as it occurs, by the odds that the tables of (cell, bit) give them without the
    one occurrence that is forecast; the last table counts every word, or those where ``whole`` holds."""
    whole = np.ones(len(words), dtype=bool) if whole is None else whole
    for at in range(0, len(words), 5000):
        s = Spelling.of(words[at : at + 5000])
        bit = BITS[s.data]
        held = np.repeat(whole[at : at + 5000], s.length)[:, None]
        x = []
        for k in range(HASHED):
            n = np.take(cells[k].view(np.int64), s.cells(k)).view(np.float32).reshape(-1, 8, 2)
            own = held if k == HASHED - 1 else np.True_
            zeros, ones = n[:, :, 0] - ((bit == 0) & own), n[:, :, 1] - ((bit == 1) & own)
            x.append(_stored(ones, zeros).ravel())
        gate = _seen(zeros + ones)
        gate[np.cumsum(s.length) - s.length] += len(LEVELS) + 1
        add_outcomes(out, x, gate.ravel(), bit.ravel(), np.repeat(times[at : at + 5000], s.length * 8))


def count_outcomes(counts: DataFrame, distinct: int, cells: list[np.ndarray]) -> np.ndarray:
    """The table of outcomes over all words of ``counts`` (word, n), as often as they occur."""
    spark = counts.sparkSession
    sent = spark.sparkContext.broadcast(cells)

    def run(batches):
        out = np.zeros(OUTCOMES)
        for pdf in batches:
            add_left_out(out, sent.value, [w.encode() for w in pdf.word], pdf.n.to_numpy())
        yield from _packed([out], TaskContext.get().partitionId())

    tasks = max(1, min(FAN_IN, -(-distinct // 120_000)))
    out = summed(counts.select("word", "n").repartition(tasks).mapInPandas(run, PACKED), [OUTCOMES])[0]
    sent.destroy()
    return out


def _newton(x: np.ndarray, y: np.ndarray, times: np.ndarray, start: np.ndarray, prior: float = 20.0) -> np.ndarray:
    """Weights of a logistic model near ``start``, of rows that occur ``times``."""
    w, pull = start.astype(np.float64), np.full(len(start), prior)
    for _ in range(8):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -15, 15)))
        slope = x.T @ (times * (y - p)) - pull * (w - start)
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        w = w + np.linalg.solve(curve, slope)
    return w.astype(np.float32)


class Layer:
    """Weights per gate, and per gate and bucket of the mixed log-odds what to add to them."""

    def __init__(self, gates: int):
        self.weights = np.full((gates, HASHED + 1), 1 / HASHED, dtype=np.float32)
        self.weights[:, HASHED] = 0
        self.refine = np.zeros(gates * BUCKETS, dtype=np.float32)

    def odds(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        gate = gate.astype(np.int64)
        z = np.take(self.weights[:, HASHED] * np.float32(0.25), gate)
        for k in range(HASHED):
            part = np.take(self.weights[:, k] / np.float32(UNIT), gate)
            part *= x[k]
            z += part
        return _refined(z, gate, self.refine)

    def learn(self, x: np.ndarray, gate: np.ndarray, y: np.ndarray, times: np.ndarray) -> None:
        for g in range(len(self.weights)):
            mine = gate == g
            xg = np.full((int(mine.sum()), HASHED + 1), 0.25)
            xg[:, :HASHED] = x[:, mine].T / UNIT
            self.weights[g] = _newton(xg, y[mine], times[mine], self.weights[g])
        z = self.odds(x, gate)
        cell, p = gate.astype(np.int32) * BUCKETS + (z * 2 + BUCKETS // 2).astype(np.int32), 1 / (1 + np.exp(-z))
        miss, ease = (np.bincount(cell, times * v, len(self.refine)) for v in (y - p, p * (1 - p)))
        self.refine = np.clip(miss / (ease + 20), -1, 1).astype(np.float32)


class Mixer:
    """Tables of log-odds, the gates' weights, and how a text mixes their sum with the word context's odds at first."""

    def __init__(self, cells: list[np.ndarray]):
        self.odds = [np.empty(len(c) // 2, dtype=np.int8) for c in cells]
        self.seen = np.empty(len(cells[-1]) // 2, dtype=np.int8)
        for c, odds in zip(cells, self.odds, strict=True):
            for at in range(0, len(odds), 1 << 18):  # in parts: the driver's memory is small
                part = c[2 * at : 2 * (at + (1 << 18))].reshape(-1, 2)
                odds[at : at + len(part)] = _stored(part[:, 1], part[:, 0])
                if odds is self.odds[-1]:
                    self.seen[at : at + len(part)] = _seen(part.sum(axis=1))
        self.layer = Layer(2 * len(LEVELS) + 2)
        self.first = np.array([1, 0], dtype=np.float32)
        self.rate = RATE

    def inputs(self, s: Spelling) -> tuple[np.ndarray, np.ndarray]:
        """Per hashed context and bit the stored log-odds; each bit's gate."""
        x, within = np.empty((HASHED, len(s.data) * 8), dtype=np.int8), s.within()
        for k in range(HASHED):
            half = s.halves(k).ravel()
            x[k] = np.take(np.take(self.odds[k].view(ROW), half).view(np.int8), within)
        gate = np.take(np.take(self.seen.view(ROW), half).view(np.int8), within)
        first = ((np.cumsum(s.length) - s.length)[:, None] * 8 + np.arange(8)).ravel()
        gate[first] += len(LEVELS) + 1
        return x, gate

    def margins(self, s: Spelling) -> np.ndarray:
        """Per bit the log-odds of the value that the bit has, in 1/FINE: by the gates, and by the word context alone."""
        x, gate = self.inputs(s)
        sign = np.take(SIGN, s.data, axis=0).ravel()
        odds = self.layer.odds(x, gate)
        odds *= np.float32(FINE)
        out = np.empty((2, len(sign)), dtype=np.int16)
        np.multiply(np.rint(odds, out=odds).astype(np.int16), sign, out=out[0])
        np.multiply(x[-1], sign * np.int16(FINE // int(UNIT)), out=out[1])
        return out


class Lexicon:
    """What a worker remembers of words: margins per bit, hash, base value. Words with a base value are the frequent ones
    and stay; others come behind them and go when they fill their room."""

    def __init__(self, mixer: Mixer, base: dict[bytes, float] | None = None):
        self.mixer, self.base = mixer, base or {}
        self.slots: dict[bytes, int] = {}
        self.passing: list[bytes] = []
        self.count = [0, 0]
        self.used = [0, REMEMBERED[0] // 8]  # bytes of either kind; slots of frequent words come first
        self.first_passing = len(self.base)
        self.margins = [np.empty(sum(REMEMBERED) // 8, dtype=ROW) for _ in range(2)]  # a row has a byte's eight, of 16 bits
        self.start, self.length = np.empty(self.first_passing, np.int64), np.empty(self.first_passing, np.int64)
        self.values, self.hashes = np.empty(self.first_passing), np.empty(self.first_passing, np.uint64)

    def _add(self, words: list[bytes], frequent: bool) -> None:
        s = Spelling.of(words)
        kind = int(not frequent)
        at = self.count[kind] + kind * self.first_passing
        self.count[kind] += len(words)
        upto, byte, first = at + len(words), self.used[kind], np.cumsum(s.length) - s.length
        self.used[kind] += len(s.data)
        if self.used[kind] > len(self.margins[0]):
            self.margins = [np.concatenate([m, np.empty(self.used[kind] * 5 // 4 - len(m), ROW)]) for m in self.margins]
        if upto > len(self.start):
            for name in ("values", "start", "length", "hashes"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.empty(upto * 5 // 4 - len(old), old.dtype)]))
        self.start[at:upto], self.length[at:upto], self.hashes[at:upto] = byte + first, s.length, s.hashes
        self.values[at:upto] = [self.base[w] for w in words] if frequent else [self.base.get(w, np.nan) for w in words]
        for held, margins in zip(self.margins, self.mixer.margins(s), strict=True):
            held[byte : self.used[kind]] = margins.view(ROW)
        self.slots.update(zip(words, range(at, upto), strict=True))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Slots of words, each given once; good until the next call."""
        slots = self.slots
        if self.used[1] - REMEMBERED[0] // 8 > REMEMBERED[1] // 8:
            for w in self.passing:
                del slots[w]
            self.used[1], self.count[1], self.passing = REMEMBERED[0] // 8, 0, []
        out = np.fromiter(map(slots.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        lacking = np.flatnonzero(out < 0)
        new = [words[i] for i in lacking.tolist()]
        room = self.used[0] + sum(map(len, new)) + len(new) <= REMEMBERED[0] // 8
        often = [w for w in new if w in self.base] if room else []
        others = [w for w in new if w not in self.base] if room else new
        self.passing += others
        for some, frequent in ((often, True), (others, False)):
            for i in range(0, len(some), FRESH):
                self._add(some[i : i + FRESH], frequent)
        out[lacking] = [slots[w] for w in new]
        return out

    def coded(self, words: pa.Array, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Of texts of so many words: the slots of their tokens, the ends included, these tokens' places among the
        distinct words, and the distinct words."""
        coded = words.dictionary_encode()
        distinct = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END.encode()], pa.binary())])
        place = np.insert(coded.indices.to_numpy(zero_copy_only=False), np.cumsum(lengths), len(distinct) - 1)
        return np.take(self.find(distinct.to_numpy(zero_copy_only=False).tolist()), place), place, distinct

    def lookup(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Slots of the tokens of each text, the end included; good until the next call."""
        lengths = np.array([len(t) for t in texts])
        slots = self.coded(pa.array(list(chain.from_iterable(texts)), pa.binary()), lengths)[0]
        return np.split(slots, np.cumsum(lengths + 1)[:-1])

    def bits(self, slot: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Margins of the layers for every bit of the tokens, in 1/FINE, and by how many bytes tokens begin."""
        size = self.length[slot]
        first = np.cumsum(size) - size
        at = np.repeat(self.start[slot] - first, size)
        at += np.arange(len(at))
        return [np.take(m, at).view(np.int16).astype(np.float32) for m in self.margins], first


def token_scores(lexicon: Lexicon, texts: list[np.ndarray]) -> list[np.ndarray]:
    """log10 probability of every token of texts of slots."""
    lengths = np.array([len(t) for t in texts])
    return np.split(scores_of(lexicon, np.concatenate(texts), lengths), np.cumsum(lengths)[:-1])


def scores_of(lexicon: Lexicon, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of every token of texts that lie one after the other, ``lengths`` long. Each step takes the next
    tokens of all texts that have some left; after it each text's weights move by its own error."""
    m, order = lexicon.mixer, np.argsort(-lengths, kind="stable")
    start, lengths, out = (np.cumsum(lengths) - lengths)[order], lengths[order], np.empty(len(flat))
    own = np.zeros((len(order), 2), dtype=np.float32)
    for at in range(0, int(lengths[0]), STEP):
        live, on = int((lengths > at).sum()), int((lengths > at + STEP).sum()) if m.rate else 0
        for i in range(0, live, SIDE):
            some = slice(i, min(i + SIDE, live))
            counts = np.minimum(lengths[some] - at, STEP)
            ahead = np.cumsum(counts) - counts
            place = np.repeat(start[some] + at - ahead, counts) + np.arange(int(counts.sum()))
            (one, two), first = lexicon.bits(flat[place])
            begin = first[ahead] * 8  # bits of each text
            n_bits = np.diff(begin, append=len(one))
            w = (m.first + own[some]) * np.float32(-1 / FINE)
            z = np.repeat(w[:, 0], n_bits)
            z *= one
            more = np.repeat(w[:, 1], n_bits)
            more *= two
            z += more
            np.minimum(np.maximum(z, -17, out=z), 17, out=z)
            e = np.exp(z, out=z)
            odds = np.add(e, np.float32(1), out=more)
            four = odds.reshape(-1, 4)  # one logarithm for the bits of half a byte: their product stays below 3e30
            half = four[:, 0] * four[:, 1]
            half *= four[:, 2] * four[:, 3]
            out[place] = np.add.reduceat(np.log(half, out=half), first * 2)
            going = min(on, some.stop) - i
            if going > 0:
                upto = int(begin[going]) if going < len(begin) else len(one)
                missed = np.divide(e[:upto], odds[:upto], out=e[:upto])  # one less the probability that the bit had
                for j, x in enumerate((one, two)):
                    own[i : i + going, j] += np.float32(m.rate / FINE) * np.add.reduceat(np.multiply(x[:upto], missed, out=x[:upto]), begin[:going])
    out /= -np.log(10)
    return out


def fit(mixer: Mixer, outcomes: np.ndarray) -> None:
    """Weights by Newton's method per gate, refinements, and first weights of the mix, from a table of outcomes."""
    cell = np.flatnonzero(outcomes)
    if not len(cell):
        return
    times, y, rest = outcomes[cell].astype(np.float64), (cell % 2).astype(np.float64), cell // 2
    x = np.empty((HASHED, len(cell)), dtype=np.float32)
    for k in range(HASHED - 1, -1, -1):
        x[k] = rest % CLASSES * COARSE - 128 + (COARSE - 1) / 2
        rest = rest // CLASSES
    mixer.layer.learn(x, rest, y, times)
    sign = 2 * y - 1
    margins = np.stack([mixer.layer.odds(x, rest) * sign, x[-1] / UNIT * sign], axis=1)
    mixer.first = _newton(margins, np.ones(len(cell)), times, mixer.first)


def learn(mixer: Mixer, texts: list[list[bytes]]) -> None:
    """What :func:`fit` does, from texts that the mixer's tables don't count."""
    s = Spelling.of([w for t in texts for w in [*t, END.encode()]])
    x, gate = mixer.inputs(s)
    outcomes = np.zeros(OUTCOMES)
    add_outcomes(outcomes, x, gate, BITS[s.data].ravel(), np.ones(len(gate)))
    fit(mixer, outcomes)


def stretches(h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of texts of token hashes that lie one after the other, ``lengths`` long: first tokens, whether it is a
    text's first stretch (``CONTEXT`` words), and for the others contexts, hashes, and whether no earlier stretch of the
    text has the same context and hash."""
    n, opening = len(h), np.zeros(len(h), dtype=bool)
    first = np.cumsum(lengths) - lengths
    opening[first] = True
    place = np.arange(n) - np.repeat(first, lengths)
    cut = place == CONTEXT
    cut[2:] |= (mixed(h[:-2] * np.uint64(3) + h[1:-1]) % np.uint64(CUT_EVERY) == 0) & (place[2:] > CONTEXT)
    starts, begin = np.flatnonzero(cut | opening), np.flatnonzero(cut)
    context = np.zeros(len(begin), dtype=np.uint64)
    for j in range(CONTEXT, 0, -1):
        context = mixed(context * np.uint64(_ODD) + h[begin - j])
    within = np.arange(n) - np.repeat(starts, np.diff(np.concatenate([starts, [n]])))
    body = mixed(np.add.reduceat(mixed(h + within.astype(np.uint64) * np.uint64(_ODD)), starts))[cut[starts]]
    once, text = np.zeros(len(begin), dtype=bool), np.repeat(np.arange(len(lengths)), lengths)[begin].astype(np.uint64)
    once[np.unique(mixed(mixed(context) + body) + text * np.uint64(_ODD), return_index=True)[1]] = True
    return starts, opening[starts], context.view(np.int64), body.view(np.int64), once


def blocks(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
    """Slices of a batch, of ``BLOCK`` bytes of text or a single row at most."""
    upto = np.cumsum(pc.binary_length(batch.column("text").fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK, side="right")))
        yield batch.slice(at, end - at)
        at = end


def scored_rows(lexicon: Lexicon, rows: pa.RecordBatch) -> pa.RecordBatch:
    """What the worker tells of some texts (``doc_id, text, train``)."""
    text = rows.column("text")
    words, lengths = split_each(text)
    flat, of, distinct = lexicon.coded(words, lengths)
    lengths = lengths + 1
    scores, first, values = scores_of(lexicon, flat, lengths), np.cumsum(lengths) - lengths, lexicon.values[flat]
    starts, opening, context, body, once = stretches(lexicon.hashes[flat], lengths)
    sums = np.add.reduceat(scores, starts)
    lacks = np.isnan(values)
    rare = distinct.take(pa.array(of[lacks])).cast(pa.string())

    def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)

    n_lacking = np.add.reduceat(lacks, first, dtype=np.int64)
    n_stretches = np.diff(np.searchsorted(starts, np.append(first, len(flat)))) - 1
    columns = {
        "doc_id": rows.column("doc_id"), "held_out": pc.invert(rows.column("train")), "n_tokens": pa.array(lengths, pa.int64()),
        "n_known": pa.array(lengths - n_lacking), "base": pa.array(np.add.reduceat(np.where(lacks, 0, values), first)), "opening": pa.array(sums[opening]),
        "rare": lists(rare, n_lacking), "n_bytes": pc.binary_length(text.fill_null("")).cast(pa.int64()),
    } | {k: lists(pa.array(v), n_stretches) for k, v in (("context", context), ("body", body), ("once", once), ("spelled", sums[~opening]))}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


SCORED = "held_out boolean, n_tokens long, n_known long, base double, opening double, rare array<string>, n_bytes long, context array<long>, body array<long>, once array<boolean>, spelled array<double>"


def _matched(scored: DataFrame) -> DataFrame:
    """``row, state, hit, n, spelled``: per text its stretches by what was forecast and whether it came."""
    each = scored.select("row", "held_out", F.explode(F.arrays_zip("context", "body", "once", "spelled")).alias("s")).select("row", "held_out", "s.*")
    known = each.where("not held_out and once").groupBy("context", "body").agg(F.count("*").alias("c"))
    order = Window.partitionBy("context").orderBy(F.desc("c"), "body")
    few = known.withColumn("place", F.row_number().over(order)).where("place <= 3")  # without its own part a text knows two
    best = few.groupBy("context").agg(F.collect_list(F.struct("body", "c")).alias("best"))
    # written, so that the join below deals out texts' rows alone and a context that many texts share can be split
    out = each.join(materialise(best, "forecasts"), "context", "left")
    # a training text's own part is taken out of the counts
    own = F.when(F.col("held_out"), 0).otherwise(1)
    rest = F.transform(F.coalesce("best", F.array().cast("array<struct<body:bigint,c:bigint>>")), lambda x: F.struct((F.when(x["body"] == F.col("body"), own).otherwise(0) - x["c"]).alias("less"), x["body"].alias("body")))
    out = out.withColumn("rest", F.array_sort(F.filter(rest, lambda x: x["less"] < 0)))
    count = lambda i: F.least(F.coalesce(-F.try_element_at("rest", F.lit(i))["less"], F.lit(0)), F.lit(7))
    hit = F.coalesce(F.col("body") == F.try_element_at("rest", F.lit(1))["body"], F.lit(False))
    out = out.select("row", "held_out", (count(1) * 8 + count(2)).cast("int").alias("state"), hit.alias("hit"), "spelled")
    return out.groupBy("row", "held_out", "state", "hit").agg(F.count("*").alias("n"), F.sum("spelled").alias("spelled"))


def score_documents(docs: DataFrame, train: Column) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every whole text.

    Learns from the rows where ``train`` holds (a null counts as held out). Null text: empty, its only token is the
    end. base_score: smoothed unigrams. score: log10 probability under the mixing model; of a training text under the
    match model of all other training texts. Without training rows both are those of the smoothing and of untrained
    weights. Repeated rows are scored each; null ids are kept; other columns don't matter.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))
    learned = rows.where("train")
    counts = materialise(count_words(learned), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where("n >= 2").orderBy(F.desc("n"), "word").limit(VOCABULARY).toPandas()  # a fixed bound
    floor = float(n) + 0.1 * (float(v) + 1)
    base = spark.sparkContext.broadcast({w.encode(): b for w, b in zip(top["word"], np.log10((top["n"].to_numpy() + 0.1) / floor).tolist(), strict=True)})

    cells = count_cells(counts, v)
    full = Mixer(cells)
    fit(full, count_outcomes(counts, v, cells))
    model, name = spark.sparkContext.broadcast(full), uuid.uuid4().hex
    del cells

    def run(batches):
        if _lexicons.get("id") != name:  # a worker keeps it from task to task
            _lexicons.clear()
            _lexicons.update(id=name, lexicon=Lexicon(model.value, base.value))
        lexicon = _lexicons["lexicon"]
        for batch in batches:
            yield from (scored_rows(lexicon, part) for part in blocks(batch))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {id_type}, {SCORED}")
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # words outside the workers' vocabulary get their exact counts by a join
    rare = scored.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.1) / F.lit(floor))).alias("rare_base"), F.count("n").alias("rare_known"))
    # forecasts: how often each state's came true among the training texts gives its odds
    matched = materialise(_matched(scored), "matched")
    held_up = matched.where("not held_out and state > 0").groupBy("state").agg(F.sum(F.when(F.col("hit"), F.col("n")).otherwise(0)).alias("hits"), F.sum("n").alias("all")).collect()  # at most 63 rows
    chance = {r["state"]: (r["hits"] + 0.4) / (r["all"] + 0.8) for r in held_up}
    odds = F.coalesce(F.try_element_at(F.create_map(*[x for s, p in chance.items() for x in (F.lit(s), F.lit(p))]), F.col("state")), F.lit(0.5)) if chance else F.lit(0.5)
    cost = F.when(F.col("state") == 0, F.col("spelled")).when(F.col("hit"), F.col("n") * F.log10(odds)).otherwise(F.col("n") * F.log10(1 - odds) + F.col("spelled"))
    rest = matched.groupBy("row").agg(F.sum(cost).alias("rest"))
    out = scored.drop("rare", "context", "body", "once", "spelled").join(rare, "row", "left").join(rest, "row", "left")
    score = F.col("opening") + F.coalesce("rest", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score / F.log10(F.lit(2.0)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def training_rows(doc_id: Column) -> Column:
    """Rows whose crc32(doc_id) mod 10 is not 0."""
    return crc_mod(doc_id, 10) != 0
