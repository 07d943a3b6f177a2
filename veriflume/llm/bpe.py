"""BPE encoding and decoding with a deterministic tokenization automaton.

The merge list is compiled once: starting from one state that loops on every base symbol, each merge ``u v -> uv`` adds
a gadget in priority order. The gadget bars ``v`` behind ``u`` (splitting the state behind ``u`` from its sharers) and
gives every state that has a ``u`` arc a ``uv`` arc to where ``v`` leads. The resulting automaton accepts exactly one
tokenization of each word. Which arc leads on depends on what follows, so encoding tries a state's arcs with the longest
label first and steps back where none leads to the word's end; every step is a transition of the automaton, and the
path found is the only one. Decoding emits the labels of the arcs that the ids name.

States are stored as differences (what a gadget barred, and from which state it was split), not as dense rows: a
vocabulary of 50,000 tokens would need billions of cells. Looked-up cells are remembered in a bounded table.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import need

#: Code points with the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Distinct chunks of text whose encoding a worker remembers.
CHUNK_MEMO = 500_000
#: Distinct words, after normalising, whose ids a worker remembers.
WORD_MEMO = 600_000
#: Transition cells that a worker remembers.
CELL_MEMO = 1_500_000


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class MergeAutomaton:
    """Deterministic automaton over token ids, compiled from a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix, self.label = suffix, {i: s for s, i in vocab.items()}
        made: dict[int, tuple[int, int, int]] = {}  # token: merge number, left part, right part
        self.parent, self.since, self.barred = [-1], [0], [{}]
        steps = [(vocab[u], vocab[v], vocab[u + v]) for u, v in merges]
        products = {t for *_, t in steps}
        self.made, self.base = made, {i for i in self.label if i not in products}
        self.target = dict.fromkeys(self.base, 0)
        sharers = {0: len(self.base) + 1}  # the start counts as a sharer of state 0
        self.cells: dict[int, bool] = {}
        for k, (u, v, t) in enumerate(steps, 1):
            if u not in self.target or v not in self.target or t in self.target or not self.has_arc(self.target[u], v, k - 1):
                continue  # u never stands before v: this gadget changes nothing
            behind_u, behind_v = self.target[u], self.target[v]
            if sharers[behind_u] > 1 or u == v:
                self.parent.append(behind_u)
                self.since.append(k)
                self.barred.append({})
                sharers[behind_u] -= 1
                self.target[u] = len(self.parent) - 1
                sharers[self.target[u]] = 1
            self.barred[self.target[u]][v] = k
            made[t] = (k, u, v)
            self.target[t] = behind_v
            sharers[behind_v] += 1
        self.token = {self.label[t]: t for t in self.target}
        self.reach: dict[str, int] = {}  # longest label by its first three characters (or fewer)
        for label in self.token:
            for k in (1, 2, 3):
                self.reach[label[:k]] = max(self.reach.get(label[:k], 0), len(label))

    def has_arc(self, state: int, token: int, merges_done: int) -> bool:
        """Whether ``state`` has an arc for ``token`` once the first ``merges_done`` gadgets are in."""
        while True:
            at, until = state, merges_done
            while at >= 0:
                barred = self.barred[at].get(token)
                if barred is not None and barred <= until:
                    return False
                until = min(until, self.since[at])
                at = self.parent[at]
            if token not in self.made:
                return True
            merges_done, token, _ = self.made[token]

    def step(self, state: int, token: int) -> bool:
        cell = state << 20 | token
        known = self.cells.get(cell)
        if known is None:
            if len(self.cells) > CELL_MEMO:
                self.cells.clear()
            known = self.cells[cell] = self.has_arc(state, token, len(self.label) + 1_000_000)
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of a pre-split word given in vocabulary symbols; symbols outside the vocabulary are left out.

        Arcs are tried longest label first. A prefix has one tokenization only, so a position that proved a dead end is
        never entered again: at most one visit per position.
        """
        n, find, step, target, suffix = len(word), self.token.get, self.step, self.target, self.suffix
        reach = self.reach
        whole = find(word + suffix)
        path: list[tuple[int, int, int]] = []
        dead: set[int] = set()
        at = state = 0
        if whole is not None and n == 1:
            return [whole]
        while at < n:
            for end in range(min(n, at + reach.get(word[at : at + 3], 2)), at, -1):
                if end in dead:
                    continue
                token = find(word[at:end] + suffix if end == n else word[at:end])
                if token is not None and (not at or step(state, token)):
                    path.append((at, state, token))
                    at, state = end, target[token]
                    break
            else:
                dead.add(at)
                if not path:  # an unknown symbol
                    known = [c for i, c in enumerate(word) if (c + suffix if i == n - 1 else c) in self.token]
                    return self.encode("".join(known)) if len(known) < n else []
                at, state, _ = path.pop()
        return [token for *_, token in path]


class BpeTokenizer:
    """Encodes and decodes like a ``tokenizers`` JSON file of kind BPE (normaliser, split pattern, byte alphabet)."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = MergeAutomaton(model["vocab"], pairs, model.get("end_of_word_suffix") or "")
        self.special = {a["content"]: a["id"] for a in d["added_tokens"]}
        self.label = self.automaton.label | {i: s for s, i in self.special.items()}
        kinds = [x["type"] for x in (d["normalizer"] or {}).get("normalizers", [d["normalizer"] or {"type": ""}])]
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        pre = (d["pre_tokenizer"] or {}).get("pretokenizers", [d["pre_tokenizer"]])
        split = next((x["pattern"]["Regex"] for x in pre if x and x["type"] == "Split"), None)
        if split is None:  # the pattern that byte-level files imply
            split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            chunk = f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
        else:
            chunk = f"[^{WHITE}]+"  # white space is dropped
        # \s and \S in terms of White_Space, which the Rust engine means by them
        inside = regex.sub(r"\[\^\\s", lambda _: f"[^{WHITE}", split)
        self.words = regex.compile(inside.replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))
        self.chunks = re.compile(chunk)
        self.bytes = byte_alphabet()
        self.from_bytes = {c: b for b, c in enumerate(self.bytes)}
        self.byte_decoder = (d["decoder"] or {}).get("type") == "ByteLevel"
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memo: dict[str, tuple[int, str, str]] = {}
        self.word_memo: dict[str, list[int]] = {}

    def normalise(self, chunk: str) -> str:
        if chunk.isascii():
            return chunk.lower() if self.lower else chunk
        chunk = unicodedata.normalize("NFC", chunk) if self.nfc else chunk
        return "".join(c.lower() for c in chunk) if self.lower else chunk

    def encode_chunk(self, chunk: str) -> list[int]:
        alphabet, out = self.bytes, []
        for word in self.words.findall(self.normalise(chunk)):
            ids = self.word_memo.get(word)
            if ids is None:
                ids = self.automaton.encode("".join([alphabet[b] for b in word.encode()]))
                if len(self.word_memo) >= WORD_MEMO:
                    self.word_memo.clear()
                if len(word) < 100:
                    self.word_memo[word] = ids
            out += ids
        return out

    def parts(self, text: str) -> Iterator[tuple[int, str, str]]:
        """Per chunk: number of ids, the ids and their labels, both joined by one space."""
        memo = self.memo
        for piece in self.cut.split(text) if self.cut and self.cut.search(text) else (text,):
            if piece in self.special:
                yield 1, str(self.special[piece]), piece
                continue
            for chunk in self.chunks.findall(piece):
                got = memo.get(chunk)
                if got is None:
                    ids = self.encode_chunk(chunk)
                    got = len(ids), " ".join(map(str, ids)), " ".join([self.label[i] for i in ids])
                    if len(memo) >= CHUNK_MEMO:
                        memo.clear()
                    if len(chunk) < 100:
                        memo[chunk] = got
                yield got

    def encode(self, text: str) -> list[int]:
        return [int(i) for n, ids, _ in self.parts(text) if n for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Labels of the arcs: joined by spaces, or, with a byte-level decoder, turned back into UTF-8 text."""
        labels = [self.label[i] for i in ids if i in self.label]
        if not self.byte_decoder:
            return " ".join(labels)
        out = bytearray()
        for s in labels:
            if s in self.special or any(c not in self.from_bytes for c in s):
                out += s.encode()
            else:
                out += bytes(self.from_bytes[c] for c in s)
        return out.decode("utf-8", "replace")


_built: dict[str, BpeTokenizer] = {}


def tokenizer(spec: str) -> BpeTokenizer:
    """The compiled tokenizer of this worker process."""
    key = hashlib.md5(spec.encode()).hexdigest()
    if key not in _built:
        _built[key] = BpeTokenizer(spec)
        gc.freeze()  # the tables live as long as the worker; looking through them for garbage is in vain
        gc.set_threshold(300_000)
    return _built[key]


def load_spec(path: str) -> str:
    """Read a tokenizer file on the driver; executors get its text by broadcast (its size is that of the vocabulary)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>, decoded`` of every whole text.

    Null text: no ids. Empty text: no ids. Repeated rows are each encoded. Other columns are ignored.
    """
    need(docs, id_col, text_col)
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        t = tokenizer(spec.value)
        for pdf in batches:
            ids = [t.encode(x or "") for x in pdf.text]
            yield pd.DataFrame({"id": pdf.id, "ids": ids, "decoded": [t.decode(i) for i in ids]})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {id_type}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the decoded text, ids never stored.

    Null and empty texts have no tokens and the digest of the empty string. No shuffle; memory is one Arrow batch plus
    two bounded tables.
    """
    need(docs, id_col, text_col)
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        t = tokenizer(spec.value)
        for pdf in batches:
            n, a, b = [], [], []
            for text in pdf.text:
                got = [p for p in t.parts(text) if p[0]] if text else []
                n.append(sum([p[0] for p in got]))
                a.append(sha(" ".join([p[1] for p in got])))
                b.append(sha(t.decode([int(i) for p in got for i in p[1].split(" ")]) if t.byte_decoder else " ".join([p[2] for p in got])))
            yield pd.DataFrame({"doc_id": pdf.doc_id, "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(run, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
