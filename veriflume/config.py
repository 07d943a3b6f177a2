"""Settings of the stages. Values are fixed by the result contract unless a caller overrides them."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class VerifyConfig:
    bm25_topk: int = 20
    cos_thresh: float = 0.82
    fuzzy_thresh: int = 85
    jaccard_thresh: float = 0.65
    near_exact: int = 97
    short_len: int = 60
    short_fuzzy: int = 92
    short_cos: float = 0.84
    long_len: int = 200
    long_cos: float = 0.78
    bonus: float = 0.02
    max_window: int = 3
    encoder: str = "token-counts"


# Cue terms. A term that ends in a space is counted as a substring, others as whole words.
CONTRAST = ("however", "but", "although", "though", "nevertheless", "nonetheless", "yet", "whereas", "on the other hand", "in contrast", "despite", "while")
LIMITATION = ("may", "might", "could", "suggest", "suggests", "suggested", "possibly", "likely", "unlikely", "uncertain", "limited", "limitation", "caution", "inconclusive", "preliminary", "assumption", "assume")
NEGATION = ("no ", "not ", "never", "none", "without", "fail to", "fails to", "cannot", "can't")


@dataclass(frozen=True)
class TriageConfig:
    """Field names are the keys of a settings file."""

    bm25_topk: int = 30
    embed_rerank_topk: int = 10
    min_claim_chars: int = 20
    query_field: str = "quote_from_report"
    window_sentences: int = 2
    window_stride: int = 1
    max_source_chars: int = 2_000_000
    contrast_markers: tuple[str, ...] = CONTRAST
    limitation_markers: tuple[str, ...] = LIMITATION
    negation_markers: tuple[str, ...] = NEGATION
    recommend_nli_if_any_contrast: bool = True
    recommend_nli_if_limitation_hits: int = 2
    recommend_nli_if_negation_hits: int = 1
    min_embed_cosine: float = 0.25

    @classmethod
    def overlay(cls, path: str | None) -> TriageConfig:
        """Defaults with the keys of a JSON file over them; a missing file raises, unknown keys are ignored."""
        if not path:
            return cls()
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        known = {x.name for x in fields(cls)}
        return replace(cls(), **{k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known})
