"""Strategies, collections and evaluation combinations, built in or read from a file."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

SIZE, OVERLAP = 800, 100


@dataclass(frozen=True)
class Strategy:
    name: str
    collection: str
    chunking: str
    model: str
    chunk_size: int = SIZE
    chunk_overlap: int = OVERLAP
    description: str = ""


@dataclass(frozen=True)
class Config:
    """Index strategies by name, and the combinations of collection and retrieval that an evaluation runs."""

    strategies: dict[str, Strategy]
    combos: tuple[str, ...]

    def strategy(self, name: str) -> Strategy:
        if name not in self.strategies:
            raise ValueError(f"Unknown strategy {name!r}; there are {', '.join(sorted(self.strategies))}")
        return self.strategies[name]

    def model_of(self, collection: str) -> str:
        """The embedder of the first strategy that fills the collection."""
        for s in self.strategies.values():
            if s.collection == collection:
                return s.model
        raise ValueError(f"no strategy fills the collection {collection!r}")


def combos_of(strategies: Iterable[Strategy]) -> tuple[str, ...]:
    return tuple(f"{c}__{r}" for c in dict.fromkeys(s.collection for s in strategies) for r in RETRIEVALS)


def load(path: str | Path) -> Config:
    """Reads a YAML file (or JSON, for which no other library is needed).

    index_strategies: by name collection_name, chunking, embedding_model, and perhaps chunk_size, chunk_overlap and description.
    eval_combos: a list; without it every collection is combined with every retrieval. Other entries don't matter.
    """
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        found = json.loads(text)
    else:
        import yaml

        found = yaml.safe_load(text)
    strategies = {}
    for name, own in (found.get("index_strategies") or {}).items():
        lacking = [k for k in ("collection_name", "chunking", "embedding_model") if not own.get(k)]
        if lacking:
            raise ValueError(f"{name} in {path} lacks {', '.join(lacking)}")
        strategies[name] = Strategy(name, own["collection_name"], own["chunking"], own["embedding_model"], int(own.get("chunk_size", SIZE)), int(own.get("chunk_overlap", OVERLAP)), " ".join(str(own.get("description", "")).split()))
    combos = tuple(found["eval_combos"]) if found.get("eval_combos") else combos_of(strategies.values())
    for c in combos:
        parse_combo(c)
    return Config(strategies, combos)


def parse_combo(combo: str) -> tuple[str, str]:
    found = re.fullmatch(r"(.+?)__(.+)", combo, re.S)
    if not found or found[1].startswith("__"):
        raise ValueError(f"no combination of collection and strategy: {combo!r}")
    return found[1], found[2]


RETRIEVALS = ("cosine", "rerank", "hybrid", "rerank_hybrid")
#: Names of models, strategies and their collections (fixed values: users' collections have these names).
MINILM, BGE = "all-MiniLM-L6-v2", "BAAI/bge-small-en-v1.5"
BUILT_IN = (
    Strategy("idx_markdown_minilm", "baseline", "markdown", MINILM, description="sections of markdown, the small embedder"),
    Strategy("idx_recursive_minilm", "recursive_minilm", "recursive", MINILM, description="paragraphs, lines and words"),
    Strategy("idx_semantic_minilm", "semantic_minilm", "semantic", MINILM, chunk_overlap=0, description="cuts where neighbouring sentences differ most"),
    Strategy("idx_markdown_bge", "bge", "markdown", BGE, description="sections of markdown, the embedder with the longer context"),
)
DEFAULT = Config({s.name: s for s in BUILT_IN}, combos_of(BUILT_IN))
STRATEGIES, EVAL_COMBOS = DEFAULT.strategies, DEFAULT.combos
get_strategy, model_of_collection = DEFAULT.strategy, DEFAULT.model_of
