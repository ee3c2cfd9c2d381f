"""Settings of the library, and reading them from a file."""

from __future__ import annotations

import json
import tomllib
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path


def _within(name: str, value: float, least: float, most: float = float("inf")) -> None:
    if not least <= value <= most:
        raise ValueError(f"{name} lies between {least} and {most}: {value}")


@dataclass(frozen=True)
class TokenizationConfig:
    """``include_whitespace`` keeps structural tokens; tokens are those of Unicode classes whatever the language."""

    tokenizer: str = "unicode"
    include_whitespace: bool = False
    language: str = "en"


@dataclass(frozen=True)
class TopologyConfig:
    """Layer types to look for (all by default), and how deep they may nest."""

    layer_types_to_detect: tuple[str, ...] | None = None
    nesting_depth_limit: int = 10

    def __post_init__(self) -> None:
        _within("nesting_depth_limit", self.nesting_depth_limit, 1)


@dataclass(frozen=True)
class CorrelationConfig:
    """How near a caption stands, the scores that are enough, and the share of overlap (in percent) that is a conflict.

    ``vectors`` says where the similarity of blocks comes from: ``none`` (similarity 0), or ``letters``, the frequencies of
    letters, which need no model.  A relation ``block_vectors`` that is given goes before both.
    """

    proximity: int = 50
    caption_threshold: float = 0.7
    figure_threshold: float = 0.6
    conflict_percent: float = 10.0
    vectors: str = "none"

    def __post_init__(self) -> None:
        _within("proximity", self.proximity, 0)
        if self.vectors not in ("none", "letters"):
            raise ValueError(f"vectors are none or letters: {self.vectors}")


@dataclass(frozen=True)
class SemanticConfig:
    """Extractors are named, models are not part of the library; paragraphs of more words may be split at a marker."""

    topic_extractor: str = "heading"
    predicate_extractor: str = "pattern"
    entity_extractor: str = "pattern"
    relationship_extractor: str = "pattern"
    entity_resolver: str = "label"
    segmentation_threshold_words: int = 150

    def __post_init__(self) -> None:
        _within("segmentation_threshold_words", self.segmentation_threshold_words, 50)


@dataclass(frozen=True)
class AggregationConfig:
    entity_merge_strategy: str = "weighted"
    conflict_resolution: str = "confidence_vote"
    topic_clustering: str = "embedding"
    confidence_scorer: str = "statistical"
    min_confidence_threshold: float = 0.0

    def __post_init__(self) -> None:
        _within("min_confidence_threshold", self.min_confidence_threshold, 0.0, 1.0)


@dataclass(frozen=True)
class GraphConfig:
    """Where stages are written, and how often Spark tries a task; both go into the session, see ``apply``."""

    checkpoint_path: str | None = None
    max_task_failures: int = 4

    def apply(self, spark) -> None:
        if self.checkpoint_path:
            spark.conf.set("spark.checkpoint.dir", self.checkpoint_path)


@dataclass(frozen=True)
class Config:
    """All settings."""

    tokenization: TokenizationConfig = field(default_factory=TokenizationConfig)
    topology: TopologyConfig = field(default_factory=TopologyConfig)
    correlation: CorrelationConfig = field(default_factory=CorrelationConfig)
    semantic: SemanticConfig = field(default_factory=SemanticConfig)
    aggregation: AggregationConfig = field(default_factory=AggregationConfig)
    graph: GraphConfig = field(default_factory=GraphConfig)

    def as_dict(self) -> dict:
        return asdict(self)


def from_dict(values: dict, kind: type = Config):
    """Settings from nested dictionaries; what is left out keeps its default, an unknown name is an error."""
    known = {f.name: f for f in fields(kind)}
    if unknown := set(values) - set(known):
        raise ValueError(f"{kind.__name__} has no {', '.join(sorted(unknown))}")
    made = {}
    for name, value in values.items():
        default = known[name].default_factory() if callable(known[name].default_factory) else known[name].default
        if is_dataclass(default):
            value = from_dict(value, type(default))
        made[name] = tuple(value) if isinstance(value, list) else value
    return kind(**made)


def load_config(path: str) -> Config:
    """Settings from a JSON or TOML file, or a YAML file where a YAML reader is installed."""
    text, kind = Path(path).read_text(encoding="utf-8"), Path(path).suffix.lower()
    if kind == ".toml":
        return from_dict(tomllib.loads(text))
    if kind in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading YAML needs a YAML reader; use JSON or TOML") from missing
        return from_dict(yaml.safe_load(text) or {})
    return from_dict(json.loads(text))
