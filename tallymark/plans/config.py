"""Settings as frozen dataclasses, from YAML with overrides of mode and data root."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import asdict, dataclass, field, replace

import yaml

from ..functions.text import ABBREVIATIONS, LEGAL_SUFFIXES
from ..operators.blocking import DEFAULT_RULES
from ..operators.features import enabled
from ..operators.metrics import THRESHOLDS

#: Caps on master rows by mode; any other mode counts as dev.
MODES = {"dev": {"train_cap": 50_000, "validation_cap": 10_000}, "final": {"train_cap": None, "validation_cap": None}}


@dataclass(frozen=True)
class Preprocessing:
    legal_suffixes: tuple[str, ...] = LEGAL_SUFFIXES
    abbreviations: dict[str, str] = field(default_factory=lambda: dict(ABBREVIATIONS))


@dataclass(frozen=True)
class Blocking:
    rules: tuple[str, ...] = DEFAULT_RULES
    max_block_size: int = 500
    max_candidates: int = 50


@dataclass(frozen=True)
class Features:
    """off: flags or features that are left out."""

    off: tuple[str, ...] = ()
    max_terms: int = 10_000

    @property
    def columns(self) -> tuple[str, ...]:
        return enabled(self.off)


@dataclass(frozen=True)
class Model:
    kind: str = "gbt"
    iterations: int = 100
    step: float = 0.05
    depth: int = 6
    least: int = 20
    share: float = 0.8


@dataclass(frozen=True)
class Training:
    validation_split: float = 0.2
    max_negatives: int = 20
    prefilter_validation: bool = False
    train_cap: int | None = 50_000
    validation_cap: int | None = 10_000


@dataclass(frozen=True)
class Post:
    threshold: float | None = None
    default: float = 0.5
    thresholds: tuple[float, ...] = THRESHOLDS
    min_name: float = 0.0
    min_address: float = 0.0
    require_country: bool = False


@dataclass(frozen=True)
class Cache:
    """Whether ranked candidates of the same sources and settings are used again."""

    enabled: bool = True
    invalidate: bool = False


PARTS = {"preprocessing": Preprocessing, "blocking": Blocking, "features": Features, "model": Model, "training": Training, "post": Post, "cache": Cache}


@dataclass(frozen=True)
class Config:
    mode: str = "dev"
    data_root: str = "."
    out: str = "output"
    train: dict = field(default_factory=lambda: {f"source{k}": f"data/train/train_source{k}.tsv" for k in (1, 2, 3)} | {"ground_truth": "data/train/train_ground_truth.tsv"})
    test: dict = field(default_factory=lambda: {f"source{k}": f"data/test/test_source{k}.tsv" for k in (1, 2, 3)})
    preprocessing: Preprocessing = field(default_factory=Preprocessing)
    blocking: Blocking = Blocking()
    features: Features = Features()
    model: Model = Model()
    training: Training = Training()
    post: Post = Post()
    cache: Cache = Cache()

    def path(self, relative: str) -> str:
        return relative if os.path.isabs(relative) or "://" in relative else f"{self.data_root}/{relative}"

    def paths(self, part: str) -> dict[str, str]:
        return {k: self.path(v) for k, v in getattr(self, part).items()}

    def candidate_key(self, part: str) -> str:
        """Of what ranked candidates depend on, but for the content of the sources."""
        what = [self.paths(part), asdict(self.preprocessing), self.blocking.rules, self.blocking.max_block_size]
        return hashlib.sha256(json.dumps(what, sort_keys=True).encode()).hexdigest()[:16]


def load_config(path: str | None = None, data_root: str | None = None, mode: str | None = None) -> Config:
    """Defaults where the file or a key is missing; unknown keys are an error."""
    raw = {}
    if path and os.path.exists(path):
        with open(path) as f:
            raw = yaml.safe_load(f) or {}
    parts = {k: kind(**{n: tuple(v) if isinstance(v, list) else v for n, v in raw.pop(k, {}).items()}) for k, kind in PARTS.items()}
    cfg = Config(**raw, **parts)
    cfg.features.columns  # unknown flags are an error at once
    mode = mode or cfg.mode
    mode = mode if mode in MODES else "dev"
    return replace(cfg, mode=mode, data_root=data_root or cfg.data_root, training=replace(cfg.training, **MODES[mode]))
