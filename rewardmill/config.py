"""Settings of ingestion, grooming and training; the defaults are the documented ones."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from rewardmill.functions import names


@dataclass(frozen=True)
class LayoutConfig:
    """Partition layout and compaction."""

    max_rows: int = 10_000
    max_files_per_group: int = 500
    max_key_bytes: int | None = 204_800  #: None: no bound on a turn's paths
    max_groom_iterations: int = 30


@dataclass(frozen=True)
class TrainConfig:
    """Hyperparameters of the two training phases."""

    version: str = "1"
    test_split: float = 0.3
    clip_min_propensity: float = 0.0001
    context_keep: float = 0.95
    reward_prior_count: float = 300.0
    prune_min_string_count: int = 20
    max_trees: int = 150
    propensity_trees: int = 200
    tree_depth: int = 6
    max_features: int = 1_000
    max_strings_per_feature: int = 10_000
    explore: bool = True
    normalize_rewards: bool = True
    binary_rewards: bool = False
    max_checkpoint_age: str = "0 seconds"
    seed: int = 17
    max_json_depth: int = 4  #: levels flattened between looks for deeper ones


@dataclass(frozen=True)
class Job:
    """What one model's training is run with: its schedule, its resources, its settings."""

    model: str
    schedule: str | None
    runtime_seconds: int | None
    volume_gb: int | None
    train: TrainConfig
    limits: dict[str, int]


def with_settings(config: TrainConfig, given: Mapping) -> tuple[TrainConfig, dict[str, int]]:
    """``config`` with the given values, read as their fields' types, and what else was given
    (whole numbers, such as bounds on records)."""
    known = {f.name: type(getattr(config, f.name)) for f in fields(config)}
    own, rest = {}, {}
    for name, value in given.items():
        if name not in known:
            rest[name] = int(value)
        elif known[name] is bool:
            own[name] = value if isinstance(value, bool) else names.parse_flag(value)
        else:
            own[name] = known[name](value)
    return replace(config, **own), rest


def jobs(settings: Mapping) -> list[Job]:
    """A training job for every model of a settings tree (``training`` and ``models``): what a
    model doesn't set itself comes from ``training``, setting by setting."""
    for name in ("organization", "project"):
        if not re.fullmatch("[a-z0-9]+", settings.get(name) or ""):
            raise ValueError(f"{name}: lower-case letters and digits only")
    common, models = settings.get("training") or {}, settings.get("models") or {}
    if not isinstance(models, Mapping):
        raise ValueError("models: not a mapping")
    out = []
    for model, own in models.items():
        if not re.fullmatch(names.MODEL_NAME.strip("^$"), model):
            raise ValueError(f"models: invalid name {model!r}")
        if not isinstance(own or {}, Mapping):
            raise ValueError(f"models.{model}: not a mapping")
        mine = (own or {}).get("training") or {}
        both = {**common, **mine}
        given = {**(common.get("hyperparameters") or {}), **(mine.get("hyperparameters") or {})}
        train, limits = with_settings(TrainConfig(), given)
        runtime, volume = both.get("max_runtime"), both.get("volume_size")
        out.append(Job(
            model, both.get("schedule"), None if runtime is None else names.parse_runtime(runtime),
            None if volume is None else names.parse_volume(volume), train, limits,
        ))
    return out
