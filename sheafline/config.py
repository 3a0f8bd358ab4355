"""Profiles: settings of a run read from YAML into a frozen dataclass, each value coerced to its field's type; unknown keys are warned of."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, fields, replace
from pathlib import Path
from typing import Any

import yaml


@dataclass(frozen=True)
class Profile:
    """Thresholds and lists of the intake; the defaults hold where a file says nothing."""

    system_marks: tuple[str, ...] = ("~$", ".tmp", "thumbs.db")
    personal_marks: tuple[str, ...] = ("входящие",)
    spared_marks: tuple[str, ...] = ("obsh/",)
    least_bytes: int = 512
    most_bytes: int = 200 << 20
    chunk_size: int = 500
    chunk_overlap: int = 50
    least_chunk: int = 30
    near_bits: int = 6
    good_score: float = 0.75
    keep_ratio: float = 0.5
    unreadable_below: float = 0.35
    unreadable_share: float = 0.6
    doubtful_below: float = 0.65
    max_age_years: int = 5


def _coerce(name: str, kind: str, value: Any) -> Any:
    if value is None:
        raise ValueError(f"{name} has no value")
    if kind.startswith("tuple"):
        return tuple(str(v) for v in ([value] if isinstance(value, str) else value))
    if kind == "int":
        number = float(value)
        if number != int(number):
            raise ValueError(f"{name} needs a whole number, not {value!r}")
        return int(number)
    return float(value) if kind == "float" else str(value)


def load_profile(path: str | Path, base: Profile | None = None) -> Profile:
    """The profile at ``path`` over ``base`` (the defaults). A missing file or an empty one gives the base; a value of a wrong type raises."""
    base = base or Profile()
    path = Path(path)
    if not path.exists():
        return base
    said = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    if not isinstance(said, dict):
        raise ValueError(f"{path} must hold a mapping")
    kinds = {f.name: str(f.type) for f in fields(Profile)}
    for key in sorted(set(said) - set(kinds)):
        warnings.warn(f"{path}: unknown setting {key!r}", stacklevel=2)
    return replace(base, **{k: _coerce(k, kinds[k], v) for k, v in said.items() if k in kinds})
