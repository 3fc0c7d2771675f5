"""Configuration: a JSON or YAML file and the environment, checked and typed."""

from __future__ import annotations

import json
import logging
import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path

from tidegrid.model import BBox, TimeResolution

log = logging.getLogger(__name__)

SYSTEM_KEYS = ("compiled", "bathy", "moon")


@dataclass(frozen=True)
class KeyConfig:
    """One variable key: where it comes from and what is kept of it."""

    source: str = ""
    variables: tuple[str, ...] = ()
    compiled: tuple[str, ...] = ()
    bbox: tuple[float, float, float, float] | None = None
    depth: tuple[float, float] | None = None
    dataset_rep: str | None = None
    dataset_nrt: str | None = None
    date_pattern: str | None = None
    range_mode: bool = False
    raw_include: str | None = None
    time_resolution: str = "year"

    def __post_init__(self) -> None:
        if self.bbox is not None:
            box = BBox(*self.bbox)
            if not (-180 <= box.xmin and box.xmax <= 180 and -90 <= box.ymin and box.ymax <= 90):
                raise ValueError(f"box out of range: {self.bbox}")
        if self.depth is not None and self.depth[0] > self.depth[1]:
            raise ValueError(f"depths out of order: {self.depth}")
        if self.range_mode and (not self.date_pattern or re.compile(self.date_pattern).groups != 2):
            raise ValueError("a range of dates needs a pattern with two groups")
        TimeResolution(self.time_resolution)


@dataclass(frozen=True)
class AppConfig:
    store_root: str = "."
    downloads_root: str = "downloads"
    keys: Mapping[str, KeyConfig] = field(default_factory=dict)
    attributes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def key(self, name: str) -> KeyConfig:
        validate_keys([name], self.keys)
        return self.keys[name]

    def downloadable(self) -> list[str]:
        return [k for k in self.keys if k not in SYSTEM_KEYS]

    def variable_attributes(self, name: str) -> dict[str, str]:
        """Attributes of a variable over those that all have (the entry "global")."""
        return {**self.attributes.get("global", {}), **self.attributes.get(name, {})}

    def column_groups(self) -> dict[str, str]:
        """The key of each compiled column."""
        return {c: k for k, v in self.keys.items() for c in v.compiled}


def validate_keys(names: Sequence[str], known: Mapping[str, object]) -> None:
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"no such variable: {', '.join(missing)}; there are {', '.join(sorted(known))}")


def normalized(wanted, known: Mapping[str, KeyConfig]) -> dict[str, list[str] | None]:
    """What to extract: None for all, a key, keys, or columns by key."""
    if wanted is None:
        return {k: None for k in known if k not in SYSTEM_KEYS}
    if isinstance(wanted, str):
        wanted = [wanted]
    if isinstance(wanted, Mapping):
        out = {k: [v] if isinstance(v, str) else list(v) if v is not None else None for k, v in wanted.items()}
    elif isinstance(wanted, Sequence):
        out = dict.fromkeys(wanted)
    else:
        raise TypeError(f"not a choice of variables: {wanted!r}")
    validate_keys(list(out), known)
    return out


def parse(raw: Mapping) -> AppConfig:
    known = {"store_root", "downloads_root", "keys", "attributes"}
    for extra in sorted(set(raw) - known):
        log.warning("unknown setting: %s", extra)
    keys = {}
    for name, entry in (raw.get("keys") or {}).items():
        keys[name] = KeyConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in (entry or {}).items()})
    return AppConfig(os.environ.get("TIDEGRID_STORE") or raw.get("store_root", "."), raw.get("downloads_root", "downloads"), keys, raw.get("attributes") or {})


def load(path: str | Path) -> AppConfig:
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return parse(json.loads(text))
    try:
        import yaml
    except ImportError as x:
        raise RuntimeError("YAML files need the yaml package; use JSON") from x
    return parse(yaml.safe_load(text) or {})


@lru_cache
def settings(path: str | None = None) -> AppConfig:
    """The configuration file named, or config.json in this folder or one above it."""
    if path:
        return load(path)
    for folder in (Path.cwd(), *Path.cwd().parents):
        if (folder / "config.json").exists():
            return load(folder / "config.json")
    return AppConfig()
