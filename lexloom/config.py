"""Paths of artifacts and held-out names, from a project's TOML file."""

from __future__ import annotations

import tomllib
from pathlib import Path

from lexloom.errors import CorpusConfigError
from lexloom.types import CorpusPaths

SECTION = ("tool", "lexloom", "corpus")
DEFAULTS = {"artifacts": "data/corpus/artifacts", "holdout": "data/corpus/holdout"}


def resolve(project_root: Path, section: tuple[str, ...] = SECTION) -> CorpusPaths:
    """The configured paths below ``project_root``; a missing file or key gives the default, a blank or absolute path is refused."""
    config = project_root / "pyproject.toml"
    found: object = tomllib.loads(config.read_text(encoding="utf-8")) if config.exists() else {}
    for part in section:
        found = found.get(part, {}) if isinstance(found, dict) else {}
    paths = {}
    for key, default in DEFAULTS.items():
        value = found.get(key, default) if isinstance(found, dict) else default
        if not isinstance(value, str) or not value.strip():
            raise CorpusConfigError(f"{'.'.join(section)}.{key} must be a path, not {value!r}")
        if Path(value).is_absolute():
            raise CorpusConfigError(f"{'.'.join(section)}.{key} must be relative to the project: {value!r}")
        paths[key] = project_root / value
    return CorpusPaths(**paths)


def require_artifacts_dir(paths: CorpusPaths) -> None:
    """An empty folder of artifacts is fine; an absent one, or a file in its place, is not."""
    if not paths.artifacts.exists():
        raise CorpusConfigError(f"{paths.artifacts} doesn't exist")
    if not paths.artifacts.is_dir():
        raise CorpusConfigError(f"{paths.artifacts} isn't a folder")
