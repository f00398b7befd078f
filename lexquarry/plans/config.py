"""Settings from a TOML file: the table [tool.lexquarry] of the nearest pyproject.toml above a folder."""

from __future__ import annotations

import logging
import time
import tomllib
from dataclasses import fields
from functools import lru_cache
from pathlib import Path

from lexquarry.operators.chunking import ChunkConfig
from lexquarry.operators.embedding import EmbedConfig

#: Folders above the first that are looked at.
LEVELS = 10


@lru_cache
def settings(start: str | None = None) -> dict:
    """The table, or an empty one if there is no file or no table."""
    folder = Path(start or ".").resolve()
    for place in [folder, *folder.parents][: LEVELS + 1]:
        file = place / "pyproject.toml"
        if file.is_file():
            return tomllib.loads(file.read_text(encoding="utf-8")).get("tool", {}).get("lexquarry", {})
    return {}


def _made(kind: type, values: dict):
    known = {f.name for f in fields(kind)}
    if unknown := values.keys() - known:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return kind(**values)


def chunk_config(start: str | None = None) -> ChunkConfig:
    return _made(ChunkConfig, settings(start).get("chunking", {}))


def embed_config(start: str | None = None) -> EmbedConfig:
    return _made(EmbedConfig, settings(start).get("embedding", {}))


def log_to(folder: str, name: str = "lexquarry") -> Path:
    """Everything to a file with the time in its name, warnings to the console."""
    path = Path(folder) / f"{name}-{time.strftime('%Y%m%d-%H%M%S')}.log"
    path.parent.mkdir(parents=True, exist_ok=True)
    root = logging.getLogger(name)
    root.setLevel(logging.DEBUG)
    file, console = logging.FileHandler(path, encoding="utf-8"), logging.StreamHandler()
    file.setLevel(logging.DEBUG)
    console.setLevel(logging.WARNING)
    form = logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s")
    for handler in (file, console):
        handler.setFormatter(form)
        root.addHandler(handler)
    return path
