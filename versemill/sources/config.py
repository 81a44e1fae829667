"""Source configuration: one JSON file per labelled text source."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

# Key names of a source's JSON file, and those that may be empty.
REQUIRED_KEYS = (
    "name",
    "csv_name",
    "kagglehub_handle",
    "csv_path",
    "cols_map",
    "language_col",
    "target_language",
    "vectorizer_config",
)
OPTIONAL_VALUES = ("csv_path", "language_col", "target_language")


@dataclass(frozen=True)
class SourceConfig:
    """What one source calls its columns, which language to keep, which words to ignore."""

    name: str
    csv_name: str = ""
    kagglehub_handle: str = ""
    csv_path: str | None = None
    cols_map: Mapping[str, str] = field(default_factory=dict)
    language_col: str | None = None
    target_language: str | None = None
    vectorizer_config: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if bool(self.language_col) != bool(self.target_language):
            raise ValueError(
                f"source {self.name!r}: language_col and target_language go together, one is missing"
            )

    def stop_words(self) -> list[str]:
        """The configured stop words. A bare name like ``english`` raises: lists of that name differ."""
        words = self.vectorizer_config.get("stop_words")
        if isinstance(words, str):
            raise ValueError(f"source {self.name!r}: stop_words must list the words, {words!r} only names a list")
        return list(words or ())


def load_source_config(path: str | Path) -> SourceConfig:
    """Read and check a source's JSON file; any problem raises."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    missing = [key for key in REQUIRED_KEYS if key not in raw]
    if missing:
        raise ValueError(f"{path}: missing keys {missing}")
    values = {key: raw[key] for key in REQUIRED_KEYS}
    values.update({key: raw[key] or None for key in OPTIONAL_VALUES})
    return SourceConfig(**values)
