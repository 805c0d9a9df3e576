"""Layered configuration with dotted keys."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

# Keys and defaults.
DEFAULTS: dict[str, Any] = {
    "common.snapshots": "snapshots",
    "scrape.folder": "input",
    "scrape.njobs": 10000,
    "db.name": "jobsDB",
    "db.tags": "tags",
    "db.jobs": "jobs",
    "db.prediction": "prediction",
    "model.k-fold": 5,
}
PATHS = ("common.snapshots", "scrape.folder")


class Config:
    """Values of a JSON file over the defaults; keys have two parts."""

    def __init__(self, filename: str | Path):
        self.filename = Path(filename)
        self.own: dict[str, Any] = json.loads(self.filename.read_text()) if self.filename.exists() else {}

    def get(self, key: str) -> Any:
        value = self.own.get(key, DEFAULTS.get(key))
        return Path(value).expanduser() if key in PATHS and value is not None else value

    def __getitem__(self, key: str) -> Any:
        if key not in self.own and key not in DEFAULTS:
            raise KeyError(key)
        return self.get(key)

    def set(self, key: str, value: Any) -> None:
        if len(key.split(".")) != 2:
            raise ValueError(f"a key has two parts: {key}")
        self.own[key] = str(value) if isinstance(value, Path) else value

    def save(self) -> None:
        self.filename.parent.mkdir(parents=True, exist_ok=True)
        self.filename.write_text(json.dumps(self.own, sort_keys=True, indent=2))

    def as_dict(self) -> dict[str, Any]:
        return DEFAULTS | self.own
