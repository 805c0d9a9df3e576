"""Versioned snapshots: a folder per kind, a folder per instance, the last name is the latest."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

KINDS = ("training", "models", "predictions", "reports")


@dataclass(frozen=True)
class Snapshot:
    root: Path
    kind: str
    name: str

    @property
    def path(self) -> Path:
        return Path(self.root) / self.kind / self.name

    def exists(self) -> bool:
        return self.path.exists()

    def create(self) -> Snapshot:
        self.path.mkdir(parents=True, exist_ok=True)
        return self

    @property
    def metadata(self) -> dict | None:
        file = self.path / "metadata.json"
        return json.loads(file.read_text()) if file.exists() else None

    def __str__(self) -> str:
        return json.dumps(self.metadata, sort_keys=True, indent=2) if self.metadata else self.name


class SnapshotCollection:
    def __init__(self, root: str | Path, kind: str, prefix: str = "", suffix: str = ""):
        if kind not in KINDS:
            raise ValueError(f"kind is one of {', '.join(KINDS)}")
        self.root, self.kind, self.prefix, self.suffix = Path(root), kind, prefix, suffix

    def keys(self) -> list[str]:
        folder = self.root / self.kind
        return sorted(p.name for p in folder.glob(f"{self.prefix}*{self.suffix}")) if folder.exists() else []

    def list(self) -> list[Snapshot]:
        return [Snapshot(self.root, self.kind, k) for k in self.keys()]

    def is_empty(self) -> bool:
        return not self.keys()

    def __contains__(self, name: str) -> bool:
        return name in self.keys()

    def __getitem__(self, name: str) -> Snapshot | None:
        return Snapshot(self.root, self.kind, name) if name in self else None

    def latest(self) -> Snapshot | None:
        found = self.list()
        return found[-1] if found else None

    def __str__(self) -> str:
        return "\n".join(self.keys())
