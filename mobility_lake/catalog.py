"""One place that decides where each table and checkpoint lives."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "index", "gold", "landing", "rejects", "mart")


@dataclass(frozen=True)
class Lake:
    """Paths under one root, so a writer and its readers cannot drift apart."""

    root: str

    def table(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{layer}/{name}"
