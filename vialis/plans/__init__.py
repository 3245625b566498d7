"""The layered pipeline: files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layers:
    """Database per layer, with the table names of the pipeline."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def raw(self, name: str) -> str:
        return f"{self.bronze}.{name}"

    def clean(self, name: str) -> str:
        return f"{self.silver}.{name}"

    def derived(self, name: str) -> str:
        return f"{self.gold}.{name}"


DEFAULT = Layers()
