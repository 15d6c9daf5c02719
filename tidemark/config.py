"""Settings of a reader: a properties file, then overrides, then defaults."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class ReaderConfig:
    slot: str
    path: str
    format: str = "binary"
    task: str = "task"
    roll_records: int = 100_000
    roll_seconds: int = 600
    two_phase: bool = False
    tables: str = ""

    @classmethod
    def load(cls, file: str | None = None, **overrides: object) -> ReaderConfig:
        """Required keys are those without a default; unknown keys and values of a wrong form are errors."""
        given: dict[str, object] = {}
        for line in Path(file).read_text().splitlines() if file else ():
            if line.strip() and not line.lstrip().startswith("#"):
                key, _, value = line.partition("=")
                given[key.strip().replace("-", "_").replace(".", "_")] = value.strip()
        given |= {k: v for k, v in overrides.items() if v is not None}
        known = {f.name: f for f in fields(cls)}
        if unknown := set(given) - set(known):
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        if missing := [n for n in ("slot", "path") if not given.get(n)]:
            raise ValueError(f"settings missing: {', '.join(missing)}")
        convert = {"int": int, "bool": lambda v: str(v).lower() in ("true", "1", "yes"), "str": str}
        out = cls(**{k: convert[known[k].type](v) for k, v in given.items()})
        if out.format not in ("binary", "sql", "json", "log"):
            raise ValueError(f"unknown format {out.format}")
        return out

    def same_slot(self, two_phase: bool) -> None:
        """A slot that exists keeps its two-phase setting."""
        if two_phase != self.two_phase:
            raise ValueError(f"slot {self.slot} exists with two_phase={two_phase}")
