"""Run configuration on the driver: .env files, a JSON file that replaces defaults, accessors."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from ..operators.enrich import DOMAINS, PATTERNS
from ..operators.merge import ROLLUPS


def read_env(text: str) -> dict[str, str]:
    """KEY=value lines; blank lines and comments skipped, outer quotes dropped."""
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            key, _, value = line.partition("=")
            out[key.strip()] = value.strip().strip("\"'")
    return out


@dataclass
class Config:
    """Vocabularies, rollups and limits. Unlike defaults merged key by key, a file's section replaces the default's."""

    domains: tuple[str, ...] = DOMAINS
    patterns: tuple[str, ...] = PATTERNS
    rollups: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(ROLLUPS))
    min_bucket_size: int = 1
    first_buckets: int | None = None
    max_cards: int | None = None
    key_by_name: bool = False
    audit_min_size: int = 10
    audit_of: str | None = None
    skip_synthesis: bool = False
    dry_run: bool = False
    max_packages: int | None = None
    packages_of: tuple[str, ...] = ()

    @classmethod
    def load(cls, path: str) -> Config:
        p = Path(path)
        if not p.exists():
            return cls()
        data = json.loads(p.read_text())
        known = {k: v for k, v in data.items() if k in cls.__dataclass_fields__}
        for k in ("domains", "patterns", "packages_of"):
            if k in known:
                known[k] = tuple(known[k])
        if "rollups" in known:
            known["rollups"] = {k: tuple(v) for k, v in known["rollups"].items()}
        return cls(**known)

    def save(self, path: str) -> None:
        Path(path).write_text(json.dumps(self.__dict__, indent=2, ensure_ascii=False))

    @property
    def vocabulary(self) -> tuple[tuple[str, ...], tuple[str, ...]]:
        return self.domains, self.patterns
