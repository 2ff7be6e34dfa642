"""Settings of commands: strict, with defaults, from and to JSON."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field

from shelf.operators.language import ALIASES


@dataclass(frozen=True)
class LanguageSettings:
    canonicalize: bool = True
    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))
    fallback_locales: tuple[str, ...] = ("en", "ru", "bg")
    ignore_patterns: tuple[str, ...] = (r"^\?+$",)


@dataclass(frozen=True)
class Settings:
    """What commands share. library names the collection; parse is title, description or fingerprint."""

    library: str = ""
    parse: str = "description"
    content_hash: bool = False
    disambiguate_authors: bool = True
    compression: str = "zst"
    rollup_bytes: int = 2_000_000_000
    language: LanguageSettings = field(default_factory=LanguageSettings)

    def __post_init__(self) -> None:
        if self.parse not in ("title", "description", "fingerprint"):
            raise ValueError(f"parse is {self.parse!r}")
        if self.compression not in ("none", "gz", "zst", "zip"):
            raise ValueError(f"compression is {self.compression!r}")
        if self.rollup_bytes <= 0:
            raise ValueError("rollup_bytes must be positive")


def _strict(kind, values: dict):
    known = {f.name: f for f in dataclasses.fields(kind)}
    if unknown := set(values) - set(known):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def settings_from(values: dict) -> Settings:
    """Settings from a mapping; a key that is none of them is an error."""
    nested = dict(values)
    if "language" in nested:
        nested["language"] = _strict(LanguageSettings, nested["language"])
    return _strict(Settings, nested)


def load_settings(path: str | None) -> Settings:
    """Settings of a JSON file, or the defaults."""
    if not path:
        return Settings()
    with open(path, encoding="utf-8") as f:
        return settings_from(json.load(f))


def dump_settings(settings: Settings) -> str:
    """All settings as JSON."""
    return json.dumps(dataclasses.asdict(settings), indent=2, ensure_ascii=False)
