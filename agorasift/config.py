"""Settings of a deployment: what the command line and the sources need beside their arguments.

Settings live in one flat table of dotted names, grouped by the part of the engine that reads them.
A JSON file may hold them nested or dotted; the environment wins over files, later files over earlier
ones.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Setting:
    """Default, and what values are allowed."""

    default: Any
    allowed: tuple = ()
    least: float | None = None


#: Every setting that some part reads.
SETTINGS: dict[str, Setting] = {
    "requests.tier": Setting("basic", allowed=("basic", "pro", "academic")),
    "requests.attempts": Setting(5, least=1),
    "requests.base_delay": Setting(2.0, least=0),
    "requests.max_delay": Setting(300.0, least=0),
    "requests.fetch": Setting("recorded"),
    "requests.resume": Setting(""),
    "clean.min_length": Setting(10, least=0),
    "clean.language": Setting("en"),
    "detect.min_score": Setting(0.3, least=0),
    "privacy.salt": Setting(""),
    "store.compression": Setting("snappy", allowed=("snappy", "zstd", "gzip", "none")),
}


def flat(values: Mapping, prefix: str = "") -> dict[str, Any]:
    """Nested mappings as dotted names."""
    out: dict[str, Any] = {}
    for k, v in values.items():
        out |= flat(v, f"{prefix}{k}.") if isinstance(v, Mapping) else {f"{prefix}{k}": v}
    return out


def load(files: Iterable[str | Path] = (), environ: Mapping[str, str] | None = None) -> dict[str, Any]:
    """All settings: defaults, then the files in order (missing ones count as empty), then AGORASIFT_GROUP_NAME variables.

    Unknown names in files are ignored; text from the environment takes the type of the default.
    """
    out = {name: s.default for name, s in SETTINGS.items()}
    for file in files:
        if Path(file).exists():
            out |= {k: v for k, v in flat(json.loads(Path(file).read_text() or "{}")).items() if k in SETTINGS}
    env = os.environ if environ is None else environ
    for name, s in SETTINGS.items():
        text = env.get("AGORASIFT_" + name.replace(".", "_").upper())
        if text is not None:
            out[name] = type(s.default)(text)
    return out


def problems(values: Mapping[str, Any]) -> list[str]:
    """What is wrong or missing; empty if all is well."""
    out = []
    for name, s in SETTINGS.items():
        v = values.get(name, s.default)
        if s.allowed and v not in s.allowed:
            out.append(f"{name} is {v!r}, not one of {', '.join(map(str, s.allowed))}")
        if s.least is not None and v < s.least:
            out.append(f"{name} is {v!r}, less than {s.least}")
    if not values.get("privacy.salt"):
        out.append("privacy.salt is not set: hashes need one that stays the same")
    return out


def source_options(values: Mapping[str, Any]) -> dict[str, str]:
    """The options of a paged source that the settings give."""
    names = {"requests.tier": "tier", "requests.attempts": "attempts", "requests.base_delay": "basedelay", "requests.max_delay": "maxdelay", "requests.fetch": "fetch", "requests.resume": "resume"}
    return {option: str(values[name]) for name, option in names.items() if values[name] != ""}
