"""The closed configuration: sources and collections, with extension, references and a redacted digest."""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass, field, fields
from pathlib import Path

import yaml

from .functions.geometry import check_box
from .plans.normalize import Source
from .plans.providers import LAYERS, PLANNED
from .sources.readers import FORMATS

_REFERENCE = re.compile(r"\$\{(env:)?([A-Za-z0-9_.]+)\}")


@dataclass(frozen=True)
class SourceEntry:
    """A source's contract and where its snapshot is.

    original: a retained original to read in place of the snapshot; selector, mask and bbox:
    what was asked for; roster_field: the column of record ids.
    """

    source_id: str
    collection: str
    path: str | None = None
    format: str = "parquet"
    layer: str | None = None
    provider: str | None = None
    url: str | None = None
    citation: str | None = None
    limitation: str | None = None
    as_of: str | None = None
    retrieved_at: str | None = None
    expected_sha256: str | None = None
    original: str | None = None
    selector: str | None = None
    mask: str | None = None
    roster_field: str | None = None
    bbox: tuple | list | None = None
    proposed: bool = False
    coverage: dict[str, str] = field(default_factory=dict)

    def contract(self) -> Source:
        return Source(self.source_id, self.provider, self.url, self.citation, self.limitation, self.as_of, self.retrieved_at, dict(self.coverage))


@dataclass(frozen=True)
class Config:
    bounds: tuple[float, float, float, float]
    sources: tuple[SourceEntry, ...]
    areas: dict[str, tuple] = field(default_factory=dict)

    def of(self, collection: str) -> tuple[SourceEntry, ...]:
        return tuple(s for s in self.sources if s.collection == collection)

    def digest(self) -> str:
        """Digest of the configuration without local paths."""
        rows = [{f.name: getattr(s, f.name) for f in fields(s) if f.name not in ("path", "original")} for s in self.sources]
        return hashlib.sha256(json.dumps([self.bounds, rows], sort_keys=True).encode()).hexdigest()


def _merge(base: dict, over: dict) -> dict:
    out = dict(base)
    for k, v in over.items():
        out[k] = _merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def _read(path: Path, seen: tuple[Path, ...] = ()) -> dict:
    path = path.resolve()
    if path in seen:
        raise ValueError(f"configuration extends itself: {path}")
    document = yaml.safe_load(path.read_text()) or {}
    base = document.pop("extends", None)
    return _merge(_read(path.parent / base, (*seen, path)), document) if base else document


def _resolve(value, root: dict, active: tuple[str, ...] = ()):
    if isinstance(value, dict):
        return {k: _resolve(v, root, active) for k, v in value.items()}
    if isinstance(value, list):
        return [_resolve(v, root, active) for v in value]
    if not isinstance(value, str):
        return value

    def found(m):
        if m[1]:
            if m[2] not in os.environ:
                raise ValueError(f"environment variable {m[2]} is not set")
            return os.environ[m[2]]
        if m[2] in active:
            raise ValueError(f"reference to itself: {m[2]}")
        node = root
        for part in m[2].split("."):
            if not isinstance(node, dict) or part not in node:
                raise ValueError(f"unknown reference {m[2]}")
            node = node[part]
        return str(_resolve(node, root, (*active, m[2])))

    return _REFERENCE.sub(found, value)


def load(path: str) -> Config:
    """Read a YAML file; unknown keys, unknown collections and malformed values are errors."""
    root = _read(Path(path))
    document = _resolve(root, root)
    extra = set(document) - {"bounds", "sources", "areas", "vars"}
    if extra:
        raise ValueError(f"unknown configuration keys {sorted(extra)}")
    bounds = tuple(float(v) for v in document["bounds"])
    check_box(*bounds)
    names = {f.name for f in fields(SourceEntry)}
    sources = []
    for key, entry in (document.get("sources") or {}).items():
        unknown = set(entry) - names
        if unknown:
            raise ValueError(f"source {key}: unknown keys {sorted(unknown)}")
        if entry.get("collection") not in LAYERS:
            raise ValueError(f"source {key}: unknown collection {entry.get('collection')}")
        if not isinstance(entry.get("proposed", False), bool):
            raise ValueError(f"source {key}: proposed must be true or false")
        if entry.get("format", "parquet") not in FORMATS:
            raise ValueError(f"source {key}: unknown format {entry['format']}")
        digest = entry.get("expected_sha256")
        if digest is not None and not re.fullmatch("[0-9a-f]{64}", digest):
            raise ValueError(f"source {key}: expected_sha256 is no digest")
        if entry.get("bbox") is not None:
            entry["bbox"] = tuple(float(v) for v in entry["bbox"])
            check_box(*entry["bbox"])
        sources.append(SourceEntry(source_id=key, **entry))
    areas = {k: tuple(float(x) for x in v) for k, v in (document.get("areas") or {}).items()}
    for box in areas.values():
        check_box(*box)
    return Config(bounds, tuple(sources), areas)


def planned(collection: str) -> bool:
    return collection in PLANNED
