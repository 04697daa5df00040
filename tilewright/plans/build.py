"""Building the products of all collections: originals, one metric table per grid, and a catalog over both."""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Config, SourceEntry
from ..operators import relational as R, validate as V
from ..operators.relational import stack
from ..storage import materialize
from . import originals, products
from .normalize import normalize, repeated
from .overlay import overlay
from .providers import LAYERS, PLANNED, group_of, layer_of, metric_groups

#: Units of a metric by the end of its name: 1 (a share), m or count; states have none.
UNITS = {"_fraction": "1", "_length_m": "m", "_count": "count"}
CATALOG_VERSION = 1


def completeness_of(sources: list[SourceEntry]) -> str:
    """complete only if every source states complete coverage of every region that it names; else partial."""
    stated = [set(s.coverage.values()) for s in sources]
    return "complete" if stated and all(x == {"complete"} for x in stated) else "partial"


def _definitions(columns: list[str], collection: str) -> dict[str, dict]:
    groups, out = metric_groups(collection), {}
    for name in columns:
        prefix, _, metric = name.rpartition("__")
        units = next((u for end, u in UNITS.items() if metric.endswith(end)), None)
        out[name] = {"collection": collection, "group": prefix, "metric": metric, "units": units or "category", "role": groups[prefix].get("role"), "model_eligible": False}
    return out


def _features(spark: SparkSession, sources: list[SourceEntry], frames: dict[str, DataFrame], allow_partial: bool, bbox: tuple | None = None) -> tuple[DataFrame | None, dict[str, DataFrame], dict[str, str]]:
    """Stacked features of a collection, the raw frames that were read, and each source's status."""
    found, raws, status = [], {}, {}
    for s in sources:
        try:
            raw = frames[s.source_id] if s.source_id in frames else originals.open_source(spark, s, bbox)
            features = normalize(raw, layer_of(s.collection, s.source_id), s.contract())
            twice = repeated(features).limit(5).collect()
            if twice:
                raise ValueError(f"{s.source_id}: repeated records {[r['record_id'] for r in twice]}")
        except Exception as error:
            if not allow_partial:
                raise
            status[s.source_id] = f"unavailable: {str(error)[:200]}"
            continue
        found.append(features)
        raws[s.source_id] = raw
        status[s.source_id] = "available"
    return (stack(found) if found else None), raws, status


def build(
    spark: SparkSession,
    config: Config,
    grids: dict[str, DataFrame],
    output: str,
    tile: dict[str, float],
    allow_partial: bool = False,
    revision: str | None = None,
    overwrite: bool = False,
    frames: dict[str, DataFrame] | None = None,
) -> dict:
    """Write output: OriginalData/<source>, metrics-<resolution> for every grid, and catalog.json; return the catalog.

    Every configured collection must be complete, and every source readable, unless
    allow_partial. A metric table has a row for every cell and the columns of every metric group,
    with hits or not; its fields are defined in its schema and its states checked against its
    values. Everything is written beside output and swapped in at the end; on failure an old
    output stays. output must be a folder that the driver can rename in, and no source may lie
    in it.
    """
    if revision is not None and not re.fullmatch("[0-9a-f]{40}", revision):
        raise ValueError("revision must be a full lower-case commit id")
    if os.path.exists(output) and not overwrite:
        raise FileExistsError(output)
    inside = [s.source_id for s in config.sources for p in (s.path, s.original) if p and os.path.abspath(p).startswith(os.path.abspath(output) + os.sep)]
    if inside:
        raise ValueError(f"sources within the output: {inside}")
    names = sorted({s.collection for s in config.sources})
    partial = [n for n in names if completeness_of(list(config.of(n))) != "complete"]
    if partial and not allow_partial:
        raise ValueError(f"partial collections {partial}: allow_partial must be given")
    stage, old = f"{output}.stage-{uuid.uuid4().hex}", f"{output}.old-{uuid.uuid4().hex}"
    os.makedirs(stage)
    try:
        catalog: dict = {"schema_version": CATALOG_VERSION, "config": config.digest(), "revision": revision, "collections": {}, "tables": {}, "originals": {}}
        parts = {}
        for name in names:
            features, raws, status = _features(spark, list(config.of(name)), frames or {}, allow_partial, config.bounds)
            for source, raw in raws.items():
                record = originals.retain(raw, os.path.join(stage, "OriginalData", source), next(s for s in config.sources if s.source_id == source))
                catalog["originals"][source] = {"rows": record["rows"], "sha256": record["sha256"], "snapshot": _snapshot(config, source)}
            parts[name] = features
            state = completeness_of(list(config.of(name))) if all(v == "available" for v in status.values()) else "partial" if features is not None else "unavailable"
            catalog["collections"][name] = {"sources": status, "completeness": state, "groups": sorted(metric_groups(name)), "model_eligible": False}
        catalog["collections"] |= {n: {"planned": True, "model_eligible": False} for n in PLANNED}
        for resolution, grid in sorted(grids.items()):
            table, definitions = _metrics(spark, grid, parts, catalog["collections"], tile[resolution])
            table, rules = materialize(table, "metrics"), {}
            for value in (c for c in table.columns if c != "cell_id" and definitions[c]["units"] != "category"):
                found = V.metric_rules(value, value.rpartition("__")[0] + "__status", definitions[value]["units"])
                if not value.endswith("__feature_count"):  # a cell with hits has no value for families that it lacks
                    found.pop(f"{value}_observed")
                rules |= found
            V.require_valid(table, rules, ["cell_id"])
            record = products.publish(products.with_metadata(table, definitions), os.path.join(stage, f"metrics-{resolution}"), {"resolution": resolution, "grain": ["cell_id"], "definitions": definitions})
            catalog["tables"][resolution] = {"rows": record["rows"], "sha256": record["sha256"], "fields": record["fields"]}
        products.write_json(os.path.join(stage, "catalog.json"), catalog)
        validate_build(spark, stage)
        if os.path.exists(output):
            os.rename(output, old)
        try:
            os.rename(stage, output)
        except OSError:
            if os.path.exists(old):
                os.rename(old, output)
            raise
        shutil.rmtree(old, ignore_errors=True)
        return catalog
    finally:
        shutil.rmtree(stage, ignore_errors=True)


def _snapshot(config: Config, source: str) -> str | None:
    path = next(s.path for s in config.sources if s.source_id == source)
    return os.path.abspath(path) if path else None


def _metrics(spark: SparkSession, grid: DataFrame, parts: dict[str, DataFrame | None], collections: dict, tile: float) -> tuple[DataFrame, dict[str, dict]]:
    """The wide table of all collections and its fields' definitions."""
    table, definitions = grid.select("cell_id"), {"cell_id": {"metric": "cell_id", "units": "category", "model_eligible": False}}
    empty = spark.createDataFrame([], "group string, feature_id string, record_id string, wkb binary")
    qualified = F.concat_ws(":", "source_id", "record_id")  # a provider's id is its own only within its source
    for name, features in parts.items():
        groups = metric_groups(name)
        shapes = group_of(features, name).select("group", "feature_id", qualified.alias("record_id"), "wkb") if features is not None else empty
        state = {}
        for prefix, group in groups.items():
            there = collections[name]["sources"].get(group["source_id"]) == "available" if "source_id" in group else features is not None
            state[prefix] = collections[name]["completeness"] if there else "unavailable"
        made = overlay(grid, shapes, list(groups), tile, completeness=state, mode="matrix")
        table = table.join(made.wide, "cell_id", "left")
        definitions |= _definitions([c for c in made.wide.columns if c != "cell_id"], name)
    return table, definitions


def validate_build(spark: SparkSession, output: str) -> dict:
    """The catalog of an output, after every table and original was found to agree with it and with its own manifest."""
    with open(os.path.join(output, "catalog.json")) as f:
        catalog = json.load(f)
    validate_catalog(catalog)
    for folder, entries, prefix in (("", catalog["tables"], "metrics-"), ("OriginalData", catalog["originals"], "")):
        for name, entry in entries.items():
            record = products.validate(spark, os.path.join(output, folder, prefix + name))
            if any(record[k] != entry[k] for k in ("rows", "sha256")):
                raise ValueError(f"{name}: table and catalog differ")
    for resolution, entry in catalog["tables"].items():
        back = spark.read.parquet(os.path.join(output, f"metrics-{resolution}", "data"))
        if back.columns != entry["fields"] or any(f.metadata.get("model_eligible") is not False for f in back.schema):
            raise ValueError(f"metrics-{resolution}: fields differ from the catalog or lack their definitions")
        if R.duplicate_keys(back, ["cell_id"]).head(1):
            raise ValueError(f"metrics-{resolution}: repeated cells")
    return catalog


def validate_catalog(catalog: dict) -> None:
    """Raise unless a catalog has the known version, only known collections, and nothing that is eligible for models."""
    if catalog.get("schema_version") != CATALOG_VERSION:
        raise ValueError("unsupported catalog version")
    unknown = set(catalog["collections"]) - set(LAYERS) - set(PLANNED)
    if unknown or not set(PLANNED) <= set(catalog["collections"]):
        raise ValueError(f"catalog's collections differ from the declared ones: {sorted(unknown)}")
    for name, entry in catalog["collections"].items():
        if entry.get("model_eligible") is not False:
            raise ValueError(f"{name} is eligible for models")


def clean_workspace(spark: SparkSession, config: Config, output: str) -> list[str]:
    """Remove the configured snapshots that output retains, after output was verified; return their paths.

    A snapshot goes only if its rows are those of the retained original; all others stay.
    """
    catalog, gone = validate_build(spark, output), []
    for s in config.sources:
        if s.source_id not in catalog["originals"] or s.path is None or not os.path.exists(s.path):
            continue
        kept = spark.read.parquet(os.path.join(output, "OriginalData", s.source_id, "data"))
        if R.differences(originals.open_source(spark, replace(s, original=None)), kept).head(1):
            continue
        shutil.rmtree(s.path) if os.path.isdir(s.path) else os.remove(s.path)
        gone.append(s.path)
    return gone


def init(folder: str) -> str:
    """A configuration to begin with in folder, where none is."""
    path = os.path.join(folder, "layers.yaml")
    if not os.path.exists(path):
        os.makedirs(folder, exist_ok=True)
        with open(path, "w") as out:
            out.write("bounds: [-180, -90, 180, 90]\nsources: {}\nareas: {}\n")
    return path
