"""The layer interface: features, metrics per cell, memberships and coverage of one collection and box."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from .config import Config, SourceEntry
from .functions.geometry import box_parts, check_box, in_box
from .functions.kernels import box_wkb, meets
from .operators import spatial
from .operators.clip import canonical_parts
from .operators.relational import coverage_matrix, stack
from .operators.validate import canonical_rules, require_valid
from .plans.normalize import normalize
from .plans.originals import open_source
from .plans.overlay import overlay
from .plans.providers import LAYERS, PLANNED, area_checked, layer_of
from .storage import materialize

#: The designation status whose features have metrics of their own, the source that always has such metrics, and the source whose snapshot is a dated instrument (fixed values).
PROPOSED = "area_of_interest"
PROPOSED_SOURCE = "dfo_oceans_act_areas_of_interest"
INSTRUMENT_SOURCE = "tc_srkw_interim_order_2026"
#: States of regional coverage that leave a source's inventory partial (fixed values).
INCOMPLETE = ("partial", "unknown", "unavailable")


@dataclass
class LayerResult:
    """Lazy tables of one request and the record of how they came about."""

    features: DataFrame
    cells: DataFrame | None
    memberships: DataFrame | None
    coverage: DataFrame
    provenance: dict


def incomplete(source: SourceEntry) -> bool:
    """Whether a source states coverage of a region that is not complete."""
    return any(state in INCOMPLETE for state in source.coverage.values())


def source_features(spark: SparkSession, source: SourceEntry, raw: DataFrame | None = None, bbox: tuple | None = None) -> DataFrame:
    """A source's retained original or snapshot, or raw in its place, as canonical features with wkb; boxes stand in where a frame has bounds only."""
    raw = raw if raw is not None else open_source(spark, source, bbox)
    features = normalize(raw, layer_of(source.collection, source.source_id), source.contract())
    if "wkb" not in features.columns:
        features = features.withColumn("wkb", box_wkb(*spatial.BOX))
    return area_checked(features) if "cfr_area_sqmi" in features.columns else features


def get_layer(
    spark: SparkSession,
    config: Config,
    collection: str,
    bbox: tuple | str | None = None,
    make_cells: bool = True,
    cell_degrees: float = 0.1,
    source_ids: list[str] | None = None,
    include_proposed: bool = False,
    allow_partial: bool = True,
    max_cells: int = 100_000,
    max_memberships: int = 1_000_000,
    frames: dict[str, DataFrame] | None = None,
    as_of: str | None = None,
) -> LayerResult:
    """Features of a collection that meet bbox, as canonical parts that are not clipped to it, and their metrics per cell.

    Features are unwrapped, repaired and cut at the dateline into parts with part_id,
    retained_fraction and repair_status (see operators.clip.canonical_parts), and must keep the
    rules of the canonical table. Coverage has a row for each source: status and reason, its
    regions and their completeness, the kind of its time, and the box that was asked for.
    Without allow_partial, a source whose regions are not complete is an error too.

    All options are checked before anything is read. With cells, the box is widened to whole
    cells so that a cell's metrics see everything in it. Sources without a readable snapshot
    become coverage rows (`unavailable`), or raise if allow_partial is False. Proposed sources
    are left out, with a coverage row, unless asked for. frames stands in for snapshots.

    A part is chosen if its geometry, not just its bounds, meets the box. Metrics are of
    exact intersections (see plans.overlay), by source, those of proposed designations in a
    group `<source>__proposed` of their own. With allow_partial, every source's rows are read
    once here, so that a source with a bad row becomes a coverage row and not a failing result.
    """
    if as_of is not None:
        raise ValueError("as_of is not supported here: snapshots are no history; slice by the effective interval instead")
    if collection in PLANNED:
        raise NotImplementedError(f"{collection} is planned and has no data")
    if collection not in LAYERS:
        raise ValueError(f"unknown collection {collection}")
    if not isinstance(make_cells, bool) or not isinstance(include_proposed, bool) or not isinstance(allow_partial, bool):
        raise TypeError("make_cells, include_proposed and allow_partial are booleans")
    if isinstance(bbox, str):
        if bbox not in config.areas:
            raise ValueError(f"unknown area {bbox}")
        bbox = config.areas[bbox]
    box = tuple(bbox) if bbox is not None else config.bounds
    check_box(*box)
    for name, value in (("max_cells", max_cells), ("max_memberships", max_memberships)):
        if type(value) is not int or value <= 0:
            raise ValueError(f"{name} must be a positive integer")
    known = {s.source_id: s for s in config.of(collection)}
    unknown = set(source_ids or ()) - set(known)
    if unknown:
        raise ValueError(f"unknown sources {sorted(unknown)}")
    chosen = [known[s] for s in (source_ids or known)]
    used = [s for s in chosen if include_proposed or not s.proposed]

    grid = spatial.lonlat_grid(spark, box, cell_degrees, max_cells) if make_cells else None
    reach = box
    if grid is not None and box[0] < box[2]:
        edge = grid.agg(*[f(c).alias(c) for f, c in ((F.min, "min_x"), (F.min, "min_y"), (F.max, "max_x"), (F.max, "max_y"))]).first()
        reach = (max(-180.0, edge["min_x"]), max(-90.0, edge["min_y"]), min(180.0, edge["max_x"]), min(90.0, edge["max_y"]))

    parts, rows = [], []
    for source in chosen:
        if source not in used:
            rows.append((source.source_id, "not_applicable", "proposed source not requested"))
            continue
        try:
            if not allow_partial and incomplete(source):
                raise ValueError(f"{source.source_id}: coverage is not complete; allow_partial must be given")
            raw = source_features(spark, source, (frames or {}).get(source.source_id), box)
            features = canonical_parts(raw.where(in_box(reach) | in_box((-180.0, -90.0, -180.0, 90.0)) | in_box((180.0, -90.0, 180.0, 90.0))))
            features = features.where(in_box(reach)).where(meets(F.col("wkb"), box_parts(*reach)))
            if allow_partial:  # bad rows show when they are read
                features = materialize(features, "features")
                require_valid(features, canonical_rules(features), ["feature_id", "record_id", "part_id"])
            parts.append(features)
            empty = allow_partial and not features.head(1)
            rows.append((source.source_id, "empty" if empty else "available", None))
        except Exception as error:
            if not allow_partial:
                raise
            rows.append((source.source_id, "unavailable", str(error)[:300]))
    told = [
        (
            *row,
            collection,
            known[row[0]].provider,
            "partial" if incomplete(known[row[0]]) else "qualified_named_source_scope",
            "not_verified",
            "instrument_version_snapshot" if row[0] == INSTRUMENT_SOURCE else "inventory_snapshot_only",
            dict(known[row[0]].coverage),
            list(map(float, box)),
            list(map(float, reach)),
            known[row[0]].limitation,
        )
        for row in rows
    ]
    coverage = spark.createDataFrame(
        told,
        "source_id string, status string, reason string, collection string, provider string, geographic_completeness string, legal_currentness string, "
        "temporal_capability string, source_regions map<string,string>, requested_bbox array<double>, support_bbox array<double>, limitation string",
    )
    if not parts:
        raise ValueError(f"no source of {collection} is available: {rows}")
    features = stack(parts)
    cells = members = None
    if grid is not None:
        state = {i: s for i, s, _ in rows}
        own = [F.col(c) for c in ("designation_id", "zone_name") if c in features.columns]
        group, groups = F.col("source_id"), [s.source_id for s in used]
        if "designation_status" in features.columns:
            proposed = F.coalesce(F.col("designation_status") == PROPOSED, F.lit(False))
            group = F.when(proposed, F.concat("source_id", F.lit("__proposed"))).otherwise(group)
            apart = {r["source_id"] for r in features.where(proposed).select("source_id").distinct().collect()}  # of the configured sources
            apart |= {s.source_id for s in used if s.source_id == PROPOSED_SOURCE}
            groups += [f"{s.source_id}__proposed" for s in used if s.source_id in apart]
            state |= {f"{s}__proposed": state[s] for s in apart}
        shapes = features.select(group.alias("group"), "feature_id", "part_id", F.concat_ws(":", "source_id", "record_id").alias("record_id"), "wkb", *own)
        made = overlay(grid, shapes, groups, cell_degrees, availability=state, mode="query", max_memberships=max_memberships)
        cells, members = made.wide, made.memberships
    provenance = {"collection": collection, "bbox": list(box), "sources": [s.source_id for s in used], "config": config.digest(), "cell_degrees": cell_degrees if make_cells else None}
    return LayerResult(features, cells, members, coverage, provenance)


#: get_<collection>(spark, config, ...) for every layer.
GETTERS = {f"get_{name}": partial(get_layer, collection=name) for name in LAYERS}


def availability(spark: SparkSession, config: Config, regions: list[str]) -> DataFrame:
    """(collection, source, region, status) of every configured source and region; regions a source doesn't state are unknown."""
    rows = [(s.collection, s.source_id, dict(s.coverage)) for s in config.sources]
    sources = spark.createDataFrame(rows, "collection string, source string, coverage map<string,string>")
    asked = spark.createDataFrame([(r,) for r in regions], "region string")
    return coverage_matrix(sources, asked)


def preflight(config: Config) -> list[dict]:
    """What is ready to build: each source with whether its retained original or snapshot is there; reads nothing else."""
    import os

    return [{"source": s.source_id, "collection": s.collection, "snapshot": any(p and os.path.exists(p) for p in (s.original, s.path))} for s in config.sources]
