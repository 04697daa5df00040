"""The overlay of a grid with features: memberships, long metrics and the wide table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import exact, metrics
from ..operators.relational import within_budget
from ..storage import materialize

#: Metrics of each cell and group (fixed names).
VALUES = ["feature_count", "source_record_count", "part_count", "polygon_coverage_fraction", "line_union_length_m", "point_count"]
OPTIONAL = ["designation_count", "zone_count"]


@dataclass
class Overlay:
    """Results of one overlay; the pieces behind them are written once, the rest is lazy."""

    memberships: DataFrame
    long: DataFrame
    wide: DataFrame


def overlay(
    cells: DataFrame,
    features: DataFrame,
    groups: list[str],
    tile: float,
    completeness: dict[str, str] | None = None,
    availability: dict[str, str] | None = None,
    mode: str = "matrix",
    max_memberships: int | None = None,
    earth: bool = True,
    attributes: list[str] | None = None,
) -> Overlay:
    """Metrics of features per cell and source group, from exact intersections.

    cells: cell_id and box, and wkb where cells are convex polygons; features: group, feature_id,
    record_id (unique over all sources), wkb, and designation_id and zone_name where the layer
    has them. Collections are taken apart into parts, and on the earth what steps over the
    dateline is cut there; part_id is the features' own where they have it, else the record with
    the part's number in it. A part is in a cell if they have an area, a length or a
    point in common, by the part's own family. Per cell and group: distinct features, records
    and parts, the share of the cell's area under the union of polygons, the length of the
    union of lines, and the distinct points; null where a group has no such parts there.

    In mode `matrix` a group's state follows its inventory's completeness (an empty cell is 0
    only where that is `complete`), and point_count counts features; in mode `query` it follows
    hits and availability, and nothing is filled. attributes names columns of features whose
    distinct values in a cell and group come as sorted lists `native_<name>`, null where there
    are none; in mode `matrix` each group's declared completeness comes as source_completeness.
    Every cell has one row; groups without hits
    have their columns. On the earth areas are equal-area and lengths geodesic metres.
    """
    if mode not in ("matrix", "query"):
        raise ValueError("mode must be matrix or query")
    spark = cells.sparkSession
    own = ["group", "feature_id", "record_id", *[c for c in ("designation_id", "zone_name") if c in features.columns]]
    own += [c for c in attributes or () if c not in own]
    given = ["part_id"] if "part_id" in features.columns else []
    parts = exact.parts_of(features.select(*own, *given, "wkb"), number="part_number", earth=earth)
    if not given:
        same = F.col("feature_id") == F.col("record_id")
        parts = parts.withColumn("part_id", F.concat_ws("-", "record_id", F.when(~same, F.col("feature_id")), F.lit("part"), F.col("part_number").cast("string")))
    found = materialize(exact.pieces(parts.drop("part_number"), cells, tile, earth), "pieces")
    relation = exact.memberships(found).select("cell_id", "group", "feature_id", "record_id", "part_id", "family", "intersection_area", "intersection_length", "point_count")
    if max_memberships is not None:
        relation = within_budget(relation, max_memberships, "memberships")
    counts = metrics.counts(found, ["cell_id", "group"], "feature_id", "record_id", "part_id")
    values = list(VALUES)
    per = found.groupBy("cell_id", "group")
    extra = []
    if "designation_id" in own:
        extra.append(F.countDistinct("designation_id").alias("designation_count"))
        if "zone_name" in own:
            extra.append(metrics.distinct_tuples(["designation_id", "zone_name"], "zone_name").alias("zone_count"))
    extra.append(F.countDistinct(F.when(F.col("family") == "point", F.col("feature_id"))).alias("point_features"))
    extra.append(F.bool_or(F.col("family") == "point").alias("has_points"))
    natives = [f"native_{c}" for c in attributes or ()]
    extra += [metrics.attribute_set(c).alias(n) for c, n in zip(attributes or (), natives)]
    counts = counts.join(per.agg(*extra), ["cell_id", "group"])
    values += [c for c in OPTIONAL if c in counts.columns]
    covered = exact.unions(found, ["cell_id", "group"], earth, written=True)
    points = F.when(F.col("has_points"), F.col("point_features")) if mode == "matrix" else F.col("distinct_points")
    long = (
        counts.join(covered, ["cell_id", "group"], "left")
        .join(exact.cell_areas(cells, earth), "cell_id")
        .withColumn("polygon_coverage_fraction", metrics.coverage_fraction("union_area", "cell_area"))
        .withColumn("line_union_length_m", F.col("union_length"))
        .withColumn("point_count", points)
        .select("cell_id", "group", *values, *natives)
    )
    declared = [(g, (completeness or {}).get(g, "unknown"), (availability or {}).get(g, "unavailable")) for g in groups]
    all_groups = spark.createDataFrame(declared, "group string, completeness string, availability string")
    full = cells.select("cell_id").crossJoin(F.broadcast(all_groups)).join(long, ["cell_id", "group"], "left")  # groups: a declared list
    hit = F.col("feature_count").isNotNull()
    if mode == "matrix":
        state = metrics.support_state("completeness")
        full = full.withColumn("intersection_status", F.when(hit, "recorded_geometry_intersects").otherwise(F.concat(F.lit("no_recorded_geometry_under_"), F.when(state == "observed", "complete").otherwise(state), F.lit("_coverage"))))
        # a cell with hits keeps nulls for the families that it lacks
        full = full.withColumns({v: F.when(hit, F.col(v)).otherwise(metrics.zero_fill(v, "completeness")) for v in values})
        full = full.withColumn("status", F.when(hit & ~state.isin("observed"), "partial").otherwise(metrics.delivery_status(F.col("feature_count"), state)))
        full = full.withColumn("source_completeness", F.col("completeness"))
        values = [*values, "intersection_status", "source_completeness"]
    else:
        full = full.withColumn("status", metrics.query_status(hit, "availability"))
    return Overlay(relation, full, metrics.for_every_cell(cells.select("cell_id"), metrics.wide(full, "cell_id", "group", groups, [*values, *natives, "status"]), "cell_id"))
