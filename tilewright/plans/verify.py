"""Independent recomputation of coverage for some cells, by another method than the overlay's."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions import kernels as K, noding as N, planar as P
from ..operators import exact
from ..operators.exact import BOX


def sampled_cells(long: DataFrame, value: str = "polygon_coverage_fraction", each: int = 2) -> DataFrame:
    """(group, cell_id, stored) of the first and last `each` cells with and without a value of every group."""
    found = long.select("group", "cell_id", F.col(value).alias("stored"), (F.coalesce(value, F.lit(0.0)) > 0).alias("hit"))
    ends = []
    for order in (F.col("cell_id").asc(), F.col("cell_id").desc()):
        by = Window.partitionBy("group", "hit").orderBy(order)
        ends.append(found.withColumn("k", F.row_number().over(by)).where(F.col("k") <= each).drop("k"))
    return ends[0].unionByName(ends[1]).distinct().select("group", "cell_id", "stored")


def recompute(long: DataFrame, cells: DataFrame, features: DataFrame, tile: float, earth: bool = True, tolerance: float = 1e-6, each: int = 2) -> DataFrame:
    """(group, cell_id, stored, recomputed, agrees) for the sampled cells of every group.

    The overlay cuts parts to boxes in strips and sweeps slabs; here parts are cut by the cell's
    half-planes in turn, the distinct pieces are noded and united as geometry, and the area is the
    integral around the union's rings. A null that was stored agrees with no area. cells and
    features are those of the overlay (cell_id, box and perhaps wkb; group and wkb).
    """
    chosen = sampled_cells(long, each=each)
    if "wkb" not in cells.columns:
        cells = cells.withColumn("wkb", K.box_wkb(*BOX))
    cells = cells.select("cell_id", "wkb", *BOX).join(chosen.select("cell_id").distinct(), "cell_id")
    parts = exact.parts_of(features.select("group", "wkb"), earth=earth).where("family = 'polygon'")
    found = exact.pieces(parts, cells, tile, earth).select("group", "cell_id", "piece").join(chosen.select("group", "cell_id"), ["group", "cell_id"], "left_semi")
    schema = T.StructType([found.schema["group"], found.schema["cell_id"], T.StructField("united", T.DoubleType())])

    def areas(batches):
        for group in exact._groups(batches, ["group", "cell_id"]):
            polygons = [v for p in group.column("piece").to_pylist() for v in N.make_valid(exact._unpacked(p))]
            area = float(sum(P.ring_area(r) for p in N.union(polygons) for r in p)) if polygons else 0.0
            first = group.select(["group", "cell_id"]).slice(0, 1).combine_chunks()
            yield from pa.table([*first.columns, pa.array(np.array([area]))], schema.names).combine_chunks().to_batches()

    by = ["group", "cell_id"]
    united = exact.spread(found.distinct(), *by).sortWithinPartitions(*by).mapInArrow(areas, schema)
    share = F.coalesce(F.col("united") / F.col("cell_area"), F.lit(0.0))
    out = chosen.join(united, by, "left").join(exact.cell_areas(cells, earth), "cell_id").withColumn("recomputed", share)
    agrees = F.abs(F.coalesce("stored", F.lit(0.0)) - F.col("recomputed")) <= tolerance
    return out.select("group", "cell_id", "stored", "recomputed", agrees.alias("agrees"))
