"""The build of all products, its checks, and the command line over it."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tilewright import cli, config as C
from tilewright.functions.kernels import from_wkb, to_wkb
from tilewright.operators import relational as R, spatial as S
from tilewright.plans import build as B

CONFIG = """
bounds: [-126, 47, -122, 50]
sources:
  uscg_app_sectors: {collection: coast_guard_sectors, path: "%(folder)s/uscg", coverage: {north: complete}}
  chs_routing_layer_4: {collection: traffic_separation_schemes, path: "%(folder)s/chs"}
  nga_world_port_index: {collection: ports}
"""


def polygon(w, s, e, n):
    return bytearray(to_wkb("Polygon", [[(w, s), (e, s), (e, n), (w, n), (w, s)]]))


def workspace(spark, tmp_path):
    folder = tmp_path / "ws"
    os.makedirs(folder, exist_ok=True)
    bounds = "min_x double, min_y double, max_x double, max_y double"
    spark.createDataFrame([(1, "Sector", "Polygon", polygon(-124.0, 48.0, -123.0, 49.0), -124.0, 48.0, -123.0, 49.0)], f"FID int, NAME string, kind string, wkb binary, {bounds}").write.parquet(str(folder / "uscg"))
    lane = (5, "TSSLPT_A", "L", "Polygon", polygon(-123.5, 48.0, -123.0, 48.5), -123.5, 48.0, -123.0, 48.5)
    spark.createDataFrame([lane], f"OBJECTID int, MERGE_SRC string, LNAM string, kind string, wkb binary, {bounds}").write.parquet(str(folder / "chs"))
    path = tmp_path / "layers.yaml"
    path.write_text(CONFIG % {"folder": folder})
    return str(path)


def test_build(spark, tmp_path):
    config, out = C.load(workspace(spark, tmp_path)), str(tmp_path / "out")
    grid = S.lonlat_grid(spark, (-124.0, 48.0, -122.0, 49.0), 1.0)
    with pytest.raises(ValueError, match="partial"):
        B.build(spark, config, {"1": grid}, out, {"1": 1.0})
    catalog = B.build(spark, config, {"1": grid}, out, {"1": 1.0}, allow_partial=True, revision="a" * 40)
    assert catalog["collections"]["ports"]["completeness"] == "unavailable" and catalog["collections"]["coast_guard_sectors"]["completeness"] == "complete"
    assert set(catalog["originals"]) == {"uscg_app_sectors", "chs_routing_layer_4"}
    rows = {r["cell_id"]: r.asDict() for r in spark.read.parquet(f"{out}/metrics-1/data").collect()}
    west, east = rows["-124_48"], rows["-123_48"]
    sector, lane = "coast_guard_sectors__uscg_sector__", "traffic_separation_schemes__chs_lane_part__"
    assert west[sector + "polygon_coverage_fraction"] == pytest.approx(1) and west[sector + "status"] == "observed"
    assert east[sector + "feature_count"] == 0  # complete inventory
    assert west[lane + "polygon_coverage_fraction"] == pytest.approx(0.25, rel=1e-2) and east[lane + "feature_count"] is None and east[lane + "status"] == "partial"
    assert west["traffic_separation_schemes__noaa_traffic_lane__status"] == "unavailable" and west["ports__status"] == "unavailable"
    assert west["coast_guard_sectors__ccg_administrative_region__feature_count"] is None
    B.validate_build(spark, out)
    with pytest.raises(FileExistsError):
        B.build(spark, config, {"1": grid}, out, {"1": 1.0}, allow_partial=True)
    again = B.build(spark, config, {"1": grid}, out, {"1": 1.0}, allow_partial=True, overwrite=True)
    assert again["tables"]["1"]["rows"] == 2
    gone = B.clean_workspace(spark, config, out)
    assert len(gone) == 2 and not os.path.exists(gone[0])
    text = json.loads(open(f"{out}/catalog.json").read())
    text["tables"]["1"]["rows"] = 3
    open(f"{out}/catalog.json", "w").write(json.dumps(text))
    with pytest.raises(ValueError, match="differ"):
        B.validate_build(spark, out)


def test_repeated_records_fail_the_build(spark, tmp_path):
    config = C.load(workspace(spark, tmp_path))
    raw = spark.read.parquet(config.of("coast_guard_sectors")[0].path)
    with pytest.raises(ValueError, match="repeated"):
        B._features(spark, list(config.of("coast_guard_sectors")), {"uscg_app_sectors": raw.union(raw)}, False)


def test_catalog_rules():
    good = {"schema_version": 1, "collections": {n: {"model_eligible": False} for n in B.PLANNED}}
    B.validate_catalog(good)
    for bad in (good | {"schema_version": 2}, good | {"collections": {}}, good | {"collections": good["collections"] | {"odd": {"model_eligible": False}}}, good | {"collections": good["collections"] | {"ports": {"model_eligible": True}}}):
        with pytest.raises(ValueError):
            B.validate_catalog(bad)


def test_command_line(spark, tmp_path, capsys):
    path, out = workspace(spark, tmp_path), str(tmp_path / "out")
    assert cli.main(["build", path, out, "--degrees", "2", "--allow-partial"]) == 0
    assert cli.main(["catalog", out]) == 0 and cli.main(["preflight", path]) == 0
    assert cli.main(["init", str(tmp_path / "new")]) == 0 and C.load(str(tmp_path / "new" / "layers.yaml")).sources == ()
    for bad in (["build", path, out, "--degrees", "2", "--allow-partial"], ["download", "ports"]):
        with pytest.raises(SystemExit):
            cli.main(bad)
    capsys.readouterr()


def test_dissolve(spark):
    rows = [("a", 2, polygon(0, 0, 1, 1)), ("a", 1, polygon(2, 0, 3, 1)), ("a", 1, polygon(2, 0, 3, 1)), ("b", 5, None)]
    made = {r["k"]: r for r in R.dissolve(spark.createDataFrame(rows, "k string, v int, wkb binary"), "k", "wkb", ["v"]).collect()}
    kind, shapes = from_wkb(bytes(made["a"]["wkb"]))
    assert (made["a"]["v"], kind, len(shapes)) == (1, "MultiPolygon", 2) and made["b"]["wkb"] is None
    assert R.dissolve(spark.createDataFrame(rows, "k string, v int, wkb binary").where(F.lit(False)), "k", "wkb", ["v"]).count() == 0
