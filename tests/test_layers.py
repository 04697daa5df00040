"""Coordinate systems on reading, geometry with heights, canonical parts, the dateline, and records by source."""

import io
import json
import sqlite3
import struct
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tilewright import api, config as C
from tilewright.functions import crs, kernels as K
from tilewright.operators import clip
from tilewright.plans import build as B, overlay as O
from tilewright.sources import readers as R

LAMBERT = """PROJCS["NAD_1983_Statistics_Canada_Lambert",GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["Lambert_Conformal_Conic"],PARAMETER["False_Easting",6200000.0],PARAMETER["False_Northing",3000000.0],PARAMETER["Central_Meridian",-91.86666666666666],PARAMETER["Standard_Parallel_1",49.0],PARAMETER["Standard_Parallel_2",77.0],PARAMETER["Latitude_Of_Origin",63.390675],UNIT["Meter",1.0]]"""
NAD83 = 'GEOGCS["GCS_North_American_1983",DATUM["D_North_American_1983",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'


@pytest.mark.parametrize("code", [3347, 3978, 3005, 5070, 3857, 6933, 32610, 26909, 32710])
def test_there_and_back(code):
    s, rng = crs.system(code), np.random.default_rng(code)
    wide = 3 if s.kind == "utm" else 25
    lon, lat = s.lon0 + rng.uniform(-wide, wide, 50), rng.uniform(25, 75, 50) * (-1 if code == 32710 else 1)
    assert np.abs(np.array(crs.to_lonlat(s, *crs.from_lonlat(s, lon, lat))) - (lon, lat)).max() < 1e-9
    if s.kind in ("lambert", "utm", "mercator"):  # conformal: a small square stays one
        x, y = crs.from_lonlat(s, lon[0] + np.array([0, 1e-4, 0]), lat[0] + np.array([0, 0, 1e-4 * np.cos(np.radians(lat[0]))]))
        assert abs((x[1] - x[0]) * (x[2] - x[0]) + (y[1] - y[0]) * (y[2] - y[0])) < 2e-2 * ((x[1] - x[0]) ** 2 + (y[1] - y[0]) ** 2)
    if s.kind == "albers":  # equal areas of equal bands
        box = lambda a, b: np.array(crs.from_lonlat(s, s.lon0 + np.array([0, 0.1, 0.1, 0]), np.array([a, a, b, b])))
        area = lambda p: abs(np.dot(p[0], np.roll(p[1], -1)) - np.dot(np.roll(p[0], -1), p[1])) / 2
        x, y = K.equal_area([0, 0.1], [50.0, 50.01])
        assert area(box(50.0, 50.01)) == pytest.approx((x[1] - x[0]) * (y[1] - y[0]), rel=1e-5)


def test_agrees_with_the_kernels():
    lon, lat = [-123.5, -122.0], [48.2, 45.0]
    assert np.allclose(crs.from_lonlat(crs.system(32610), lon, lat), K.utm(lon, lat, 10), atol=1e-4)
    assert np.allclose(crs.from_lonlat(crs.system(6933), lon, lat), K.equal_area(lon, lat), atol=1e-6)


def test_definitions():
    assert crs.from_wkt(NAD83).kind == "geographic"
    found, named = crs.from_wkt(LAMBERT), crs.system(3347)
    assert np.allclose(crs.from_lonlat(found, -75.7, 45.42), crs.from_lonlat(named, -75.7, 45.42))
    assert crs.from_wkt('PROJCS["x",AUTHORITY["EPSG","32610"]]') == crs.system(32610)
    assert crs.from_geo_metadata(json.dumps({"columns": {"geometry": {}}})).kind == "geographic"
    for bad in ('PROJCS["x",PROJECTION["Krovak"]]', 'GEOGCS["Tokyo"]'):
        with pytest.raises(ValueError):
            crs.from_wkt(bad)
    for text in (None, json.dumps({"columns": {"geometry": {"crs": None}}}), json.dumps({"columns": {"geometry": {"crs": {"id": {"authority": "EPSG", "code": 2154}}}}})):
        with pytest.raises(ValueError):
            crs.from_geo_metadata(text)


def _box_in(system, lon, lat, size=0.5):
    corners = [(lon, lat), (lon, lat + size), (lon + size, lat + size), (lon + size, lat), (lon, lat)]
    x, y = crs.from_lonlat(system, *zip(*corners))
    return list(zip(x.tolist(), y.tolist()))


def test_shapefile_in_metres(spark, tmp_path):
    def archive(name, prj):
        ring = _box_in(crs.system(3347), -75.7, 45.4)
        flat = [v for p in ring for v in p]
        body = struct.pack("<i4d2ii", 5, 0, 0, 1, 1, 1, 5, 0) + struct.pack("<10d", *flat)
        dbf = struct.pack("<B3xIHH20x", 3, 1, 65, 6) + b"NAME\0\0\0\0\0\0\0C" + b"\0" * 4 + bytes([5]) + b"\0" * 15 + b"\r" + b" Lake "
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("a.shp", b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body)
            z.writestr("a.dbf", dbf)
            if prj:
                z.writestr("a.prj", prj)

    archive("a.zip", LAMBERT)
    row = R.shapefiles(spark, str(tmp_path / "a.zip")).first()
    assert row["min_x"] == pytest.approx(-75.7) and row["max_y"] == pytest.approx(45.9) and K.from_wkb(bytes(row["wkb"]))[1][0][0] == pytest.approx((-75.7, 45.4))
    archive("b.zip", None)
    with pytest.raises(Exception, match="no coordinate system"):
        R.shapefiles(spark, str(tmp_path / "b.zip")).collect()


def test_geopackage_in_metres_with_heights(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "a.gpkg")
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id integer)")
    db.execute("create table gpkg_spatial_ref_sys (srs_id integer, organization text, organization_coordsys_id integer, definition text)")
    db.execute("insert into gpkg_geometry_columns values ('lanes', 'geom', 100), ('lost', 'geom', 0)")
    db.execute("insert into gpkg_spatial_ref_sys values (100, 'NONE', 0, ?)", (LAMBERT,))
    ring = _box_in(crs.system(3347), -63.0, 44.0)
    wkb = struct.pack("<3I", 1003, 1, len(ring))
    wkb = b"\1" + wkb + b"".join(struct.pack("<3d", *p, 7.0) for p in ring)
    for t in ("lanes", "lost"):
        db.execute(f"create table {t} (geom blob)")
        db.execute(f"insert into {t} values (?)", (b"GP\0\1" + struct.pack("<i", 100) + wkb,))
    db.commit()
    db.close()
    row = R.geopackage(spark, str(tmp_path / "a.gpkg"), "lanes").first()
    assert (row["min_x"], row["max_y"]) == pytest.approx((-63.0, 44.5))
    with pytest.raises(Exception, match="no coordinate system"):
        R.geopackage(spark, str(tmp_path / "a.gpkg"), "lost").collect()


def test_geoparquet_by_its_footer(spark, tmp_path):
    ring = _box_in(crs.system(32610), -123.0, 48.0)
    table = pa.table({"n": [1], "geometry": [K.to_wkb("Polygon", [ring])]})
    meta = {"columns": {"geometry": {"crs": {"id": {"authority": "EPSG", "code": 32610}}}}}
    pq.write_table(table.replace_schema_metadata({"geo": json.dumps(meta)}), tmp_path / "a.parquet")
    row = R.geoparquet(spark, str(tmp_path / "a.parquet")).first()
    assert (row["min_x"], row["min_y"]) == pytest.approx((-123.0, 48.0)) and row["kind"] == "Polygon"
    pq.write_table(table, tmp_path / "b.parquet")
    with pytest.raises(Exception, match="no degrees"):
        R.geoparquet(spark, str(tmp_path / "b.parquet")).collect()


def test_wkb_with_heights_and_measures():
    for code, size in ((1, 2), (1001, 3), (2001, 3), (3001, 4), (0x80000001, 3), (0x40000001, 3), (0xC0000001, 4)):
        data = struct.pack("<BI", 1, code) + struct.pack(f"<{size}d", 1.0, 2.0, 8.0, 9.0)[: 8 * size] if size == 4 else struct.pack("<BI", 1, code) + struct.pack(f"<{size}d", *(1.0, 2.0, 8.0)[:size])
        assert K.from_wkb(data) == ("Point", (1.0, 2.0))
    extended = struct.pack("<BII", 1, 0xA0000002, 4326) + struct.pack("<I", 2) + struct.pack("<6d", 0, 1, 5, 2, 3, 5)
    assert K.from_wkb(extended) == ("LineString", [(0, 1), (2, 3)])
    many = struct.pack("<BII", 1, 1004, 2) + 2 * (struct.pack("<BI", 1, 1001) + struct.pack("<3d", 4, 5, 6))
    assert K.from_wkb(many) == ("MultiPoint", [(4, 5), (4, 5)])
    with pytest.raises(ValueError):
        K.from_wkb(struct.pack("<BI", 1, 4001))


def _wkb(*points):
    return bytearray(K.to_wkb("Polygon", [[*points, points[0]]]))


def test_overlay_over_the_dateline(spark):
    shapes = [("f", _wkb((179.0, 0.0), (-179.0, 0.0), (-179.0, 1.0), (179.0, 1.0))), ("g", bytearray(K.to_wkb("LineString", [(179.5, 0.5), (-179.5, 0.5)])))]
    features = spark.createDataFrame([("a", i, i, d) for i, d in shapes], "group string, feature_id string, record_id string, wkb binary")
    cells = spark.createDataFrame([("west", 179.0, 180.0), ("east", -180.0, -179.0), ("zero", 0.0, 1.0)], "cell_id string, min_x double, max_x double").withColumns({"min_y": F.lit(0.0), "max_y": F.lit(1.0)})
    made = {r["cell_id"]: r for r in O.overlay(cells, features, ["a"], 1.0, completeness={}).long.collect()}
    assert made["west"]["polygon_coverage_fraction"] == pytest.approx(1) and made["east"]["polygon_coverage_fraction"] == pytest.approx(1)
    assert made["zero"]["polygon_coverage_fraction"] is None and made["zero"]["feature_count"] is None
    assert made["west"]["line_union_length_m"] == pytest.approx(made["east"]["line_union_length_m"], rel=1e-9) and made["west"]["line_union_length_m"] > 50_000


def test_canonical_parts(spark):
    shapes = {
        "line": _wkb((179.0, 0.0), (-179.0, 0.0), (-179.0, 1.0), (179.0, 1.0)),
        "tie": _wkb((0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (2.0, 0.0), (1.0, 1.0), (0.0, 2.0)),
        "spike": _wkb((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 4.0), (2.0, 9.0), (2.0, 4.0), (0.0, 4.0)),
        "plain": _wkb((0.0, 0.0), (1.0, 0.0), (1.0, 1.0)),
    }
    frame = spark.createDataFrame([(k, "s", k, v, 0.0, 0.0, 1.0, 1.0) for k, v in shapes.items()], "feature_id string, source_id string, record_id string, wkb binary, min_x double, min_y double, max_x double, max_y double")
    parts = clip.canonical_parts(frame).cache()
    made = {}
    for r in parts.orderBy("part_id").collect():
        made.setdefault(r["record_id"], []).append(r)
    assert [len(made[k]) for k in ("line", "tie", "spike", "plain")] == [2, 2, 1, 1]
    assert made["line"][0]["part_id"] == "s:line:part-001" and {r["repair_status"] for r in made["line"]} == {"not_required"} and made["line"][0]["retained_fraction"] == pytest.approx(1)
    assert all(-180 <= r["min_x"] <= r["max_x"] <= 180 for r in made["line"])
    assert made["tie"][0]["repair_status"] == "repaired_preserving_dimension" and made["spike"][0]["repair_status"] == "repaired_lower_dimension_remnants_reported"
    assert made["tie"][0]["repair_delta"] > 1e9 and abs(made["spike"][0]["repair_delta"]) < 1 and made["plain"][0]["repair_delta"] is None
    told = clip.clip_diagnostics(frame, parts).first()
    assert (told["source_rows"], told["output_parts"], told["repaired_rows"], told["repair_dimension_remnant_rows"], told["excluded_rows"], told["clipped_source_rows"]) == (4, 6, 2, 1, 0, 0)


def test_records_of_two_sources_are_two(spark, tmp_path):
    """One provider id in two sources counts twice, in a layer and in the build."""
    (tmp_path / "a.yaml").write_text("bounds: [-130, 30, -110, 50]\nsources:\n  fws_national_wildlife_refuges: {collection: wildlife_refuges}\n  other_refuges: {collection: wildlife_refuges}\n")
    config = C.load(str(tmp_path / "a.yaml"))
    shape = _wkb((-123.0, 40.0), (-122.95, 40.0), (-122.95, 40.05))
    raw = spark.createDataFrame([(5, "A", "NWR", "Polygon", shape, -123.0, 40.0, -122.95, 40.05)], "OBJECTID int, ORGNAME string, RSL_TYPE string, kind string, wkb binary, min_x double, min_y double, max_x double, max_y double")
    features = B.stack([api.source_features(spark, s, raw) for s in config.sources])
    grid = spark.createDataFrame([("c", -123.0, 40.0, -122.9, 40.1)], "cell_id string, min_x double, min_y double, max_x double, max_y double")
    table, _ = B._metrics(spark, grid, {"wildlife_refuges": features}, {"wildlife_refuges": {"sources": {}, "completeness": "partial"}}, 0.1)
    row = table.first().asDict()
    counts = {k.rpartition("__")[2]: v for k, v in row.items() if v in (1, 2)}
    assert counts["feature_count"] == 2 and counts["source_record_count"] == 2 and counts["part_count"] == 2
    found = api.get_layer(spark, config, "wildlife_refuges", (-123.05, 40.0, -122.9, 40.1), frames={s.source_id: raw for s in config.sources})
    parts = found.features.select("part_id", "geometry_type", "clipped").collect()
    assert {r["part_id"] for r in parts} == {f"{s.source_id}:5:part-001" for s in config.sources} and {r["clipped"] for r in parts} == {False}
    assert found.memberships.select("part_id").distinct().count() == 2
    told = {r["source_id"]: r for r in found.coverage.collect()}
    assert told["other_refuges"]["geographic_completeness"] == "qualified_named_source_scope" and len(told["other_refuges"]["support_bbox"]) == 4


def _normal(spark, collection, source, schema, *rows):
    from tilewright.plans import normalize as N, providers

    frame = spark.createDataFrame([(*r, "LineString", bytearray(K.to_wkb("LineString", [(0, 0), (1, float(i + 1))]))) for i, r in enumerate(rows)], schema + ", kind string, wkb binary")
    return [r.asDict() for r in N.normalize(frame, providers.layer_of(collection, source), N.Source(source, provider="P", as_of="2020-01-01")).collect()]


def test_records_without_their_own_id(spark):
    """A maritime line falls back to its OBJECTID and then to its geometry; its vintage is its own date, else the source's."""
    schema = "BOUND_ID string, OBJECTID string, REGION string, RULEID int, RULE string, PUB_DATE long, AOR string, STATUS string"
    rows = [("B1", "7", "Alaska", 2, "EEZ", 1_577_836_800_000, "NOAA", "current"), (None, "8", None, 99, None, None, None, None), (None, None, None, None, None, None, None, None)]
    a, b, c = sorted(_normal(spark, "federal_waters", "noaa_us_eez_dynamic", schema, *rows), key=lambda r: r["record_id"])
    assert (a["record_id"], a["feature_id"], a["region"], a["agency"], a["source_vintage"]) == ("8", "us_maritime_zone:exclusive_economic_zone:8", None, None, "2020-01-01")
    assert b["record_id"] == "B1" and b["source_vintage"] == "2020-01-01" and b["geometry_role"] == "eez_outer_limit" and b["feature_name"] == "Alaska — U.S. EEZ limit"
    assert c["record_id"].startswith("geometry-") and c["geometry_role"] == "source_value_unknown"
    found = _normal(spark, "federal_waters", "nrcan_canadian_geopolitical_boundaries_lines", "UUID string, TYPE_E string, SRC_DESC string, P_UPD_DATE string", (None, "EEZ_200", "order", "2011-05-06"), ("u", "INTERN", None, None))
    assert len(found) == 1 and found[0]["source_vintage"] == "2011-05-06" and found[0]["rule_label"] == "EEZ_200" and found[0]["legal_authority"] == "Canada Oceans Act; order"


def test_inventory_fields(spark):
    schema = "site_id string, site_name string, gov_level string, State string, IUCNcat string, estab_yr string, date_gis_u string, prot_lvl string"
    rows = [("A", "Bay", "Federal", "CA", "IV", "1999", "2019-03-04", "No Take"), ("B", None, None, None, None, None, None, None)]
    a, b = sorted(_normal(spark, "marine_protected_areas", "noaa_mpa_inventory_2023", schema, *rows), key=lambda r: r["record_id"])
    assert (a["source_vintage"], a["source_subdivision_code"], a["iucn_class"], a["established_precision"], a["protection_level"]) == ("2019-03-04", "CA", "IV", "year", "No Take")
    assert (b["source_vintage"], b["established_precision"], b["map_group"], b["feature_name"]) == ("2020-01-01", "unknown", "us_state_tribal_local_reference", "B") and a["iucn_status"] != b["iucn_status"]


def test_sanctuary_areas(spark):
    """The polygons of a source together are held against the area by regulation."""
    from tilewright.config import SourceEntry

    x, y = K.equal_area([0.0, 1.0], [47.0, 48.0])
    wide = 3188.0 * 2_589_988.110336 / ((y[1] - y[0]) * (x[1] - x[0]))  # degrees of longitude with that area
    shapes = [_wkb((-125.0, 47.0), (-125.0 + wide / 2, 47.0), (-125.0 + wide / 2, 48.0), (-125.0, 48.0)), _wkb((-125.0 + wide / 2, 47.0), (-125.0 + wide, 47.0), (-125.0 + wide, 48.0), (-125.0 + wide / 2, 48.0))]
    frame = lambda n: spark.createDataFrame([(str(i), "Polygon", shapes[i]) for i in range(n)], "POLY_ID string, kind string, wkb binary")
    source = SourceEntry("noaa_onms_olympic_coast_boundary", "national_marine_sanctuaries")
    good = api.source_features(spark, source, frame(2)).collect()
    assert {(r["area_status"], r["qc_status"]) for r in good} == {("within_0_5_percent_of_current_cfr_approx_area", "passed_with_legal_source_caveat")}
    assert good[0]["geometry_area_sqmi"] == pytest.approx(3188.0, rel=1e-6)
    bad = api.source_features(spark, source, frame(1)).collect()
    assert bad[0]["qc_status"] == "review_required" and bad[0]["area_difference_percent"] == pytest.approx(-50, abs=1e-3)


def test_routing_names(spark):
    schema = "OBJECTID string, MERGE_SRC string, LNAM string, OBJNAM string"
    found = {r["record_id"]: r for r in _normal(spark, "shipping_lanes", "chs_routing_layer_5", schema, ("1", "NAVLNE_L", "L1", None), ("2", "RECTRC_L", None, "Track"))}
    assert [found[k]["jurisdiction"] for k in sorted(found)] == ["Published source coverage; no jurisdiction inferred"] * 2
    first, second = (found[k] for k in sorted(found))
    assert first["feature_name"] == "Chs Navigation Line" and second["feature_name"] == "Track" and first["routing_identity"] != second["routing_identity"]


def test_native_values_in_a_cell(spark):
    """The distinct values of chosen columns in each cell and group, and the declared completeness."""
    shape = lambda x: _wkb((x, 0.1), (x + 0.2, 0.1), (x + 0.2, 0.3))
    rows = [("a", "1", "1", shape(0.1), "b", None), ("a", "2", "2", shape(0.3), "a", 7), ("a", "3", "3", shape(0.5), "b", 7), ("g", "4", "4", shape(1.2), None, None)]
    features = spark.createDataFrame(rows, "group string, feature_id string, record_id string, wkb binary, kind_of string, level int")
    cells = spark.createDataFrame([("x", 0.0, 0.0, 1.0, 1.0), ("y", 1.0, 0.0, 2.0, 1.0)], "cell_id string, min_x double, min_y double, max_x double, max_y double")
    made = {r["cell_id"]: r for r in O.overlay(cells, features, ["a", "g"], 1.0, completeness={"a": "complete", "g": "partial"}, attributes=["kind_of", "level"]).wide.collect()}
    assert made["x"]["a__native_kind_of"] == ["a", "b"] and made["x"]["a__native_level"] == ["7"] and made["y"]["a__native_kind_of"] is None
    assert made["y"]["g__native_kind_of"] is None and made["y"]["g__feature_count"] == 1 and made["x"]["a__source_completeness"] == "complete" and made["x"]["g__source_completeness"] == "partial"
    assert made["y"]["a__feature_count"] == 0 and made["x"]["g__feature_count"] is None
