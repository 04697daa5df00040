import io
import hashlib
import json
import sqlite3
import struct
import zipfile

import pytest
from pyspark.sql import types as T

from tilewright import api, config as C
from tilewright.functions.kernels import from_wkb, to_wkb
from tilewright.plans import normalize as N, providers as PR
from tilewright.sources import acquire as A, readers as R
from tilewright.streaming import points

SQUARE = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]


def test_paged_geojson_with_receipts(spark, tmp_path):
    feature = lambda i, g: {"type": "Feature", "properties": {"OBJECTID": i, "NAME": f"n{i}"}, "geometry": g}
    polygon = {"type": "Polygon", "coordinates": SQUARE}
    snapshot = {"source_id": "s", "pages": [{"retrieved_at": "t1", "response": {"features": [feature(1, polygon), feature(2, None)]}}, {"retrieved_at": "t2", "response": {"features": [feature(1, polygon)]}}]}
    (tmp_path / "a.json").write_text(json.dumps(snapshot))
    (tmp_path / "b.json").write_text(json.dumps({"source_id": "e", "pages": []}))
    schema = T._parse_datatype_string("OBJECTID long, NAME string")
    df = R.paged_geojson(spark, str(tmp_path / "*.json"), schema)
    rows = sorted(df.collect(), key=lambda r: (r["OBJECTID"], r["received_at"]))
    assert [r["kind"] for r in rows] == ["Polygon", "Polygon", None] and rows[0]["max_x"] == 1.0
    assert from_wkb(bytes(rows[0]["wkb"]))[0] == "Polygon"
    assert {r["OBJECTID"]: r["received_at"] for r in R.receipts(df, "OBJECTID").collect()} == {1: "t2", 2: "t1"}
    assert R.paged_geojson(spark, str(tmp_path / "b.json"), schema).count() == 0


def test_ports(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"ports": [{"portNumber": 7, "portName": "A", "latitude": "48°34'00\"N", "longitude": "125°06'00\"W", "tss": "y"}]}))
    row = R.ports(spark, str(tmp_path / "p.json")).first()
    assert (row["portNumber"], row["min_x"], row["max_y"]) == (7, pytest.approx(-125.1), pytest.approx(48 + 34 / 60))


KML = """<kml xmlns="http://www.opengis.net/kml/2.2"><Placemark id="p1"><name>One</name><MultiGeometry><Polygon>
<outerBoundaryIs><LinearRing><coordinates>0,0 4,0 4,4 0,4 0,0</coordinates></LinearRing></outerBoundaryIs>
<innerBoundaryIs><LinearRing><coordinates>1,1 2,1 2,2 1,1</coordinates></LinearRing></innerBoundaryIs></Polygon></MultiGeometry></Placemark></kml>"""


def test_kml_in_kmz_in_zip(spark, tmp_path):
    kmz = io.BytesIO()
    with zipfile.ZipFile(kmz, "w") as z:
        z.writestr("doc.kml", KML)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("inner.kmz", kmz.getvalue())
    row = R.kml_archives(spark, str(tmp_path / "a.zip")).first()
    kind, rings = from_wkb(bytes(row["wkb"]))
    assert (row["placemark"], row["name"], kind, len(rings)) == ("p1", "One", "Polygon", 2)
    with pytest.raises(ValueError, match="entities"):
        list(R.parse_kml(b"<!DOCTYPE kml><kml/>"))
    with pytest.raises(ValueError, match="closed"):
        list(R.parse_kml(KML.replace("0,4 0,0", "0,4 0,1").encode()))


def test_html_zones(spark, tmp_path):
    html = "<h2 id='z1'>Zone <b>1</b></h2><table>" + "".join(f"<tr><td>go</td><td>{a}</td><td>{b}</td></tr>" for a, b in (("48°34.000’N", "125°06.000’W"), ("48°40.0’N", "125°06.0’W"), ("48°40.0’N", "125°00.0’W"))) + "</table>"
    (tmp_path / "r.html").write_text(html)
    tables = R.html_tables(spark, str(tmp_path / "r.html"))
    assert tables.count() == 3
    zone = R.zone_rings(tables).first()
    kind, rings = from_wkb(bytes(zone["wkb"]))
    assert (zone["zone_id"], zone["label"], kind, len(rings[0])) == ("z1", "Zone 1", "Polygon", 4) and rings[0][0] == rings[0][-1]


def instrument(*zones):
    """HTML of an instrument: (section, heading, rows of instruction, latitude, longitude)."""
    out = "June 1, 2026"
    for section in dict.fromkeys(z[0] for z in zones):
        out += f"<h2 id='{section}'>{section}</h2><table>"
        for s, heading, rows in zones:
            if s == section:
                out += f"<tr><th colspan=4>{heading}</th></tr>" + "".join(f"<tr><td>{i}</td><td>{a}</td><td>{b}</td><td>p</td></tr>" for i, a, b in rows)
        out += "</table>"
    return out


RING = [("beginning at", "48°34.000’N", "125°06.000’W"), ("then<br>to", "48°40.0’N", "125°06.0’W"), ("then to", "48°40.0’N", "125°00.0’W"), ("then to", "48°34.000’N", "125°06.000’W")]


def test_zones_by_heading_rows(spark, tmp_path):
    path = str(tmp_path / "i.html")
    open(path, "w").write(instrument(("schedule2", "1. Saturna Island", RING), ("schedule2", "2. Pender Island", RING), ("schedule3", "1. Mouth of the Nitinat River", [("along the coastline", "", "")]), ("schedule3", "2. Swiftsure Bank", RING)))
    zones = R.read_source(spark, path, "instrument")
    assert sorted((r["zone_id"], r["schedule"]) for r in zones.collect()) == [("pender", "schedule2"), ("saturna", "schedule2"), ("swiftsure", "schedule3")]
    for collection, ids in (("exclusion_zones", ["tc.2026:pender", "tc.2026:saturna"]), ("speed_restriction_zones", ["tc.2026:swiftsure"])):
        made = N.normalize(zones, PR.layer_of(collection, "tc_srkw_interim_order_2026"), N.Source("tc_srkw_interim_order_2026"))
        assert sorted(r["feature_id"] for r in made.collect()) == ids
    assert made.first()["original_quantity"] == 10.0 and made.first()["legal_status"] == "derived_reference_geometry"
    for bad, message in (
        (("schedule2", "3. Elsewhere", RING), "unknown zone"),
        (("schedule2", "1. Saturna Island", RING[:3]), "no closed ring"),
        (("schedule2", "1. Saturna Island", [*RING[:2], ("along the shore", "", ""), *RING[2:]]), "without coordinates"),
        (("schedule2", "1. Saturna Island", [("to", "48°60.000’N", "125°06.000’W"), *RING[1:]]), "not a coordinate"),
    ):
        open(path, "w").write(instrument(bad))
        with pytest.raises(Exception, match=message):
            R.read_source(spark, path, "instrument").collect()


def test_formats_are_dispatched_and_pinned(spark, tmp_path):
    path = str(tmp_path / "f.geojson")
    body = json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"OBJECTID": 7, "NAME": "a"}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]})
    open(path, "w").write(body)
    digest = hashlib.sha256(body.encode()).hexdigest()
    row = R.read_source(spark, path, "geojson", expected_sha256=digest).first()
    assert (row["OBJECTID"], row["NAME"], row["kind"], row["min_x"]) == (7, "a", "Point", 1.0)
    with pytest.raises(ValueError, match="pinned"):
        R.read_source(spark, path, "geojson", expected_sha256="0" * 64)
    with pytest.raises(ValueError, match="unknown format"):
        R.read_source(spark, path, "dwg")


def test_geopackage(spark, tmp_path):
    path = tmp_path / "a.gpkg"
    db = sqlite3.connect(path)
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id integer)")
    db.execute("create table gpkg_spatial_ref_sys (srs_id integer, organization text, organization_coordsys_id integer, definition text)")
    db.execute("insert into gpkg_geometry_columns values ('lanes', 'geom', 4326)")
    db.execute("insert into gpkg_spatial_ref_sys values (4326, 'EPSG', 4326, '')")
    db.execute("create table lanes (geom blob, routeType text)")
    header = b"GP\0\3" + struct.pack("<i", 4326) + struct.pack("<4d", 0, 1, 0, 1)
    db.execute("insert into lanes values (?, 'tss')", (header + to_wkb("Polygon", SQUARE),))
    db.execute("insert into lanes values (null, 'none')")
    db.commit()
    db.close()
    rows = R.geopackage(spark, str(path), "lanes").orderBy("fid").collect()
    assert json.loads(rows[0]["properties"]) == {"routeType": "tss"} and rows[0]["kind"] == "Polygon" and rows[1]["wkb"] is None


def test_shapefile_parts():
    ring = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
    flat = [v for p in ring + hole for v in p]
    body = struct.pack("<i4d2i2i", 5, 0, 0, 4, 4, 2, 9, 0, 5) + struct.pack(f"<{len(flat)}d", *flat)
    data = b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body + struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    assert list(R.parse_shp(data)) == [("Polygon", [ring, hole]), (None, None)]


def test_grid_reader(spark, tmp_path):
    cells = spark.createDataFrame([("a", 1, 0.0, 0.0, 1.0, 1.0)], "CELL_ID string, RESOLUTION int, MIN_X double, MIN_Y double, MAX_X double, MAX_Y double")
    cells.write.parquet(str(tmp_path / "g"))
    assert R.grid(spark, str(tmp_path / "g")).first()["cell_id"] == "a"
    cells.union(cells).write.parquet(str(tmp_path / "twice"))
    with pytest.raises(ValueError, match="distinct"):
        R.grid(spark, str(tmp_path / "twice"))


def test_acquisition_checks(spark):
    assert A.covers((170, 0, -170, 10), (175, 1, 179, 2)) and not A.covers((0, 0, 1, 1), (0, 0, 2, 1))
    with pytest.raises(ValueError, match="version"):
        A.check_receipt({"provider": "p", "version": 1}, {"provider": "p", "version": 2})
    budget = A.Budget(pages=1)
    budget.spend(pages=1)
    with pytest.raises(ValueError):
        budget.spend(pages=1)
    held = {i: {"id": i} for i in range(10)}
    short = lambda batch: [held[i] for i in batch][:3]
    assert sorted(r["id"] for r in A.fetch_all(list(held), short, 8)) == list(range(10))
    with pytest.raises(ValueError, match="not delivered"):
        A.fetch_all([99], lambda b: [])
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1,), (1,), (3,)], "k int")
    with pytest.raises(ValueError, match="repeated"):
        A.check_roster(a, b, "k")
    A.check_roster(a, a, "k")


def test_tasks_fetch_records(spark):
    def short(batch):  # the provider never returns more than three records
        return [{"id": i, "v": f"r{i}"} for i in batch[:3]]

    ids = spark.createDataFrame([(i % 50,) for i in range(120)] + [(None,)], "id long")
    got = A.fetched(ids, "id", short, "id long, v string", size=16)
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(i, f"r{i}") for i in range(50)]
    with pytest.raises(Exception, match="announced"):
        A.fetched(ids, "id", lambda batch: [{"id": i, "v": ""} for i in batch if i != 7], "id long, v string", size=16).collect()
    assert A.fetched(ids.limit(0), "id", short, "id long, v string").count() == 0


CONFIG = """
vars: {who: FWS}
bounds: [-130, 30, -110, 50]
areas: {small: [-123.05, 40.0, -122.9, 40.1]}
sources:
  fws: {collection: wildlife_refuges, provider: "${vars.who}", coverage: {north: complete}}
  later: {collection: wildlife_refuges, proposed: true}
  gone: {collection: wildlife_refuges, path: /nowhere}
"""


def test_config(tmp_path, monkeypatch):
    (tmp_path / "a.yaml").write_text(CONFIG)
    (tmp_path / "b.yaml").write_text("extends: a.yaml\nbounds: [-131, 30, -110, 50]\n")
    a, b = C.load(str(tmp_path / "a.yaml")), C.load(str(tmp_path / "b.yaml"))
    assert a.sources[0].provider == "FWS" and b.bounds[0] == -131 and a.digest() != b.digest()
    for bad in ("bounds: [0, 0, 1, 1]\nodd: 1\n", "bounds: [0, 0, 1, 1]\nsources: {x: {collection: nope}}\n", "bounds: [0, 0, 1, 1]\nareas: {x: [\"${env:NOT_SET_HERE}\", 0, 1, 1]}\n"):
        (tmp_path / "c.yaml").write_text(bad)
        with pytest.raises(ValueError):
            C.load(str(tmp_path / "c.yaml"))
    (tmp_path / "d.yaml").write_text("extends: d.yaml\n")
    with pytest.raises(ValueError, match="itself"):
        C.load(str(tmp_path / "d.yaml"))


def polygon(*points):
    return bytearray(to_wkb("Polygon", [[*points, points[0]]]))


def test_get_layer(spark, tmp_path):
    (tmp_path / "a.yaml").write_text(CONFIG)
    config = C.load(str(tmp_path / "a.yaml"))
    raw = spark.createDataFrame(
        [(1, "A", "NWR", -123.02, 40.02, -122.95, 40.05), (2, "far", "NWR", -115.0, 31.0, -114.0, 32.0)],
        "OBJECTID int, ORGNAME string, RSL_TYPE string, min_x double, min_y double, max_x double, max_y double",
    )
    found = api.get_layer(spark, config, "wildlife_refuges", "small", frames={"fws": raw})
    assert [r["feature_id"] for r in found.features.collect()] == ["fws:1"]
    assert {r["source_id"]: r["status"] for r in found.coverage.collect()} == {"fws": "available", "later": "not_applicable", "gone": "unavailable"}
    cells = found.cells.collect()
    assert len(cells) == 2 and {r["fws__status"] for r in cells} == {"partial"} and {r["gone__status"] for r in cells} == {"unavailable"}
    assert found.memberships.count() == 2
    bad = [dict(collection="nope"), dict(collection="seasonal_closures"), dict(collection="ports", bbox=(0, 1, 1, 0)), dict(collection="ports", as_of="2020-01-01"), dict(collection="ports", max_cells=0)]
    for options in bad:
        with pytest.raises((ValueError, NotImplementedError)):
            api.get_layer(spark, config, **options)
    with pytest.raises(Exception):
        api.get_layer(spark, config, "wildlife_refuges", "small", frames={"fws": raw}, allow_partial=False)
    assert {(r["source"], r["status"]) for r in api.availability(spark, config, ["north"]).collect()} >= {("fws", "complete"), ("gone", "unknown")}


def test_layer_of_shapes(spark, tmp_path):
    """Features are chosen and measured by their geometry; a source with a bad row is a coverage row."""
    sources = "\n".join(f"  {s}: {{collection: marine_protected_areas}}" for s in ("dfo_oceans_act_marine_protected_areas", "dfo_oceans_act_areas_of_interest", "odfw_marine_reserves_2016"))
    (tmp_path / "m.yaml").write_text(f"bounds: [-130, 40, -120, 50]\nsources:\n{sources}\n")
    schema = "OBJECTID int, NAME_E string, ZONE_E string, kind string, wkb binary, min_x double, min_y double, max_x double, max_y double"
    slanted = polygon((-125.0, 45.0), (-124.0, 46.0), (-125.0, 46.0))  # its bounds meet the box, it doesn't
    inside = polygon((-124.2, 45.0), (-124.0, 45.0), (-124.0, 45.2))
    active = [(1, "Bay", "Core", "Polygon", inside, -124.2, 45.0, -124.0, 45.2), (2, "Off", "Core", "Polygon", slanted, -125.0, 45.0, -124.0, 46.0)]
    point = [(9, "New Bay", None, "Point", bytearray(to_wkb("Point", (-124.05, 45.05))), -124.05, 45.05, -124.05, 45.05)]
    bad = spark.createDataFrame([(None, "x", "Point", -124.1, 45.1, -124.1, 45.1)], "ODFW_RECORD_ID string, ODFW_NAME string, kind string, min_x double, min_y double, max_x double, max_y double")
    frames = {
        "dfo_oceans_act_marine_protected_areas": spark.createDataFrame(active, schema),
        "dfo_oceans_act_areas_of_interest": spark.createDataFrame(point, schema),
        "odfw_marine_reserves_2016": bad,
    }
    found = api.get_layer(spark, C.load(str(tmp_path / "m.yaml")), "marine_protected_areas", (-124.2, 45.0, -124.0, 45.2), cell_degrees=0.1, frames=frames)
    assert sorted(r["feature_id"] for r in found.features.collect()) == ["marine_protected_area:can:bay:1", "marine_protected_area_aoi:can:new-bay"]
    assert {r["source_id"]: r["status"] for r in found.coverage.collect()}["odfw_marine_reserves_2016"] == "unavailable"
    cells = {r["cell_id"]: r.asDict() for r in found.cells.collect()}
    source, proposed = "dfo_oceans_act_marine_protected_areas__", "dfo_oceans_act_areas_of_interest__proposed__"
    corner = next(c for c in cells.values() if c[proposed + "point_count"] == 1)
    assert corner[source + "polygon_coverage_fraction"] == pytest.approx(1.0) and corner[source + "zone_count"] == 1
    shares = sorted(c[source + "polygon_coverage_fraction"] for c in cells.values() if c[source + "feature_count"])
    assert shares == [pytest.approx(0.5, abs=1e-3), pytest.approx(0.5, abs=1e-3), pytest.approx(1.0)]


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(f"2024-01-01 00:0{i % 9}:00", float(i % 25), 1.0, i % 4) for i in range(60)], "t string, x double, y double, f int")
    rows = rows.selectExpr("cast(t as timestamp) as t", "x", "y", "f")
    rows.write.parquet(str(tmp_path / "in"))
    want = sorted(map(tuple, points.windowed_counts(rows, 10, "t", "5 minutes", "1 hour", "f").collect()))
    stream = points.windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), 10, "t", "5 minutes", "1 hour", "f")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("moving").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("moving").collect())) == want
