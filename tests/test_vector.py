"""GeoPackages and shapefiles read in ranges of rows, with boxes handed to the files' own indexes."""

import json
import sqlite3
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tilewright.functions.kernels import to_wkb
from tilewright.sources import readers as R, vector as V

N = 1000
WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'


def box(i):
    x, y = -120 + (i % 40) * 0.1, 30 + (i // 40) * 0.1
    return x, y, x + 0.05, y + 0.05


def ring(i):
    w, s, e, n = box(i)
    return [(w, s), (w, n), (e, n), (e, s), (w, s)]


def inside(w, s, e, n):
    return {i for i in range(N) if box(i)[2] >= w and box(i)[0] <= e and box(i)[3] >= s and box(i)[1] <= n}


def package(path, poisoned=(), tree=True, gaps=1):
    """N squares at row ids 1, 1 + gaps, ...; the poisoned ones can't be read."""
    db = sqlite3.connect(path)
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id integer)")
    db.execute("create table gpkg_spatial_ref_sys (srs_id integer, organization text, organization_coordsys_id integer, definition text)")
    db.execute("insert into gpkg_geometry_columns values ('lanes', 'geom', 4326), ('none', 'geom', 4326)")
    db.execute("insert into gpkg_spatial_ref_sys values (4326, 'EPSG', 4326, '')")
    for t in ("lanes", "none"):
        db.execute(f'create table {t} (fid integer primary key, geom blob, "the name" text, number integer)')
    if tree:
        db.execute("create virtual table rtree_lanes_geom using rtree(id, minx, maxx, miny, maxy)")
    for i in range(N):
        blob = b"no geometry" if i in poisoned else b"GP\0\1" + struct.pack("<i", 4326) + to_wkb("Polygon", [ring(i)])
        db.execute("insert into lanes values (?, ?, ?, ?)", (1 + gaps * i, blob, f"n{i}", i))
        if tree:
            w, s, e, n = box(i)
            db.execute("insert into rtree_lanes_geom values (?, ?, ?, ?, ?)", (1 + gaps * i, w, e, s, n))
    db.execute("insert into lanes values (-7, null, null, null)")
    db.commit()
    db.close()
    return str(path)


def shapefile(folder, poisoned=(), index=True, stem="a", prj=WGS84):
    body, offsets = b"", b""
    for i in range(N):
        flat = [v for p in ring(i) for v in p]
        points = 1 << 28 if i in poisoned else 5
        one = struct.pack("<i4d2ii", 5, *box(i), 1, points, 0) + struct.pack("<10d", *flat)
        if i == 7:
            one = struct.pack("<i", 0)  # no shape
        offsets += struct.pack(">2i", (100 + len(body)) // 2, len(one) // 2)
        body += struct.pack(">2i", i + 1, len(one) // 2) + one
    head = lambda size: struct.pack(">i20xi", 9994, size // 2) + b"\0" * 72
    dbf = struct.pack("<B3xIHH20x", 3, N, 65, 7) + b"NAME\0\0\0\0\0\0\0C" + b"\0" * 4 + bytes([6]) + b"\0" * 15 + b"\r"
    dbf += b"".join(f" n{i}".encode().ljust(7) for i in range(N)) + b"\x1a"
    files = {"shp": head(100 + len(body)) + body, "dbf": dbf, "prj": prj.encode()} | ({"shx": head(100 + 8 * N) + offsets} if index else {})
    for end, data in files.items():
        (folder / f"{stem}.{end}").write_bytes(data)
    return files


@pytest.mark.parametrize("gaps", [1, 13])
def test_geopackage_in_ranges(spark, tmp_path, gaps):
    df = V.vector(spark, package(tmp_path / "a b.gpkg", gaps=gaps), "geopackage", "lanes", rows=90)
    assert df.rdd.getNumPartitions() == 12
    rows = df.collect()
    assert sorted(int(r["fid"]) for r in rows) == [-7, *range(1, 1 + gaps * N, gaps)]
    by_number = {json.loads(r["properties"])["number"]: r for r in rows}
    assert by_number[None]["kind"] is None and by_number[None]["min_x"] is None
    assert all(tuple(by_number[i][s] for s in V.SIDES) == box(i) for i in range(N))
    assert bytes(by_number[5]["wkb"]) == to_wkb("Polygon", [ring(5)])
    assert V.vector(spark, str(tmp_path), "geopackage", "none").count() == 0


def test_box_reaches_the_tree(spark, tmp_path):
    w, s, e, n = -119.02, 30.51, -118.33, 31.0
    wanted = inside(w, s, e, n)
    path = package(tmp_path / "a.gpkg", poisoned=set(range(N)) - inside(w - 0.01, s - 0.01, e + 0.01, n + 0.01))
    found = V.vector(spark, path, "geopackage", "lanes", rows=10).where((F.col("min_x") <= e) & (F.col("max_x") >= w) & (F.col("min_y") <= n) & (F.col("max_y") >= s))
    assert {int(r["fid"]) - 1 for r in found.collect()} == wanted and wanted
    with pytest.raises(Exception, match="not a GeoPackage geometry"):
        V.vector(spark, path, "geopackage", "lanes").collect()
    plain = V.vector(spark, package(tmp_path / "b.gpkg", tree=False), "geopackage", "lanes")
    assert plain.where((F.col("min_x") <= e) & (F.col("max_x") >= w) & (F.col("min_y") <= n) & (F.col("max_y") >= s)).count() == len(wanted)
    sound = V.vector(spark, package(tmp_path / "c.gpkg"), "geopackage", "lanes")
    exact = sound.where((F.col("min_x") == box(min(wanted))[0]) & (F.col("max_y") == box(min(wanted))[3]))
    assert [int(r["fid"]) - 1 for r in exact.collect()] == [min(wanted)]


@pytest.mark.parametrize("how", ["loose", "zip", "no index"])
def test_shapefile_in_ranges(spark, tmp_path, how):
    files = shapefile(tmp_path, index=how != "no index")
    path = str(tmp_path / "a.shp")
    if how == "zip":
        path = str(tmp_path / "z.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for end, data in files.items():
                z.writestr(f"in/A.{end.upper()}", data)
    df = V.vector(spark, path, "shapefile", rows=90)
    assert df.rdd.getNumPartitions() == (1 if how == "no index" else 12)
    rows = {int(r["fid"]): r for r in df.collect()}
    assert set(rows) == set(range(N)) and rows[7]["wkb"] is None
    assert all(json.loads(r["properties"]) == {"NAME": f"n{i}"} and (i == 7 or tuple(r[s] for s in V.SIDES) == box(i)) for i, r in rows.items())
    named = R.read_source(spark, path, "shapefile")
    assert named.where("NAME = 'n12'").select("fid", "NAME").collect() == [("12", "n12")]


def test_box_skips_records(spark, tmp_path):
    w, s, e, n = -119.02, 30.51, -118.33, 31.0
    shapefile(tmp_path, poisoned=set(range(N)) - inside(w, s, e, n) - {7})
    df = V.vector(spark, str(tmp_path), "shapefile", rows=100).where((F.col("min_x") <= e) & (F.col("max_x") >= w) & (F.col("min_y") <= n) & (F.col("max_y") >= s))
    assert {int(r["fid"]) for r in df.collect()} == inside(w, s, e, n) - {7}


def test_fields_by_headers(spark, tmp_path):
    path = package(tmp_path / "a.gpkg")
    assert V.fields(spark, path, "geopackage", "lanes") == ["fid", "number", "the name"]
    empty = R.read_source(spark, path, "geopackage", "none")
    assert empty.count() == 0 and {"number", "the name"} <= set(empty.columns)
    with pytest.raises(Exception, match="no layer"):
        R.read_source(spark, path, "geopackage", "absent")
