"""Readers of provider formats as DataFrames with explicit columns.

Geometry comes as GeoJSON type, WKB and four bounds. Files are read by Spark's own readers;
what a format needs beyond them is done per file inside tasks.
"""

from __future__ import annotations

import hashlib
import io
import itertools
import json
import os
import re
import struct
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import crs, scalar as S
from ..functions.kernels import _NAMES, box_wkb, from_wkb, to_wkb

SHAPE = "kind string, wkb binary, min_x double, min_y double, max_x double, max_y double"
#: Bound of what one nested archive member may unpack to.
MEMBER_BYTES = 4_000_000
#: Rows that a file reader hands on at a time.
BATCH = 2000


def _points(coordinates) -> Iterator[tuple]:
    if coordinates and isinstance(coordinates[0], (int, float)):
        yield coordinates
    else:
        for c in coordinates:
            yield from _points(c)


def moved(coordinates, system: crs.System):
    """GeoJSON coordinates of a system as longitudes and latitudes."""
    if isinstance(coordinates[0], (int, float)):
        x, y = crs.to_lonlat(system, coordinates[0], coordinates[1])
        return float(x), float(y)
    if isinstance(coordinates[0][0], (int, float)):
        x, y = crs.to_lonlat(system, [p[0] for p in coordinates], [p[1] for p in coordinates])
        return list(zip(x.tolist(), y.tolist()))
    return [moved(c, system) for c in coordinates]


def shape(kind: str | None, coordinates, system: crs.System | None = None) -> tuple:
    """(kind, wkb, bounds) of a GeoJSON geometry; nulls for an empty or absent one; raises for unknown types.

    Coordinates of a system other than longitude and latitude are brought to these.
    """
    if kind is None or not coordinates:
        return (None,) * 6
    if kind not in _NAMES.values() or kind == "GeometryCollection":
        raise ValueError(f"unsupported source geometry {kind}")
    if system is not None and system.kind != "geographic":
        coordinates = moved(coordinates, system)
    xs, ys = zip(*[p[:2] for p in _points(coordinates)])
    return kind, to_wkb(kind, coordinates), float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys))


def _shapes(df: DataFrame, geometry: str) -> DataFrame:
    """df with the columns of SHAPE in place of a column of GeoJSON geometry text."""
    fields = T._parse_datatype_string(SHAPE)

    def run(a):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_type

        rows = [shape(None, None) if g is None else shape(*(json.loads(g).get(k) for k in ("type", "coordinates"))) for g in a.to_pylist()]
        return pa.array([dict(zip(fields.names, r)) for r in rows], to_arrow_type(fields))

    return df.withColumn("__shape", F.arrow_udf(run, fields)(geometry)).select(*[c for c in df.columns if c != geometry], "__shape.*")


def paged_geojson(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """Features of snapshots with pages of responses: properties, received_at of each feature's page, and shape.

    A snapshot without features gives no rows and still has all columns.
    """
    feature = T.StructType().add("type", "string").add("properties", properties).add("geometry", "string")
    page = T.StructType().add("retrieved_at", "string").add("response", T.StructType().add("features", T.ArrayType(feature)))
    snapshots = spark.read.schema(T.StructType().add("source_id", "string").add("pages", T.ArrayType(page))).json(path, multiLine=True)
    pages = snapshots.select("source_id", F.explode("pages").alias("page"))
    features = pages.select("source_id", F.col("page.retrieved_at").alias("received_at"), F.explode("page.response.features").alias("f"))
    return _shapes(features.select("source_id", "received_at", "f.properties.*", F.col("f.geometry").alias("geometry")), "geometry")


def receipts(features: DataFrame, object_id: str) -> DataFrame:
    """(object_id, received_at): the page time of each record, the latest where a record came twice."""
    return features.groupBy(object_id).agg(F.max("received_at").alias("received_at"))


def geojson(spark: SparkSession, path: str, properties: T.StructType) -> DataFrame:
    """Features of GeoJSON feature collections."""
    feature = T.StructType().add("properties", properties).add("geometry", "string")
    files = spark.read.schema(T.StructType().add("features", T.ArrayType(feature))).json(path, multiLine=True)
    rows = files.select(F.explode("features").alias("f")).select("f.properties.*", F.col("f.geometry").alias("geometry"))
    return _shapes(rows, "geometry")


def footers(spark: SparkSession, path: str, key: str) -> list[str | None]:
    """The different values that a key has in the footers of Parquet files, read by tasks; null where a file lacks it."""
    files = spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")
    files = files.repartition(max(1, min(files.count(), spark.sparkContext.defaultParallelism)))

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            found = []
            for name in batch.column("file").to_pylist():
                system, place = fs.FileSystem.from_uri(name)
                with system.open_input_file(place) as f:
                    value = (pq.ParquetFile(f).metadata.metadata or {}).get(key.encode())
                found.append(value.decode() if value is not None else None)
            yield pa.RecordBatch.from_pydict({"value": pa.array(found, pa.string())})

    return [r["value"] for r in files.mapInArrow(run, "value string").distinct().collect()]


def geoparquet(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """Parquet with WKB in a column, as longitudes and latitudes; bounds are worked out where the file has none.

    The system is that of the files' `geo` metadata, in which all files must agree. Files
    without such metadata are tables of longitudes and latitudes; other numbers are an error.
    """
    df, told = spark.read.parquet(path), footers(spark, path, "geo")
    systems = {crs.from_geo_metadata(t, geometry) if t is not None else None for t in told}
    if len(systems) > 1:
        raise ValueError(f"{path}: files of different coordinate systems")
    (system,) = systems or {None}
    if {"min_x", "min_y", "max_x", "max_y"} <= set(df.columns) and (system is None or system.kind == "geographic"):
        return df.withColumnRenamed(geometry, "wkb")
    fields = T._parse_datatype_string(SHAPE)

    def run(a):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_type

        rows = [shape(None, None) if w is None else shape(*from_wkb(w), system) for w in a.to_pylist()]
        if system is None and any(r[2] is not None and (max(abs(r[2]), abs(r[4])) > 540 or max(abs(r[3]), abs(r[5])) > 90) for r in rows):
            raise ValueError("no coordinate system is declared, and these are no degrees")
        return pa.array([dict(zip(fields.names, r)) for r in rows], to_arrow_type(fields))

    bounds = ("min_x", "min_y", "max_x", "max_y", geometry)
    return df.withColumn("__shape", F.arrow_udf(run, fields)(geometry)).select(*[c for c in df.columns if c not in bounds], "__shape.*")


def ports(spark: SparkSession, path: str) -> DataFrame:
    """Points of a JSON array of ports with coordinates in degrees, minutes and seconds; unreadable ones have null bounds."""
    port = T._parse_datatype_string("portNumber long, portName string, latitude string, longitude string, tss string")
    files = spark.read.schema(T.StructType().add("ports", T.ArrayType(port))).json(path, multiLine=True)
    p = files.select(F.explode("ports").alias("p")).select("p.*")
    lon, lat = S.dms("longitude"), S.dms("latitude")
    p = p.select("portNumber", "portName", "latitude", "longitude", "tss", F.lit("Point").alias("kind"), lon.alias("min_x"), lat.alias("min_y"), lon.alias("max_x"), lat.alias("max_y"))
    return p.withColumn("wkb", box_wkb("min_x", "min_y", "max_x", "max_y"))


# --- formats read file by file ----------------------------------------------------------------


def _from_files(files: DataFrame, rows, schema: str) -> DataFrame:
    """Rows of each whole file: rows(name, bytes) runs in tasks, one file at a time, and hands on BATCH rows at a time.

    files: path and content. A file is one row, so the rows of a large one are dealt out to all tasks.
    """
    fields = T._parse_datatype_string(schema)

    def run(batches):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(fields)
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                found = iter(rows(name, content))
                while made := [dict(zip(kind.names, r)) for r in itertools.islice(found, BATCH)]:
                    yield pa.RecordBatch.from_pylist(made, kind)

    return files.select("path", "content").mapInArrow(run, schema).repartition(files.sparkSession.sparkContext.defaultParallelism)


def _per_file(spark: SparkSession, path: str, rows, schema: str) -> DataFrame:
    return _from_files(spark.read.format("binaryFile").load(path), rows, schema)


def _ring(text: str) -> list[tuple[float, float]]:
    ring = [tuple(float(v) for v in p.split(",")[:2]) for p in text.split()]
    if len(ring) < 4 or ring[0] != ring[-1]:
        raise ValueError("a ring must be closed")
    return ring


def _kml_rows(name: str, content: bytes):
    with zipfile.ZipFile(io.BytesIO(content)) as outer:
        for kmz in (n for n in outer.namelist() if n.lower().endswith(".kmz")):
            if outer.getinfo(kmz).file_size > MEMBER_BYTES:
                raise ValueError(f"{name}: {kmz} is too large")
            with zipfile.ZipFile(io.BytesIO(outer.read(kmz))) as inner:
                for kml in (n for n in inner.namelist() if n.lower().endswith(".kml")):
                    if inner.getinfo(kml).file_size > MEMBER_BYTES:
                        raise ValueError(f"{name}: {kml} is too large")
                    yield from parse_kml(inner.read(kml))


def parse_kml(data: bytes) -> Iterator[tuple]:
    """(placemark id, name, shape...) of a KML document; document types and entities are refused."""
    if re.search(rb"<!\s*(DOCTYPE|ENTITY)", data, re.I):
        raise ValueError("document types and entities are not read")
    local = lambda e: e.tag.rpartition("}")[2]
    for mark in (e for e in ElementTree.fromstring(data).iter() if local(e) == "Placemark"):
        polygons = []
        for polygon in (e for e in mark.iter() if local(e) == "Polygon"):
            shell, holes = None, []
            for border in polygon:
                rings = [_ring(c.text or "") for c in border.iter() if local(c) == "coordinates"]
                if local(border) == "outerBoundaryIs":
                    shell = rings[0]
                elif local(border) == "innerBoundaryIs":
                    holes += rings
            if shell is None:
                raise ValueError("a polygon without an outer boundary")
            polygons.append([shell, *holes])
        title = next((c.text for c in mark if local(c) == "name"), None)
        if polygons:
            yield mark.get("id"), title, *(shape("Polygon", polygons[0]) if len(polygons) == 1 else shape("MultiPolygon", polygons))


def kml_archives(spark: SparkSession, path: str) -> DataFrame:
    """Polygon placemarks of KML in KMZ in ZIP files."""
    return _per_file(spark, path, _kml_rows, "placemark string, name string, " + SHAPE)


class _Tables(HTMLParser):
    """Table rows under the heading that has an id: (heading id, heading, cells)."""

    def __init__(self):
        super().__init__()
        self.rows, self.section, self.title, self.into, self.cells = [], None, "", None, []

    def handle_starttag(self, tag, attrs):
        if tag == "h2":
            self.section, self.title, self.into = dict(attrs).get("id"), "", "title"
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            self.cells.append("")
            self.into = "cell"
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in ("h2", "td", "th"):
            self.into = None
        elif tag == "tr" and self.section and self.cells:
            self.rows.append((self.section, self.title.strip(), [c.strip() for c in self.cells]))

    def handle_data(self, data):
        if self.into == "title":
            self.title += data
        elif self.into == "cell":
            self.cells[-1] += data


def tables_of(files: DataFrame) -> DataFrame:
    """(file, section, title, row, cells) of the tables under the headings of HTML documents (path, content), in document order."""

    def rows(name, content):
        parser = _Tables()
        parser.feed(bytes(content).decode("utf-8"))
        for i, (section, title, cells) in enumerate(parser.rows):
            yield name, section, title, i, cells

    return _from_files(files, rows, "file string, section string, title string, row int, cells array<string>")


def html_tables(spark: SparkSession, path: str) -> DataFrame:
    return tables_of(spark.read.format("binaryFile").load(path))


_DM = re.compile(r"^\s*(\d{1,3})\s*°\s*(\d{1,2}(?:\.\d+)?)\s*[’'′]?\s*([NSEW])\s*$")
#: Headings of the instrument's zones and their ids, and the zone that a coastline closes (fixed values).
INSTRUMENT_ZONES = {"1. Saturna Island": "saturna", "2. Pender Island": "pender", "1. Mouth of the Nitinat River": "nitinat", "2. Swiftsure Bank": "swiftsure"}
OPEN_ZONES = ("nitinat",)


def _degrees(text: str, axis: str) -> float | None:
    """Degrees of `48°34.000’N`; None for what is no coordinate of the axis; minutes are under 60."""
    m = _DM.match(text)
    if not m or m[3] not in axis:
        return None
    if float(m[2]) >= 60 or float(m[1]) + float(m[2]) / 60 > (90 if axis == "NS" else 180):
        raise ValueError(f"not a coordinate: {text}")
    return (float(m[1]) + float(m[2]) / 60) * (-1 if m[3] in "SW" else 1)


def zone_rings(tables: DataFrame, zones: dict[str, str] | None = None, open_zones: tuple[str, ...] = (), schedules: tuple[str, ...] | None = None) -> DataFrame:
    """(zone_id, schedule, label, shape) of the zones in html_tables, each a ring of the coordinates in its rows.

    A row of one cell is a heading and begins a zone; rows before any heading are the section's
    own zone. zones names the ids of headings by how they begin: another heading is an error.
    Without zones, a heading is its own id. open_zones are closed by something else than
    coordinates and left out. A row that holds no latitude and longitude is an error in a zone
    with headings, as is a ring that is not closed; a section's own zone is closed here. Rows of
    sections other than schedules are skipped where these are named.
    """
    schema = "zone_id string, schedule string, label string, " + SHAPE
    if schedules is not None:
        tables = tables.where(F.col("section").isin(*schedules))
    begins = F.when(F.size("cells") == 1, F.element_at("cells", 1))
    so_far = Window.partitionBy("file", "section").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    rows = tables.withColumn("heading", F.last(begins, ignorenulls=True).over(so_far)).where("size(cells) > 1")
    if zones is not None:
        known = F.coalesce(*[F.when(F.col("heading").startswith(k), F.lit(v)) for k, v in zones.items()])
        unknown = F.raise_error(F.concat(F.lit("unknown zone heading: "), F.coalesce("heading", F.lit("none")))).cast("string")
        rows = rows.withColumn("zone", F.when(known.isNull(), unknown).otherwise(known)).where(~F.col("zone").isin(*open_zones)) if open_zones else rows.withColumn("zone", F.when(known.isNull(), unknown).otherwise(known))
    else:
        rows = rows.withColumn("zone", F.coalesce("heading", "section"))

    def build(pdf):
        import pandas as pd

        zone, named = pdf["zone"].iloc[0], pdf["heading"].iloc[0]
        points = []
        for cells in pdf.sort_values("row")["cells"]:
            lat = next((v for v in (_degrees(c, "NS") for c in cells) if v is not None), None)
            lon = next((v for v in (_degrees(c, "EW") for c in cells) if v is not None), None)
            if lat is not None and lon is not None:
                points.append((lon, lat))
            elif named is not None:
                raise ValueError(f"zone {zone}: a boundary without coordinates: {list(cells)}")
        if named is not None and (len(points) < 4 or points[0] != points[-1]):
            raise ValueError(f"zone {zone} is no closed ring")
        if len(points) < 3:
            raise ValueError(f"zone {zone} has fewer than three points")
        if points[0] != points[-1]:
            points.append(points[0])
        names = [f.split()[0] for f in schema.split(", ")]
        return pd.DataFrame([(zone, pdf["section"].iloc[0], named or pdf["title"].iloc[0], *shape("Polygon", [points]))], columns=names)

    return rows.groupBy("file", "section", "zone").applyInPandas(build, schema)


def gpkg_wkb(blob: bytes) -> bytes:
    """WKB of a GeoPackage geometry, its header and envelope taken off."""
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    envelope = (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]
    return blob[8 + envelope :]


def geopackage(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """(fid, properties as JSON, shape) of a layer of GeoPackage files, in longitudes and latitudes; a layer without a known system is an error."""
    from .vector import vector

    return vector(spark, path, "geopackage", layer)


def shp_geometry(body: bytes) -> tuple:
    """GeoJSON type and coordinates of a shapefile's record; rings are grouped by their direction."""
    (code,) = struct.unpack_from("<i", body)
    if code == 0:
        return None, None
    if code in (1, 11, 21):
        return "Point", struct.unpack_from("<2d", body, 4)
    if code not in (3, 13, 23, 5, 15, 25):
        raise ValueError(f"unsupported shape type {code}")
    n_parts, n_points = struct.unpack_from("<2i", body, 36)
    starts = [*struct.unpack_from(f"<{n_parts}i", body, 44), n_points]
    flat = struct.unpack_from(f"<{2 * n_points}d", body, 44 + 4 * n_parts)
    points = list(zip(flat[::2], flat[1::2]))
    parts = [points[a:b] for a, b in zip(starts, starts[1:])]
    if code in (3, 13, 23):
        return ("LineString", parts[0]) if len(parts) == 1 else ("MultiLineString", parts)
    polygons: list = []
    for ring in parts:  # shells run clockwise, holes the other way
        area = sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:]))
        if area <= 0 or not polygons:
            polygons.append([ring])
        else:
            polygons[-1].append(ring)
    return ("Polygon", polygons[0]) if len(polygons) == 1 else ("MultiPolygon", polygons)


def parse_shp(data: bytes) -> Iterator[tuple]:
    """GeoJSON type and coordinates of the points, lines and polygons of a whole shapefile."""
    at = 100
    while at < len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        body, at = data[at + 8 : at + 8 + 2 * words], at + 8 + 2 * words
        yield shp_geometry(body)


def shapefiles(spark: SparkSession, path: str) -> DataFrame:
    """(fid, properties as JSON, shape) of shapefiles in ZIP files or loose, in longitudes and latitudes by their .prj, which they must have."""
    from .vector import vector

    return vector(spark, path, "shapefile")


# --- grids -----------------------------------------------------------------------------------


def grid(spark: SparkSession, path: str) -> DataFrame:
    """A grid with upper- or lower-case columns: cell_id, resolution and box; null, repeated or empty cells raise."""
    df = spark.read.parquet(path)
    df = df.select(*[F.col(c).alias(c.lower()) for c in df.columns])
    bad = df.agg(
        F.count("*").alias("rows"),
        F.countDistinct("cell_id").alias("distinct"),
        F.count_if(F.col("cell_id").isNull() | ~F.coalesce((F.col("min_x") < F.col("max_x")) & (F.col("min_y") < F.col("max_y")), F.lit(False))).alias("bad"),
    ).first()
    if not bad["rows"] or bad["bad"] or bad["distinct"] != bad["rows"]:
        raise ValueError(f"{path}: {bad['rows']} cells, {bad['distinct']} distinct, {bad['bad']} null or empty")
    return df


# --- by format -------------------------------------------------------------------------------


def flattened(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with entries of its JSON text `properties` as columns."""
    parsed = F.from_json("properties", "map<string,string>")
    return df.select(*[c for c in df.columns if c != "properties"], *[F.element_at(parsed, k).alias(k) for k in keys])


def _pinned(path: str, expected: str | None) -> None:
    """Raise unless the file's sha256, or that of a folder's data files in order, is the expected one."""
    if expected is None:
        return
    names = [path] if os.path.isfile(path) else sorted(os.path.join(path, n) for n in os.listdir(path) if not n.startswith(("_", ".")))
    total = hashlib.sha256()
    for name in names:
        with open(name, "rb") as f:
            while block := f.read(1 << 20):
                total.update(block)
    if total.hexdigest() != expected:
        raise ValueError(f"{path}: content is not the pinned one")


def _properties(spark: SparkSession, path: str, where: str) -> T.StructType:
    """The properties' fields of GeoJSON features, by Spark's own inference."""
    found = spark.read.json(path, multiLine=True).select(F.explode(where).alias("f"))
    if where == "pages":
        found = found.select(F.explode("f.response.features").alias("f"))
    kind = found.schema["f"].dataType
    return kind["properties"].dataType if isinstance(kind, T.StructType) and "properties" in kind.names else T.StructType()


def read_source(spark: SparkSession, path: str, kind: str, layer: str | None = None, expected_sha256: str | None = None) -> DataFrame:
    """A snapshot by the name of its format, after its content was found to be the pinned one.

    Formats: parquet, geojson, paged_geojson, geopackage (with layer), shapefile (in zip),
    kml_archive (KML in KMZ in ZIP), ports, instrument (HTML tables of zones). An unknown
    format is an error.
    """
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind}; known are {sorted(FORMATS)}")
    _pinned(path, expected_sha256)
    return FORMATS[kind](spark, path, layer)


def _geopackage(spark: SparkSession, path: str, layer: str | None) -> DataFrame:
    if layer is None:
        raise ValueError(f"{path}: a GeoPackage needs the name of a layer")
    from .vector import fields

    return flattened(geopackage(spark, path, layer), fields(spark, path, "geopackage", layer)).withColumnRenamed("fid", "SOURCE_FID")


def _shapefiles(spark: SparkSession, path: str) -> DataFrame:
    from .vector import fields

    return flattened(shapefiles(spark, path), fields(spark, path, "shapefile"))


FORMATS = {
    "parquet": lambda spark, path, layer: geoparquet(spark, path) if "geometry" in spark.read.parquet(path).columns else spark.read.parquet(path),
    "geojson": lambda spark, path, layer: geojson(spark, path, _properties(spark, path, "features")),
    "paged_geojson": lambda spark, path, layer: paged_geojson(spark, path, _properties(spark, path, "pages")),
    "geopackage": _geopackage,
    "shapefile": lambda spark, path, layer: _shapefiles(spark, path),
    "kml_archive": lambda spark, path, layer: kml_archives(spark, path).withColumnsRenamed({"placemark": "ODFW_RECORD_ID", "name": "ODFW_NAME"}),
    "ports": lambda spark, path, layer: ports(spark, path),
    "instrument": lambda spark, path, layer: zone_rings(html_tables(spark, path), INSTRUMENT_ZONES, OPEN_ZONES, ("schedule2", "schedule3")),
}
