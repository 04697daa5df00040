"""GeoPackages and shapefiles as a Spark data source: one file is read by many tasks, and boxes reach the file's own index.

Partitions are ranges of rows: row ids of a GeoPackage's layer, record numbers of a
shapefile by its `.shx`, whose offsets are where a task begins to read. Comparisons of
min_x, min_y, max_x and max_y with numbers are handed to the GeoPackage's R-tree and to the
boxes that shapefile records begin with; Spark applies them again, so the index may round.
"""

from __future__ import annotations

import itertools
import json
import sqlite3
import struct
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..functions import crs
from ..functions.kernels import from_wkb
from . import readers

SCHEMA = "fid string, properties string, " + readers.SHAPE
#: Rows of a file that one task reads.
ROWS = 20_000
SIDES = ("min_x", "min_y", "max_x", "max_y")


@dataclass
class Range(InputPartition):
    """Rows start <= row < stop of a layer in a file; a stop of None is the end of a file whose rows nobody counted."""

    file: str
    layer: str
    start: int
    stop: int | None


class Bounds:
    """What filters say of a feature's four sides: for each a least and a greatest value, ends included."""

    def __init__(self):
        self.sides = {s: [-float("inf"), float("inf")] for s in SIDES}
        self.open = True

    def take(self, f) -> None:
        if not isinstance(f, (EqualTo, LessThan, LessThanOrEqual, GreaterThan, GreaterThanOrEqual)) or f.attribute[0] not in SIDES or f.value is None:
            return
        side, value = self.sides[f.attribute[0]], float(f.value)
        if value != value:  # Spark holds NaN greater than any number; it says nothing of a box
            return
        self.open = False
        if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            side[0] = max(side[0], value)
        if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            side[1] = min(side[1], value)

    def admits(self, box: tuple) -> bool:
        return not any(v < low or v > high for v, (low, high) in zip(box, self.sides.values()))


@contextmanager
def _file(uri: str):
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(uri)
    with system.open_input_file(place) as f:
        yield f


# --- GeoPackages -----------------------------------------------------------------------------


def _mounted(uri: str) -> str | None:
    """The path of a file that lies in a mounted folder."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(uri)
    return place if isinstance(system, fs.LocalFileSystem) else None


@contextmanager
def _database(uri: str):
    """The GeoPackage at uri: opened in place in a mounted folder, else read into memory, for SQLite needs one or the other."""
    place = _mounted(uri)
    if place is not None:
        db = sqlite3.connect(f"file:{quote(place)}?immutable=1", uri=True)
    else:
        db = sqlite3.connect(":memory:")
        with _file(uri) as f:
            db.deserialize(f.read())
    try:
        yield db
    finally:
        db.close()


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _layer(db, uri: str, layer: str) -> tuple[str, crs.System]:
    """A layer's column of geometries and its coordinate system."""
    found = db.execute("select column_name, srs_id from gpkg_geometry_columns where table_name = ?", (layer,)).fetchone()
    if found is None:
        raise ValueError(f"{uri}: no layer {layer}")
    geometry, number = found
    told = db.execute("select organization, organization_coordsys_id, definition from gpkg_spatial_ref_sys where srs_id = ?", (number,)).fetchone()
    if told is None or number <= 0:
        raise ValueError(f"{uri}: {layer} has no coordinate system")
    return geometry, crs.system(int(told[1])) if told[0].upper() == "EPSG" else crs.from_wkt(told[2])


def _indexed(db, layer: str, geometry: str, system: crs.System, bounds: Bounds) -> tuple[str, list]:
    """Condition and values that leave out rows by the R-tree; none without an index, without bounds, or for other units than degrees."""
    tree = f"rtree_{layer}_{geometry}"
    if bounds.open or system.kind != "geographic" or not db.execute("select 1 from sqlite_master where name = ?", (tree,)).fetchone():
        return "", []
    terms, values = [], []
    # The tree's sides are single floats, rounded outwards: lower ones are at most, upper ones at least the exact value.
    for side, stored in zip(SIDES, ("minx", "miny", "maxx", "maxy")):
        low, high = bounds.sides[side]
        end, sign = (high, "<=") if stored.startswith("min") else (low, ">=")
        if abs(end) != float("inf"):
            terms.append(f"{stored} {sign} ?")
            values.append(end)
    return (f" and rowid in (select id from {_quoted(tree)} where {' and '.join(terms)})", values) if terms else ("", [])


def _gpkg_ranges(uri: str, layer: str, bounds: Bounds, rows: int) -> Iterator[Range]:
    if _mounted(uri) is None:
        yield Range(uri, layer, -(2**63), None)
        return
    with _database(uri) as db:
        geometry, system = _layer(db, uri, layer)
        condition, values = _indexed(db, layer, geometry, system, bounds)
        count, low, high = db.execute(f"select count(*), min(rowid), max(rowid) from {_quoted(layer)} where 1{condition}", values).fetchone()
    if count:
        pieces = -(-count // rows)
        step = -(-(high - low + 1) // pieces)
        for i in range(pieces):
            if low + i * step <= high:
                yield Range(uri, layer, low + i * step, min(low + (i + 1) * step, high + 1))


def _gpkg_rows(part: Range, bounds: Bounds) -> Iterator[tuple]:
    with _database(part.file) as db:
        geometry, system = _layer(db, part.file, part.layer)
        condition, values = _indexed(db, part.layer, geometry, system, bounds)
        until, ends = ("", []) if part.stop is None else (" and rowid < ?", [part.stop])
        cursor = db.execute(f"select rowid, * from {_quoted(part.layer)} where rowid >= ?{until}{condition}", [part.start, *ends, *values])
        names = [d[0] for d in cursor.description[1:]]
        for fid, *found in cursor:
            row = dict(zip(names, found))
            blob = row.pop(geometry)
            told = json.dumps({k: v for k, v in row.items() if not isinstance(v, bytes)}, sort_keys=True)
            yield str(fid), told, *(readers.shape(None, None) if blob is None else readers.shape(*from_wkb(readers.gpkg_wkb(blob)), system))


def _gpkg_fields(uri: str, layer: str) -> list[str]:
    with _database(uri) as db:
        geometry, _ = _layer(db, uri, layer)
        return [r[1] for r in db.execute(f"pragma table_info({_quoted(layer)})") if r[1] != geometry and "BLOB" not in r[2].upper()]


# --- shapefiles ------------------------------------------------------------------------------


class _Shapefile:
    """The files of a shapefile, in a ZIP file (layer is the name of the .shp within) or beside each other."""

    def __init__(self, uri: str, layer: str, f):
        self.uri, self.stem = uri, (layer or uri)[:-4]
        self.archive = zipfile.ZipFile(f) if layer else None

    @contextmanager
    def open(self, end: str):
        """The member with an ending, None if there is none."""
        if self.archive is not None:
            name = next((n for n in self.archive.namelist() if n.lower() == (self.stem + end).lower()), None)
            if name is None:
                yield None
            else:
                with self.archive.open(name) as f:
                    yield f
            return
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(self.uri)
        for made in (place[:-4] + end, place[:-4] + end.upper()):
            if system.get_file_info(made).type == fs.FileType.File:
                with system.open_input_file(made) as f:
                    yield f
                return
        yield None

    def system(self) -> crs.System:
        with self.open(".prj") as f:
            if f is None:
                raise ValueError(f"{self.uri}: {self.stem}.shp has no coordinate system")
            return crs.from_wkt(f.read().decode("utf-8", "replace"))

    def count(self) -> int | None:
        """Records by the size that the index's header states; None without an index."""
        with self.open(".shx") as f:
            return None if f is None else (2 * struct.unpack_from(">i", f.read(28), 24)[0] - 100) // 8

    def table(self) -> tuple[list[tuple[str, int]], int, int]:
        """Fields with their widths, size of the header and of a record."""
        with self.open(".dbf") as f:
            first = f.read(32)
            head, size = struct.unpack_from("<HH", first, 8)
            rest = f.read(head - 32)
        fields, at = [], 0
        while at < len(rest) and rest[at] != 0x0D:
            fields.append((rest[at : at + 11].split(b"\0")[0].decode(), rest[at + 16]))
            at += 32
        return fields, head, size

    def bodies(self, start: int, stop: int | None) -> Iterator[bytes]:
        """Records' content in order, BATCH at a time; without an index from the first to the last, by their own lengths."""
        with self.open(".shx") as index, self.open(".shp") as f:
            if stop is None:
                f.seek(100)
                while len(head := f.read(8)) == 8:
                    yield f.read(2 * struct.unpack_from(">i", head, 4)[0])
                return
            index.seek(100 + 8 * start)
            for at in range(start, stop, readers.BATCH):
                n = min(readers.BATCH, stop - at)
                for offset, words in struct.iter_unpack(">2i", index.read(8 * n)):
                    f.seek(2 * offset + 8)
                    yield f.read(2 * words)

    def records(self, start: int, stop: int | None) -> Iterator[dict]:
        fields, head, size = self.table()
        with self.open(".dbf") as f:
            f.seek(head + start * size)
            for _ in itertools.count() if stop is None else range(start, stop):
                line, place, record = f.read(size), 1, {}
                if len(line) < size:
                    return
                for name, width in fields:
                    record[name] = line[place : place + width].decode("utf-8", "replace").strip() or None
                    place += width
                yield record


@contextmanager
def _shapefile(uri: str, layer: str):
    if not layer:
        yield _Shapefile(uri, layer, None)
        return
    with _file(uri) as f:
        yield _Shapefile(uri, layer, f)


def _shp_names(uri: str) -> list[str]:
    """Shapefiles in a ZIP file; for a .shp itself one empty name."""
    if uri.lower().endswith(".shp"):
        return [""]
    with _file(uri) as f:
        return [n for n in zipfile.ZipFile(f).namelist() if n.lower().endswith(".shp")]


def _shp_ranges(uri: str, bounds: Bounds, rows: int) -> Iterator[Range]:
    for name in _shp_names(uri):
        with _shapefile(uri, name) as s:
            count = s.count()
        if count is None:
            yield Range(uri, name, 0, None)
        else:
            yield from (Range(uri, name, at, min(at + rows, count)) for at in range(0, count, rows))


def _shp_rows(part: Range, bounds: Bounds) -> Iterator[tuple]:
    with _shapefile(part.file, part.layer) as s:
        system = s.system()
        skips = not bounds.open and system.kind == "geographic"
        for i, (body, record) in enumerate(zip(s.bodies(part.start, part.stop), s.records(part.start, part.stop), strict=part.stop is not None), part.start):
            (code,) = struct.unpack_from("<i", body)
            if skips and code % 10 in (3, 5) and not bounds.admits(struct.unpack_from("<4d", body, 4)):
                continue
            yield str(i), json.dumps(record, sort_keys=True), *readers.shape(*readers.shp_geometry(body), system)


def _shp_fields(uri: str) -> list[str]:
    out = []
    for name in _shp_names(uri):
        with _shapefile(uri, name) as s:
            out += [f for f, _ in s.table()[0]]
    return out


# --- the data source -------------------------------------------------------------------------


class VectorSource(DataSource):
    """Options: files (JSON list of URIs), kind (geopackage or shapefile), layer (of a GeoPackage), rows (of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "tilewright_vector"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return VectorReader(self.options)


class VectorReader(DataSourceReader):
    def __init__(self, options):
        self.files, self.kind = json.loads(options["files"]), options["kind"]
        self.layer, self.rows, self.bounds = options.get("layer", ""), int(options.get("rows", ROWS)), Bounds()

    def pushFilters(self, filters):
        for f in filters:
            self.bounds.take(f)
        return filters

    def partitions(self) -> list[Range]:
        found = (_gpkg_ranges(f, self.layer, self.bounds, self.rows) if self.kind == "geopackage" else _shp_ranges(f, self.bounds, self.rows) for f in self.files)
        return list(itertools.chain.from_iterable(found)) or [Range("", "", 0, 0)]

    def read(self, part: Range):
        import pyarrow as pa

        if not part.file:
            return
        kind = pa.schema([("fid", pa.string()), ("properties", pa.string()), ("kind", pa.string()), ("wkb", pa.binary()), *[(s, pa.float64()) for s in SIDES]])
        found = _gpkg_rows(part, self.bounds) if self.kind == "geopackage" else _shp_rows(part, self.bounds)
        while made := [dict(zip(kind.names, r)) for r in itertools.islice(found, readers.BATCH)]:
            yield pa.RecordBatch.from_pylist(made, kind)


def _uris(spark: SparkSession, path: str) -> list[str]:
    """Addresses of the files that path names (a file, a folder or a pattern); of a loose shapefile's files its .shp."""
    found = spark.read.format("binaryFile").load(path).inputFiles()
    return sorted(f for f in found if not f.lower().endswith((".shx", ".dbf", ".prj", ".cpg", ".sbn", ".sbx", ".qix", ".xml")))


def vector(spark: SparkSession, path: str, kind: str, layer: str | None = None, rows: int = ROWS) -> DataFrame:
    """(fid, properties as JSON, shape) of all features, in longitudes and latitudes; a layer without a known system is an error.

    A layer without features gives no rows; a feature without a geometry has null shape.
    fid is the row id or record number within its file. `rows` bounds a task's rows, so a file
    of any size is spread out; a GeoPackage outside mounted folders and a shapefile without
    an index are one task's.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(VectorSource)
    source = spark.read.format(VectorSource.name()).option("files", json.dumps(_uris(spark, path))).option("kind", kind).option("rows", rows)
    return source.option("layer", layer or "").load()


def fields(spark: SparkSession, path: str, kind: str, layer: str | None = None) -> list[str]:
    """Names of the properties by the files' headers alone."""
    found = (_gpkg_fields(f, layer or "") if kind == "geopackage" else _shp_fields(f) for f in _uris(spark, path))
    return sorted(set(itertools.chain.from_iterable(found)))
