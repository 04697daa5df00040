"""Sources' rows kept as Parquet that says of itself what it is: identity, scope and roster stand in the files' footers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import SourceEntry
from ..operators import relational as R
from ..sources.acquire import check_roster, covers
from ..sources.readers import footers, read_source
from . import products

VERSION = 1
#: Footer key under which Spark keeps a table's schema with its fields' metadata (a fixed value).
SCHEMA_KEY = "org.apache.spark.sql.parquet.row.metadata"
#: What must be the same in a retained original and in the source that asks for it.
IDENTITY = ("source_id", "provider", "url", "as_of", "selector", "mask")


def _roster_hash(df: DataFrame, key: str) -> dict:
    """Number and digest of a table's record ids, repeated ones included; no id passes the driver."""
    return R.semantic_hash(df.select(F.col(key).cast("string").alias("id")), "digest").first().asDict()


def _field(df: DataFrame, name: str) -> str:
    """The column that a roster's field names, in whatever case."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name} of record ids")
    return found[0]


def retain(df: DataFrame, path: str, source: SourceEntry, roster: DataFrame | None = None, overwrite: bool = False) -> dict:
    """Publish a source's rows with their provenance in every file's footer; return the manifest.

    roster: the ids that the provider announced, in a column named as the source's
    `roster_field`; rows that repeat, are missing or weren't announced are an error. Without
    it the ids at hand are the roster, if the source names a field. A table without rows keeps
    its columns and provenance.
    """
    told = {"version": VERSION, **{k: getattr(source, k) for k in IDENTITY}, "bbox": list(source.bbox) if source.bbox else None, "roster": None}
    if source.roster_field:
        key = _field(df, source.roster_field)
        if roster is not None:
            roster = roster.select(F.col(_field(roster, source.roster_field)).alias(key)).distinct()
        ids = df.select(key)
        check_roster(roster if roster is not None else ids.distinct(), ids, key)
        told["roster"] = {"field": key, **_roster_hash(roster if roster is not None else ids, key)}
    first, *rest = df.columns
    marked = df.select(F.col(f"`{first}`").alias(first, metadata=df.schema[first].metadata | {"original": json.dumps(told, sort_keys=True)}), *[F.col(f"`{c}`") for c in rest])
    return products.publish(marked, path, {"source": source.source_id}, overwrite)


def provenance(spark: SparkSession, path: str) -> dict:
    """What the footers of a retained original say; all of its files must say the same."""
    found = footers(spark, f"{path}/data", SCHEMA_KEY)
    told = {json.loads(f)["fields"][0]["metadata"].get("original") if f else None for f in found}
    if len(told) != 1 or None in told:
        raise ValueError(f"{path}: files without provenance, or with several")
    return json.loads(told.pop())


def read_original(spark: SparkSession, path: str, source: SourceEntry, bbox: tuple | None = None) -> DataFrame:
    """The rows of a retained original, after it was found to be of this source and version, whole, and wide enough for bbox.

    An original with a roster must hold just those ids. One that was asked for by a box serves
    requests within that box only.
    """
    told = provenance(spark, path)
    if told["version"] != VERSION:
        raise ValueError(f"{path}: unsupported version of provenance")
    other = [k for k in IDENTITY if told[k] != getattr(source, k)]
    if other:
        raise ValueError(f"{path}: original differs from the source in {other}")
    with open(f"{path}/manifest.json") as f:
        rows = json.load(f)["rows"]
    df = spark.read.parquet(f"{path}/data")
    if df.count() != rows:
        raise ValueError(f"{path}: rows don't match the manifest")
    if told["roster"]:
        key = told["roster"]["field"]
        if key not in df.columns or _roster_hash(df, key) != {k: told["roster"][k] for k in ("rows", "digest")}:
            raise ValueError(f"{path}: records are not those of the roster")
    if told["bbox"] and not (bbox and covers(tuple(told["bbox"]), tuple(bbox))):
        raise ValueError(f"{path}: scope of the original is smaller than the request")
    return df


def open_source(spark: SparkSession, source: SourceEntry, bbox: tuple | None = None) -> DataFrame:
    """A source's rows: the retained original where one is named, else the snapshot; checked either way."""
    if source.original is not None:
        return read_original(spark, source.original, source, bbox)
    if source.path is None:
        raise FileNotFoundError(f"{source.source_id} has no snapshot")
    return read_source(spark, source.path, source.format, source.layer, source.expected_sha256)
