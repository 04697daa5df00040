"""Publishing tables: staged writes, manifests, checks and one table per resolution."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..operators import relational as R


def per_resolution(df: DataFrame, column: str, values: Iterable) -> dict:
    """One lazy table for each resolution, with the filter on the column where a scan can prune by it."""
    return {v: df.where(F.col(column) == v) for v in values}


def with_metadata(df: DataFrame, fields: dict[str, dict]) -> DataFrame:
    """df with each column's definition in its metadata, which Parquet keeps; columns and definitions must be the same set."""
    if set(fields) != set(df.columns):
        raise ValueError(f"fields don't match definitions: {sorted(set(fields) ^ set(df.columns))}")
    return df.select(*[F.col(c).alias(c, metadata=fields[c]) for c in df.columns])


def write_json(path: str, value, overwrite: bool = False) -> None:
    """Sorted JSON, complete or not there at all."""
    if os.path.exists(path) and not overwrite:
        raise FileExistsError(path)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "w") as out:
        json.dump(value, out, sort_keys=True, indent=1)
    os.replace(part, path)


def digest(spark, path: str) -> str:
    """Digest of a table's files in a folder that the driver can list."""
    return digest_of(spark, [os.path.join(os.path.abspath(path), n) for n in os.listdir(path) if n.endswith(".parquet")])


def digest_of(spark, places: list[str]) -> str:
    """sha256 over the names and the sha256 of files, in order of names. Tasks read the files, a block at a time; the driver has one line a file."""
    if not places:
        return hashlib.sha256().hexdigest()
    files = spark.createDataFrame([(p.rpartition("/")[2], p) for p in places], "name string, file string")
    files = files.repartition(min(len(places), 4 * spark.sparkContext.defaultParallelism), "name")

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for file in batch.column("file").to_pylist():
                system, place = fs.FileSystem.from_uri(file)
                total = hashlib.sha256()
                with system.open_input_stream(place) as f:
                    while block := f.read(1 << 20):
                        total.update(block)
                found.append(total.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(found, pa.string())], ["name", "sha256"])

    total = hashlib.sha256()
    for r in sorted(files.mapInArrow(run, "name string, sha256 string").collect()):
        total.update(f"{r['name']} {r['sha256']}\n".encode())
    return total.hexdigest()


def publish(df: DataFrame, path: str, manifest: dict | None = None, overwrite: bool = False) -> dict:
    """Write a table and its manifest beside each other: staged, read back, then swapped in; on failure the old one stays.

    path is a folder that the driver can rename in (local or mounted); the table is its
    subfolder `data`, the manifest `manifest.json` with rows, digests and the caller's entries.
    """
    if os.path.exists(path) and not overwrite:
        raise FileExistsError(path)
    stage, old = f"{path}.stage-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    lock = f"{path}.lock"
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    os.close(os.open(lock, os.O_CREAT | os.O_EXCL))
    try:
        df.write.option("compression", "zstd").parquet(f"{stage}/data")
        back = df.sparkSession.read.parquet(f"{stage}/data")
        summary = R.semantic_hash(back, "semantic_hash").first().asDict()
        record = (manifest or {}) | {"rows": summary["rows"], "semantic_hash": summary["semantic_hash"], "sha256": digest(df.sparkSession, f"{stage}/data"), "fields": back.columns}
        write_json(f"{stage}/manifest.json", record)
        validate(df.sparkSession, stage)
        if os.path.exists(path):
            os.rename(path, old)
        try:
            os.rename(stage, path)
        except OSError:
            if os.path.exists(old):
                os.rename(old, path)
            raise
        shutil.rmtree(old, ignore_errors=True)
        return record
    finally:
        shutil.rmtree(stage, ignore_errors=True)
        os.remove(lock)


def validate(spark, path: str) -> dict:
    """The manifest of a published table, after its files, fields and rows were found to agree with it."""
    with open(f"{path}/manifest.json") as f:
        record = json.load(f)
    if digest(spark, f"{path}/data") != record["sha256"]:
        raise ValueError(f"{path}: files don't match their checksum")
    back = spark.read.parquet(f"{path}/data")
    if back.columns != record["fields"]:
        raise ValueError(f"{path}: fields don't match the manifest")
    if back.count() != record["rows"]:
        raise ValueError(f"{path}: rows don't match the manifest")
    return record


def retained_equal(original: DataFrame, written: DataFrame) -> None:
    """Raise unless two tables hold the same rows, repetitions included."""
    sample = R.differences(original, written).limit(5).collect()
    if sample:
        raise ValueError(f"read-back differs: {sample}")


class Releases:
    """Immutable generations of published tables under one folder, and a pointer to the current one."""

    def __init__(self, root: str):
        self.root = root
        os.makedirs(root, exist_ok=True)

    def add(self, spark, name: str, tables: dict[str, DataFrame]) -> None:
        """A new generation; it must not exist."""
        folder = os.path.join(self.root, name)
        if os.path.exists(folder):
            raise FileExistsError(folder)
        os.makedirs(folder)
        for table, df in tables.items():
            publish(df, os.path.join(folder, table))
        write_json(os.path.join(folder, "generation.json"), {"name": name, "tables": sorted(tables)})

    def activate(self, spark, name: str) -> None:
        """Make a generation current after it has been validated."""
        folder = os.path.join(self.root, name)
        with open(os.path.join(folder, "generation.json")) as f:
            for table in json.load(f)["tables"]:
                validate(spark, os.path.join(folder, table))
        write_json(os.path.join(self.root, "current.json"), {"name": name}, overwrite=True)

    def current(self) -> str | None:
        path = os.path.join(self.root, "current.json")
        if not os.path.exists(path):
            return None
        with open(path) as f:
            return json.load(f)["name"]
