"""Versions of a table on any file system that Spark writes to, object stores included: nothing is ever renamed.

Rows go to a folder of their own, `data/<unique name>`; the version comes into being by one
file, `versions/<number>.json`, the manifest, which is created last and only if it isn't there
yet. So a reader sees a whole version or none, of two writers of a number one wins, and a
version once there never changes.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession

from ..operators import relational as R
from .products import digest_of

_NUMBER = re.compile(r"(\d{12})\.json")


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, name: str):
        """A place below the root with its Hadoop file system."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _mounted(self, name: str) -> str | None:
        """The path of a place in a mounted folder, None on other file systems."""
        path, system = self._at(name)
        told = urlparse(system.makeQualified(path).toString())
        return unquote(told.path) if told.scheme == "file" else None

    def _create(self, name: str, text: str) -> None:
        """Create a file with a text; raises FileExistsError if it is there, whoever made it."""
        place = self._mounted(name)
        if place is not None:
            os.makedirs(os.path.dirname(place), exist_ok=True)
            part = f"{place}.{uuid.uuid4().hex}"
            with open(part, "w") as out:
                out.write(text)
            try:
                os.link(part, place)
            finally:
                os.remove(part)
            return
        path, system = self._at(name)
        try:
            out = system.createFile(path).recursive().overwrite(False).opt("fs.option.create.conditional.overwrite", True).build()
            out.write(bytearray(text.encode()))
            out.close()
        except Exception as error:
            if system.exists(path):
                raise FileExistsError(f"{self.root}/{name}") from error
            raise

    def _numbers(self) -> list[int]:
        """Numbers of all versions, the latest first; one that is just being written may be among them."""
        path, system = self._at("versions")
        if not system.exists(path):
            return []
        found = (_NUMBER.fullmatch(s.getPath().getName()) for s in system.listStatus(path))
        return sorted((int(m[1]) for m in found if m), reverse=True)

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, or of the latest that is whole; None if there is none."""
        for number in self._numbers() if version is None else [version]:
            path, system = self._at(f"versions/{number:012d}.json")
            if not system.exists(path):
                return None
            stream = system.open(path)
            try:
                return json.loads(bytes(stream.readAllBytes()))
            except ValueError:  # its writer has not closed it yet
                continue
            finally:
                stream.close()
        return None

    def commit(self, df: DataFrame, manifest: dict | None = None, expected: int | None = None) -> dict:
        """Write df as the next version and return its manifest.

        expected: the version that df was made from (0: none); if another one is the latest by
        the time of the commit, FileExistsError is raised and what was written is removed.
        """
        base = max(self._numbers(), default=0) if expected is None else expected
        folder = f"data/{uuid.uuid4().hex}"
        try:
            df.write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
            back = self.spark.read.parquet(f"{self.root}/{folder}")
            summary = R.semantic_hash(back, "semantic_hash").first().asDict()
            record = (manifest or {}) | summary | {"version": base + 1, "folder": folder, "fields": back.columns, "sha256": digest_of(self.spark, back.inputFiles())}
            if max(self._numbers(), default=0) > base:
                raise FileExistsError(f"{self.root}: version {base + 1} is there")
            self._create(f"versions/{base + 1:012d}.json", json.dumps(record, sort_keys=True, indent=1))
        except BaseException:
            path, system = self._at(folder)
            system.delete(path, True)
            raise
        return record

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, or of the latest."""
        record = self.manifest(version)
        if record is None:
            raise FileNotFoundError(f"{self.root}: no version" if version is None else f"{self.root}: no version {version}")
        return self.spark.read.parquet(f"{self.root}/{record['folder']}")

    def validate(self, version: int | None = None) -> dict:
        """The manifest of a version, after its files, fields and rows were found to agree with it."""
        back, record = self.read(version), self.manifest(version)
        if digest_of(self.spark, back.inputFiles()) != record["sha256"]:
            raise ValueError(f"{self.root}: files don't match their checksum")
        if back.columns != record["fields"] or back.count() != record["rows"]:
            raise ValueError(f"{self.root}: rows or fields don't match the manifest")
        return record
