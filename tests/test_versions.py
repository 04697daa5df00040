"""Versions of a table without renames: manifests last, one winner, old versions unchanged."""

import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from tilewright.plans.versions import Versions


@pytest.fixture(params=["mounted", "hadoop"])
def table(spark, tmp_path, request, monkeypatch):
    if request.param == "hadoop":
        monkeypatch.setattr(Versions, "_mounted", lambda self, name: None)
    return Versions(spark, str(tmp_path / "a table"))


def test_commit_and_read(spark, table):
    assert table.manifest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.commit(spark.range(5), {"by": "test"}, expected=0)
    assert (first["version"], first["rows"], first["by"]) == (1, 5, "test")
    table.commit(spark.range(7).coalesce(1))
    assert table.read().count() == 7 and table.read(1).count() == 5 and table.validate()["version"] == 2
    assert table.manifest(3) is None
    with pytest.raises(FileExistsError):
        table.commit(spark.range(1), expected=1)
    assert len(os.listdir(f"{table.root}/data")) == 2  # what the loser wrote is gone
    empty = table.commit(spark.range(0))
    assert empty["rows"] == 0 and table.read().columns == ["id"]


def test_one_of_many_writers_wins(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))  # in a mounted folder; Hadoop's interface to local folders has no atomic creation

    def write(n):
        try:
            return table.commit(spark.range(n), expected=0)["rows"]
        except FileExistsError:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [r for r in pool.map(write, (1, 2, 3, 4)) if r is not None]
    assert len(won) == 1 and table.read().count() == won[0] and len(os.listdir(f"{table.root}/data")) == 1
    assert table._numbers() == [1] and table.validate()["version"] == 1


def test_unfinished_and_damaged(spark, table):
    table.commit(spark.range(5).coalesce(1))
    with open(f"{table.root}/versions/000000000002.json", "w") as f:
        f.write('{"version": 2, "fol')  # being written
    for crc in glob.glob(f"{table.root}/versions/.*.crc"):
        os.remove(crc)
    assert table.manifest()["version"] == 1 and table.read().count() == 5
    with pytest.raises(FileExistsError):
        table.commit(spark.range(1), expected=1)
    (file,) = glob.glob(f"{table.root}/data/*/*.parquet")
    spark.range(6).coalesce(1).write.parquet(f"{table.root}/other")
    (other,) = glob.glob(f"{table.root}/other/*.parquet")
    for crc in glob.glob(f"{table.root}/data/*/.*.crc"):
        os.remove(crc)
    os.replace(other, file)
    with pytest.raises(ValueError, match="checksum"):
        table.validate(1)
