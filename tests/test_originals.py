"""Retained originals: provenance in footers, identity, roster and scope on reading."""

import os

import pyarrow.parquet as pq
import pytest

from tilewright import api, config as C
from tilewright.config import SourceEntry
from tilewright.plans import build as B, originals as O

COLUMNS = "OBJECTID int, LNAM string, MERGE_SRC string, kind string, wkb binary, min_x double, min_y double, max_x double, max_y double"


def source(**over):
    given = {"provider": "p", "url": "u", "as_of": "2024", "roster_field": "objectid"} | over
    return SourceEntry("chs_routing_layer_4", "traffic_separation_schemes", **given)


def rows(spark, ids=(1, 2, 3), parts=2):
    from tilewright.functions.kernels import to_wkb

    ring = [(-123.5, 48.0), (-123.0, 48.0), (-123.0, 48.5), (-123.5, 48.5), (-123.5, 48.0)]
    wkb = bytearray(to_wkb("Polygon", [ring]))
    return spark.createDataFrame([(i, "L", "TSSLPT_A", "Polygon", wkb, -123.5, 48.0, -123.0, 48.5) for i in ids], COLUMNS).repartition(parts)


def test_provenance_in_every_footer(spark, tmp_path):
    path = str(tmp_path / "o")
    O.retain(rows(spark), path, source(mask="m" * 64))
    files = [f for f in os.listdir(f"{path}/data") if f.endswith(".parquet")]
    assert files and all(b'"original"' in pq.read_metadata(f"{path}/data/{f}").metadata[O.SCHEMA_KEY.encode()] for f in files)
    told = O.provenance(spark, path)
    assert told["source_id"] == "chs_routing_layer_4" and told["roster"]["rows"] == 3 and told["mask"] == "m" * 64
    back = O.read_original(spark, path, source(mask="m" * 64))
    assert sorted(r["OBJECTID"] for r in back.collect()) == [1, 2, 3]


@pytest.mark.parametrize("field", ["provider", "url", "as_of", "selector", "mask"])
def test_identity(spark, tmp_path, field):
    O.retain(rows(spark), str(tmp_path / "o"), source())
    with pytest.raises(ValueError, match=field):
        O.read_original(spark, str(tmp_path / "o"), source(**{field: "other"}))


def test_roster(spark, tmp_path):
    announced = spark.createDataFrame([(1,), (2,), (3,)], "ObjectId int")
    O.retain(rows(spark), str(tmp_path / "whole"), source(), announced)
    for i, ids in enumerate([(1, 2), (1, 2, 3, 4), (1, 2, 3, 3)]):
        with pytest.raises(ValueError, match="roster mismatch"):
            O.retain(rows(spark, ids), str(tmp_path / f"bad{i}"), source(), announced)
    with pytest.raises(ValueError, match="no column"):
        O.retain(rows(spark).drop("OBJECTID"), str(tmp_path / "none"), source())
    # Rows of another table under the same provenance: as many, not the same.
    path = str(tmp_path / "whole")
    first = rows(spark).schema.names[0]
    from pyspark.sql import functions as F

    meta = spark.read.parquet(f"{path}/data").schema[first].metadata
    other = rows(spark, (1, 2, 4)).withColumn(first, F.col(first).alias(first, metadata=meta))
    other.write.mode("overwrite").parquet(f"{path}/data")
    with pytest.raises(ValueError, match="roster"):
        O.read_original(spark, path, source())
    other.limit(2).write.mode("overwrite").parquet(f"{path}/data")
    with pytest.raises(ValueError, match="manifest"):
        O.read_original(spark, path, source())
    rows(spark).write.mode("append").parquet(f"{path}/data")
    with pytest.raises(ValueError, match="provenance"):
        O.read_original(spark, path, source())


def test_scope(spark, tmp_path):
    O.retain(rows(spark), str(tmp_path / "o"), source(bbox=(170.0, 40.0, -120.0, 50.0)))
    assert O.read_original(spark, str(tmp_path / "o"), source(), (-124.0, 48.0, -123.0, 49.0)).count() == 3
    for box in (None, (-124.0, 48.0, -119.0, 49.0)):
        with pytest.raises(ValueError, match="scope"):
            O.read_original(spark, str(tmp_path / "o"), source(), box)


def test_empty(spark, tmp_path):
    O.retain(rows(spark).limit(0), str(tmp_path / "o"), source())
    back = O.read_original(spark, str(tmp_path / "o"), source())
    assert back.count() == 0 and back.columns == rows(spark).columns


def test_original_before_snapshot(spark, tmp_path):
    snapshot, kept = str(tmp_path / "snapshot"), str(tmp_path / "kept")
    rows(spark, (1, 2)).write.parquet(snapshot)
    text = "bounds: [-126, 47, -122, 50]\nsources:\n  chs_routing_layer_4: {collection: traffic_separation_schemes, provider: p, path: '%s', original: '%s', roster_field: OBJECTID}\n"
    (tmp_path / "layers.yaml").write_text(text % (snapshot, kept))
    config = C.load(str(tmp_path / "layers.yaml"))
    O.retain(rows(spark), kept, config.sources[0])
    found = api.get_layer(spark, config, "traffic_separation_schemes", (-123.6, 47.9, -122.9, 48.6))
    assert found.features.count() == 3
    catalog = B.build(spark, config, {}, str(tmp_path / "out"), {}, allow_partial=True)
    assert catalog["originals"]["chs_routing_layer_4"]["rows"] == 3
    assert O.provenance(spark, str(tmp_path / "out/OriginalData/chs_routing_layer_4"))["roster"]["rows"] == 3
