import random

import pytest
from pyspark.sql import functions as F

from tilewright.functions import kernels as K
from tilewright.functions.kernels import to_wkb
from tilewright.operators import clip, exact as E, metrics as M, relational as R, spatial as P, validate as V
from tilewright.plans import normalize as N, overlay as O, products, providers as PR


def boxes(spark, rows, extra="id string"):
    return spark.createDataFrame(rows, f"{extra}, min_x double, min_y double, max_x double, max_y double")


def test_tile_join_keeps_each_pair_once(spark):
    a = boxes(spark, [("a", 0.0, 0.0, 35.0, 35.0), ("n", None, 0.0, 1.0, 1.0)])
    b = boxes(spark, [("b", 5.0, 5.0, 40.0, 40.0), ("touch", 35.0, 0.0, 36.0, 1.0)])
    assert [(r["id"], r["r_id"]) for r in P.tile_join(a, b, 10).collect()] == [("a", "b")]
    assert sorted(r["r_id"] for r in P.tile_join(a, b, 10, closed=True).collect()) == ["b", "touch"]


def test_union_area_and_length(spark):
    b = boxes(spark, [("g", 0.0, 0.0, 2.0, 2.0), ("g", 1.0, 1.0, 3.0, 3.0), ("g", 1.0, 1.0, 3.0, 3.0), ("h", 0.0, 0.0, 1.0, 1.0)])
    assert {r["id"]: r["union_area"] for r in P.union_area(b, ["id"], P.BOX).collect()} == {"g": 7.0, "h": 1.0}
    i = spark.createDataFrame([("k", 0, 5), ("k", 3, 8), ("k", 10, 11), ("k", 4, 4)], "k string, s int, e int")
    assert P.union_length(i, ["k"], "s", "e").first()["union_length"] == 9


def test_nearest_needs_no_cross_join(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 500.0, 500.0)], "id int, x double, y double")
    t = spark.createDataFrame([(3.0, 4.0), (9.0, 9.0)], "x double, y double")
    metric = lambda a, b: F.hypot(F.col(a + "x") - F.col(b + "x"), F.col(a + "y") - F.col(b + "y"))
    found = P.nearest_distance(p, t, "id", 10.0, metric)
    assert {r["id"]: r["distance"] for r in found.collect()} == {1: 5.0, 2: None}


def test_missing_is_not_zero(spark):
    df = spark.createDataFrame([("complete", None), ("partial", None), ("complete", 3)], "c string, v long")
    assert [r["v"] for r in df.select(M.zero_fill("v", "c").alias("v")).collect()] == [0, None, 3]
    s = spark.createDataFrame([(None, "observed"), (1, "observed"), (None, "partial")], "v int, s string")
    assert [r["x"] for r in s.select(M.delivery_status("v", "s").alias("x")).collect()] == ["unknown", "observed", "partial"]
    with pytest.raises(Exception, match="contradicts"):
        s.select(M.delivery_status(F.lit(1), F.lit("unavailable")).alias("x")).collect()
    with pytest.raises(Exception, match="exceeds"):
        s.select(M.coverage_fraction(F.lit(1.1), F.lit(1.0)).alias("x")).collect()


CELLS = [("c0", 0.0, 0.0, 10.0, 10.0), ("c1", 10.0, 0.0, 20.0, 10.0)]


def features(spark, rows):
    """rows: group, feature_id, record_id, GeoJSON type, coordinates."""
    made = [(g, f, r, bytearray(to_wkb(kind, c))) for g, f, r, kind, c in rows]
    return spark.createDataFrame(made, "group string, feature_id string, record_id string, wkb binary")


def rectangle(w, s, e, n):
    return [[(w, s), (e, s), (e, n), (w, n), (w, s)]]


def test_overlay_modes(spark):
    cells = boxes(spark, CELLS, "cell_id string")
    rows = [
        ("a", "f1", "r1", "MultiPolygon", [rectangle(0.0, 0.0, 5.0, 10.0), rectangle(0.0, 0.0, 10.0, 5.0)]),
        ("b", "f2", "r2", "Polygon", rectangle(2.0, 2.0, 10.0, 4.0)),
    ]
    made = O.overlay(cells, features(spark, rows), ["a", "b", "z"], 10, completeness={"a": "complete", "b": "partial"}, earth=False)
    rows_of = {r["cell_id"]: r.asDict() for r in made.wide.collect()}
    c0, c1 = rows_of["c0"], rows_of["c1"]
    assert c0["a__polygon_coverage_fraction"] == 0.75 and c0["a__feature_count"] == 1 and c0["a__part_count"] == 2
    assert c1["a__feature_count"] == 0 and c1["b__feature_count"] is None  # touching is not a hit
    assert c1["a__status"] == "observed" and c0["z__feature_count"] is None and c0["b__status"] == "partial"
    assert c0["a__line_union_length_m"] is None and c1["a__line_union_length_m"] == 0
    assert c0["a__intersection_status"] == "recorded_geometry_intersects" and c1["b__intersection_status"] == "no_recorded_geometry_under_partial_coverage"
    asked = O.overlay(cells, features(spark, rows), ["a", "b"], 10, availability={"a": "available"}, mode="query", max_memberships=10)
    status = {(r["cell_id"], r["group"]): r["status"] for r in asked.long.collect()}
    assert status == {("c0", "a"): "partial", ("c0", "b"): "partial", ("c1", "a"): "unknown", ("c1", "b"): "unavailable"}
    with pytest.raises(ValueError, match="memberships"):
        O.overlay(cells, features(spark, rows), ["a"], 10, mode="query", max_memberships=1)


def test_overlay_measures_shapes_and_not_their_boxes(spark):
    cells = boxes(spark, CELLS, "cell_id string")
    triangle = ("a", "t", "t", "Polygon", [[(0, 0), (20, 0), (0, 10), (0, 0)]])
    line = ("a", "l", "l", "LineString", [(0, 0), (10, 10)])
    points = ("a", "p", "p", "MultiPoint", [(10.0, 5.0), (5.0, 5.0)])  # the first is on the border of both cells
    made = O.overlay(cells, features(spark, [triangle, triangle, line, line, points]), ["a"], 10, mode="query", availability={"a": "available"}, earth=False)
    got = {r["cell_id"]: r for r in made.wide.collect()}
    assert got["c0"]["a__polygon_coverage_fraction"] == pytest.approx(0.75) and got["c1"]["a__polygon_coverage_fraction"] == pytest.approx(0.25)
    assert got["c0"]["a__line_union_length_m"] == pytest.approx(200**0.5) and got["c1"]["a__line_union_length_m"] is None
    assert (got["c0"]["a__point_count"], got["c1"]["a__point_count"]) == (2, 1)
    assert (got["c0"]["a__feature_count"], got["c1"]["a__feature_count"]) == (3, 2)
    rows = {(r["cell_id"], r["family"]): (r["intersection_area"], r["intersection_length"], r["point_count"]) for r in made.memberships.collect()}
    assert rows["c1", "polygon"] == (pytest.approx(25), None, None) and rows["c0", "point"] == (None, None, 1)
    assert ("c1", "line") not in rows  # it meets the second cell's corner only


def test_overlay_on_the_earth(spark):
    cells = boxes(spark, [("c", 0.0, 48.0, 1.0, 49.0)], "cell_id string")
    hole = rectangle(0.25, 48.25, 0.75, 48.75)[0]
    rows = [("a", "x", "x", "Polygon", [rectangle(0, 48, 1, 49)[0], hole]), ("a", "l", "l", "LineString", [(0.5, 48.0), (0.5, 50.0)])]
    made = O.overlay(cells, features(spark, rows), ["a"], 1.0, mode="query")
    row = made.wide.first()
    y = lambda lat: float(K.equal_area(0.0, lat)[1])
    assert row["a__polygon_coverage_fraction"] == pytest.approx(1 - 0.5 * (y(48.75) - y(48.25)) / (y(49) - y(48)), rel=1e-9)
    assert row["a__line_union_length_m"] == pytest.approx(float(K.geodesic(0.5, 48, 0.5, 49)), rel=1e-9)
    area = made.memberships.where("family = 'polygon'").first()["intersection_area"]
    assert area == pytest.approx(row["a__polygon_coverage_fraction"] * float(K.equal_area(1.0, 0)[0]) * (y(49) - y(48)), rel=1e-9)


def test_counts_of_designations_and_zones(spark):
    cells = boxes(spark, CELLS, "cell_id string")
    f = features(spark, [("a", f"f{i}", f"r{i}", "Point", (1.0 + i, 1.0)) for i in range(4)])
    f = f.withColumn("designation_id", F.when(F.col("record_id") != "r3", "d")).withColumn("zone_name", F.when(F.col("record_id").isin("r0", "r1"), F.col("record_id")))
    got = {r["cell_id"]: r for r in O.overlay(cells, f, ["a"], 10, mode="query").long.collect()}
    assert (got["c0"]["designation_count"], got["c0"]["zone_count"], got["c1"]["zone_count"]) == (1, 2, None)


def test_unions_of_crowded_cells_equal_unions_at_once(spark):
    r = random.Random(4)
    rows = []
    for i in range(120):
        x, y, w, h = r.uniform(0, 9), r.uniform(0, 9), r.uniform(0.1, 4), r.uniform(0.1, 4)
        rows.append(("a", str(i), str(i), "Polygon", [[(x, y), (x + w, y), (x, y + h), (x, y)]]))
        a, b = r.randrange(10), r.randrange(8)
        rows.append(("a", f"l{i}", f"l{i}", "LineString", [(a, b), (a, b + 2.5)] if i % 2 else [(b, a), (b + 2, a)]))
        rows.append(("a", f"p{i}", f"p{i}", "Point", (r.randrange(10), r.randrange(10))))
    rows += rows[:200]
    cells = boxes(spark, CELLS, "cell_id string")
    parts = E.parts_of(features(spark, rows))
    found = E.pieces(parts, cells, 10, earth=False).cache()
    by = ["cell_id", "group"]
    once = {r["cell_id"]: r for r in E.unions(found, by, earth=False).collect()}
    many = {r["cell_id"]: r for r in E.unions(found, by, earth=False, many=20).collect()}
    assert set(once) == set(many)
    for cell, row in once.items():
        for name in ("union_area", "union_length", "distinct_points"):
            assert many[cell][name] == (None if row[name] is None else pytest.approx(row[name], rel=1e-9)), (cell, name)
    found.unpersist()


def test_pieces_of_parts_of_any_extent(spark):
    cells = boxes(spark, [(f"{i}_{j}", 1.0 * i, 1.0 * j, i + 1.0, j + 1.0) for i in range(40) for j in range(40)], "cell_id string")
    big = [[(0, 0), (40, 0), (40, 40), (0, 40), (0, 0)], [(1, 1), (1, 39), (39, 39), (39, 1), (1, 1)]]  # a frame one cell wide
    rows = [("a", "big", "big", "Polygon", big), ("a", "small", "small", "Polygon", rectangle(3.2, 3.2, 3.4, 3.4)), ("a", "line", "line", "LineString", [(0.5, 0.5), (39.5, 39.5)])]
    got = E.pieces(E.parts_of(features(spark, rows)), cells, 1.0, earth=False).groupBy("feature_id").agg(F.count("*").alias("n"), F.sum("measure").alias("m"), F.countDistinct("cell_id").alias("d"))
    found = {r["feature_id"]: (r["n"], r["d"], r["m"]) for r in got.collect()}
    assert found["big"] == (156, 156, pytest.approx(156)) and found["small"][0] == 1 and found["small"][2] == pytest.approx(0.04)
    assert found["line"] == (40, 40, pytest.approx(39 * 2**0.5))
    assert E.pieces(E.parts_of(features(spark, rows).limit(0)), cells, 1.0).count() == 0


def test_crosswalk_fractions(spark):
    cells = boxes(spark, [("c0", 0.0, 0.0, 10.0, 10.0), ("c1", 10.0, 0.0, 20.0, 10.0)], "cell string")
    parts = boxes(spark, [("r", 5.0, 0.0, 15.0, 10.0), ("r", 5.0, 0.0, 12.0, 10.0)], "rec string")
    walk = P.crosswalk(parts, cells, ["rec"], "cell", 10)
    assert sorted((r["cell"], r["fraction_of_native"], r["fraction_of_cell"]) for r in walk.collect()) == [("c0", 0.5, 0.5), ("c1", 0.5, 0.5)]
    assert P.check_crosswalk(walk, ["rec"], "cell").first().asDict() == {"rows": 2, "bad_measures": 0, "bad_fractions": 0, "repeated": 0, "above_one": 0}


def test_crosswalk_of_shapes(spark):
    cells = boxes(spark, CELLS, "cell_id string")
    triangle = [[(5, 0), (15, 0), (5, 10), (5, 0)]]
    rows = [("a", "f", "r", "Polygon", triangle), ("a", "f", "r", "Polygon", rectangle(5, 0, 7, 2)), ("b", "f", "r", "Polygon", rectangle(5, 0, 25, 10)), ("a", "f", "l", "LineString", [(0, 0), (9, 9)])]
    parts = E.parts_of(features(spark, rows))
    walk = E.crosswalk(parts, cells, ["group", "record_id"], 4.0, earth=False)
    got = {(r["group"], r["cell_id"]): (r["intersection_area"], r["native_area"], r["fraction_of_cell"]) for r in walk.collect()}
    near = lambda *x: tuple(pytest.approx(v, rel=1e-9) for v in x)
    assert got == {("a", "c0"): near(37.5, 50, 0.375), ("a", "c1"): near(12.5, 50, 0.125), ("b", "c0"): near(50, 200, 0.5), ("b", "c1"): near(100, 200, 1.0)}
    assert P.check_crosswalk(walk, ["group", "record_id"], "cell_id").first().asDict() == {"rows": 4, "bad_measures": 0, "bad_fractions": 0, "repeated": 0, "above_one": 0}
    corner = E.parts_of(features(spark, [("m", "f", "r", "Polygon", [[(9, 9), (10, 9), (10, 12), (9, 9)]])]))  # its bounds touch the second cell
    assert [r["cell_id"] for r in E.supported(cells, corner, 4.0).collect()] == ["c0"]


def test_relations(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted((r["k"] or 0, r["side"]) for r in R.roster_gaps(a, b, "k").collect()) == [(0, "missing"), (1, "missing"), (3, "extra")]
    assert R.duplicate_keys(a, ["k"]).first()["rows"] == 2
    assert R.differences(a, a).count() == 0 and R.differences(a, b).count() == 4
    with pytest.raises(ValueError):
        R.within_budget(a, 3)
    with pytest.raises(ValueError):
        R.view(a, {"zz": 1})


def test_semantic_hash_ignores_order_only(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    h = lambda df: R.semantic_hash(df).first()["row_hash"]
    assert h(a) == h(a.orderBy(F.desc("k")).select("v", "k")) != h(a.union(a))
    assert h(a.limit(0)) != h(a)


def test_classify_fails_on_unknown_values(spark):
    look = spark.createDataFrame([("a", 1)], "c string, role int")
    ok = spark.createDataFrame([("a",)], "c string")
    assert R.classify(ok, look, ["c"]).first()["role"] == 1
    with pytest.raises(Exception, match="unclassified"):
        R.classify(spark.createDataFrame([("b",)], "c string"), look, ["c"]).collect()


def test_clip_boxes_across_the_dateline(spark):
    df = boxes(spark, [("a", 170.0, 0.0, 180.0, 10.0), ("b", -180.0, 0.0, -170.0, 10.0), ("c", 0.0, 0.0, 1.0, 1.0)])
    out = {r["id"]: (r["min_x"], r["max_x"], r["retained_fraction"], r["clipped"]) for r in clip.clip_boxes(df, (175, 0, -175, 10)).collect()}
    assert out == {"a": (175.0, 180.0, 0.5, True), "b": (-180.0, -175.0, 0.5, True)}


def test_clip_polygons_half(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([("r", [[{"x": x, "y": y} for x, y in ring]])], "rec string, rings array<array<struct<x: double, y: double>>>")
    got = clip.clip_polygons(df, (0, -5, 1, 5), "rec").collect()
    assert len(got) == 1 and got[0]["part_id"] == "r:part-001"
    assert got[0]["retained_fraction"] == pytest.approx(0.5) and got[0]["clipped"]


def test_clip_polygons_over_the_dateline(spark):
    ring = [(179.0, 0.0), (-179.0, 0.0), (-179.0, 1.0), (179.0, 1.0), (179.0, 0.0)]
    df = spark.createDataFrame([("r", [[{"x": x, "y": y} for x, y in ring]])], "rec string, rings array<array<struct<x: double, y: double>>>")
    got = clip.clip_polygons(df, (178, -5, -178, 5), "rec").collect()
    assert [r["part_number"] for r in got] == [1, 2] and all(r["retained_fraction"] == pytest.approx(1) for r in got)


def test_clip_features_of_every_family(spark):
    rows = [
        ("a", "f", "point", "Point", (-120.0, 40.0)),
        ("a", "f", "border", "Point", (-109.0, 50.0)),
        ("a", "f", "outside", "Point", (0.0, 0.0)),
        ("a", "f", "edge", "LineString", [(-109.0, 40.0), (-109.0, 45.0)]),
        ("a", "f", "dateline", "LineString", [(179.0, 50.0), (-179.0, 50.0)]),
        ("a", "f", "points", "MultiPoint", [(-120.0, 40.0), (10.0, 10.0)]),
        ("a", "f", "comb", "Polygon", [[(-112.0, 40.0), (-106.0, 40.0), (-106.0, 43.0), (-112.0, 43.0), (-112.0, 42.0), (-107.0, 42.0), (-107.0, 41.0), (-112.0, 41.0), (-112.0, 40.0)]]),
        ("a", "f", "touch", "Polygon", rectangle(-109.0, 40.0, -100.0, 41.0)),
        ("a", "f", "none", "Point", (-115.0, 33.0)),
    ]
    f = features(spark, rows).withColumn("wkb", F.when(F.col("record_id") != "none", F.col("wkb")))
    got = {}
    for r in clip.clip_features(f, (-180, 32, -109, 72)).collect():
        got.setdefault(r["record_id"], []).append(r)
    assert set(got) == {"point", "border", "edge", "dateline", "points", "comb"}
    share = {k: (v[0]["retained_fraction"], v[0]["clipped"], len(v)) for k, v in got.items()}
    assert share["point"] == (1, False, 1) == share["border"] and share["edge"] == (pytest.approx(1), False, 1)
    assert share["dateline"] == (pytest.approx(0.5, rel=1e-3), True, 1) and got["dateline"][0]["min_x"] == -180
    assert share["points"] == (0.5, True, 1)
    assert share["comb"][1:] == (True, 2) and sorted(r["part_id"] for r in got["comb"]) == ["comb:part-001", "comb:part-002"]
    y = lambda lat: float(K.equal_area(0.0, lat)[1])
    arms = 3 * (y(41) - y(40) + y(43) - y(42))
    assert share["comb"][0] == pytest.approx(arms / (arms * 2 + 1 * (y(42) - y(41))), rel=1e-9)


def test_clip_features_repairs(spark):
    tie = ("a", "f", "tie", "Polygon", [[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]])
    out = clip.clip_features(features(spark, [tie]), (-5, -5, 5, 5)).collect()
    assert len(out) == 2 and all(r["repaired"] and not r["clipped"] and r["retained_fraction"] == pytest.approx(1) for r in out)
    half = clip.clip_features(features(spark, [tie]), (-5, -5, 1, 5)).collect()
    assert len(half) == 1 and half[0]["retained_fraction"] == pytest.approx(0.5)
    flat = ("a", "f", "flat", "Polygon", [[(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)]])
    with pytest.raises(Exception, match="loses its dimension"):
        clip.clip_features(features(spark, [flat]), (-5, -5, 5, 5)).collect()


def test_clip_features_over_the_dateline(spark):
    hole = rectangle(179.5, 0.25, -179.5, 0.75)[0]
    rows = [("a", "f", "p", "Polygon", [rectangle(179.0, 0.0, -179.0, 1.0)[0], hole]), ("a", "f", "l", "LineString", [(179.0, 0.5), (-179.0, 0.5)])]
    out = clip.clip_features(features(spark, rows), (178, -5, -178, 5)).collect()
    assert all(r["retained_fraction"] == pytest.approx(1) and not r["clipped"] for r in out)
    assert sorted((r["record_id"], r["min_x"], r["max_x"]) for r in out) == [("l", -180, -179), ("l", 179, 180), ("p", -180, -179), ("p", 179, 180)]
    assert clip.clip_features(features(spark, rows).limit(0), (178, -5, -178, 5)).count() == 0


def test_rules_raise_with_counts(spark):
    df = spark.createDataFrame([("a", 1.0, "observed"), ("b", None, "observed"), ("c", 2.0, "odd")], "id string, v double, s string")
    found = V.count_violations(df, V.metric_rules("v", "s", "1")).first().asDict()
    assert found == {"rows": 3, "v_state": 1, "v_observed": 1, "v_missing": 0, "v_range": 1}
    with pytest.raises(ValueError, match="v_state"):
        V.require_valid(df, V.metric_rules("v", "s", "1"), ["id"])


def test_normalize(spark):
    raw = spark.createDataFrame([(1, " North ", "NWR"), (None, "x", "OTHER")], "objectid int, orgname string, rsl_type string")
    refuge = PR.LAYERS["wildlife_refuges"]
    made = N.normalize(raw, refuge, N.Source("fws", provider="FWS", url="u"))
    row = made.collect()
    assert len(row) == 1 and row[0]["feature_id"] == "fws:1" and row[0]["feature_name"] == "North" and row[0]["authority"] == "FWS"
    assert row[0]["FWS_RSL_TYPE"] == "NWR" and row[0]["model_eligible"] is False
    with pytest.raises(ValueError, match="missing required"):
        N.normalize(raw.drop("rsl_type"), refuge, N.Source("fws"))
    with pytest.raises(Exception, match="without identity"):
        N.normalize(raw.withColumn("rsl_type", F.lit("NWR")), refuge, N.Source("fws")).collect()
    with pytest.raises(ValueError, match="not a whole number"):
        N.normalize(raw.withColumn("objectid", F.lit(1.5)), refuge, N.Source("fws"))
    assert N.repeated(made.union(made)).first()["rows"] == 2 and N.repeated(made).count() == 0


def test_routing_roles(spark):
    schema = "OBJECTID int, MERGE_SRC string, ENC_NAME string, LNAM string, kind string"
    source = N.Source("chs_routing_layer_4", provider="CHS")
    lanes = spark.createDataFrame([(1, "TSSLPT_A", "e", "L1", "Polygon"), (2, "TSSLPT_A", "f", "L1", "Polygon"), (3, "RCTLPT_A", "e", None, "MultiPolygon"), (4, "TWRTPT_A", "e", "L9", "Polygon")], schema)
    tss = N.normalize(lanes, PR.layer_of("traffic_separation_schemes", source.source_id), source)
    assert sorted((r["record_id"], r["feature_id"], r["routing_role"]) for r in tss.collect()) == [("1", "chs:TSSLPT_A:L1", "chs_lane_part"), ("2", "chs:TSSLPT_A:L1", "chs_lane_part")]
    ways = N.normalize(lanes, PR.layer_of("shipping_lanes", source.source_id), source)
    assert sorted((r["feature_id"], r["routing_role"]) for r in ways.collect()) == [("chs:TWRTPT_A:L9", "chs_two_way_route_part"), ("chs_routing_layer_4:3", "chs_recommended_lane_part")]
    assert {r["group"] for r in PR.group_of(ways, "shipping_lanes").collect()} == {"shipping_lanes__chs_two_way_route_part", "shipping_lanes__chs_recommended_lane_part"}
    with pytest.raises(Exception, match="unknown type NEW"):
        N.normalize(spark.createDataFrame([(1, "NEW", "e", None, "Polygon")], schema), PR.layer_of("shipping_lanes", source.source_id), source).collect()
    with pytest.raises(Exception, match="another family"):
        N.normalize(spark.createDataFrame([(1, "TWRTPT_A", "e", None, "LineString")], schema), PR.layer_of("shipping_lanes", source.source_id), source).collect()
    noaa = spark.createDataFrame([("5", "Fairway"), ("6", "Traffic Lane"), ("7", "Precautionary Area")], "SOURCE_FID string, routeType string")
    found = {c: [(r["feature_id"], r["routing_role"]) for r in N.normalize(noaa, PR.layer_of(c, "noaa_routing_2026"), N.Source("noaa_routing_2026")).collect()] for c in ("shipping_lanes", "traffic_separation_schemes")}
    assert found == {"shipping_lanes": [("noaa_routing_2026:5", "noaa_fairway")], "traffic_separation_schemes": [("noaa_routing_2026:6", "noaa_traffic_lane")]}
    assert len(PR.metric_groups("traffic_separation_schemes")) == 7 and len(PR.metric_groups("shipping_lanes")) == 8


PROVIDER_ROWS = [
    ("federal_waters", "noaa_us_eez_dynamic", "OBJECTID int, BOUND_ID string, REGION string, RULEID int, APPRV_DATE long", (1, "b1", "Pacific", 2, 1590969600000),
     {"feature_id": "us_maritime_zone:exclusive_economic_zone:b1", "geometry_role": "eez_outer_limit", "approval_date": "2020-06-01", "zone_limit_nm": 200, "feature_name": "Pacific — U.S. EEZ limit"}),
    ("federal_waters", "nrcan_canadian_geopolitical_boundaries_lines", "UUID int, TYPE_E string, SRC_DESC string, P_UPD_DATE string, ACCUR int", (3, "EEZ_200", None, "2015-01-02", 50),
     {"feature_id": "can_maritime_zone:exclusive_economic_zone:3", "geometry_role": "eez_200nm_outer_limit", "accuracy_m": 50.0, "legal_authority": "Canada Oceans Act"}),
    ("international_boundaries", "nrcan_canadian_geopolitical_boundaries_lines", "UUID int, TYPE_E string", (4, "INTERN"), {"feature_id": "international_boundary:cgb:4"}),
    ("international_boundaries", "international_boundary_commission_v1_3", "SectionNum int, SectionEng string, MaxScale string", (7, None, "1:200,000"), {"boundary_id": "IBC-7", "scale_denominator": 200000}),
    ("marine_protected_areas", "noaa_mpa_inventory_2023", "site_id string, site_name string, gov_level string, estab_yr string, mgmt_agen string, area_km_ma double, date_gis_u long", ("CA1", "Cove", "State", "est. 1999", "CA Fish & Game", 2.5, 0),
     {"designation_id": "USA:NOAA_MPA:CA1", "established": 1999, "map_group": "us_state_tribal_local_reference", "authority_id": "USA:AGENCY:ca-fish-game", "source_date": "1970-01-01", "marine_area_km2": 2.5}),
    ("wildlife_refuges", "eccc_wildlife_areas_sanctuaries", "OBJECTID int, TYPE_E string, NAME_E string", (5, "Migratory Bird Sanctuary", "Nest"), {"feature_name": "Nest", "refuge_type": "Migratory Bird Sanctuary", "legal_url": None}),
    ("conservation_designations", "eccc_marine_classification", "OBJECTID int, PARENT_ID int, ZONE_ID int, BIOME string, PA_OECM_DF int, STATUS int", (6, 10, 2, "M", 3, 3), {"feature_id": "cpcad:parent:10:zone:2", "classification_role": "reported_interim_pa"}),
    ("management_areas", "adfg_groundfish_statistical_areas", "OBJECTID int, STAT_AREA int, GEOMETRY_START_DATE long, GEOMETRY_END_DATE long", (8, 345631, 0, None), {"feature_id": "adfg.groundfish.statistical:345631", "valid_from": "1970-01-01"}),
    ("management_areas", "dfo_pacific_fishery_management_areas", "OBJECTID int, MGNT_AREA int, SUBAREA_ int, GLOBALID string", (9, 21, 0, "{0a0b0c0d-1111-2222-3333-444455556666}"), {"area_code": "21-0", "parent_area": "21"}),
    ("management_areas", "wdfw_recreational_marine_areas", "OBJECTID int, AreaName string, AreaTitle string, WAC string", (1, "7", "Islands", None), {"feature_name": "WDFW Marine Area 7 — Islands"}),
    ("tribal_first_nations_areas", "nrcan_indian_reserves", "OBJECTID int, adminAreaId string, distributionTypeEng string, jurisdictionEng string", (1, "a", "Indian Reserve", "British Columbia"), {"area_id": "a"}),
    ("county_regional_boundaries", "census_counties_2025", "GEOID string, NAME string", ("06001", "A"), {"feature_id": "census_counties_2025:06001"}),
    ("critical_habitat", "noaa_critical_habitat_line", "OBJECTID int, LISTENTITY string, EFFECTDATE string", (2, "whale", "20210521"), {"effective_start": "2021-05-21"}),
]
BROKEN_ROWS = [
    ("conservation_designations", "eccc_marine_classification", "OBJECTID int, PARENT_ID int, ZONE_ID int, BIOME string, PA_OECM_DF int, STATUS int", (6, 10, 2, "M", 9, 9), "unknown classification"),
    ("conservation_designations", "eccc_marine_classification", "OBJECTID int, PARENT_ID int, ZONE_ID int, BIOME string, PA_OECM_DF int, STATUS int", (6, 10, 2, "T", 1, 1), "not marine"),
    ("management_areas", "adfg_groundfish_statistical_areas", "OBJECTID int, STAT_AREA int, GEOMETRY_START_DATE long, GEOMETRY_END_DATE long", (8, 45631, 0, None), "six-digit"),
    ("management_areas", "dfo_pacific_fishery_management_areas", "OBJECTID int, MGNT_AREA int, SUBAREA_ int, GLOBALID string", (9, 5, 0, "{0a0b0c0d-1111-2222-3333-444455556666}"), "not a subarea"),
    ("tribal_first_nations_areas", "nrcan_indian_reserves", "OBJECTID int, adminAreaId string, distributionTypeEng string, jurisdictionEng string", (1, "a", "Indian Reserve", "Yukon"), "outside the scope"),
    ("county_regional_boundaries", "census_counties_2025", "GEOID string, NAME string", ("6001", "A"), "five-digit"),
    ("federal_waters", "noaa_us_eez_dynamic", "OBJECTID int, BOUND_ID string, APPRV_DATE string", (1, "b", "01/06/2020"), "not a date"),
]


@pytest.mark.parametrize("collection,source,schema,row,want", PROVIDER_ROWS, ids=lambda x: x if isinstance(x, str) and " " not in x else "")
def test_providers(spark, collection, source, schema, row, want):
    made = N.normalize(spark.createDataFrame([row], schema), PR.layer_of(collection, source), N.Source(source, provider="p")).first()
    assert {k: made[k] for k in want} == want


@pytest.mark.parametrize("collection,source,schema,row,message", BROKEN_ROWS, ids=lambda x: x if isinstance(x, str) and " " not in x else "")
def test_providers_reject(spark, collection, source, schema, row, message):
    with pytest.raises(Exception, match=message):
        N.normalize(spark.createDataFrame([row], schema), PR.layer_of(collection, source), N.Source(source, provider="p")).collect()


def test_publish_and_tamper(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    path = str(tmp_path / "t")
    assert products.publish(df, path)["rows"] == 2
    products.validate(spark, path)
    with pytest.raises(FileExistsError):
        products.publish(df, path)
    products.publish(df.limit(1), path, overwrite=True)
    assert products.validate(spark, path)["rows"] == 1
    part = next((tmp_path / "t" / "data").glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    with pytest.raises(ValueError, match="checksum"):
        products.validate(spark, path)


def test_failed_swap_keeps_the_old_table(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1,)], "k int")
    path = str(tmp_path / "t")
    products.publish(df, path)
    real = products.os.rename

    def broken(a, b):
        if ".stage-" in a:
            raise OSError("disk")
        real(a, b)

    monkeypatch.setattr(products.os, "rename", broken)
    with pytest.raises(OSError):
        products.publish(df.union(df), path, overwrite=True)
    monkeypatch.undo()
    assert products.validate(spark, path)["rows"] == 1


def test_releases(spark, tmp_path):
    r = products.Releases(str(tmp_path / "r"))
    r.add(spark, "g1", {"t": spark.range(3).toDF("k")})
    assert r.current() is None
    r.activate(spark, "g1")
    assert r.current() == "g1"
    with pytest.raises(FileExistsError):
        r.add(spark, "g1", {})


def test_polygons_in_convex_cells_are_cut_in_one_pass():
    """All polygons of a batch against cells of four and six corners, as one by one."""
    import numpy as np

    from tilewright.operators import exact

    hexagon = np.array([(50, -25), (50, 25), (0, 50), (-50, 25), (-50, -25), (0, -50)], float)
    cells = [hexagon, hexagon + (50, 75), np.array([(-20, -20), (20, -20), (20, 20), (-20, 20)], float)]
    rng = np.random.default_rng(1)
    shapes = [[np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])] for x, y, w, h in rng.uniform(-60, 60, (60, 4))]
    shapes += [[8 * hexagon, hexagon / 4], [np.array([(0, 0), (30, 30), (30, 0), (0, 30)], float)]]
    begins = np.arange(len(shapes)) * 3
    got = {(k, i - 3 * k): a for k, i, a, _ in exact._many_polygon_pieces(shapes, np.zeros((3 * len(shapes), 4)), begins, begins + 3, False, cells * len(shapes))}
    want = {(k, i): a for k, s in enumerate(shapes) for i, a, _ in exact._polygon_in_rings(s, cells, False)}
    assert len(got) > 50 and got == pytest.approx(want, abs=1e-9)
