"""Unions as geometry, buffers, boundaries, distances and the comparison of boundaries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.functions import kernels as K, noding as N, planar as P
from tilewright.operators import dissolve as D, distances, exact


def ring(*p):
    return [*p, p[0]]


def box(x, y, w, h):
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def frame(spark, rows, schema="grp string, wkb binary"):
    return spark.createDataFrame([(*r[:-1], bytearray(r[-1]) if r[-1] is not None else None) for r in rows], schema)


def polygons(found):
    return [K.primitives(*K.from_wkb(bytes(r["wkb"])))[0][1] for r in found]


def perimeter(rings):
    return sum(np.hypot(*(np.roll(r, -1, axis=0) - r).T).sum() for r in rings)


def test_dissolve_over_tiles(spark):
    """A ring of boxes with a hole, a box apart, an island in the hole, and one that touches at a corner only."""
    shapes = [box(0, 0, 30, 7), box(0, 23, 30, 7), box(0, 0, 7, 30), box(23, 0, 7, 30), box(12, 12, 4, 4), box(40, 0, 5, 5), box(45, 5, 3, 3), box(0, 0, 30, 7)]
    rows = [("a", K.to_wkb("Polygon", [s])) for s in shapes] + [(None, K.to_wkb("Polygon", [box(1, 1, 2, 2)])), ("b", None), ("b", K.to_wkb("Point", (1, 1)))]
    for tile in (4.0, 10.0, 100.0):
        found = D.dissolve(exact.parts_of(frame(spark, rows)), ["grp"], tile).collect()
        made = sorted((r["grp"] or "", round(r["area"], 6)) for r in found)
        assert made == [("", 4), ("a", 9), ("a", 16), ("a", 25), ("a", 900 - 256)]
        frame_ = max(polygons(found), key=lambda p: abs(P.ring_area(p[0])))
        assert len(frame_) == 2 and perimeter(frame_) == pytest.approx(120 + 64)  # no inner edges


@pytest.mark.parametrize("tile", [7.0, 60.0])
def test_dissolve_equals_the_union_area(spark, tile):
    rng, rows = np.random.default_rng(4), []
    for i in range(150):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 7))
        p = rng.uniform(0, 50, 2) + rng.uniform(1, 5) * np.column_stack((np.cos(turn), np.sin(turn)))
        if i % 5 == 0:
            p = p[rng.permutation(7)]  # crosses itself
        rows.append(("xy"[i % 2], K.to_wkb("Polygon", [ring(*map(tuple, p.tolist()))])))
    parts = exact.parts_of(frame(spark, rows))
    made = {r["grp"]: r["area"] for r in D.dissolve(parts, ["grp"], tile).groupBy("grp").agg(F.sum("area").alias("area")).collect()}
    for g in "xy":
        want = P.covered_area([K.primitives(*K.from_wkb(d))[0][1] for k, d in rows if k == g])
        assert made[g] == pytest.approx(want, rel=1e-6)


def test_what_is_united_is_valid():
    rng = np.random.default_rng(8)
    made = N.union([N.make_valid([rng.integers(0, 20, (6, 2)).astype(float)])[0] for _ in range(40)])
    assert all(N.repaired(p)[1]["remnant_length"] == 0 and len(N.make_valid(p)) == 1 for p in made)
    assert sum(P.ring_area(r) for p in made for r in p) == pytest.approx(P.covered_area(made), rel=1e-7)


def test_repair_reports():
    found, told = N.repaired([np.array([(0, 0), (10, 0), (10, 10), (0, 10)], float), np.array([(1, 1), (5, 1), (5, 5), (1, 5)], float), np.array([(3, 3), (7, 3), (7, 7), (3, 7)], float)])
    assert told == {"area_before": 68.0, "area_after": 76.0, "area_change": 8.0, "remnant_length": 0.0} and sum(len(p) for p in found) == 3
    found, told = N.repaired([np.array([(0, 0), (4, 0), (4, 4), (2, 4), (2, 9), (2, 4), (0, 4)], float)])
    assert told["remnant_length"] == 5 and told["area_after"] == 16
    assert N.repaired([np.array([(0, 0), (4, 0), (8, 0)], float)])[0] == []


def test_buffer_and_boundary(spark):
    rows = [("p", K.to_wkb("Point", (3, 3))), ("l", K.to_wkb("LineString", [(0, 0), (10, 0), (10, 10)])), ("q", K.to_wkb("Polygon", [box(0, 0, 10, 10), box(2, 2, 6, 6)[::-1]]))]
    found = {r["grp"]: r["area"] for r in D.buffer(frame(spark, rows), ["grp"], 1.0, 5.0, quarter=64).collect()}
    assert found["p"] == pytest.approx(math.pi, rel=1e-3)
    assert found["l"] == pytest.approx(40 + math.pi - (1 - math.pi / 4), rel=1e-3)
    assert found["q"] == pytest.approx(100 - 16 + 40 + math.pi, rel=1e-3)
    with pytest.raises(ValueError):
        D.buffer(frame(spark, rows), ["grp"], 0.0, 5.0)
    lines = {r["grp"]: r["b"] and K.from_wkb(bytes(r["b"])) for r in frame(spark, rows).select("grp", D.boundary(F.col("wkb")).alias("b")).collect()}
    assert lines["p"] is None and lines["l"] == ("MultiPoint", [(0, 0), (10, 10)]) and [len(x) for x in lines["q"][1]] == [5, 5]


def test_points_along(spark):
    shape = K.to_wkb("MultiLineString", [[(0, 0), (3, 0), (3, 4)], [(0, 10), (0, 10.5)], [(5, 5), (5, 5)]])
    rows = distances.points_along(frame(spark, [("a", shape), ("b", None), ("c", K.to_wkb("Point", (0, 0)))]), ["grp"], 2.0).orderBy("part", "number").collect()
    assert [(r["part"], round(r["x"], 9), round(r["y"], 9)) for r in rows] == [(0, 0, 0), (0, 1.75, 0), (0, 3, 0.5), (0, 3, 2.25), (0, 3, 4), (1, 0, 10), (1, 0, 10.5), (2, 5, 5), (2, 5, 5)]


def test_nearest_edge(spark):
    rng = np.random.default_rng(2)
    lines = [("k" if i % 2 else "m", K.to_wkb("LineString", (rng.uniform(0, 100, 2) + rng.normal(size=(4, 2))).tolist())) for i in range(40)]
    lines += [("k", K.to_wkb("Polygon", [box(200, 200, 10, 10)])), ("m", K.to_wkb("Point", (-300, 5)))]
    points = [(i, "km"[i % 2] if i % 17 else "none", *rng.uniform(-500, 500, 2).tolist()) for i in range(120)] + [(500, "k", None, 1.0), (501, "k", 205.0, 203.0)]
    edges = distances.edges_of(frame(spark, lines), ["grp"])
    made = {r["id"]: r["distance"] for r in distances.nearest_edge(spark.createDataFrame(points, "id int, grp string, x double, y double"), edges, "id", 1.5, ["grp"]).collect()}
    every = edges.collect()
    for i, g, x, y in points:
        want = None
        for e in (e for e in every if e["grp"] == g and x is not None):
            a, b, p = np.array([e["x1"], e["y1"]]), np.array([e["x2"], e["y2"]]), np.array([x, y])
            t = np.clip((p - a) @ (b - a) / max(1e-300, (b - a) @ (b - a)), 0, 1)
            want = min(want if want is not None else math.inf, float(np.hypot(*(a + t * (b - a) - p))))
        assert made[i] == (pytest.approx(want) if want is not None else None)
    none = distances.nearest_edge(spark.createDataFrame(points, "id int, grp string, x double, y double"), edges.where("false"), "id", 1.5, ["grp"])
    assert none.where("distance is not null").count() == 0 and none.count() == len(points)


def test_reconcile(spark):
    line = lambda y, x=100_000: K.to_wkb("LineString", [(0, y), (x, y)])
    sections = spark.createDataFrame([(1, bytearray(line(0)), 30.0), (2, bytearray(line(200_000)), None)], "section_id int, wkb binary, precision double")
    shapes = [("near", line(20), 10.0), ("near", line(10**6), 50.0), ("minor", line(800), None), ("wide", line(4_000), None), ("far", line(30_000), None), ("gone", None, None)]
    frame_ = spark.createDataFrame([(a, b and bytearray(b), c) for a, b, c in shapes], "source_id string, wkb binary, accuracy double")
    compared = distances.reconcile(sections, frame_, 10_000.0)
    made = {(r["section_id"], r["source_id"]): r for r in compared.collect()}
    assert {k[1]: r["status"] for k, r in made.items() if k[0] == 1} == {
        "near": "aligned_within_reported_precision",
        "minor": "minor_divergence_within_1km",
        "wide": "divergence_within_5km_review_required",
        "far": "unresolved_divergence",
        "gone": "comparison_geometry_unavailable",
    }
    assert made[1, "near"]["tolerance"] == 30 and made[1, "near"]["samples"] == 21 and made[1, "far"]["median_distance"] == 30_000
    assert {made[2, s]["status"] for s in ("near", "minor", "wide", "far")} == {"no_comparable_geometry_near_section"}
    said = {r["section_id"]: tuple(r)[1:3] for r in distances.reconciliation_status(compared, ["near", "minor"]).collect()}
    assert said == {1: ("source_compared", "pass_with_limitations"), 2: ("source_compared", "pass_with_limitations")}
    said = {r["section_id"]: r["qc_status"] for r in distances.reconciliation_status(compared, ["wide", "gone"]).collect()}
    assert said == {1: "review_required", 2: "review_required"}


def test_equal_geometries_are_repaired_once(spark, monkeypatch):
    from tilewright import storage
    from tilewright.operators import repair

    written = {}

    def materialize(df, label):
        written[label] = storage.materialize(df, label)
        return written[label]

    monkeypatch.setattr(repair, "materialize", materialize)
    tie = K.to_wkb("Polygon", [[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]])
    box = K.to_wkb("Polygon", [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]])
    rows = [(1, tie), (2, tie), (2, tie), (3, box), (4, None)]
    made = repair.repair(spark.createDataFrame(rows, "id int, wkb binary")).collect()
    assert written["repaired"].count() == 2
    assert sorted((r["id"], r["repaired"], r["pieces"]) for r in made if r["id"] < 4) == [(1, True, 2), (2, True, 2), (2, True, 2), (3, False, 1)]
    assert [r["wkb"] for r in made if r["id"] == 4] == [None] and len(made) == 5


def test_nearest_leaves_are_those_of_brute_force():
    rng = np.random.default_rng(4)
    a = rng.uniform(0, 100, (500, 2))
    e = np.hstack((a, a + rng.uniform(-30, 30, (500, 2)) * rng.integers(0, 2, (500, 1))))
    p = rng.uniform(-200, 300, (300, 2))
    assert distances._nearest(p, e) == pytest.approx(distances._to_edges(p[:, None], e[None]).min(axis=1), abs=1e-12)


def test_equal_points_and_edges_are_compared_once(spark, monkeypatch):
    from tilewright import storage

    written = {}

    def materialize(df, label):
        written.setdefault(label, storage.materialize(df, label))
        return written[label] if label not in ("visits", "near") else storage.materialize(df, label)

    monkeypatch.setattr(distances, "materialize", materialize)
    points = spark.range(600).selectExpr("id", "cast(id % 3 as double) as x", "0D as y")
    lines = spark.range(9000).selectExpr("-100D as x1", "cast(5 + id % 4500 as double) as y1", "100D as x2", "cast(5 + id % 4500 as double) as y2")
    made = distances.nearest_edge(points, lines, "id", 1.0).collect()
    assert len(made) == 600 and {r["distance"] for r in made} == {5.0}
    assert written["places"].count() == 3 and written["edges"].count() == 4500 and written["blocks"].count() >= 3


def test_points_along_come_in_batches(spark, monkeypatch):
    """Lines share batches of points, and a long line fills some of its own."""
    monkeypatch.setattr(distances, "POINTS", 7)
    lines = frame(spark, [(f"g{k}", K.to_wkb("LineString", [(0, k), (length, k)])) for k, length in enumerate((3, 20, 1, 1))])
    made = distances.points_along(lines, ["grp"], 1.0).collect()
    got = {g: sorted((r["number"], r["along"], r["x"], r["y"]) for r in made if r["grp"] == g) for g in {r["grp"] for r in made}}
    assert got == {f"g{k}": [(i, float(i), float(i), float(k)) for i in range(length + 1)] for k, length in enumerate((3, 20, 1, 1))}
