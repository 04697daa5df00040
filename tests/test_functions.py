import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tilewright.functions import geometry as G, kernels as K, noding as N, planar as P, scalar as S, temporal as T


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize("raw,value", [("  a ", "a"), ("  ", None), ("", None), (None, None)])
def test_clean(spark, raw, value):
    assert one(spark, S.clean(F.lit(raw).cast("string"))) == value


@pytest.mark.parametrize(
    "raw,value",
    [("48°34'00\"N", 48 + 34 / 60), ("125°06.000’W", -125.1), ("60°60'00\"N", 61.0), ("10°59'60\"S", -11.0), ("10°61'00\"S", None), ("north", None)],
)
def test_dms(spark, raw, value):
    found = one(spark, S.dms(lit(raw)))
    assert found is None if value is None else found == pytest.approx(value)


def test_dates(spark):
    assert one(spark, S.iso_date(lit("2020-02-29T10:00:00Z"))) == "2020-02-29"
    assert one(spark, S.epoch_ms_date(lit(0))) == "1970-01-01"
    assert one(spark, S.effective_date(lit("1/2/2003"))) == "2003-01-02"
    assert one(spark, S.effective_date(lit("20030102"))) == "2003-01-02"
    assert one(spark, S.effective_date(lit("2 Jan"))) is None
    for bad in ("01/02/2003", "1234567", "2021-02-30"):
        with pytest.raises(Exception, match="not a date"):
            one(spark, S.iso_date(lit(bad)))


def test_numbers(spark):
    assert one(spark, S.scale_denominator(lit("1:200,000"))) == 200000
    assert one(spark, S.strict_int(lit("21.5"))) is None
    assert one(spark, S.strict_int(lit("21"))) == 21
    assert one(spark, S.year(lit("est. 1987-05"))) == 1987
    assert one(spark, S.year(lit("no 17 here"))) is None
    with pytest.raises(Exception, match="whole number"):
        one(spark, S.required_int(lit("x")))


def test_as_of(spark):
    assert one(spark, T.as_of("2020-01-01", lit("2020-01-01"), lit(None).cast("string")))
    assert not one(spark, T.as_of("2020-01-01", lit("2020-01-02"), lit(None).cast("string")))
    assert one(spark, T.as_of("2020-01-01", lit("soon"), lit("2020-01-01")))


def test_whole_ellipsoid_area(spark):
    area = one(spark, (G.project_x(lit(180.0)) - G.project_x(lit(-180.0))) * (G.project_y(lit(90.0)) - G.project_y(lit(-90.0))))
    e = G.ECC
    whole = 2 * math.pi * G.SEMI_MAJOR**2 * (1 + (1 - G.ECC2) / e * math.atanh(e))
    assert area == pytest.approx(whole, rel=1e-12)


def test_geodesic_closed_forms():
    degree = math.pi * G.SEMI_MAJOR / 180
    assert float(K.geodesic(0, 0, 1, 0)) == pytest.approx(degree, rel=1e-12)
    assert float(K.geodesic(0, 0, 0, 90)) == pytest.approx(10001965.729313, rel=1e-11)
    assert float(K.geodesic(5, 5, 5, 5)) == 0


def test_utm_central_meridian():
    x, y = K.utm(-123.0, 0.0, 10)
    assert (float(x), float(y)) == pytest.approx((500000.0, 0.0))
    assert float(K.utm(-123.0, 90.0, 10)[1]) == pytest.approx(0.9996 * 10001965.729313, rel=1e-10)


def test_unwrap(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(0.0).alias("y")) for x in (179, -179, 178, -170)])
    assert [p["x"] for p in one(spark, G.unwrap(ring))] == [179, 181, 178, 190]


def test_polygon_area(spark):
    ring = lambda *p: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in p])
    shell, hole = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (1, 2), (2, 2), (2, 1))
    assert one(spark, G.polygon_area(F.array(shell, hole))) == 15


def test_boxes():
    assert G.box_parts(179, 0, -179, 1) == [(179, 0, 180.0, 1), (-180.0, 0, -179, 1)]
    for bad in ((0, 1, 1, 0), (0, 0, 0, 1), (float("nan"), 0, 1, 1), (0, 0, 200, 1)):
        with pytest.raises(ValueError):
            G.check_box(*bad)


def rings(*lists):
    return [np.array(r, float) for r in lists]


def square(a, b, n):
    return rings([(a, b), (a + n, b), (a + n, b + n), (a, b + n)])


def test_bow_tie_area():
    tie = rings([(0, 0), (10, 10), (10, 0), (0, 10)])
    assert not P.is_simple(tie) and P.polygon_area(tie) == pytest.approx(50)


def test_holes_and_overlaps():
    holed = [square(0, 0, 4)[0], square(1, 1, 2)[0]]
    assert P.covered_area([holed]) == pytest.approx(12) == P.polygon_area(holed, simple=True)
    assert P.covered_area([holed, square(1, 1, 2)], 2) == pytest.approx(0)
    assert P.covered_area([square(0, 0, 4), square(2, 2, 4)], 2) == pytest.approx(4)
    assert P.covered_area([square(0, 0, 4), square(2, 2, 4)]) == pytest.approx(28)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8), st.integers(1, 5), st.integers(1, 5)), max_size=6))
def test_union_equals_raster(boxes):
    grid = np.zeros((16, 16), bool)
    for x, y, w, h in boxes:
        grid[x : x + w, y : y + h] = True
    polygons = [rings([(x, y), (x + w, y), (x + w, y + h), (x, y + h)]) for x, y, w, h in boxes]
    assert P.covered_area(polygons) == pytest.approx(grid.sum())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20)), min_size=3, max_size=7), min_size=1, max_size=4))
def test_covered_area_equals_slab_by_slab(shapes):
    """Even-odd areas of any rings, against a plain loop over slabs."""
    from fractions import Fraction

    edges = [(k, *map(Fraction, (*a, *b))) for k, r in enumerate(shapes) for a, b in zip(r, r[1:] + r[:1]) if a[0] != b[0]]
    edges = [(k, *(e if e[0] < e[2] else e[2:] + e[:2])) for k, *e in edges]
    xs = {x for e in edges for x in (e[1], e[3])}
    for i, a in enumerate(edges):
        for b in edges[:i]:
            slope = lambda e: (e[4] - e[2]) / (e[3] - e[1])
            if slope(a) != slope(b):
                x = (b[2] - a[2] + slope(a) * a[1] - slope(b) * b[1]) / (slope(a) - slope(b))
                if max(a[1], b[1]) < x < min(a[3], b[3]):
                    xs.add(x)
    total, xs = Fraction(0), sorted(xs)
    for left, right in zip(xs, xs[1:]):
        middle = (left + right) / 2
        live = sorted((e[2] + (middle - e[1]) * (e[4] - e[2]) / (e[3] - e[1]), e[0]) for e in edges if e[1] <= left and e[3] >= right)
        inside: set = set()
        for (low, who), (high, _) in zip(live, live[1:]):
            inside ^= {who}
            if inside:
                total += (high - low) * (right - left)
    got = P.covered_area([rings(r) for r in shapes])
    assert got == pytest.approx(float(total), abs=1e-9)


def test_clip_and_split():
    assert P.covered_area([P.clip_polygon(square(-1, -1, 4), (0, 0, 2, 2))]) == pytest.approx(4)
    assert P.clip_polygon(square(5, 5, 1), (0, 0, 2, 2)) == []
    comb = rings([(0, 0), (7, 0), (7, 4), (5, 4), (5, 1), (4, 1), (4, 4), (2, 4), (2, 1), (0, 1)])  # two teeth
    parts = P.split_polygon(comb, (-1, 2, 9, 9))
    assert sorted(P.polygon_area(p, True) for p in parts) == [4, 4]
    holed = [square(0, 0, 10)[0], square(1, 1, 2)[0], square(6, 4, 2)[0]]
    left, right = sorted(P.split_polygon(holed, (-1, -1, 5, 11)) + P.split_polygon(holed, (5, -1, 11, 11)), key=lambda p: p[0][:, 0].min())
    assert P.polygon_area(left, True) == 46 and P.polygon_area(right, True) == 46 and len(left) == len(right) == 2
    assert sum(P.polygon_area(p, True) for p in P.split_polygon(holed, (2, 2, 7, 20))) == pytest.approx(40 - 1 - 2)
    star = rings([(5 + 4 * math.cos(a) * (1 if i % 2 else 0.4), 5 + 4 * math.sin(a) * (1 if i % 2 else 0.4)) for i, a in enumerate(np.linspace(0, 2 * math.pi, 25)[:-1])])
    for box in ((0, 0, 5, 5), (3, 2, 8, 5.5), (5, 5, 6, 6), (1, 8, 9, 9)):
        assert sum(P.polygon_area(p, True) for p in P.split_polygon(star, box)) == pytest.approx(P.polygon_area(P.clip_polygon(star, box)))


def test_make_valid():
    sizes = lambda polygons: sorted(round(P.polygon_area(p, True), 9) for p in polygons)
    assert sizes(N.make_valid(rings([(0, 0), (10, 10), (10, 0), (0, 10)]))) == [25, 25]
    assert sizes(N.make_valid([square(0, 0, 4)[0], square(1, 1, 2)[0]])) == [12]
    assert sizes(N.make_valid([square(0, 0, 4)[0], square(10, 10, 2)[0]])) == [4, 16]  # a hole outside is land
    assert sizes(N.make_valid(rings([(0, 0), (4, 0), (4, 4), (6, 4), (4, 4), (0, 4)]))) == [16]  # a spike is dropped
    assert N.make_valid(rings([(0, 0), (1, 0), (2, 0)])) == []
    nested = [square(0, 0, 10)[0], square(1, 1, 8)[0], square(2, 2, 6)[0]]
    assert sizes(N.make_valid(nested)) == [36, 36]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=3, max_size=7), min_size=1, max_size=2))
def test_valid_polygons_cover_the_same(shapes):
    made = N.make_valid(rings(*shapes))
    assert sum(P.polygon_area(p, True) for p in made) == pytest.approx(P.covered_area([rings(*shapes)]), abs=1e-6)
    assert all(P.covered_area([p]) == pytest.approx(P.polygon_area(p, True), abs=1e-6) for p in made)


def test_simplified(spark):
    line = np.array([(0, 0), (1, 0.05), (2, -0.05), (3, 0), (3, 3), (3.02, 4), (3, 5)], float)
    assert P.simplified(line, 0.1).tolist() == [[0, 0], [3, 0], [3, 5]]
    data = [bytearray(K.to_wkb("LineString", line.tolist())), bytearray(K.to_wkb("Polygon", [[(0, 0), (1, 0.01), (2, 0), (2, 2), (0, 2), (0, 0)]])), None]
    df = spark.createDataFrame([(d,) for d in data], "g binary").select(K.simplify(F.col("g"), 0.1).alias("g"))
    got = [None if r["g"] is None else K.from_wkb(bytes(r["g"])) for r in df.collect()]
    assert len(got[0][1]) == 3 and got[1][1][0] == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)] and got[2] is None


def test_segments_merge():
    s = np.array([[0, 0, 2, 0], [3, 0, 1, 0], [5, 0, 6, 0], [0, 0, 0, 2], [0, 1, 0, 3], [0, 1, 1, 1], [1, 1, 3, 3], [2, 2, 0, 0]], float)
    merged = P.merged_segments(s)
    assert np.hypot(merged[:, 2] - merged[:, 0], merged[:, 3] - merged[:, 1]).sum() == pytest.approx(3 + 1 + 3 + 1 + 3 * math.sqrt(2))
    assert P.clip_line(np.array([[0.0, 0], [10, 10], [10, 0]]), (2, 2, 10, 5)).tolist() == [[2, 2, 5, 5], [10, 5, 10, 2]]
    assert len(P.clip_line(np.array([[0.0, 0], [1, 0]]), (1, 0, 2, 2))) == 0


def test_geodesic_lengths_of_a_batch(spark):
    lines = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], None, [], [(5.0, 5.0)], [(0.0, 0.0), (0.0, 1.0)]]
    df = spark.createDataFrame([(None if x is None else [{"x": a, "y": b} for a, b in x],) for x in lines], "l array<struct<x: double, y: double>>")
    got = [r["m"] for r in df.select(K.geodesic_length(F.col("l")).alias("m")).collect()]
    one = lambda *p: float(K.geodesic(*p))
    assert got == [pytest.approx(one(0, 0, 1, 0) + one(1, 0, 1, 1)), None, 0, 0, pytest.approx(one(0, 0, 0, 1))]


def test_geometry_meets_box():
    box = (0, 0, 2, 2)
    meets = lambda kind, c: K.meets_box(kind, c, box)
    assert meets("Polygon", [[(-5, -5), (9, -5), (9, 9), (-5, 9), (-5, -5)]])  # around the box
    assert not meets("Polygon", [[(-5, -5), (9, -5), (9, 9), (-5, 9), (-5, -5)], [(-1, -1), (3, -1), (3, 3), (-1, 3), (-1, -1)]])  # the box is in its hole
    assert meets("LineString", [(-1, 1), (3, 1)]) and not meets("LineString", [(-1, 2.5), (2.5, 2.5)])
    assert not meets("LineString", [(1, 4), (4, 1)]) and not meets("Polygon", [[(1.5, 5), (5, 1.5), (5, 5), (1.5, 5)]])  # only the bounds meet
    assert meets("MultiPoint", [(9, 9), (2, 2)]) and not meets("Point", (2.1, 0))


@pytest.mark.parametrize(
    "kind,c",
    [("Point", (1.0, 2.0)), ("LineString", [(0.0, 0.0), (1.0, 1.0)]), ("Polygon", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]), ("MultiPoint", [(1.0, 2.0), (3.0, 4.0)])],
)
def test_wkb_round_trip(kind, c):
    assert K.from_wkb(K.to_wkb(kind, c)) == (kind, c)


def test_wkb_parts(spark):
    data = bytearray(K.to_wkb("MultiPoint", [(1.0, 2.0), (3.0, 4.0)]))
    df = spark.createDataFrame([(data,), (None,)], "g binary").select(F.size(K.wkb_parts(F.col("g"))).alias("n"))
    assert [r["n"] for r in df.collect()] == [2, 0]
