"""Queries take whole tables."""

from tilewright.queries import QUERIES
from tilewright.queries.base import table


def test_every_customer_has_a_distance(spark, sf):
    made = QUERIES["sphere_distance_all"](spark, sf)
    ids = table(spark, sf, "customer").select("c_custkey")
    assert ids.exceptAll(made.select("c_custkey")).count() == 0 and made.where("metres is null").count() == 0
    assert made.count() == ids.count() == QUERIES["sphere_distance"](spark, sf).count()


def test_every_part_is_exploded(spark, sf):
    made = QUERIES["explode_parts_all"](spark, sf)
    want = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "cast(l_quantity as bigint)")
    assert want.exceptAll(made).count() == 0 and made.exceptAll(want).count() == 0
    assert made.where("quantity <= 45").count() > 0
