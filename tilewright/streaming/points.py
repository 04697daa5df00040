"""Moving points by cell and time window; an extension beyond the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def assign_cells(points: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """points with the square cell (cx, cy) they are in; null coordinates have null cells."""
    return points.withColumn("cx", F.floor(F.col(x) / size)).withColumn("cy", F.floor(F.col(y) / size))


def windowed_counts(points: DataFrame, size: float, time: str, window: str, late: str, feature: str, slide: str | None = None) -> DataFrame:
    """Points and approximate distinct features per cell and event-time window, final once the watermark has passed it.

    Works on a batch and on a stream alike; rows later than `late` behind the newest are dropped
    by the stream, as the watermark demands.
    """
    seen = assign_cells(points, size).withWatermark(time, late)
    span = F.window(time, window, slide) if slide else F.window(time, window)
    out = seen.groupBy(span.alias("window"), "cx", "cy").agg(F.count("*").alias("points"), F.approx_count_distinct(feature).alias("features"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "cx", "cy", "points", "features")


def sessions(points: DataFrame, time: str, gap: str, late: str, feature: str) -> DataFrame:
    """Runs of points of a feature with no longer pause than gap."""
    return (
        points.withWatermark(time, late)
        .groupBy(F.session_window(time, gap).alias("s"), feature)
        .agg(F.count("*").alias("points"))
        .select(feature, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "points")
    )
