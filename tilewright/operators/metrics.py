"""Metrics per cell and group: counts, coverage, missing-data rules, states and the wide table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import col
from .spatial import union_area

#: Support states of a metric (fixed values).
STATES = ("observed", "unknown", "unavailable", "not_applicable", "partial")
#: A complete named roster is not complete coverage of the grid (fixed value).
ROSTER_ONLY = "complete_current_noaa_west_coast_sanctuary_roster"


def counts(hits: DataFrame, keys: list[str], feature: str, record: str, part: str) -> DataFrame:
    """Distinct features and records and the number of parts of each key; keys without hits have no row."""
    return hits.groupBy(*keys).agg(
        F.countDistinct(feature).alias("feature_count"), F.countDistinct(record).alias("source_record_count"), F.count(part).alias("part_count")
    )


def distinct_tuples(fields: list[str], present: str) -> Column:
    """Number of distinct tuples of fields, nulls in them included, over rows where `present` is not null."""
    return F.countDistinct(F.when(F.col(present).isNotNull(), F.struct(*fields)))


def coverage_fraction(covered: Column | str, whole: Column | str) -> Column:
    """covered / whole in [0, 1]: round-off beyond is cut off, anything beyond round-off is an error."""
    share = col(covered) / col(whole)
    bad = (share < -1e-10) | (share > 1 + 1e-8)
    return F.when(bad, F.raise_error(F.lit("coverage fraction exceeds the cell"))).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def attribute_set(c) -> Column:
    """Sorted distinct values as text; null instead of an empty set."""
    found = F.array_sort(F.collect_set(col(c).cast("string")))
    return F.when(F.size(found) > 0, found)


def zero_fill(value, completeness) -> Column:
    """A missing value is 0 only where the inventory is declared complete; else it stays null."""
    v = col(value)
    return F.when(col(completeness) == "complete", F.coalesce(v, F.lit(0))).otherwise(v)


def query_status(has_hits, availability) -> Column:
    """State of the interactive query: partial with hits; unknown without, if the source was read; else unavailable."""
    return F.when(col(has_hits), "partial").when(col(availability).isin("available", "empty"), "unknown").otherwise("unavailable")


def support_state(completeness) -> Column:
    c = col(completeness)
    return F.when(c == "complete", "observed").when(c.isin("partial", ROSTER_ONLY), "partial").otherwise(c)


def delivery_status(value, state) -> Column:
    """State of a delivered value: a null under `observed` is unknown; a value under a missing state is an error."""
    v, s = col(value), col(state)
    contradiction = s.isin("unavailable", "not_applicable", "unknown") & v.isNotNull()
    return (
        F.when(contradiction, F.raise_error(F.concat(F.lit("finite value contradicts state "), s)))
        .when(v.isNull() & (s == "observed"), "unknown")
        .otherwise(s)
    )


def for_every_cell(cells: DataFrame, found: DataFrame, cell: str) -> DataFrame:
    """Every cell once, with nulls where nothing was found; nothing is filled in."""
    return cells.join(found, cell, "left")


def wide(long: DataFrame, cell: str, group: str, groups: list[str], metrics: list[str]) -> DataFrame:
    """One row per cell with columns GROUP__METRIC, for the groups named, whether or not they have rows."""
    out = long.groupBy(cell).pivot(group, groups).agg(*[F.first(m).alias(m) for m in metrics])
    if len(metrics) == 1:  # then the pivot names its columns by the group alone
        return out.select(cell, *[F.col(f"`{g}`").alias(f"{g}__{metrics[0]}") for g in groups])
    return out.select(cell, *[F.col(f"`{g}_{m}`").alias(f"{g}__{m}") for g in groups for m in metrics])


def cell_coverage(hits: DataFrame, cell: str, group: str, cell_area: float) -> DataFrame:
    """(cell, group, union_area, fraction) of box memberships."""
    return union_area(hits, [cell, group]).withColumn("fraction", coverage_fraction(F.col("union_area"), F.lit(cell_area)))


def receipts(sources: DataFrame, group: str, available: Column, source: str) -> DataFrame:
    """(group, available, configured, fraction, gaps): how many of the configured sources were received, and which not."""
    return sources.groupBy(group).agg(
        F.count_if(available).alias("available"),
        F.count("*").alias("configured"),
        (F.count_if(available) / F.count("*")).alias("fraction"),
        F.array_sort(F.collect_set(F.when(~available, F.col(source)))).alias("gaps"),
    )


def completeness(coverage: DataFrame, collection: str, status: str) -> DataFrame:
    """(collection, complete, partial): complete if every status is complete or not_applicable; partial if any is short of it."""
    return coverage.groupBy(collection).agg(
        F.bool_and(F.coalesce(F.col(status).isin("complete", "not_applicable"), F.lit(False))).alias("complete"),
        F.bool_or(F.coalesce(F.col(status).isin("partial", "unknown", "unavailable"), F.lit(True))).alias("partial"),
    )


def distance_stats(samples: DataFrame, keys: list[str], distance: str, tolerance: float) -> DataFrame:
    """Least, median, 95th percentile and greatest distance, and the share of samples within tolerance."""
    d = F.col(distance)
    return samples.groupBy(*keys).agg(
        F.count(d).alias("samples"),
        F.min(d).alias("least"),
        F.median(d).alias("median"),
        F.percentile(d, 0.95).alias("p95"),
        F.max(d).alias("greatest"),
        F.avg((d <= tolerance).cast("double")).alias("share_within"),
    )


def distance_status(share, tolerance: float = 0.995) -> Column:
    s = col(share)
    return F.when(s.isNull(), "not_compared").when(s >= tolerance, "consistent").when(s > 0, "review_required").otherwise("disjoint")


def area_qc(measured, reference, percent: float = 0.5) -> Column:
    """Whether a measured area is within so many percent of the reference; not_applicable without one."""
    difference = 100 * (col(measured) - col(reference)) / col(reference)
    return F.when(col(reference).isNull() | (col(reference) == 0), "not_applicable").when(F.abs(difference) <= percent, "passed").otherwise("review_required")


def nested_counts(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """(outer, counts): a map from each inner value to its number of rows, in the order of the values."""
    per = df.groupBy(outer, inner).agg(F.count("*").alias("n"))
    return per.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(inner, "n")))).alias("counts"))
