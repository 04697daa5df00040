"""Rules that a table must keep, counted in one aggregation and raised on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.temporal import is_utc_timestamp
from ..functions.scalar import try_iso_date
from .metrics import STATES

#: Vocabularies of the canonical table (fixed values).
LEGAL_STATUS = (
    "reference_geometry",
    "derived_reference_geometry",
    "proposal_reference_geometry",
    "non_binding_physical_reference",
    "non_binding_cartographic_reference",
    "binding_designation_reference_geometry",
)
QC_STATUS = ("review_required", "support_only", "pass_with_limitations", "passed_with_legal_source_caveat", "passed")
COVERAGE_STATES = ("complete", "partial", "unknown", "unavailable", "not_applicable")
GEOMETRY_TYPES = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")


def count_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: the number of rows, and for each rule how many rows break it (null counts as broken)."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])


def require_valid(df: DataFrame, rules: dict[str, Column], sample: list[str]) -> DataFrame:
    """df, or an error that names the broken rules, their counts and up to five rows."""
    found = count_violations(df, rules).first().asDict()
    bad = {k: v for k, v in found.items() if k != "rows" and v}
    if bad:
        worst = next(iter(bad))
        rows = [r.asDict() for r in df.where(~F.coalesce(rules[worst], F.lit(False))).select(*sample).limit(5).collect()]
        raise ValueError(f"broken rules {bad}; for {worst}, for example {rows}")
    return df


def text(name: str) -> Column:
    return F.trim(F.col(name)) != ""


def finite_or_null(name: str) -> Column:
    c = F.col(name).cast("double")
    return c.isNull() | (~F.isnan(c) & (F.abs(c) != float("inf")))


def canonical_rules(df: DataFrame) -> dict[str, Column]:
    """Rules of the canonical feature table, without uniqueness of parts (see duplicate_keys)."""
    c = F.col
    rules = {f"text_{n}": text(n) for n in ("feature_id", "source_id", "record_id", "part_id", "feature_type", "measurement_status", "coverage_status", "legal_status")}
    rules |= {
        "legal_status": c("legal_status").isin(*LEGAL_STATUS),
        "qc_status": c("qc_status").isNull() | c("qc_status").isin(*QC_STATUS),
        "coverage_status": F.greatest(*[((c("coverage_status") == s) | c("coverage_status").startswith(s + "_")) for s in COVERAGE_STATES]),
        "model_eligible": c("model_eligible") == False,  # noqa: E712
        "clipped": c("clipped").isNotNull(),
        "geometry_type": c("geometry_type").isin(*GEOMETRY_TYPES),
        "retained_fraction": c("retained_fraction").isNull() | c("retained_fraction").between(0, 1),
        "interval": (c("effective_start").isNull() | c("effective_end").isNull()) | (c("effective_start") <= c("effective_end")),
        "learned_at": c("learned_at").isNull() | is_utc_timestamp("learned_at"),
        "bounds": c("min_x").between(-180, 180) & c("max_x").between(-180, 180) & c("min_y").between(-90, 90) & c("max_y").between(-90, 90),
    }
    rules |= {f"date_{n}": c(n).isNull() | F.coalesce(try_iso_date(n) == c(n), F.lit(False)) for n in ("effective_start", "effective_end")}
    return {k: v for k, v in rules.items()}


def metric_rules(value: str, status: str, units: str) -> dict[str, Column]:
    """Rules of one metric and its state: vocabulary, presence, and range by units (`1`, `m` or `count`)."""
    if units not in ("1", "m", "count"):
        raise ValueError(f"unsupported units {units}")
    v, s = F.col(value), F.col(status)
    high = v <= 1 if units == "1" else F.lit(True)
    return {
        f"{value}_state": s.isin(*STATES),
        f"{value}_observed": ~((s == "observed") & v.isNull()),
        f"{value}_missing": ~(s.isin("unknown", "unavailable", "not_applicable") & v.isNotNull()),
        f"{value}_range": v.isNull() | ((v >= 0) & high & finite_or_null(value)),
    }


def grid_rules() -> dict[str, Column]:
    c = F.col
    return {
        "id": text("cell_id"),
        "box": (c("min_x") < c("max_x")) & (c("min_y") < c("max_y")),
        "finite": finite_or_null("min_x") & finite_or_null("max_x") & finite_or_null("min_y") & finite_or_null("max_y") & c("min_x").isNotNull(),
    }


def grain(df: DataFrame, cell: str, date: str | None = None) -> DataFrame:
    """One row: rows, repeated keys and null dates of a static (cell) or dynamic (cell, date) table."""
    keys = [cell] + ([date] if date else [])
    repeated = df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("repeated_keys"))
    nulls = F.count_if(F.col(date).isNull()) if date else F.lit(0).cast("bigint")
    return df.agg(F.count("*").alias("rows"), nulls.alias("null_dates")).join(repeated)


def monotone(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, monotone): whether value rises strictly along a total order within each key."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    steps = df.select(*keys, F.col(value).alias("__v"), before.alias("__before"))
    return steps.groupBy(*keys).agg(F.bool_and(F.col("__before").isNull() | (F.col("__v") > F.col("__before"))).alias("monotone"))
