"""Normalizing provider frames into the canonical feature table, by declarations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import scalar as S
from ..functions.geometry import family
from ..functions.temporal import learned_at
from ..operators.relational import duplicate_keys, require, resolve


@dataclass(frozen=True)
class Source:
    """One upstream dataset's contract."""

    source_id: str
    provider: str | None = None
    url: str | None = None
    citation: str | None = None
    limitation: str | None = None
    as_of: str | None = None
    retrieved_at: str | None = None
    coverage: dict[str, str] = field(default_factory=dict)


def base_record(
    df: DataFrame,
    source: Source,
    *,
    record_id: Column,
    feature_id: Column,
    feature_type: Column,
    feature_name: Column | None = None,
    authority: Column | None = None,
    jurisdiction: Column | None = None,
    legal_authority: Column | None = None,
    legal_url: Column | None = None,
    coverage_status: str = "partial",
    receipts: str | None = None,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """The canonical fields of every row in one projection, with the source's defaults, and then extra columns.

    Authority falls back to the provider, legal authority to the citation, the url to the
    source's. receipts names a column with a record's own receipt time, which goes before the
    source's.
    """
    none = F.lit(None).cast("string")
    said = lambda c: none if c is None else S.clean(c)
    return df.select(
        S.clean(feature_id).alias("feature_id"),
        F.lit(source.source_id).alias("source_id"),
        S.clean(record_id).alias("record_id"),
        said(feature_name).alias("feature_name"),
        S.clean(feature_type).alias("feature_type"),
        F.coalesce(said(authority), F.lit(source.provider)).alias("authority"),
        said(jurisdiction).alias("jurisdiction"),
        F.lit("reference_geometry").alias("legal_status"),
        F.coalesce(said(legal_authority), F.lit(source.citation)).alias("legal_authority"),
        F.coalesce(said(legal_url), F.lit(source.url)).alias("legal_url"),
        none.alias("effective_start"),
        none.alias("effective_end"),
        (learned_at(receipts, F.lit(source.retrieved_at)) if receipts else F.lit(source.retrieved_at)).cast("string").alias("learned_at"),
        F.lit(source.as_of).cast("string").alias("source_vintage"),
        F.lit(coverage_status).alias("coverage_status"),
        F.lit("observed").alias("measurement_status"),
        F.lit(False).alias("model_eligible"),
        F.lit("review_required").alias("qc_status"),
        F.lit(source.limitation).cast("string").alias("qc_reason"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def passthrough(df: DataFrame, prefix: str, skip: tuple[str, ...] = ()) -> list[Column]:
    """Every provider column as cleaned text under a prefix."""
    return [S.clean(c).alias(prefix + c.upper()) for c in df.columns if c not in skip]


#: Identities that providers declare as whole numbers (fixed values).
INTEGER_FIELDS = ("OBJECTID", "STAT_AREA")
Value = Callable[[DataFrame], Column] | str | float | bool | None


@dataclass(frozen=True)
class Layer:
    """How one provider's layer becomes features: fields by alias, a filter, a type lookup and an identity rule.

    Names are resolved in any case of letters. keep is applied before identities are checked.
    types maps raw types of type_field to canonical ones; a raw type it lacks is an error, one
    that maps to None is left out. The canonical type is the feature's type, or the field
    role_field where that is named. identity is the record's id and must not be null where rows
    are kept; feature_id, a function of the frame, is the feature's, else it is the record's.
    Where otherwise names fields, these stand in for a null identity, and last the geometry's
    digest. vintage, qc_status and qc_reason go before the source's own where they are not null.
    rules are conditions that every kept row must meet. families is the geometry family that
    all features, or those of a role, must have (checked where the frame has `kind`). fields are
    further columns, constants or functions of the frame.
    """

    name: str
    identity: tuple[str, ...]
    prefix: str
    feature_type: str | None = None
    type_field: str | None = None
    types: dict[str, str | None] | None = None
    role_field: str | None = None
    title: tuple[str, ...] = ()
    feature_name: Value = None
    authority: tuple[str, ...] | str = ()
    jurisdiction: Value = None
    legal_authority: Value = None
    legal_url: Value = None
    legal: bool = True
    legal_status: str = "reference_geometry"
    coverage: str = "partial"
    keep: Callable[[DataFrame], Column] | None = None
    rules: dict[str, Callable[[DataFrame], Column]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    feature: tuple[str, ...] = ()
    feature_id: Callable[[DataFrame], Column] | None = None
    families: str | dict[str, str] | None = None
    fields: dict[str, Value] = field(default_factory=dict)
    geometry: tuple[str, ...] = ("kind", "wkb", "min_x", "min_y", "max_x", "max_y")
    started: tuple[str, ...] = ()
    dates: Callable[[Column], Column] = S.try_iso_date
    otherwise: tuple[str, ...] = ()
    vintage: Value = None
    qc_status: Value = None
    qc_reason: Value = None


def text(*names: str) -> Callable[[DataFrame], Column]:
    """The first of the fields whose cleaned value is not null."""
    return lambda df: F.coalesce(*[S.clean(resolve(df, n)) for n in names])


def identity_of(*names: str) -> Callable[[DataFrame], Column]:
    """The first of the fields that is not null, else the geometry's digest."""

    def of(df: DataFrame) -> Column:
        digest = [F.concat(F.lit("geometry-"), F.substring(F.sha2("wkb", 256), 1, 16))] if "wkb" in df.columns else []
        return F.coalesce(text(*names)(df), *digest)

    return of


def date_of(name: str) -> Callable[[DataFrame], Column]:
    """A field as `YYYY-MM-DD` by its declared type: numbers are milliseconds, dates and times are dates, text is ISO."""

    def of(df: DataFrame) -> Column:
        found = next((f for f in df.schema if f.name.casefold() == name.casefold()), None)
        if found is None:
            return F.lit(None).cast("string")
        if isinstance(found.dataType, T.NumericType):
            return S.epoch_ms_date(f"`{found.name}`")
        if isinstance(found.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.date_format(f"`{found.name}`", "yyyy-MM-dd")
        return S.iso_date(S.clean(f"`{found.name}`"))

    return of


def number(*names: str) -> Callable[[DataFrame], Column]:
    return lambda df: F.coalesce(*[S.number(resolve(df, n)) for n in names])


def _value(df: DataFrame, v: Value) -> Column:
    return v(df) if callable(v) else F.lit(v).cast("string") if v is None or isinstance(v, str) else F.lit(v)


def _checked(column: Column, ok: Column, message: str, shown: Column) -> Column:
    """column, and an error where ok doesn't hold."""
    return F.when(F.coalesce(ok, F.lit(False)), column).otherwise(F.raise_error(F.concat(F.lit(message), F.coalesce(shown.cast("string"), F.lit("null")))).cast("string"))


def normalize(df: DataFrame, layer: Layer, source: Source) -> DataFrame:
    """A provider frame as canonical features with the provider's own columns under the layer's prefix.

    Raises at once for missing fields, and when rows are read for null identities, unknown
    types, broken rules and other geometry families. Geometry columns pass through. Repeated
    identities are found by `repeated`, which needs a shuffle and is left to the build.
    """
    named = () if layer.otherwise else layer.identity
    require(df, [*layer.required, *named, *([layer.type_field] if layer.type_field else [])])
    for f in df.schema:
        if f.name.upper() in INTEGER_FIELDS and f.name.casefold() in {n.casefold() for n in (*layer.identity, *layer.required)}:
            if not isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)):
                raise ValueError(f"{layer.name}: {f.name} is {f.dataType.simpleString()}, not a whole number")
    if layer.keep is not None:
        df = df.where(layer.keep(df))
    kind = F.lit(layer.feature_type)
    raw = S.clean(resolve(df, layer.type_field)) if layer.type_field else F.lit(None).cast("string")
    extra: dict[str, Column] = {}
    if layer.types is not None:
        known = F.coalesce(*[F.when(raw == k, F.lit(v if v is not None else "\0")) for k, v in layer.types.items()])
        mapped = F.when(known.isNull(), F.raise_error(F.concat(F.lit(f"{layer.name}: unknown type "), F.coalesce(raw, F.lit("null"))))).otherwise(known)
        df = df.withColumn("__kind", mapped).where("__kind <> '\\0'")
        if layer.role_field:
            extra[layer.role_field] = F.col("__kind")
        else:
            kind = F.col("__kind")
    key = F.concat_ws("/", *[S.clean(resolve(df, c)) for c in layer.identity])
    absent = F.greatest(F.lit(False), *[S.clean(resolve(df, c)).isNull() for c in layer.identity])
    if layer.otherwise:
        key = identity_of(*layer.identity, *layer.otherwise)(df)
        absent = key.isNull()
    record = F.when(absent, F.raise_error(F.lit(f"{layer.name}: record without identity"))).otherwise(key)
    for name, rule in layer.rules.items():
        record = _checked(record, rule(df), f"{layer.name}: {name}: ", key)
    if layer.families and "kind" in df.columns:
        wanted = layer.families if isinstance(layer.families, str) else None
        wanted = F.lit(wanted) if wanted else F.coalesce(*[F.when(F.col("__kind") == k, F.lit(v)) for k, v in layer.families.items()])
        record = _checked(record, family("kind") == wanted, f"{layer.name}: geometry of another family: ", F.col("kind"))
    feature = F.coalesce(*[S.clean(resolve(df, c)) for c in layer.feature], key) if layer.feature else key
    pick = lambda names: F.coalesce(*[S.clean(resolve(df, n)) for n in names]) if names else None
    own = {c: df[c] for c in layer.geometry if c in df.columns}
    skip = (*layer.geometry, "__kind", "received_at")
    extra = own | {layer.prefix + c.upper(): S.clean(c) for c in df.columns if c not in skip} | extra
    extra |= {name: _value(df, v) for name, v in layer.fields.items()}
    made_id = layer.feature_id(df) if layer.feature_id else F.concat(F.lit(source.source_id + ":"), feature)
    optional = lambda v: None if v is None else _value(df, v)
    own_fields = {"source_vintage": layer.vintage, "qc_status": layer.qc_status, "qc_reason": layer.qc_reason}
    own_fields = {name: v for name, v in own_fields.items() if v is not None}
    extra |= {"__" + name: _value(df, v).cast("string") for name, v in own_fields.items()}
    out = base_record(
        df,
        source,
        record_id=record,
        feature_id=made_id,
        feature_type=kind,
        feature_name=optional(layer.feature_name) if layer.feature_name is not None else pick(layer.title),
        authority=F.lit(layer.authority) if isinstance(layer.authority, str) else pick(layer.authority),
        jurisdiction=optional(layer.jurisdiction),
        legal_authority=optional(layer.legal_authority),
        legal_url=optional(layer.legal_url),
        coverage_status=layer.coverage,
        receipts="received_at" if "received_at" in df.columns else None,
        extra=extra | ({"__start": layer.dates(resolve(df, *layer.started))} if layer.started else {}),
    )
    out = out.withColumn("legal_status", F.lit(layer.legal_status))
    for name in own_fields:
        out = out.withColumn(name, F.coalesce(F.col("__" + name), F.col(name))).drop("__" + name)
    if not layer.legal:
        none = F.lit(None).cast("string")
        out = out.withColumns({"legal_authority": none, "legal_url": none})
    return out.withColumn("effective_start", F.col("__start")).drop("__start") if layer.started else out


def repeated(features: DataFrame) -> DataFrame:
    """Record ids that occur more than once within a source, with how often; a layer may have none."""
    return duplicate_keys(features, ["source_id", "record_id"])
