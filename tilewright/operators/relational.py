"""Relations between tables: keys, duplicates, first rows, numbering, samples, equality and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of left that right lacks; null keys match null keys."""
    return left.select(*keys).subtract(right.select(*keys))


def roster_gaps(expected: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """(key, side): `missing` keys were expected and not received, `extra` ones the reverse."""
    a, b = expected.select(key).distinct(), received.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order, by one pre-aggregated minimum instead of a window sort."""
    rank = [F.struct(*[c if isinstance(c, Column) else F.col(c) for c in order]).alias("o"), F.struct(*df.columns).alias("r")]
    return df.groupBy(*keys).agg(F.min(F.struct(*rank)).alias("m")).select(*[F.col(f"m.r.{c}").alias(c) for c in df.columns])


def number_parts(df: DataFrame, source: str, order: list[str], prefix: str | None = None) -> DataFrame:
    """part_number 1, 2, ... within each source by a total order, and part_id `source:part-001` if prefix names that column."""
    w = Window.partitionBy(source).orderBy(*order)
    out = df.withColumn("part_number", F.row_number().over(w))
    return out.withColumn(prefix, F.format_string("%s:part-%03d", F.col(source).cast("string"), F.col("part_number"))) if prefix else out


def ends_per(df: DataFrame, keys: list[str], order: list[str], n: int = 2) -> DataFrame:
    """The first and the last n rows of each stratum by a total order."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumn("__up", F.row_number().over(w.orderBy(*[F.asc(c) for c in order]))).withColumn("__down", F.row_number().over(w.orderBy(*[F.desc(c) for c in order])))
    return ranked.where((F.col("__up") <= n) | (F.col("__down") <= n)).drop("__up", "__down")


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with their repetitions, that only one of two tables has; empty for equal tables."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def within_budget(df: DataFrame, most: int, what: str = "rows") -> DataFrame:
    """df, or an error if it has more than `most` rows; looks at most + 1 rows only."""
    if most <= 0:
        raise ValueError(f"budget of {what} must be a positive integer")
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} {what}; reduce the query's scope")
    return df


def conflicts(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """For each key the number of distinct non-null values of each field, and whether any exceeds one."""
    counts = df.groupBy(*keys).agg(*[F.countDistinct(f).alias(f"n_{f}") for f in fields])
    bad = F.greatest(*[F.col(f"n_{f}") for f in fields], F.lit(0)) > 1
    return counts.withColumn("conflict", bad)


def semantic_hash(df: DataFrame, key: str = "row_hash") -> DataFrame:
    """One row: the number of rows and a digest of their values that no order of rows changes.

    Row digests are added up as numbers, so no task sees more than one partition's sums.
    """
    digest = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.conv(F.substring(digest, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")
    sums = df.select(part(0).alias("a"), part(1).alias("b"), part(2).alias("c")).agg(F.count("*").alias("rows"), *[F.coalesce(F.sum(x), F.lit(0)).cast("decimal(38,0)").alias(x) for x in "abc"])
    return sums.select("rows", F.sha2(F.concat_ws(":", *[F.col(x).cast("string") for x in ("rows", "a", "b", "c")]), 256).alias(key))


def view(df: DataFrame, filters: dict) -> DataFrame:
    """Rows that equal every (field, value); an unknown field is an error."""
    absent = [f for f in filters if f not in df.columns]
    if absent:
        raise ValueError(f"layer has no field {absent}")
    for field, value in filters.items():
        df = df.where(F.col(field) == value)
    return df


def stack(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, columns aligned by name, absent ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def resolve(df: DataFrame, *names: str) -> Column:
    """The first of the names that df has, in any case of letters; null if it has none."""
    lookup = {c.casefold(): c for c in df.columns}
    found = next((lookup[n.casefold()] for n in names if n.casefold() in lookup), None)
    return F.lit(None).cast("string") if found is None else F.col(found)


def require(df: DataFrame, fields: list[str]) -> None:
    absent = sorted(set(f.casefold() for f in fields) - {c.casefold() for c in df.columns})
    if absent:
        raise ValueError(f"missing required fields: {absent}")


def classify(df: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """df with the lookup's columns (a dimension of one row per key); key values the lookup lacks are an error when rows are read."""
    marked = df.join(lookup.withColumn("__known", F.lit(True)), on, "left")
    checked = F.when(F.col("__known").isNull(), F.raise_error(F.concat_ws(" ", F.lit("unclassified value:"), *[F.col(c).cast("string") for c in on]))).otherwise(F.col(on[0]))
    return marked.withColumn(on[0], checked).drop("__known")


def coverage_matrix(sources: DataFrame, regions: DataFrame) -> DataFrame:
    """(collection, source, region, status) of every source (with its coverage, a map from region to status) and every region of a declared list; what a source doesn't state is unknown."""
    every = sources.crossJoin(F.broadcast(regions))  # regions: a declared list
    return every.select("collection", "source", "region", F.coalesce(F.element_at("coverage", F.col("region")), F.lit("unknown")).alias("status"))


def dissolve(df: DataFrame, key: str, wkb: str, order: list[str]) -> DataFrame:
    """One row per key: all parts of its geometries as one collection, and the other columns of its first row by an explicit order.

    Parts are gathered, not merged; equal geometries are one. A key's rows meet in one task, so keys are features.
    """
    from ..functions.kernels import collection_wkb

    shapes = df.groupBy(key).agg(F.collect_set(wkb).alias("__shapes")).withColumnRenamed(key, "__key")
    rest = first_per(df.drop(wkb), [key], order)
    return rest.join(shapes, F.col(key).eqNullSafe(F.col("__key"))).withColumn(wkb, collection_wkb(F.array_sort("__shapes"))).drop("__key", "__shapes")
