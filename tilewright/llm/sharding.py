"""Two-pass external shuffle into shards, in DataFrame functions only.

First pass: every record goes, by a seeded hash of itself, into one of so many buckets that a
bucket fits in memory. Second pass: a bucket's records are put into the order of their hashes
and shuffled by Fisher-Yates with draws from the seed and the bucket. The buckets one after
another are a random order of all records, which is cut into shards of equal row counts. The
order depends on the seed and the records alone, not on how the input is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import materialize

BUCKET_BYTES, BUCKET_ROWS = 8 << 20, 1024
#: What one task of the exchange takes.
TASK_BYTES = 64 << 20
GROUP = 4096


def _running(counts: DataFrame) -> DataFrame:
    """counts (bucket, n) -> (bucket, begin, total): rows before each bucket, in groups of GROUP buckets and then over the groups."""
    groups = counts.withColumn("group", F.expr(f"bucket div {GROUP}"))
    per = groups.groupBy("group").agg(F.sum("n").alias("m"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    per = per.select("group", F.coalesce(F.sum("m").over(before), zero).alias("earlier"), F.sum("m").over(everything).alias("total"))
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return groups.join(per, "group").select("bucket", (F.col("earlier") + F.coalesce(F.sum("n").over(inside), zero)).alias("begin"), "total")


def record_size(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint") + 1


def _comparable(field: T.StructField) -> Column:
    """A column as something that Spark can hash and group by: maps as JSON."""
    c = F.col(f"`{field.name}`")
    return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c


def _numbered(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """rows with __h and __copy (0, 1, ... among rows equal in every column).

    hashes has __h and its number of rows, n. Only rows whose hash repeats are compared: equal
    ones are counted before anything is shuffled and become rows again in blocks, so that no
    task sees a whole group however large.
    """
    if not hashes.where("n > 1").head(1):
        return rows.withColumn("__copy", F.lit(0).cast("bigint"))
    again = materialize(hashes.where("n > 1").select("__h"), "repeated")
    single = rows.join(again, "__h", "left_anti").withColumn("__copy", F.lit(0).cast("bigint"))
    own = [f for f in rows.schema if f.name != "__h"]
    keys = [_comparable(f).alias(f"__k{i}") for i, f in enumerate(own)]
    values = [F.first(f"`{f.name}`").alias(f.name) for f in own]
    groups = rows.join(again, "__h", "left_semi").groupBy("__h", *keys).agg(F.count("*").alias("__n"), *values)
    blocks = groups.withColumn("__block", F.explode(F.sequence(F.lit(0), F.expr(f"(__n - 1) div {GROUP}"))))
    blocks = blocks.repartition("__h", "__block")
    inside = F.sequence(F.expr(f"__block * {GROUP}"), F.expr(f"least(__n, (__block + 1) * {GROUP}) - 1"))
    many = blocks.select(*[f"`{f.name}`" for f in own], "__h", F.explode(inside).alias("__copy"))
    return single.select(*[f"`{f.name}`" for f in own], "__h", "__copy").unionByName(many)


def fisher_yates(size: Column, draw) -> Column:
    """The numbers 0 to size - 1 in shuffled order: number i changes places with the one at draw(i), which is from 0 to i.

    Each step copies the array, so this is for arrays of some thousand numbers.
    """

    def step(done: Column, i: Column) -> Column:
        j = draw(i)
        swapped = F.concat(F.slice(done, F.lit(1), j), F.array(i), F.slice(done, j + 2, i - j - 1), F.array(F.get(done, j)))
        return F.when(j == i, F.concat(done, F.array(i))).otherwise(swapped)

    numbers = F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(numbers, F.array(F.lit(0)), step)


def external_shuffle(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (0, 1, ... in each shard), in random order by the seed.

    The law is `rows`: shards differ by one row at most. All columns are kept, the texts travel
    with their rows through one exchange, and rows with null ids or texts are placed like any
    other. The bucket follows from the seed and all of a row's columns, so groups of equal texts
    or equal ids spread over the buckets; rows equal in every column get a number each, and it
    is the same whichever of them has which. The same rows and seed give the same result for any
    split of the input, any number of partitions and any task that runs again.

    A bucket holds about bucket_bytes or bucket_rows, whichever is less, plus at most its longest
    text; the exchange has a task for every TASK_BYTES. docs is read three times (hashes and sizes,
    rows in each bucket, the rows themselves) and must give the same rows each time. An empty table stays empty. Columns of docs named
    shard or slot are replaced.
    """
    rows = docs.drop("shard", "slot")
    names = [f"`{c}`" for c in rows.columns]
    keyed = rows.withColumn("__h", F.xxhash64(F.lit(seed).cast("bigint"), *[_comparable(f) for f in rows.schema]))
    hashes = keyed.groupBy("__h").agg(F.count("*").alias("n"), F.sum(record_size(text_col)).alias("bytes"))
    hashes = materialize(hashes, "hashes")
    total = hashes.agg(F.sum("n").alias("rows"), F.sum("bytes").alias("bytes")).first()
    n, size = total["rows"] or 0, total["bytes"] or 0
    buckets = max(1, -(-size // bucket_bytes), -(-n // bucket_rows))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-size // TASK_BYTES), min(buckets, width))

    numbered = _numbered(keyed, hashes).withColumn("__key", F.xxhash64(F.lit(seed).cast("bigint"), "__h", "__copy"))
    bucket = F.pmod("__key", F.lit(buckets)).alias("bucket")
    begins = _running(numbered.select(bucket).groupBy("bucket").agg(F.count("*").alias("n")))
    scattered = numbered.select(bucket, F.struct("__key", "__h", "__copy").alias("key"), F.struct(*names).alias("row")).repartition(tasks, "bucket")
    filled = scattered.groupBy("bucket").agg(F.collect_list(F.struct("key", "row")).alias("rows"))
    # array_sort by position, not by row: rows need no order of their own
    keys = F.transform("rows", lambda r, i: F.struct(r["key"].alias("key"), i.alias("i")))
    filled = filled.withColumn("order", F.transform(F.sort_array(keys), lambda k: k["i"]))
    draw = lambda i: F.pmod(F.xxhash64(F.lit(seed).cast("bigint"), F.col("bucket"), i), (i + 1).cast("bigint")).cast("int")
    mixed = filled.withColumn("mixed", fisher_yates(F.size("rows"), draw))
    placed = mixed.join(begins.hint("shuffle_hash"), "bucket")
    shuffled = F.transform("mixed", lambda m: F.get("rows", F.get("order", m))["row"])
    out = placed.select("begin", "total", F.posexplode(shuffled).alias("at", "row"))
    position = F.col("begin") + F.col("at")
    out = out.select(*[F.col("row").getField(c).alias(c) for c in rows.columns], F.col("total").alias("__total"), position.alias("__position"))
    out = out.withColumn("shard", F.expr(f"(__position * {shards}) div __total"))
    slot = F.col("__position") - F.expr(f"(shard * __total + {shards - 1}) div {shards}")
    return out.withColumn("slot", slot).select(*names, F.col("shard").cast("int").alias("shard"), "slot")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Parquet folders shard=0, shard=1, ... in slot order within each file."""
    shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
