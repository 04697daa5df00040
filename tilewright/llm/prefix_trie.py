"""The trie of all prefixes of conversations, by prefix doubling.

Turns get dense numbers as names. Blocks of 2, 4, 8, ... turns that start at multiples of their
size are named by the pair of names of their halves, so every round doubles the length with one
grouping and one join. A prefix of any length is a row of such blocks, largest first (the binary
digits of its length), and is named by the prefix before its last block and that block, in as
many rounds as a length has ones. Equal names of one length mean equal prefixes: those are the
nodes. Work and rows are in proportion to the turns in each round, however long a conversation
and however common a prefix is.

A node is told by its smallest member and its depth. Members grow fewer with depth, so the nodes
that one conversation stands for are the lower end of its path. The sum over a subtree is
therefore the sum of what its members stand for, less what its own conversation stands for above
it, and no walk over levels is needed.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

#: Turns of a block of running sums, repetitions in one array, conversations in a chunk of a list (a power of two).
BLOCK, COPIES, CHUNK = 1024, 4096, 4096
#: Buckets in which names are numbered; a name that has more than 1 / COMMON of all rows is joined by broadcast.
BUCKETS, COMMON = 256, 1000


def _before(df: DataFrame, key: str, at: str, value: str, out: str, order: list) -> DataFrame:
    """df with the sum of value over the rows of a key that come earlier, where at is a number that order begins with.

    Sums run within blocks of at and then over blocks. df is read twice and must be a written table.
    """
    blocks = df.withColumn("__b", F.expr(f"{at} div {BLOCK}"))
    earlier = Window.partitionBy(key).orderBy(F.col("__b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    per = blocks.groupBy(key, "__b").agg(F.sum(value).alias("__s"))
    per = per.select(F.col(key).alias("__k"), F.col("__b").alias("__c"), F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__e"))
    inside = Window.partitionBy(key, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = blocks.withColumn("__w", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = within.join(per, (F.col(key) == F.col("__k")) & F.col("__b").eqNullSafe(F.col("__c")))
    return joined.withColumn(out, (F.col("__e") + F.col("__w")).cast("bigint")).select(*df.columns, out)


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, words): the turns of each conversation from 0 on, as a written table.

    Turns are in order of their number, null first; those of one number by role and by the
    digest of their text. A null role or text is empty. digest is SHA-256 of role and text,
    words counts `[^\\x20\\x09-\\x0D]+` of the text. Rows without a conversation take no part.
    Equal turns meet as a count; different turns of one number in one conversation share a window.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    t = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"),
        role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))).cast("bigint").alias("words"),
    )
    t = materialize(t.groupBy("conv", "turn", "role", "digest", "words").agg(F.count("*").alias("copies")), "turns")
    t = _before(t, "conv", "turn", "copies", "pos", [F.col("turn").asc_nulls_first(), "role", "digest"])
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES).cast("bigint")))
    t = t.withColumn("first", first).withColumn("copy", F.explode(F.expr(f"sequence(first, least(first + {COPIES}, copies) - 1)")))
    return materialize(t.select("conv", (F.col("pos") + F.col("copy")).alias("pos"), "digest", "words"), "numbered")


def with_family_heads(numbered: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the beginning of their family's first: (turns as numbered_turns gives them, (conv, len)).

    Of conversation c the first h turns give way to the first h of conversation c - c % family
    (all if it has fewer, none if it is absent), with h = crc32(c in decimal) % heads.
    """
    c = F.col("conv")
    sizes = numbered.groupBy("conv").agg((F.max("pos") + 1).alias("own"))
    sizes = sizes.withColumn("h", (F.crc32(c.cast("string").cast("binary")) % heads).cast("bigint")).withColumn("base", c - c % family)
    based = sizes.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    plan = sizes.join(based, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0).cast("bigint"))))
    plan = materialize(plan.select("conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("len")), "rebuilt")
    kept = numbered.join(plan, "conv").where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words", "len")
    given = numbered.where(f"pos < {heads} and conv % {family} = 0").withColumnRenamed("conv", "base")
    given = given.join(plan, "base").where("pos < taken").select("conv", "pos", "digest", "words", "len")
    return materialize(kept.unionByName(given), "rebuilt-turns"), plan.select("conv", "len")


def _named(rows: DataFrame, keys: list[str], starts: Column, label: str) -> DataFrame:
    """rows, a written table, with a dense name for their keys instead of them, and rep and n: the smallest conversation and the number of rows with this name where starts holds.

    Names are numbered in buckets one after another, whose sizes (BUCKETS numbers) come to the
    driver. Names with more than 1 / COMMON of all rows, which are at most COMMON, are joined by
    broadcast, so none gathers its rows in one task; all others by a shuffle.
    """
    found = rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.min(F.when(starts, F.col("conv"))).alias("rep"), F.count_if(starts).alias("n"))
    found = found.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
    found = materialize(found.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(*keys))), f"{label}-names")
    sizes = {r["bucket"]: (r["names"], r["rows"]) for r in found.groupBy("bucket").agg(F.count("*").alias("names"), F.sum("rows").alias("rows")).collect()}
    offsets, total = [], 0
    for b in range(BUCKETS):
        offsets.append(total)
        total += sizes.get(b, (0, 0))[0]
    every = sum(n for _, n in sizes.values())
    named = found.withColumn("name", F.col("place") - 1 + F.element_at(F.array(*[F.lit(x).cast("bigint") for x in offsets]), F.col("bucket") + 1))
    named = named.select(*keys, "name", "rep", "n", (F.col("rows") * COMMON > every).alias("common"))
    own = [c for c in rows.columns if c not in keys]
    hit = rows.join(F.broadcast(named.where("common")), keys, "left")
    rest = hit.where("name is null").select(*rows.columns).join(named.where("not common").drop("common"), keys)
    out = hit.where("name is not null").select(*own, "name", "rep", "n").unionByName(rest.select(*own, "name", "rep", "n"))
    return materialize(out, label)


def prefixes(turns: DataFrame, most: int) -> DataFrame | None:
    """(conv, d, rep, n, words, len): every prefix of d >= 1 turns of every conversation, with its node's smallest member and number of members.

    turns: conv, pos, digest, words, len, a written table; most: the longest length. words are
    those of the prefix's last turn. None if there are no turns.
    """
    if most < 1:
        return None
    level = _named(turns.withColumnRenamed("pos", "k"), ["digest"], F.col("k") == 0, "level-0")
    levels = [level]
    while 2 << (len(levels) - 1) <= most:
        even = F.col("k") % 2 == 0
        pairs = level.groupBy("conv", F.expr("k div 2").alias("k")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b"), F.max(F.when(~even, F.col("words"))).alias("words"), F.max("len").alias("len")
        )
        pairs = materialize(pairs.where("a is not null and b is not null"), "pairs")
        level = _named(pairs, ["a", "b"], F.col("k") == 0, f"level-{len(levels)}")
        levels.append(level)
    columns = ["conv", "d", "name", "rep", "n", "words", "len"]
    current = reduce(DataFrame.unionByName, [x.where("k = 0").withColumn("d", F.lit(1 << j).cast("bigint")).select(*columns) for j, x in enumerate(levels)])
    found, ones = [current], 1
    while (2 << ones) - 1 <= most:
        later = [
            x.where((F.col("k") > 0) & (F.col("k") % 2 == 0) & (F.bit_count("k") == ones)).select("conv", F.expr(f"shiftleft(k, {j})").alias("d"), F.lit(1 << j).alias("more"), F.col("name").alias("b"), "words", "len")
            for j, x in enumerate(levels)
        ]
        joined = reduce(DataFrame.unionByName, later).join(current.select("conv", "d", F.col("name").alias("a")), ["conv", "d"])
        joined = materialize(joined.select("conv", (F.col("d") + F.col("more")).alias("d"), (F.col("d") + F.col("more")).alias("depth"), "a", "b", "words", "len"), "prefixes")
        current = _named(joined, ["depth", "a", "b"], F.lit(True), f"ones-{ones + 1}").select(*columns)
        found.append(current)
        ones += 1
    return reduce(DataFrame.unionByName, found).drop("name")


def _list_hashes(ends: DataFrame) -> DataFrame:
    """(rep, d, ends_sha256) of ends (rep, d, conv): SHA-256 of the conversations in decimal, ascending and joined by commas.

    They go in chunks of CHUNK neighbouring numbers; a task reads a node's chunks in order and keeps
    the hash alone, so a list of any length takes no memory.
    """
    chunk = ends.groupBy("rep", "d", F.shiftright("conv", CHUNK.bit_length() - 1).alias("chunk")).agg(F.sort_array(F.collect_list("conv")).alias("convs"))
    chunk = chunk.select("rep", "d", "chunk", F.array_join("convs", ",").alias("text")).repartition("rep", "d").sortWithinPartitions("rep", "d", "chunk")

    def run(batches):
        at, running = None, None
        for batch in batches:
            done = []
            for rep, d, text in zip(*(batch.column(c).to_pylist() for c in ("rep", "d", "text"))):
                if (rep, d) != at:
                    if at is not None:
                        done.append((*at, running.hexdigest()))
                    at, running = (rep, d), hashlib.sha256()
                else:
                    running.update(b",")
                running.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["rep", "d", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, running.hexdigest())], ["rep", "d", "ends_sha256"])

    return chunk.mapInArrow(run, "rep bigint, d bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv, pos (0 to len - 1), digest, words, len; sizes: conv, len of every conversation,
    turnless ones included; both written tables. A node is a different sequence of the first
    depth turns (role and text), from the root, depth 0, whose parent is null. n_leaves counts
    the childless nodes of its subtree, saved_tokens adds (n_convs - 1) * words of the last turn
    over the subtree (it and the root included), ends_sha256 is of the conversations that end
    there. No conversations give no nodes.
    """
    whole = sizes.agg(F.count("*").alias("n"), F.min("conv").alias("rep"), F.max("len").alias("most")).first()
    if not whole["n"]:
        none = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
        return sizes.sparkSession.createDataFrame([], none)
    long = lambda x: F.lit(x).cast("bigint")
    every = sizes.select("conv", long(0).alias("d"), long(whole["rep"]).alias("rep"), long(whole["n"]).alias("n"), long(0).alias("words"), "len")
    found = prefixes(turns, whole["most"])
    every = materialize(every if found is None else every.unionByName(found), "every")
    ending = every.where("d = len")
    value = (F.col("n") - 1) * F.col("words")
    nodes = materialize(every.where("conv = rep").withColumn("value", value), "nodes")
    nodes = materialize(_before(nodes, "conv", "d", "value", "above", ["d"]), "chains")
    parents = every.select("conv", (F.col("d") + 1).alias("d"), F.col("rep").alias("parent"))
    nodes = materialize(nodes.join(parents, ["conv", "d"], "left"), "parents")
    # a leaf is the last node of the conversation that it is told by, and all its members end there
    ends = ending.groupBy("rep", "d").agg(F.count("*").alias("ends"))
    leaves = nodes.join(ends.withColumnRenamed("rep", "conv"), ["conv", "d"]).where("n = ends").select("conv", long(1).alias("leaf"), long(0).alias("value"))
    standing = nodes.select("conv", long(0).alias("leaf"), "value").unionByName(leaves).groupBy("conv").agg(F.sum("leaf").alias("leaf"), F.sum("value").alias("value"))
    members = every.select("conv", "rep", "d").join(standing, "conv").select("rep", "d", "value", F.col("leaf").alias("leaves"))
    own = nodes.select(F.col("conv").alias("rep"), "d", (-F.col("above")).alias("value"), F.col("n").alias("n_convs"), "parent")
    children = nodes.where("parent is not null").select(F.col("parent").alias("rep"), (F.col("d") - 1).alias("d"), long(1).alias("children"))
    parts = [members, own, children, _list_hashes(ending.select("rep", "d", "conv"))]
    told = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).groupBy("rep", "d")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    told = told.agg(
        F.max("parent").alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        zero("children").alias("n_children"),
        zero("leaves").alias("n_leaves"),
        zero("value").alias("saved_tokens"),
        F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
    return told.select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_of(turns: DataFrame, **columns) -> DataFrame:
    """The trie of conversations as they are (see prefix_trie and numbered_turns)."""
    numbered = numbered_turns(turns, **columns)
    sizes = materialize(numbered.groupBy("conv").agg((F.max("pos") + 1).alias("len")), "sizes")
    return prefix_trie(materialize(numbered.join(sizes, "conv"), "turns"), sizes)
