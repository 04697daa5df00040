"""Near-duplicate documents by circulant MinHash.

Two permutations make the whole signature. The first (`_shuffled`) scatters the shingles over
the ring of 2**32 places; the second (`_ranked`) ranks the places. Coordinate k ranks every
shingle after shifting the ring by k places and keeps the least rank. Rows of coordinates make
bands; documents that share a band are candidates, and candidates are confirmed on their full
shingle sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialize, slices
from .graph import components

U64, U32 = np.uint64, np.uint32
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        steps = np.full(max(n, 1 << 20), base, U64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def words(text: str) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; bytes.split() and bytes.lower() are exactly that."""
    return text.encode().lower().split()


def shingle_set(tokens: list[bytes], size: int) -> set:
    """Distinct runs of `size` words; the whole sequence as one where there are fewer; none without words."""
    if len(tokens) < size:
        return {tuple(tokens)} if tokens else set()
    return set(zip(*(tokens[i:] for i in range(size))))


def _word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of text whose words are parted by single spaces or line feeds."""
    text = np.frombuffer(joined, np.uint8)
    gap = (text == 32) | (text == 10)
    inside = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(inside == -1), np.flatnonzero(inside == 1)
    total = np.zeros(len(text) + 1, U64)
    np.cumsum((text.astype(U64) + U64(1)) * _power("up", _BASE, len(text)), out=total[1:])
    return _mix64((total[ends] - total[starts]) * _power("down", _BASE_INVERSE, len(text) + 1)[starts] + (ends - starts).astype(U64)), starts


def shingle_hashes(normal: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (single spaces between its words)."""
    joined = b"\n".join(normal)
    hashes, starts = _word_hashes(joined)
    ends = np.cumsum([len(x) + 1 for x in normal])
    upto = np.searchsorted(starts, ends)
    mixed = hashes.copy()
    for i in range(1, size):
        upper = max(0, len(mixed) - i)
        mixed[:upper] = _mix64(mixed[:upper] * U64(3) + hashes[i:])
    out, begin = [], 0
    for end in upto.tolist():
        n = end - begin
        if n >= size:
            out.append(np.unique(mixed[begin : end - size + 1]))
        elif n:
            few = hashes[begin : begin + 1]
            for i in range(1, n):
                few = _mix64(few * U64(5) + hashes[begin + i])
            out.append(_mix64(few + U64(n)))
        else:
            out.append(np.zeros(0, U64))
        begin = end
    return out


def _shuffled(x: np.ndarray) -> np.ndarray:
    """The first permutation: 64-bit hashes to places of the ring."""
    return (x >> U64(32)).astype(U32) * U32(0x9E3779B1)


def _ranked(x: np.ndarray) -> np.ndarray:
    """The second permutation, in place: a bijection of 32-bit numbers."""
    x ^= x >> U32(16)
    x *= U32(0x85EBCA6B)
    x ^= x >> U32(13)
    x *= U32(0xC2B2AE35)
    x ^= x >> U32(16)
    return x


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """(documents, length) coordinates of non-empty shingle sets."""
    ring = _shuffled(np.concatenate(sets))
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), length), U32)
    moved = np.empty_like(ring)
    for k in range(length):
        np.add(ring, U32(k), out=moved)  # the ring wraps around by itself
        out[:, k] = np.minimum.reduceat(_ranked(moved), begins)
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit keys; a band's number is part of its key."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * _BASE, (len(coordinates), bands))
    parts = coordinates.reshape(len(coordinates), bands, rows).astype(U64)
    for i in range(rows):
        key = _mix64(key + parts[:, :, i] * U64(0x9FB21C651E98DF25) + U64(i))
    return key.view(np.int64)


def sketch(docs: DataFrame, shingle: int, bands: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n_shingles, node, bands): node is a digest of the word sequence, null without words."""

    def run(batches):
        for batch in batches:
            normal = [b" ".join(words(t or "")) for t in batch.column("text").to_pylist()]
            for lo, hi in slices([len(x) for x in normal], 1 << 20):
                sets = shingle_hashes(normal[lo:hi], shingle)
                full = np.array([len(s) > 0 for s in sets], bool)
                made = np.zeros((0, bands), np.int64)
                if full.any():
                    made = band_keys(signatures([s for s in sets if len(s)], bands * rows), bands, rows)
                ends = np.concatenate(([0], np.cumsum(np.where(full, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id")[lo:hi],
                        batch.column("text_hash")[lo:hi],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(x, digest_size=16).digest() if x else None for x in normal[lo:hi]], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel())),
                    ],
                    ["id", "text_hash", "n_shingles", "node", "bands"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows_in = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return rows_in.mapInArrow(run, f"id {kind}, text_hash bigint, n_shingles bigint, node binary, bands array<bigint>")


def _similar(x: set, y: set, percent: int) -> bool:
    both = len(x & y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets satisfy 100 * intersection >= percent * union."""

    def run(batches):
        hub, x = None, set()
        for batch in batches:
            kept = []
            for a, left, right in zip(*(batch.column(c).to_pylist() for c in ("a", "ta", "tb"))):
                if a != hub:  # the pairs of one hub often follow each other
                    hub, x = a, shingle_set(words(left), shingle)
                kept.append(_similar(x, shingle_set(words(right), shingle), percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    full = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"
    )
    return full.select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


#: Members of a bucket up to which its pairs are listed, and members and shingles of a block beyond.
FEW, BLOCK, BLOCK_SHINGLES = 16, 512, 200_000


def _few(members: DataFrame, fits: str, tried: DataFrame) -> DataFrame:
    """Pairs (a, b) of small buckets whose members are in different components and weren't compared yet."""
    left = members.select("bucket", F.col("node").alias("a"), F.col("n").alias("m"), F.col("c").alias("d"))
    pairs = left.join(members.select("bucket", F.col("node").alias("b"), "n", "c"), "bucket").where(f"a < b and c != d and {fits}")
    both_ways = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select("a", "b").distinct().join(both_ways, ["a", "b"], "left_anti")


def _many(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of large buckets that join different components, enough of them to join all that are linked.

    The members outside the bucket's main component are compared with all members, block by
    block; pairs are made and judged inside a task, and a task returns one link at most for
    each component it saw, so what comes out grows with the members, not with their pairs.
    """
    other = F.col("c") != F.col("main.c")
    blocks = lambda k, size: F.greatest(F.ceil(k / BLOCK), F.ceil(size / BLOCK_SHINGLES), F.lit(1)).cast("int")
    rest = blocks(F.col("members") - F.col("main.k"), F.col("size") - F.col("main.size"))
    every = blocks(F.col("members"), F.col("size"))
    sized = members.select("bucket", "node", "c", other.alias("other"), rest.alias("x"), every.alias("y"), F.xxhash64("node").alias("h"))
    sized = sized.join(texts, "node")
    turn = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod("h", F.col(n)).cast("int")
    left = sized.where("other").select("bucket", own("x").alias("i"), turn("y").alias("j"), "node", "c", "text")
    again = [F.col(c).alias(c) for c in ("bucket", "node", "c", "text")]  # new columns, to tell the sides apart
    right = sized.select(*again, turn("x").alias("i"), own("y").alias("j"))

    def run(xs: pa.Table, ys: pa.Table) -> pa.Table:
        x, y = ({c: t.column(c).to_pylist() for c in ("node", "c", "text")} for t in (xs, ys))
        found = linked(x["text"], x["c"], y["text"], y["c"], shingle, percent)
        return pa.table({k: pa.array([side["node"][p[i]] for p in found], pa.binary()) for i, (k, side) in enumerate((("a", x), ("b", y)))})

    return left.groupBy("bucket", "i", "j").cogroup(right.groupBy("bucket", "i", "j")).applyInArrow(run, "a binary, b binary")


def linked(x: list[str], x_part: list, y: list[str], y_part: list, shingle: int, percent: int) -> list[tuple[int, int]]:
    """Pairs of a text of x and one of y that are similar enough, each joining two parts that no earlier pair joined.

    Hashes find them; a pair joins its parts only if its full sets confirm it.
    """
    if not x or not y:
        return []
    normal = lambda texts: [b" ".join(words(t)) for t in texts]
    sets, against = shingle_hashes(normal(x), shingle), shingle_hashes(normal(y), shingle)
    size = np.array([len(s) for s in against])
    flat, owner = np.concatenate(against), np.repeat(np.arange(len(y)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    root = {p: p for p in {*x_part, *y_part}}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    found = []
    for i, own in enumerate(sets):
        lo, hi = np.searchsorted(flat, own), np.searchsorted(flat, own, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(y))
        for j in np.flatnonzero(100 * both >= percent * (len(own) + size - both)).tolist():
            a, b = find(x_part[i]), find(y_part[j])
            if a != b and _similar(shingle_set(words(x[i]), shingle), shingle_set(words(y[j]), shingle), percent):
                root[a] = b
                found.append((i, j))
    return found


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 36,
    rows: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of docs: id, text_hash, n_shingles, component_id, kept.

    Documents are linked if 100 * |A & B| >= percent * |A | B| over their shingle sets;
    component_id is the least id that can be reached over links. A pair at the least linked
    similarity s shares no band with probability (1 - s**rows)**bands: 6e-7 with the defaults.

    Equal word sequences are one node, so exact copies cost nothing beyond a count. In a bucket
    every member is first compared with the bucket's hub, the member that shares most buckets
    (in a group of near copies: the text they were made from); only members that are then still
    in different components are compared with each other: as listed pairs in buckets of up to
    FEW members, in blocks inside a task in larger ones. So what is shuffled stays in proportion
    to the members, and no link that could join two components is left out.

    Null, empty and wordless texts have no shingles, are linked with nothing and are kept. Rows
    with a null id take part; a component of null ids only has a null component_id, and kept is
    then false. Repeated rows share a component. Extra columns are ignored. An empty table gives
    an empty result.
    """
    seen = materialize(sketch(docs, shingle, bands, rows, id_col, text_col), "sketch")
    nodes = seen.where("node is not null").groupBy("node").agg(
        F.max("n_shingles").alias("n"), F.first("bands").alias("bands"), F.min(F.struct("id", "text_hash")).alias("rep")
    )
    entries = nodes.select("node", "n", "rep", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    entries = materialize(entries.join(shared, "bucket"), "entries")
    score = entries.groupBy("node").agg(F.sum("members").alias("score"))
    hubs = entries.join(score, "node").groupBy("bucket").agg(F.max(F.struct("score", "node", "n")).alias("hub"))
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    tried = (
        entries.join(hubs, "bucket")
        .select(F.col("hub.node").alias("a"), F.col("node").alias("b"), "n", F.col("hub.n").alias("m"))
        .where(f"a != b and {fits}")
        .select("a", "b")
        .distinct()
    )
    tried = materialize(tried, "tried")

    reps = entries.select("node", F.col("rep.id").alias("id"), F.col("rep.text_hash").alias("text_hash")).distinct()
    source = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    texts = source.join(reps, F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("text_hash"))).groupBy("node").agg(F.first("text").alias("text"))
    texts = materialize(texts, "texts")

    links = materialize(_confirm(tried, texts, shingle, percent), "links")
    found = materialize(components(links), "components")
    placed = entries.select("bucket", "node", "n").join(found, "node", "left").select("bucket", "node", "n", F.coalesce(F.col("component"), F.col("node")).alias("c"))
    shares = placed.groupBy("bucket", "c").agg(F.count("*").alias("k"), F.sum("n").alias("size"))
    shares = shares.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("k").alias("members"), F.sum("size").alias("size"), F.max(F.struct("k", "size", "c")).alias("main"))
    mixed = materialize(placed.join(shares.where("parts > 1"), "bucket"), "open")
    more = _few(mixed.where(f"members <= {FEW}"), fits, tried).unionByName(_many(mixed.where(f"members > {FEW}"), texts, shingle, percent))
    more = materialize(_confirm(more.distinct(), texts, shingle, percent), "links")
    found = materialize(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)), "components")

    # rows without words belong to no component, and would all meet on one key of the joins
    rows_in = seen.select("id", "text_hash", "n_shingles", "node")
    where = rows_in.where("node is not null").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = where.groupBy("component").agg(F.min("id").alias("component_id"))
    placed = where.join(least, "component").select("id", "text_hash", "n_shingles", "component_id", "component")
    alone = rows_in.where("node is null").select("id", "text_hash", "n_shingles", F.col("id").alias("component_id"), F.lit(None).cast("binary").alias("component"))
    first = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    placed = placed.withColumn("kept", first).unionByName(alone.withColumn("kept", F.lit(True)))
    return placed.select("id", "text_hash", "n_shingles", "component_id", "kept", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without near duplicates: of each component one row with the least id stays, with all its columns.

    Null, empty and wordless texts stay, as do their repetitions. A component whose ids are all
    null keeps one row too.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("best")
    chosen = found.where("component is not null").groupBy("component").agg(best).select(
        F.col("best.id").alias("__id"), F.col("best.text_hash").alias("__hash")
    )
    chosen = materialize(chosen, "chosen")
    marked = docs.withColumn("__own", F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash"))
    first = marked.join(chosen, same, "left_semi")
    repeated = found.where("component is not null").groupBy("id", "text_hash").count().where("count > 1")
    if not repeated.isEmpty():  # rows that repeat in id and text: only they are grouped by their text
        again = repeated.select(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
        twice = first.join(again, same, "left_semi").dropDuplicates([id_col, text_col])
        first = first.join(again, same, "left_anti").unionByName(twice)
    has_words = F.coalesce(F.col(text_col).rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return first.drop("__own").unionByName(docs.where(~has_words))
