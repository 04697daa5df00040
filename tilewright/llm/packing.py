"""Best-fit decreasing packing of token sequences.

Piece lengths are whole numbers up to `limit`, so the packing depends only on how many pieces
there are of each length. The plan is made from that histogram of at most `limit` rows: lengths
in falling order, each going into the tightest open bins that a segment tree over remaining
capacities finds. Bins of equal history are handled together, so the plan has as many rows as
there are different ways a bin is filled, whatever the number of documents. Spark then numbers
the pieces of each length and gives each its place by the plan.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, slices
from .tokens import encode, tokenizer_path


class CapacityTree:
    """Segment tree over remaining capacities 0..limit: how many open bins have each of them."""

    def __init__(self, limit: int):
        self.width = 1 << limit.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, capacity: int, bins: int) -> None:
        at = self.width + capacity
        while at:
            self.count[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of an open bin that is at least `least`."""
        at = self.width + least
        if self.count[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.width
            at >>= 1
        return None


@dataclass
class Run:
    """Pieces first .. first+pieces-1 of a length: `each` to a bin, from bin `bin` and offset `offset` on."""

    length: int
    first: int
    pieces: int
    each: int
    bin: int
    offset: int


def best_fit_plan(histogram: dict[int, int], limit: int) -> tuple[list[Run], int]:
    """Places for histogram[length] pieces of each length, and the number of bins.

    The same bins as best-fit decreasing piece by piece: equal pieces keep going into the same
    bin until it is no longer the tightest, so a group of g equal bins with room for q pieces
    each takes them q at a time.
    """
    tree, open_bins, runs, bins = CapacityTree(limit), {}, [], 0

    def put(capacity: int, first_bin: int, count: int) -> None:
        if capacity and count:
            open_bins.setdefault(capacity, []).append((first_bin, count))
            tree.add(capacity, count)

    for length in sorted(histogram, reverse=True):
        todo, first = histogram[length], 0
        while todo:
            room = tree.tightest(length)
            if room is None:
                each = limit // length
                full, part = divmod(todo, each)
                start, count, room = bins, full + (part > 0), limit
                bins += count
            else:
                start, count = open_bins[room].pop()
                tree.add(room, -count)
                each = room // length
                full = min(count, todo // each)
                part = todo % each if full < count and todo // each == full else 0
            if full:
                runs.append(Run(length, first, full * each, each, start, limit - room))
                put(room - each * length, start, full)
            if part:
                runs.append(Run(length, first + full * each, part, part, start + full, limit - room))
                put(room - part * length, start + full, 1)
            put(room, start + full + (part > 0), count - full - (part > 0))
            done = full * each + part
            first, todo = first + done, todo - done
    return runs, bins


def pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = 1024,
    end_id: int | None = 2,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, copy, piece, start, length, ids_crc32[, ids]) of every document, encoded whole with end_id after it.

    A document longer than limit is cut into pieces of limit tokens, of which the first may be
    shorter. A null text is empty, so such a document is its end_id only (none without one:
    then it has no pieces). copy tells rows of the same id and text apart.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, copy bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices([len(t or "") for t in texts], 8 << 20):
                row, piece, start, length, crc, parts = [], [], [], [], [], []
                for k, ids in enumerate(encode(path, [t or "" for t in texts[lo:hi]]), lo):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range(n % limit or limit, n, limit), n] if n else [0]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        part = ids[4 * a : 4 * b]
                        row.append(k)
                        piece.append(i)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(part))
                        parts.append(part)
                at = pa.array(row, pa.int64())
                out = [batch.column("id").take(at), batch.column("copy").take(at), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if keep_ids:
                    ends = pa.array(np.cumsum([0, *length]), pa.int32())
                    out.append(pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(parts), "<i4"))))
                yield pa.RecordBatch.from_arrays(out, ["id", "copy", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("copy"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


SHARE = 500_000


def best_fit(cut: DataFrame, limit: int = 1024) -> DataFrame:
    """cut (pieces with a length of 1..limit) with sequence_id and offset; cut is read twice and must be a written table.

    Pieces of one length are numbered within salted shares of that length, so that a length
    which very many pieces have is not numbered in one task; there are so many shares that one
    holds about SHARE pieces at most, and their sizes say where each one's numbers begin. Only
    the histogram of lengths (at most limit rows) comes to the driver, and only the plan goes
    back, whose size the limit bounds too.
    """
    spark = cut.sparkSession
    salts = max(64, cut.count() // SHARE)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("id", "copy", "piece"), F.lit(salts)).cast("int"))
    shares = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = shares.select("length", "salt", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("begin"))
    begins = materialize(begins, "shares")
    histogram = {r["length"]: r["n"] for r in begins.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = best_fit_plan(histogram, limit)
    plan = spark.createDataFrame(
        [(r.length, r.first, r.first + r.pieces, r.each, r.bin, r.offset) for r in runs],
        "length bigint, low bigint, high bigint, each bigint, bin bigint, fill bigint",
    )
    place = plan.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("low", "high", "each", "bin", "fill"))).alias("plan"))
    known = begins.select("length", "salt", "begin").join(F.broadcast(place), "length")
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "copy", "piece")) - 1
    ranked = salted.withColumn("within", number).join(known, ["length", "salt"])
    step = F.col("begin") + F.col("within")
    run = F.filter("plan", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"]))[0]
    done = ranked.withColumn("rank", step.cast("bigint")).withColumn("run", run).withColumn("i", F.col("rank") - F.col("run.low"))
    return done.select(
        *cut.columns,
        F.expr("run.bin + i div run.each").alias("sequence_id"),
        F.expr("run.fill + (i % run.each) * length").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, end_id: int | None = 2, keep_ids: bool = True, **columns) -> DataFrame:
    """Every document's pieces with their sequence_id and offset, in as few sequences as best-fit decreasing finds.

    Columns: id, copy, piece, start, length, ids_crc32, ids (unless keep_ids is False),
    sequence_id, offset. Within a sequence the pieces lie one after another from offset 0 and
    hold at most limit tokens; no piece of at most limit tokens is cut, and no token is lost.
    Null and empty texts hold the end_id only. Repeated rows are packed each. Extra columns are
    ignored. An empty table gives no rows.
    """
    cut = materialize(pieces(docs, tokenizer, limit, end_id, keep_ids, **columns), "pieces")
    return best_fit(cut, limit)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, at most limit of them, from pack() with its ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
