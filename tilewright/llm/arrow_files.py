"""Token ids as Arrow stream files of fixed-size lists.

A folder holds one stream file of sequences for each range of document ids, all of whose record
batches have ROWS sequences of equal length: `ids`, and `mask`, which is false on the filling
after the last document. As every batch takes equally many bytes, a sequence is found by
arithmetic, and a memory-mapped file gives it without a copy. A second stream file beside it
says where each document begins. A manifest (a Parquet table of one row a file) names the files
that count, in order.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, shared_dir, slices
from .tokens import encode, load, tokenizer_path

#: Sequences in a batch, and documents in a batch of their file.
ROWS, DOCS = 64, 4096
#: Bytes of text that a file takes, about.
FILE_BYTES = 32 << 20
ALIGNED = pa.ipc.IpcWriteOptions(use_legacy_format=False)


def id_type(vocabulary: int) -> pa.DataType:
    """Unsigned 16-bit where all ids fit, else 32-bit."""
    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


def sequence_schema(length: int, ids: pa.DataType, rows: int = ROWS) -> pa.Schema:
    """The schema of a file of sequences; its metadata says how many a batch holds."""
    return pa.schema([pa.field("ids", pa.list_(ids, length), False), pa.field("mask", pa.list_(pa.bool_(), length), False)], {b"rows": str(rows).encode()})


def document_schema(key: pa.DataType) -> pa.Schema:
    """The schema of a file of documents; start counts the ids of the file before the document."""
    return pa.schema([("doc_id", key), ("start", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Cuts a run of ids into sequences and writes full batches of them; holds one batch at most."""

    def __init__(self, sink, length: int, ids: pa.DataType, rows: int = ROWS):
        self.schema = sequence_schema(length, ids, rows)
        self.out = pa.ipc.new_stream(sink, self.schema, options=ALIGNED)
        self.buffer = np.zeros(length * rows, ids.to_pandas_dtype())
        self.used = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, len(self.buffer) - self.used)
            self.buffer[self.used : self.used + n] = ids[at : at + n]
            self.used, at = self.used + n, at + n
            if self.used == len(self.buffer):
                self._flush()
        self.total += len(ids)

    def _flush(self) -> None:
        self.buffer[self.used :] = 0
        mask = pa.array(np.arange(len(self.buffer)) < self.used)
        lists = [pa.FixedSizeListArray.from_arrays(v, type=f.type) for v, f in zip((pa.array(self.buffer), mask), self.schema)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.used = 0

    def close(self) -> None:
        if self.used:
            self._flush()
        self.out.close()


class SequenceFile:
    """Random access to the sequences of one file: a batch's place is head + number * size."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        self.schema = pa.ipc.read_schema(source)
        self.head = source.tell()
        self.rows = int(self.schema.metadata[b"rows"])
        self.length = self.schema.field("ids").type.list_size
        end = source.size()
        self.size, self.batches = 0, 0
        if pa.ipc.read_message(source) is not None if self.head < end - 8 else False:
            self.size = source.tell() - self.head
            self.batches = (end - self.head) // self.size  # what marks the end is shorter than a batch

    def batch(self, number: int) -> pa.RecordBatch:
        if not 0 <= number < self.batches:
            raise IndexError(number)
        self.source.seek(self.head + number * self.size)
        return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the file's own bytes, if it is mapped) and mask of a sequence."""
        batch = self.batch(number // self.rows)
        at = number % self.rows * self.length
        ids, mask = (batch.column(i).values.slice(at, self.length) for i in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def ids(self, start: int, n: int):
        """The ids start .. start+n-1 of the file's run, in views of a batch each."""
        per = self.rows * self.length
        while n > 0:
            values = self.batch(start // per).column(0).values.slice(start % per, n)
            yield values.to_numpy(zero_copy_only=True)
            start, n = start + len(values), n - len(values)


def opened(path: str):
    """A file of the shared folder for reading; mapped into memory where it is on a mounted disk."""
    system, place = fs.FileSystem.from_uri(path)
    return pa.memory_map(place) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(place)


@dataclass
class Written:
    """The folder and the manifest: file (number in order), sequences, documents (paths), n_docs, n_tokens."""

    folder: str
    manifest: DataFrame


def write(
    docs: DataFrame,
    tokenizer: str | None = None,
    length: int = 1024,
    end_id: int | None = 2,
    folder: str | None = None,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Written:
    """Encode whole texts, each with end_id after it, and write all ids in ascending order of id_col.

    Documents are dealt to files by ranges of their id, so file after file the ids form one run;
    what fills up a file's last batch is masked. Null ids come first; documents of one id are in
    the order of their texts' hashes, and a range may end among them, so one id with very many
    rows is split. Null and empty texts hold end_id only (nothing without one). Extra columns
    are ignored, an empty table gives no files. The texts are shuffled once and encoded once;
    their sizes are summed first (unless `files` is given), and the ranges come from a sample.

    A task writes files under names of its own in `folder` (the shared folder by default), which
    every executor must reach by its address, and only then hands out their names; names of
    attempts that were lost appear in no manifest.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    folder = folder or f"{shared_dir(spark)}/tilewright/ids-{uuid.uuid4().hex}"
    kind = id_type(max(load(path).get_vocab_size(), (end_id or 0) + 1))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if files is None:
        size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
        files = max(-(-size // FILE_BYTES), min(spark.sparkContext.defaultParallelism, -(-size // (1 << 20))), 1)
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("copy")]
    dealt = rows.withColumn("h", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(files, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("file"), "id", "text")
    end = np.array([] if end_id is None else [end_id], "<u4")

    def run(batches):
        sink = None
        for batch in batches:
            if not len(batch):
                continue
            if sink is None:
                system, place = fs.FileSystem.from_uri(folder)
                system.create_dir(place, recursive=True)
                file, name = batch.column("file")[0].as_py(), uuid.uuid4().hex
                names = [f"{what}-{file:07d}-{name}.arrows" for what in ("sequences", "documents")]
                outs = [system.open_output_stream(f"{place}/{n}") for n in names]
                sink, docs_schema = SequenceWriter(outs[0], length, kind), document_schema(batch.schema.field("id").type)
                listed, n_docs = pa.ipc.new_stream(outs[1], docs_schema), 0
            texts = batch.column("text").to_pylist()
            for lo, hi in slices([len(t) for t in texts], 8 << 20):
                for a in range(lo, hi, DOCS):
                    starts, sizes = [], []
                    for data in encode(path, texts[a : min(hi, a + DOCS)]):
                        ids = np.concatenate((np.frombuffer(data, "<u4"), end))
                        starts.append(sink.total)
                        sizes.append(len(ids))
                        sink.add(ids)
                    keys = batch.column("id").slice(a, len(sizes))
                    listed.write_batch(pa.RecordBatch.from_arrays([keys, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=docs_schema))
                    n_docs += len(sizes)
        if sink is not None:
            sink.close()
            listed.close()
            for out in outs:
                out.close()
            yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int32()), "sequences": [f"{folder}/{names[0]}"], "documents": [f"{folder}/{names[1]}"], "n_docs": [n_docs], "n_tokens": [sink.total]})

    made = dealt.mapInArrow(run, "file int, sequences string, documents string, n_docs bigint, n_tokens bigint")
    return Written(folder, materialize(made, "manifest"))


def read(written: Written, key: str = "bigint", keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files that the manifest names.

    start counts the ids of all documents before it, ids_crc32 is the checksum of its ids as
    little-endian unsigned 32-bit integers. One task reads one file, a batch at a time; key is
    the type of the documents' ids.
    """
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = written.manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).cast("bigint"))
    files = files.select("sequences", "documents", "before").repartition(max(1, written.manifest.count()), "sequences")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["sequences"]) as source, opened(row["documents"]) as listed:
                    sequences = SequenceFile(source)
                    for docs in pa.ipc.open_stream(listed):
                        crcs, ids = [], []
                        for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()):
                            crc, parts = 0, []
                            for view in sequences.ids(start, n):
                                wide = view.astype("<u4")
                                crc = zlib.crc32(wide, crc)
                                parts.append(wide.astype(np.int32)) if keep_ids else None
                            crcs.append(crc)
                            ids.append(np.concatenate(parts) if parts else [])
                        start = pa.compute.add(docs.column("start"), row["before"])
                        out = [docs.column("doc_id"), start, docs.column("n_tokens"), pa.array(crcs, pa.int64())]
                        if keep_ids:
                            out.append(pa.array(ids, pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids)

    return files.mapInArrow(run, f"doc_id {key}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids)
