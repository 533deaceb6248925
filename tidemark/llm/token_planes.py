"""Token ids in binary files of compressed bit or byte planes.

``write`` ranges documents by id over shards.  A shard's task encodes its documents in order
(the public library, each distinct unit once, see ``units``), appends the end id and streams
the ids to one file:

    magic | planes of chunk 0 | planes of chunk 1 | ... | footer | footer length | magic

A chunk is a block of a fixed number of ids (the last one is shorter).  Its ids are
transposed: byte plane k holds byte k of every id (bit plane k: bit k, eight ids a byte), and
each plane is compressed with zstandard on its own; a plane of zeros takes no room.  The
footer is an Arrow stream of the documents (key, ids) and one of the chunk index (place of
each plane), so ``read_ids`` fetches any range of ids from the chunks that hold it.

Which files belong to the table is recorded by Spark's own commit: tasks return a row per
shard, and those rows, written as Parquet beside the files, are the shard index.  A lost or
repeated task leaves at most a file that the index does not name; ``write`` removes those.

Defined cases: a null text is empty and has the end id alone; documents are ordered by id
(null ids last), rows of one id by a hash of their text, equal rows in any order; an empty
table has no shards and reads back as no rows; a text longer than a block is encoded on its
own; columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from contextlib import closing

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from . import textkit as tk
from . import units

MAGIC = b"TIDPLAN1"
CHUNK_IDS = 1 << 16
LEVEL = 3
INDEX = ("shard int, file string, n_docs long, n_ids long, n_bytes long")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of a path or URI, for drivers and executors alike."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# --- planes --------------------------------------------------------------------

def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The 4 byte planes or 32 bit planes of ids; a plane of zeros is empty."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "byte":
        planes = np.ascontiguousarray(octets)
    else:
        bits = np.unpackbits(octets[:, :, None], axis=2, bitorder="little")
        planes = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1)
    return [p.tobytes() if p.any() else b"" for p in planes]


def join_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """Inverse of ``split_planes``."""
    width = n if kind == "byte" else (n + 7) // 8
    full = np.zeros((len(planes), width), np.uint8)
    for k, p in enumerate(planes):
        if p:
            full[k] = np.frombuffer(p, np.uint8)
    if kind == "bit":
        bits = np.unpackbits(full, axis=1)[:, :n].reshape(4, 8, n).transpose(0, 2, 1)
        full = np.packbits(bits, axis=2, bitorder="little")[:, :, 0]
    return np.ascontiguousarray(full.T).view("<u4").reshape(n)


# --- one file ------------------------------------------------------------------

def _stream(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(out, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return out.getvalue()


class PlaneWriter:
    """Writes the ids of consecutive documents to one file, a chunk at a time."""

    def __init__(self, out, key_type: pa.DataType, kind: str = "byte", chunk: int = CHUNK_IDS):
        if kind not in ("byte", "bit"):
            raise ValueError("planes are 'byte' or 'bit'")
        self.out, self.kind, self.chunk, self.key_type = out, kind, chunk, key_type
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_docs = 0
        self.at = len(MAGIC)
        self.index: list[tuple[int, int, list[int]]] = []
        self.keys: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        out.write(MAGIC)

    def add(self, keys: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents ``keys`` with ``counts`` of the ids each."""
        self.keys.append(keys)
        self.counts.append(counts)
        self.n_docs += len(counts)
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= self.chunk:
            self._flush(self.chunk)

    def _flush(self, n: int) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.held])
        now, rest = ids[:n], ids[n:]
        self.held, self.n_held = [rest], len(rest)
        packed = [self.compress(p) if p else b"" for p in split_planes(now, self.kind)]
        self.index.append((self.at, len(now), [len(p) for p in packed]))
        for p in packed:
            self.out.write(p)
        self.at += sum(map(len, packed))
        self.n_ids += len(now)

    def finish(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        docs = pa.record_batch(
            [pa.concat_arrays([pa.array([], self.key_type), *self.keys]), pa.array(counts)],
            names=["key", "n_ids"])
        chunks = pa.record_batch(
            [pa.array([x[0] for x in self.index], pa.int64()),
             pa.array([x[1] for x in self.index], pa.int64()),
             pa.array([x[2] for x in self.index], pa.list_(pa.int32()))],
            names=["at", "n_ids", "planes"])
        parts = [_stream(docs), _stream(chunks)]
        footer = struct.pack("<cq", self.kind[1:2].encode(), len(parts[0])) + b"".join(parts)
        self.out.write(footer + struct.pack("<q", len(footer)) + MAGIC)
        self.at += len(footer) + 8 + len(MAGIC)


class PlaneFile:
    """A written file: its documents, and any range of its ids."""

    def __init__(self, path: str):
        system, name = _open(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(8 + len(MAGIC), size - 8 - len(MAGIC)) if size > 24 else b""
        if tail[8:] != MAGIC:
            raise ValueError(f"not a complete plane file: {path}")
        (length,) = struct.unpack("<q", tail[:8])
        footer = self.file.read_at(length, size - len(tail) - length)
        letter, first = struct.unpack_from("<cq", footer)
        self.kind = "byte" if letter == b"y" else "bit"
        body = footer[struct.calcsize("<cq"):]
        docs = pa.ipc.open_stream(body[:first]).read_all().combine_chunks()
        chunks = pa.ipc.open_stream(body[first:]).read_all()
        self.keys = pa.chunked_array(docs["key"]).combine_chunks() if docs.num_rows else \
            pa.array([], docs.schema.field("key").type)
        self.bounds = np.r_[0, np.cumsum(docs["n_ids"].to_numpy())].astype(np.int64)
        self.chunk_at = chunks["at"].to_pylist()
        self.chunk_planes = chunks["planes"].to_pylist()
        self.chunk_bounds = np.r_[0, np.cumsum(chunks["n_ids"].to_numpy())].astype(np.int64)
        self.decompress = zstandard.ZstdDecompressor().decompress
        self._last: tuple[int, np.ndarray] | None = None

    def close(self) -> None:
        self.file.close()

    def chunk(self, k: int) -> np.ndarray:
        """Ids of chunk k (the last one read is kept)."""
        if self._last is None or self._last[0] != k:
            sizes = self.chunk_planes[k]
            packed = self.file.read_at(sum(sizes), self.chunk_at[k])
            cuts = np.r_[0, np.cumsum(sizes)].tolist()
            planes = [self.decompress(packed[a:b]) if b > a else b""
                      for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            n = int(self.chunk_bounds[k + 1] - self.chunk_bounds[k])
            self._last = (k, join_planes(planes, n, self.kind))
        return self._last[1]

    def parts(self, start: int, end: int) -> Iterator[np.ndarray]:
        """Ids ``start`` to ``end`` of the file, a chunk's at a time."""
        k = int(np.searchsorted(self.chunk_bounds, start, "right")) - 1
        while start < end:
            lo, hi = int(self.chunk_bounds[k]), int(self.chunk_bounds[k + 1])
            yield self.chunk(k)[start - lo:min(end, hi) - lo]
            start, k = hi, k + 1

    def ids(self, start: int, end: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *self.parts(start, end)])


def read_ids(path: str, start: int, n: int) -> np.ndarray:
    """``n`` ids from position ``start`` of one file, from the chunks that hold them."""
    with closing(PlaneFile(path)) as file:
        return file.ids(start, start + n)


# --- Spark ---------------------------------------------------------------------

def _shard_writer(folder: str, shared, end_id: int, special_text: bool, kind: str, chunk: int):
    """``mapInArrow`` function: the rows of a partition, in order, to one file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = out = None
        context = TaskContext.get()
        shard = context.partitionId()
        name = f"ids-{shard:06d}-{context.taskAttemptId()}.planes"
        encode = units.byte_level(shared.value, special_text)
        for batch in batches:
            for lo, hi, buf, off in tk.text_blocks(batch.column("text")):
                if writer is None:
                    system, root = _open(folder)
                    out = system.open_output_stream(f"{root}/{name}")
                    writer = PlaneWriter(out, batch.schema.field("key").type, kind, chunk)
                ids, bounds = encode(buf, off)
                counts = np.diff(bounds) + 1
                ended = np.insert(ids, bounds[1:], end_id)
                writer.add(batch.column("key").slice(lo, hi - lo), counts, ended)
        if writer is not None:
            writer.finish()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([name]), pa.array([writer.n_docs]),
                 pa.array([writer.n_ids]), pa.array([writer.at])],
                names=["shard", "file", "n_docs", "n_ids", "n_bytes"])
    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id",
          text: str = "text", special_text: bool = False, planes: str = "byte",
          chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Encode all rows and write them below ``path`` in ascending order of ``key``; returns
    the shard index.  ``path`` must be a folder that driver and executors share.

    Rows are ranged on (key, hash of the text, a number of the row), so a repeated id or row
    does not fill one task."""
    spark = docs.sparkSession
    tk.small_batches(spark)
    with open(tokenizer_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())    # a vocabulary file of fixed size
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("by_text"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col("key").asc_nulls_last(), F.col("by_text").asc(), F.col("row").asc()]
    system, root = _open(path)
    system.create_dir(f"{root}/ids", recursive=True)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    written = ranged.mapInArrow(
        _shard_writer(f"{path}/ids", shared, end_id, special_text, planes, chunk_ids), INDEX)
    written.write.parquet(f"{path}/index")
    index = shards(spark, path)
    named = {r.file for r in index.select("file").toLocalIterator()}    # a row per task
    for found in system.get_file_info(pafs.FileSelector(f"{root}/ids")):
        if found.base_name not in named:
            system.delete_file(found.path)
    return index


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard index with the number of ids before each shard (a row per writing task)."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _on_shards(spark: SparkSession, path: str, schema: T.StructType, rows_of) -> DataFrame:
    """A task per shard that puts out ``rows_of(file, start, first doc, end doc)``."""
    index = shards(spark, path)
    n = max(1, index.count())
    at = F.row_number().over(Window.orderBy("shard")) - 1
    listed = index.withColumn("at", at.cast("int")).repartitionById(n, "at")
    names, key_type = schema.names, to_arrow_type(schema[0].dataType)

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(),
                                   batch.column("start").to_pylist(), strict=True):
                with closing(PlaneFile(f"{path}/ids/{name}")) as file:
                    n_docs, lo = len(file.bounds) - 1, 0
                    while lo < n_docs:
                        far = np.searchsorted(file.bounds, file.bounds[lo] + 16 * CHUNK_IDS)
                        hi = min(max(int(far), lo + 1), lo + 4096, n_docs)
                        made = rows_of(file, lo, hi)
                        yield pa.RecordBatch.from_arrays(
                            [file.keys.slice(lo, hi - lo).cast(key_type),
                             pa.array(file.bounds[lo:hi] + start),
                             pa.array(np.diff(file.bounds[lo:hi + 1])), made], names=names)
                        lo = hi

    return listed.select("file", "start").mapInArrow(run, schema)


def _schema(key_type: T.DataType, name: str, made: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc_id", key_type), T.StructField("start", T.LongType()),
                         T.StructField("n_tokens", T.LongType()), T.StructField(name, made)])


def read(spark: SparkSession, path: str, key_type: T.DataType = T.LongType()) -> DataFrame:
    """The documents of the files below ``path``: id, ``start`` (ids of all documents before
    it), ``n_tokens`` and ``token_ids``."""
    def rows_of(file: PlaneFile, lo: int, hi: int) -> pa.Array:
        ids = file.ids(int(file.bounds[lo]), int(file.bounds[hi]))
        bounds = (file.bounds[lo:hi + 1] - file.bounds[lo]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))

    return _on_shards(spark, path, _schema(key_type, "token_ids", T.ArrayType(T.IntegerType())),
                      rows_of)


def read_digests(spark: SparkSession, path: str, key_type: T.DataType = T.LongType()
                 ) -> DataFrame:
    """As ``read`` with ``ids_crc32``, the crc32 of the ids as little-endian 32-bit
    integers, in place of the ids."""
    def crc(file: PlaneFile, k: int) -> int:
        value = 0
        for part in file.parts(int(file.bounds[k]), int(file.bounds[k + 1])):
            value = zlib.crc32(part.astype("<u4"), value)
        return value

    def rows_of(file: PlaneFile, lo: int, hi: int) -> pa.Array:
        return pa.array([crc(file, k) for k in range(lo, hi)], pa.int64())

    return _on_shards(spark, path, _schema(key_type, "ids_crc32", T.LongType()), rows_of)
