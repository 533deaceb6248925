"""Vectorised helpers for whole texts inside Arrow tasks.

Every helper works on a *block*: the UTF-8 bytes of some consecutive rows in one
``uint8`` array plus row offsets.  Blocks are cut by bytes, so the arrays derived
from them (a few 8-byte values per input byte) stay bounded whatever the length of
a Spark batch; a single text longer than the limit makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

U64 = np.uint64
BLOCK_BYTES = 1 << 20

#: White space of the text contracts: space and 0x09-0x0D.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.isin(np.arange(256), list(SPACES))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_RNG = np.random.Generator(np.random.PCG64(20240611))
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C55)
_STEP_INV = U64(pow(0x9E3779B97F4A7C55, -1, 2**64))
_PLACE = _RNG.integers(1, 2**63, 16, dtype=U64) * U64(2) + U64(1)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lower the session's Arrow batch size: at the default of 10,000 rows a batch of
    long texts would be gigabytes in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    """Arrow type that a column has in Python functions."""
    return to_arrow_type(df.schema[column].dataType)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a schema in DDL, as Python functions must return it."""
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def text_blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first_row, end_row, bytes, offsets)``; a null text is empty."""
    if len(col) == 0:
        return
    arr = (pc.fill_null(col, "") if col.null_count else col).cast(pa.large_string())
    _, raw_off, raw = arr.buffers()
    off = np.frombuffer(raw_off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(arr):
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), len(arr))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``member`` bytes that stay inside one row."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.empty(len(member), bool)
    first[0] = True
    np.logical_not(member[:-1], out=first[1:])
    last = np.empty(len(member), bool)
    last[-1] = True
    np.logical_not(member[1:], out=last[:-1])
    full = off[1:] > off[:-1]
    first[off[:-1][full]] = True
    last[off[1:][full] - 1] = True
    return np.flatnonzero(first & member), np.flatnonzero(last & member) + 1


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the words ``[^\\x20\\x09-\\x0D]+`` of every row."""
    return runs(~IS_SPACE[buf], off)


def rows_of(positions: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Row (within the block) that each byte position belongs to."""
    return np.searchsorted(off, positions, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up, down = np.full(n, _STEP, U64), np.full(n, _STEP_INV, U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, equal for equal bytes wherever they stand."""
    up, down = _powers(max(20, int(len(buf)).bit_length()))
    prefix = np.zeros(len(buf) + 1, U64)
    np.cumsum(_BYTE_VALUE[buf] * up[:len(buf)], out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(U64) * _STEP)


def hash_runs(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of each window of ``length`` consecutive values (windows may cross rows)."""
    n = max(0, len(values) - length + 1)
    out = np.full(n, U64(length), U64)
    for j in range(length):
        out += values[j:j + n] * _PLACE[j]
    return mix(out)


def group_bounds(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Bounds of each row's slice in an array ordered by row (length ``n_rows + 1``)."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def map_blocks(fn: Callable, schema: pa.Schema, text: str = "text",
               max_bytes: int = BLOCK_BYTES) -> Callable:
    """``mapInArrow`` function that calls ``fn(batch slice, bytes, offsets)`` per block;
    ``fn`` returns the block's output columns in the order of ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in text_blocks(batch.column(text), max_bytes):
                cols = fn(batch.slice(lo, hi - lo), buf, off)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for c, f in zip(cols, schema, strict=True)], schema=schema)
    return run


def hash_sequences(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice of ``values``, equal for equal sequences."""
    up, down = _powers(max(20, int(len(values)).bit_length()))
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(U64) * _STEP)
