"""Helpers shared by the document operators: reading, scratch tables and
vectorised work on the UTF-8 bytes of an Arrow batch."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat.session import ensure_checkpoint_dir

#: Bytes of text whose temporary arrays a task holds at a time. A longer text
#: is a block of its own.
BLOCK_BYTES = 1 << 20
#: Rows, and bytes of text, that a step holds as Python strings or hands back
#: to Spark at a time. A batch has up to 10,000 rows of any length; Spark holds
#: each one that it is handed whole, outside its heap.
SLICE_ROWS, SLICE_BYTES = 500, 1 << 20

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)
BASE_INV = U64(pow(int(BASE), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read
    back: the lineage is cut by files that every executor sees."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/regstat-llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under names no other column can clash with;
    a null text counts as empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code per byte value, the same in every process."""
    return mix(np.arange(256, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(mix_int(seed)))


def mix_int(seed: int) -> int:
    return int(mix(np.array([seed], dtype=U64))[0])


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_POWERS["up"]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        for key, base in (("up", BASE), ("down", BASE_INV)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class SpanHash:
    """64-bit hashes of any byte spans of one buffer, from one running sum."""

    def __init__(self, buf: np.ndarray, codes: np.ndarray):
        up, self.down = powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U64)
        np.cumsum(codes[buf] * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


class Block:
    """Consecutive rows of a batch as one byte buffer.

    ``ids``: document ids; ``at``: row offsets into ``buf`` (one more than
    rows)."""

    __slots__ = ("ids", "buf", "at")

    def __init__(self, ids: np.ndarray, buf: np.ndarray, at: np.ndarray):
        self.ids, self.buf, self.at = ids, buf, at

    def text(self, row: int) -> bytes:
        return self.buf[self.at[row] : self.at[row + 1]].tobytes()

    def rows_of(self, positions: np.ndarray) -> np.ndarray:
        """Row of each byte position."""
        return np.searchsorted(self.at, positions, side="right") - 1


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of about ``limit`` bytes from batches with ``doc_id, text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("doc_id")
        ids = np.array(ids.to_pylist(), object) if ids.null_count else ids.to_numpy(zero_copy_only=False)
        text = batch.column("text")
        wide = pa.types.is_large_string(text.type)
        at = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1]
        at = at.astype(np.int64)
        data = text.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
            yield Block(ids[lo:hi], data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            lo = hi


def slices(batch: pa.RecordBatch, text_col: str, rows: int = SLICE_ROWS, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices (not copied) of at most ``rows``
    rows and about ``limit`` bytes of text; a longer text is a slice of its own."""
    at = np.zeros(batch.num_rows + 1, np.int64)
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
    np.cumsum(sizes.to_numpy(zero_copy_only=False), out=at[1:])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1))
        yield batch.slice(lo, hi - lo)
        lo = hi


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(block: Block, separators: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: a maximal run of bytes that are no
    separators, never across documents."""
    n = len(block.buf)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~separators[block.buf]
    start = inside[:n].copy()
    start[1:] &= ~inside[: n - 1]
    first = block.at[:-1][block.at[:-1] < block.at[1:]]
    start[first] = inside[first]
    starts = np.flatnonzero(start)
    stop = inside[:n].copy()
    stop[: n - 1] &= ~inside[1:n]
    last = first_to_last(block.at)
    stop[last] = inside[last]
    return starts, np.flatnonzero(stop) + 1, block.rows_of(starts)


def first_to_last(at: np.ndarray) -> np.ndarray:
    """Last byte of every row that has one."""
    return at[1:][at[1:] > at[:-1]] - 1


def counts_by_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def sums_by_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of a per-byte value over each row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 0x41) & (buf <= 0x5A), buf + np.uint8(32), buf)


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and list lengths."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
