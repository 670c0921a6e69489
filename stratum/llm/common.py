"""Helpers shared by the operators: written intermediate tables, Arrow batches, text hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.session import work_dir

WIDE_ROWS = 256         # Arrow rows at once where a row holds several texts
BATCH_BYTES = 4 << 20  # text handled at once inside a task; bounds a worker's memory, not the data


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


_SHORT_GROUPS = {"parquet.block.size": str(BATCH_BYTES), "parquet.page.size.row.check.min": "4"}  # rows between looks at the size


def stored(df: DataFrame, name: str, arrow_rows: int | None = None, wide: bool = False) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, not a recompute.
    `arrow_rows`: how many rows Python gets at once meanwhile, where a row holds several texts.
    `wide`: rows of some 100 KB are written in short row groups, as a task holds a row group whole when it writes or reads it.
    """
    path, conf = work_dir(df.sparkSession, f"llm-{name}"), df.sparkSession.conf
    before = conf.get(_ARROW_ROWS)
    try:
        if arrow_rows:
            conf.set(_ARROW_ROWS, str(arrow_rows))
            df = df.select("*")  # planned anew
        df.write.options(**_SHORT_GROUPS if wide else {}).parquet(path)
    finally:
        conf.set(_ARROW_ROWS, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000  # fixed-width rows (ids, hashes) up to which a join side is broadcast


def bounded(table: DataFrame) -> DataFrame:
    """A written table of narrow rows as a join side: broadcast if it was counted to be small, else shuffled as usual."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns naming a row by its id and text, so that rows repeating an id stay apart."""
    return [F.col(id_col).alias("__id"),
            F.xxhash64(F.col(text_col)).alias("__th"),
            F.coalesce(F.length(F.col(text_col)), F.lit(-1)).alias("__tl")]


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about `limit` bytes of text (a longer text is one run)."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts' UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


# --- hashes of runs of bytes, from prefix sums --------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit integers (multiply and shift rounds)."""
    x = x ^ np.uint64(seed * 0xD6E8FEB86659FD93 & _MASK)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64), 17)


class PowerTable:
    """Powers of the base and of its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            size = max(n, 2 * len(self.power), 1 << 16)
            self.power, self.inverse = (
                np.concatenate([np.ones(1, dtype=np.uint64),
                                np.multiply.accumulate(np.full(size - 1, b & _MASK, dtype=np.uint64))])
                for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.power, self.inverse


_POWERS = PowerTable()


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[starts[i]:ends[i]], in time linear in the data.

    H(a, b) = sum of T[byte j] * B**(j - a): a prefix-sum difference times B**-a.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _POWERS.upto(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[np.frombuffer(data, dtype=np.uint8)] * power[:len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words_joined(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A-Z lower-cased words between white space (0x20, 0x09-0x0D), joined by one space;
    the byte places where each begins and ends."""
    data = b" ".join(text.lower().split())
    if not data:
        return data, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)
    return data, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
