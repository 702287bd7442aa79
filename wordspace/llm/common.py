"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package

#: rows per Arrow batch: keeps a batch of very long texts small
ARROW_ROWS = 2000
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the executors and lineage cuts possible."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def unused(name: str, taken: list[str]) -> str:
    """The name, lengthened until no column has it (names differ by more than case)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, rows: int = ARROW_ROWS, text: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in pieces (views, no copies) of at most ``rows`` rows and, if
    the column ``text`` is named, of about ``SLICE_BYTES`` of it, or one row."""
    if text is None or not batch.num_rows:
        cuts = range(0, batch.num_rows, rows)
    else:
        held = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts, at = [], 0
        while at < batch.num_rows:
            cuts.append(at)
            before = held[at - 1] if at else 0
            at = max(at + 1, min(at + rows, int(np.searchsorted(held, before + SLICE_BYTES, side="right"))))
    ends = [*list(cuts)[1:], batch.num_rows]
    for a, b in zip(cuts, ends, strict=True):
        yield batch.slice(a, b - a)


def utf8_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, row offsets from 0) of a string column; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]
