"""Bounded-space online packing of token ids into sequences of one length.

Every partition keeps a fixed number of open windows. A document's ids are cut into pieces of at
most one window; full pieces are windows of their own, and a remainder goes to the open window it
fits best. When none has room, the fullest is emitted and a new one opened. What is still open at
a partition's end is merged with the leftovers of other partitions, a bounded number of windows a
task, by the same rule.

Defined results: null and empty texts are documents of the end id alone; repeated rows and rows
without an id are packed as separate documents; an empty table gives no piece; other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm.byte_bpe import byte_bpe
from tallyfield.llm.common import stored, table

#: Open windows of a partition, and partitions whose leftovers meet in one merging task.
OPEN_WINDOWS = 128
PARTITIONS_A_MERGE = 64

#: Windows are numbered by partition and place; merged ones by merging task, beyond all partitions.
PLACES = 1 << 32
MERGED = 1 << 24


class Windows:
    """The open windows: place each item best-fit, emit the fullest when none has room."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free: list[tuple[int, int]] = []
        self.opened = 0

    def place(self, size: int) -> tuple[int, int, int | None]:
        """The item's window, its offset there, and a window that had to be emitted for it."""
        emitted = None
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            free, window = self.free.pop(at)
        else:
            if len(self.free) == self.most:
                emitted = self.free.pop(0)[1]
            free, window = self.capacity, self.opened
            self.opened += 1
        if free > size:
            insort(self.free, (free - size, window))
        return window, self.capacity - free, emitted

    def left(self) -> set[int]:
        return {window for _, window in self.free}


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, ids binary"


def _pieces(id_type: pa.DataType, capacity: int, end_id: int, most: int, with_ids: bool, vocabulary):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset", "ids", "left"]
    types = [id_type, *[pa.int64()] * 6, pa.binary(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(names, types, strict=True)))
    end = np.array([end_id], "<u4")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() * PLACES
        windows = Windows(capacity, most)
        encoder = byte_bpe(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch.column(0).to_pylist(), encoder.encode_many(batch.column(1)), strict=True):
                ids = np.concatenate([raw.astype("<u4"), end])
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity].tobytes()
                    window, offset, _ = windows.place(len(part) // 4)
                    rows.append((
                        doc_id, start, len(part) // 4, zlib.crc32(part), len(ids), base + window,
                        offset, part if with_ids else None, None,
                    ))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema=schema)
        left = [base + window for window in sorted(windows.left())]
        if left:
            yield pa.record_batch(
                [pa.array([x], t) for x, t in zip([None] * 8 + [left], types, strict=True)], schema=schema
            )

    return pieces


def _merge(capacity: int, most: int):
    def merge(leftovers: pd.DataFrame) -> pd.DataFrame:
        group = int(leftovers["merge"].iloc[0])
        leftovers = leftovers.sort_values(["fill", "window"], ascending=[False, True])
        windows = Windows(capacity, most)
        placed = [windows.place(int(fill))[:2] for fill in leftovers["fill"]]
        return pd.DataFrame({
            "window": leftovers["window"].to_numpy(),
            "sequence_id": [(MERGED + group) * PLACES + window for window, _ in placed],
            "shift": [offset for _, offset in placed],
        })

    return merge


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 1,
    open_windows: int = OPEN_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row for each piece: whence it comes and where it lies; its ids too, if asked for."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType
    work = _pieces(to_arrow_type(id_type), capacity, end_id, open_windows, with_ids, vocabulary)
    schema = f"doc_id {id_type.simpleString()}, {PIECE}, left array<long>"
    rows = stored(source.mapInArrow(work, schema))
    pieces = rows.where("window IS NOT NULL").drop("left")
    left = rows.where("left IS NOT NULL").select(F.explode("left").alias("window"))
    return _sequences(pieces, left, capacity, open_windows)


def _sequences(pieces: DataFrame, left: DataFrame, capacity: int, open_windows: int) -> DataFrame:
    """Windows as sequences, those left open merged across partitions."""
    merge_of = F.floor(F.col("window") / F.lit(PLACES * PARTITIONS_A_MERGE)).cast("long")
    fills = (
        pieces.join(left, "window", "left_semi")
        .groupBy("window")
        .agg(F.max(F.col("offset") + F.col("length")).alias("fill"))
        .withColumn("merge", merge_of)
    )
    moved = fills.groupBy("merge").applyInPandas(
        _merge(capacity, open_windows), "window long, sequence_id long, shift long"
    )
    return pieces.join(moved, "window", "left").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("sequence_id", "window").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        "ids",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
