"""Token ids of a corpus in document order, one wavelet matrix a shard.

Documents are dealt into ranges of their ids and tokenised there; each range is written as shards
of whole documents. A shard is one file: a Parquet row with the ids and lengths of its documents
and the compressed wavelet matrix of their tokens, so that Spark's commit keeps files of lost
tasks out and any store that Spark writes to will do. ``wavelet.Wavelet`` answers look-ups,
counts and occurrences from that one file.

Defined results: null and empty texts are documents of the end id alone; rows without an id come
first; rows with the same id stand in order of their texts' hash, each with its own entry; an
empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
from pyspark.sql.window import Window

from tallyfield.llm import wavelet
from tallyfield.llm.byte_bpe import byte_bpe
from tallyfield.llm.common import stored, table
from tallyfield.session import scratch_dir

#: Tokens of a shard; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 21


def _shards(id_type: pa.DataType, end_id: int, vocabulary: str | None):
    schema = pa.schema([
        ("part", pa.int64()), ("shard", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(id_type)),
        ("lengths", pa.list_(pa.int64())), ("tokens", pa.binary()),
    ])
    end = np.array([end_id], "<u2")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, encoder = TaskContext.get().partitionId(), 0, byte_bpe(vocabulary)
        doc_ids, rows, total = [], [], 0

        def close() -> pa.RecordBatch:
            blob = wavelet.build(np.concatenate(rows))
            values = ([part], [shard], [total], [doc_ids], [[len(row) for row in rows]], [blob])
            return pa.record_batch([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_many(batch.column(1)), strict=True):
                if rows and total + len(ids) + 1 > SHARD_TOKENS:
                    yield close()
                    doc_ids, rows, total, shard = [], [], 0, shard + 1
                doc_ids.append(doc_id)
                rows.append(np.concatenate([ids, end]))
                total += len(rows[-1])
        if rows:
            yield close()

    return shards


def write(
    docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str | None = None,
) -> None:
    """Write the store: files of ascending document ids."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    # By id, then by text, so that rows of one id or of none may lie in several ranges.
    ordered = source.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = (
        f"part long, shard long, n_tokens long, doc_ids array<{kind.simpleString()}>, "
        "lengths array<long>, tokens binary"
    )
    ordered.select("doc_id", "text").mapInArrow(_shards(to_arrow_type(kind), end_id, vocabulary), schema).write.option(
        "maxRecordsPerFile", 1
    ).option("compression", "none").parquet(path)


def _unpacked(id_type: pa.DataType, name: str, kind: pa.DataType, value: Callable[[np.ndarray], object]):
    schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                doc_ids, lengths, blob, start = (batch.column(i)[place].as_py() for i in range(4))
                raw = wavelet.Wavelet(blob).decode()
                begins = list(accumulate(lengths, initial=0))
                docs = [value(raw[a : a + n]) for a, n in zip(begins, lengths, strict=False)]
                values = (doc_ids, [start + a for a in begins[:-1]], lengths, docs)
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    return unpacked


def _opened(spark: SparkSession, path: str, name: str, kind: pa.DataType, value: Callable[[np.ndarray], object]) -> DataFrame:
    """A value of each document's tokens, with its id, the place of its first token and their number.

    The places come from sums by range, of which the driver sees one number each. Places of shards
    are a written table, so that Spark knows its size when it chooses how to join it to the files.
    """
    files = spark.read.parquet(path)
    id_type = files.schema["doc_ids"].dataType.elementType
    sizes = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    begins = accumulate((n for _, n in sizes), initial=0)
    ranges = spark.createDataFrame(
        [(part, begin) for (part, _), begin in zip(sizes, begins, strict=False)], "part long, range_start long"
    )
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(
        files.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"))
        .join(ranges, "part")
        .select("part", "shard", (F.col("range_start") + F.col("shard_start")).alias("start"))
    )
    work = _unpacked(to_arrow_type(id_type), name, kind, value)
    schema = f"doc_id {id_type.simpleString()}, start long, n_tokens long, {name} {from_arrow_type(kind).simpleString()}"
    shards = files.join(places, ["part", "shard"]).select("doc_ids", "lengths", "tokens", "start")
    return shards.mapInArrow(work, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a store: id, place of its first token, and its tokens as 16-bit ids."""
    return _opened(spark, path, "tokens", pa.binary(), lambda ids: ids.tobytes())


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a store with the crc32 of their ids as little-endian 32-bit integers."""
    return _opened(spark, path, "ids_crc32", pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark) + "/tokens"
    write(table(spark, sf_dir, "documents"), path)
    return checksums(spark, path)
