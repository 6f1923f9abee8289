"""Does a key exist already? Bloom filters of each stored partition's keys, kept beside the table.

A filter is split into blocks of eight 32-bit words. A key's hash picks one block and one bit in each
word, so that looking a key up is one equi-join on (level, block) whatever the number of bits, and
building is one aggregation by bit_or that combines map-side. ``level`` is the binary logarithm
of a partition's number of blocks, by its rows; keys meet the few levels there are.

A filter says for which files it was built. Spark names each file it writes anew, so a partition that
was written since, by whatever job, is seen by its names and its filter built again; no load has to
take part, and a job lost at any point leaves no filter that hides a key. The filters only choose
partitions: each key found is looked up in the rows of those, so what comes back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.fingerprints import row_hash
from tallyfield.session import stored

if TYPE_CHECKING:
    from tallyfield.sources.warehouse import Warehouse

WORDS = 8
WORD_BITS = 32
#: With 12 bits a key about one absent key in 200 is taken for a present one.
BITS_PER_KEY = 12

#: The trailing ``/column=value`` folders of a file's path.
_PARTITION = r"((?:/[^/=]+=[^/]*)*)/[^/]+$"

FILTERS = "level int, block bigint, " + ", ".join(f"w{i} int" for i in range(WORDS)) + ", partition string"
BUILT = "partition string, files string, level int"

_ROW, _BATCH, _STORED = "_partition", "batch_rows", "stored_rows"


def _name(table: str) -> str:
    return f"keyfilters-{table}"


def _folder(store: Warehouse, table: str) -> str:
    return f"{store.root}/_keyfilters/{table}"


def _partition_of(path: str) -> str:
    return unquote(re.search(_PARTITION, path)[1]) + "/"


def _files(rows: DataFrame) -> dict[str, list[str]]:
    """Paths of a table's files by partition; Spark has listed them to plan the read."""
    found: dict[str, list[str]] = {}
    for path in rows.inputFiles():
        found.setdefault(_partition_of(path), []).append(path)
    return found


def _print(paths: Sequence[str]) -> str:
    names = sorted(p.rsplit("/", 1)[-1] for p in paths)
    return hashlib.sha256("\n".join(names).encode()).hexdigest()


def _hashes(keys: Sequence[str], level: Column) -> list[Column]:
    """(block, one word mask a word) of a key; NULL is a value like any other."""
    place, bits = row_hash([*keys]), row_hash([*keys, keys[0]])
    # A shift by 64 is one by 0 to the JVM.
    block = F.when(level > 0, F.call_function("shiftrightunsigned", place, F.lit(64) - level)).otherwise(F.lit(0).cast("bigint"))
    masks = [
        F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(bits, 5 * i).bitwiseAND(F.lit(WORD_BITS - 1).cast("bigint")).cast("int"))
        for i in range(WORDS)
    ]
    return [block.alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(masks)]]


def _rows_of(store: Warehouse, table: str, partitions: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Keys and partition of the rows in some partitions; no other folder is listed or read."""
    root, schema = store.path(table), store.read(table).schema
    paths = [root + p.rstrip("/") for p in partitions]
    rows = store.spark.read.schema(schema).option("basePath", root).parquet(*paths)
    return rows.select(*[F.col(f"`{k}`") for k in keys], _own_partition(partitions[0].count("/") - 1).alias(_ROW))


def _own_partition(depth: int) -> Column:
    """As _partition_of() the path of each row's file, so many folders deep; once a row, so without a pattern."""
    if not depth:
        return F.lit("/")
    own = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -depth - 1), "/", depth)
    plain = F.when(own.contains("%"), F.url_decode(F.replace(own, F.lit("+"), F.lit("%2B")))).otherwise(own)
    return F.concat(F.lit("/"), plain, F.lit("/"))


def _levels(rows: DataFrame) -> DataFrame:
    """Binary logarithm of the number of blocks for each partition, by its rows."""
    blocks = F.col("n") * BITS_PER_KEY / (WORDS * WORD_BITS)
    level = F.greatest(F.lit(0), F.ceil(F.log2(blocks))).cast("int")
    return rows.groupBy(_ROW).agg(F.count(F.lit(1)).alias("n")).select(_ROW, level.alias("level"))


def _placed(rows: DataFrame, levels: dict[str, int], keys: Sequence[str]) -> DataFrame:
    """Block and masks of each row's key; the few levels go to the rows, which are not moved for them."""
    known = rows.sparkSession.createDataFrame(list(levels.items()), f"{_ROW} string, level int")
    hashed = rows.join(F.broadcast(known), _ROW)
    return hashed.select(F.col(_ROW).alias("partition"), "level", *_hashes(keys, F.col("level")))


def _build(store: Warehouse, table: str, partitions: Sequence[str], keys: Sequence[str]) -> dict[str, int]:
    """Write the filters of some partitions over their earlier ones; returns their levels."""
    rows = _rows_of(store, table, partitions, keys)
    # One row a partition, as many as Spark itself lists.
    levels = {r[0]: r[1] for r in _levels(rows).collect()}
    placed = _placed(rows, levels, keys)
    words = [F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)]
    filters = placed.groupBy("partition", "level", "block").agg(*words).hint("rebalance", "partition")
    writer = filters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition")
    writer.parquet(_folder(store, table))
    return levels


def refresh(store: Warehouse, table: str, keys: Sequence[str]) -> list[str]:
    """Build the filters of partitions written since they were last built; returns which.

    Which partitions have filters is written after the filters, so a job lost in between builds
    them again. Filters for other keys are all built anew.
    """
    files = _files(store.read(table))
    prints = {p: _print([",".join(keys), *paths]) for p, paths in files.items()}
    folder = store.versions.current(_name(table))
    before = {r[0]: (r[1], r[2]) for r in store.spark.read.schema(BUILT).parquet(folder).collect()} if folder else {}
    stale = sorted(p for p, files_print in prints.items() if before.get(p, ("",))[0] != files_print)
    if stale or set(before) - set(prints):
        levels = _build(store, table, stale, keys) if stale else {}
        # A partition whose files hold no row has no filter, and needs none.
        now = [(p, prints[p], levels.get(p, before.get(p, ("", 0))[1])) for p in sorted(prints)]
        store.versions.replace(store.spark.createDataFrame(now, BUILT).coalesce(1), _name(table))
    return stale


def _batch_keys(store: Warehouse, table: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of a batch in the stored types, with how often each comes."""
    types = {f.name: f.dataType for f in store.read(table).schema}
    typed = batch.select(*[F.col(f"`{k}`").try_cast(types[k]).alias(k) for k in keys])
    return typed.groupBy(*keys).agg(F.count(F.lit(1)).alias(_BATCH))


def candidates(store: Warehouse, table: str, arriving: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with each partition whose filter does not rule them out."""
    built = store.spark.read.schema(BUILT).parquet(store.versions.current(_name(table)))
    # A handful of numbers: logarithms of partition sizes.
    levels = sorted(r[0] for r in built.select("level").distinct().collect())
    probes = arriving.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels])))
    probes = probes.select(*keys, _BATCH, "level", *_hashes(keys, F.col("level")))
    filters = store.spark.read.schema(FILTERS).parquet(_folder(store, table))
    filters = filters.join(built.select("partition", "level"), ["partition", "level"])  # not of partitions that have gone
    held = F.lit(True)
    for i in range(WORDS):
        held = held & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    return probes.join(filters, ["level", "block"]).where(held).select(*keys, _BATCH, F.col("partition").alias(_ROW))


def known_keys(store: Warehouse, table: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a batch that repeat: (keys, batch_rows, stored_rows).

    A row for each key that is stored already, or comes more than once in the batch. A NULL part of
    a key equals another NULL. A key that does not convert to the stored type is NULL there. Rows are
    read in those partitions alone whose filters hold a key of the batch. Of a table that is not
    stored, and of an empty one, no key is known.
    """
    if not batch.columns or any(k not in batch.columns for k in keys):
        raise ValueError(f"the batch lacks key columns: {[k for k in keys if k not in batch.columns]}")
    if not store.exists(table) or not _files(store.read(table)):
        own = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias(_BATCH))
        return own.withColumn(_STORED, F.lit(0).cast("bigint")).where(F.col(_BATCH) > 1)
    refresh(store, table, keys)
    arriving = stored(_batch_keys(store, table, batch, keys))
    maybe = stored(candidates(store, table, arriving, keys))
    partitions = sorted(r[0] for r in maybe.select(_ROW).distinct().collect())
    repeated = arriving.withColumn(_STORED, F.lit(0).cast("bigint")).where(F.col(_BATCH) > 1)
    if not partitions:
        return repeated
    rows = _rows_of(store, table, partitions, keys).groupBy(*keys, _ROW).agg(F.count(F.lit(1)).alias("_n"))
    found = maybe.alias("a").join(rows.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, _ROW)])
    counted = found.select(*[f"a.{k}" for k in keys], F.col(f"a.{_BATCH}").alias(_BATCH), F.col("_n").alias(_STORED))
    both = counted.unionByName(repeated).groupBy(*keys)
    return both.agg(F.max(_BATCH).alias(_BATCH), F.sum(_STORED).alias(_STORED))
