"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every partition sends the owner of each fingerprint range its own fingerprints there, distinct,
sorted and Golomb-coded. An owner merges what it gets and answers each sender with a bitmap: which
of its fingerprints some other row has too. Rows whose bit is set are suspects; only their texts
are compared, by grouping on all their bytes. Fingerprints are as short as the row count allows,
so a code costs a few bits more than the logarithm of the number of partitions.

A fingerprint reaches its owner once from each partition, however many copies there are, and
copies inside a partition are marked by the sender; so a text that a third of all rows share is no
hot key. Grouping by text combines copies before it shuffles.

Defined results: null text counts as empty. Rows with the same id are separate rows: each counts
in the group's size, and all rows that carry the kept id are kept. A null id is the least: it is
kept only by a group of such rows. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm import golomb
from tallyfield.llm.common import stored, table

#: Rows for each owner of a fingerprint range.
OWNER_ROWS = 1 << 20

#: Bits of a fingerprint beyond the logarithm of the row count: one row in 2**10 is a suspect in vain.
SPARE_BITS = 10

ROW = "kind string, doc_id {id}, part long, sha string, bytes long, owner long, place long, twice boolean, message binary"


def _send(id_type: pa.DataType, owners: int, bits: int):
    """A partition's rows, each with the place of its fingerprint in the message to its owner; then the messages."""
    fields = [
        ("kind", pa.string()), ("doc_id", id_type), ("part", pa.int64()), ("sha", pa.string()),
        ("bytes", pa.int64()), ("owner", pa.int64()), ("place", pa.int64()), ("twice", pa.bool_()),
        ("message", pa.binary()),
    ]
    schema = pa.schema(fields)
    width = -(-(1 << bits) // owners)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        got = pa.Table.from_batches(batches)
        prints = got["print"].to_numpy().astype(np.int64)
        known, where, counts = np.unique(prints, return_inverse=True, return_counts=True)
        owner = known // width
        begins = np.searchsorted(owner, np.arange(owners + 1))
        n, place = len(prints), np.arange(len(known)) - begins[owner]
        columns = {
            "kind": pa.array(["row"] * n), "doc_id": got["doc_id"], "part": pa.array([part] * n, pa.int64()),
            "sha": got["sha"], "bytes": got["bytes"], "owner": pa.array(owner[where]),
            "place": pa.array(place[where]), "twice": pa.array(counts[where] > 1), "message": pa.nulls(n, pa.binary()),
        }
        yield from pa.table(columns, schema=schema).combine_chunks().to_batches(max_chunksize=1 << 16)
        used = np.flatnonzero(np.diff(begins))
        coded = [golomb.encode(known[begins[o] : begins[o + 1]] - o * width, width) for o in used]
        columns = {name: pa.nulls(len(used), kind) for name, kind in fields} | {
            "kind": pa.array(["message"] * len(used)), "part": pa.array([part] * len(used), pa.int64()),
            "owner": pa.array(used), "message": pa.array(coded, pa.binary()),
        }
        yield from pa.table(columns, schema=schema).combine_chunks().to_batches()

    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """An owner's bitmaps: for each sender, which of its fingerprints another sender has too."""
    lists = [golomb.decode(raw) for raw in messages["message"]]
    known, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = known[counts > 1]
    bitmaps = [np.packbits(np.isin(sent, shared, assume_unique=True)).tobytes() for sent in lists]
    return pd.DataFrame({"part": messages["part"], "owner": messages["owner"], "bitmap": bitmaps})


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: the id that stays for its text, the size of its group, whether it stays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    kind = source.schema["doc_id"].dataType
    rows = source.count()
    bits = min(62, math.ceil(math.log2(rows + 2)) + SPARE_BITS)
    owners = max(8, -(-rows // OWNER_ROWS))
    digest = F.sha2(F.col("text"), 256).alias("sha"), F.octet_length("text").cast("long").alias("bytes")
    digests = source.select(
        "doc_id", F.shiftrightunsigned(F.xxhash64("text"), 64 - bits).alias("print"),
        *digest,
    )
    sent = stored(digests.mapInArrow(_send(to_arrow_type(kind), owners, bits), ROW.format(id=kind.simpleString())))
    members = sent.where("kind = 'row'").drop("kind", "message")
    messages = sent.where("kind = 'message'").select("part", "owner", "message")
    bitmaps = messages.groupBy("owner").applyInPandas(_answer, "part long, owner long, bitmap binary")
    suspects = stored(
        members.join(bitmaps, ["part", "owner"])
        .where(
            "twice OR shiftright(cast(conv(hex(substring(bitmap, cast(place div 8 AS int) + 1, 1)), 16, 10) AS int), "
            "cast(7 - place % 8 AS int)) & 1 = 1"
        )
        .select("doc_id")
        .distinct()
    )
    verified = (
        source.join(suspects.hint("shuffle_hash"), source["doc_id"].eqNullSafe(suspects["doc_id"]), "left_semi")
        .groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(*digest, "keep_id", "group_size")
    )
    return members.join(verified, ["sha", "bytes"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    found = find_copies(docs, id_col, text_col)
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias("__copy_id"), F.col("text_sha256").alias("__copy_sha")).distinct())
    same = docs[id_col].eqNullSafe(gone["__copy_id"]) & (F.sha2(F.coalesce(docs[text_col], F.lit("")), 256) == gone["__copy_sha"])
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
