"""WARC files and their Merkle fixity audit.

Records are written in order into one WARC file a shard. A tree stands over each file: its leaves
are the hashes of the records with their offset ranges, and every node hashes the range and hash
of each of its children. An audit compares the roots of two replicas and goes down only where they
differ, level by level, so that what is joined shrinks to the damaged records. A replica's leaves
are taken at the other's offset ranges, so damage to a header does not hide what follows; bytes
beyond the last range are a leaf of their own. A file that is damaged where it is stored is unpacked
as far as its bytes go; what can't be unpacked is missing from its ranges, whose hashes then differ.

A shard holds SHARD_RECORDS consecutive ids and is cut where it reaches SHARD_BYTES.

Defined results: null URLs and bodies are empty; records without an id are dealt by their content
into shards of their own, below 0; repeated records are all written, in an order fixed by their
content; an empty table gives no file, and an audit of nothing is empty. A file that one replica
lacks, or that is empty, is damaged as a whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfield.llm.common import stored, table
from tallyfield.session import scratch_dir

#: Records of a shard (of consecutive ids), bytes at which it is cut, cuts of a shard at most, children of a node.
SHARD_RECORDS, SHARD_BYTES, CUTS, FAN = 512, 1 << 26, 4096, 16

#: Bytes unpacked at once.
CHUNK = 1 << 16

#: Between records; the format's own mark.
END = "\r\n\r\n"

_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]+)", re.IGNORECASE)
_NAME = re.compile(rb"\r\nWARC-Record-ID: *<urn:page:([^>]*)>")

NODES = "shard long, level int, node long, begin long, end long, hash string"
LEAVES = "shard long, leaf long, begin long, end long, hash string, name string"


def records(pages: DataFrame, shard_records: int = SHARD_RECORDS, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(shard, page_id, record) of rows (page_id, url, html); shards not yet cut by bytes."""
    body = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END), body,
    )
    unnamed = max(1, -(-pages.where("page_id IS NULL").count() // shard_records))
    dealt = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(unnamed))
    shard = F.coalesce(F.floor(F.col("page_id") / shard_records), dealt).cast("long")
    return pages.select(shard.alias("shard"), "page_id", head.alias("record"))


def cut_by_bytes(rows: DataFrame) -> DataFrame:
    """Rows in file order, each shard cut into numbered ones wherever it reaches SHARD_BYTES."""
    size = F.octet_length("record") + len(END)
    before = Window.partitionBy("shard").orderBy("page_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0))
    part = F.least(F.floor(begin / SHARD_BYTES), F.lit(CUTS - 1))
    return rows.withColumn("tie", F.xxhash64("record")).withColumn("shard", F.col("shard") * CUTS + part)


def write(rows: DataFrame, path: str, copies: int = 1, damage=lambda record, copy: record) -> None:
    """Replicas of one compressed file a shard, records in order of ids; what is damaged is for tests.

    The window that cuts the shards has dealt and sorted the rows by shard already.
    """
    each = cut_by_bytes(rows).withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    each.sortWithinPartitions("replica", "shard", "page_id", "tie").select(
        "replica", "shard", damage(F.col("record"), F.col("replica")).alias("value")
    ).write.partitionBy("replica", "shard").option("lineSep", END).option("compression", "gzip").text(path)


def unpacked(content: bytes) -> bytes:
    """What can be read of a gzip file, up to the first damage."""
    out, rest = [], content
    while rest:
        reader = zlib.decompressobj(wbits=31)
        try:
            for at in range(0, len(rest), CHUNK):
                before, chunk = reader.copy(), rest[at : at + CHUNK]
                out.append(reader.decompress(chunk))
        except zlib.error:
            try:  # byte by byte, up to the one that is wrong
                for at in range(len(chunk)):
                    out.append(before.decompress(chunk[at : at + 1]))
            except zlib.error:
                pass
            break
        rest = reader.unused_data
    return b"".join(out)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Files as they are stored; one that the file system itself finds corrupt counts as lacking."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").option("ignoreCorruptFiles", "true")
    return files.load(path).select(F.col("shard").cast("long").alias("shard"), "content")


def cut(content: bytes) -> list[tuple[int, int]]:
    """Offset ranges of a file's records; what is no record ends the list as one range."""
    ranges, at = [], 0
    while at < len(content):
        blank = content.find(END.encode(), at)
        found = _LENGTH.search(content, at, blank) if blank >= 0 else None
        end = blank + 2 * len(END) + int(found[1]) if found else len(content)
        end = min(end, len(content))
        ranges.append((at, end))
        at = end
    return ranges


def _leaf_rows(shard: int, content: bytes, ranges: list[tuple[int, int]]) -> list[tuple]:
    if ranges and ranges[-1][1] < len(content):
        ranges = [*ranges, (ranges[-1][1], len(content))]
    rows = []
    for leaf, (begin, end) in enumerate(ranges):
        record = content[begin:end]
        name = _NAME.search(record, 0, max(0, record.find(END.encode())))
        text = name[1].decode("utf-8", "replace") if name else None
        rows.append((shard, leaf, begin, end, hashlib.sha256(record).hexdigest(), text))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
    return pa.record_batch(arrays, names=["shard", "leaf", "begin", "end", "hash", "name"])


def leaves(spark: SparkSession, path: str) -> DataFrame:
    """Hash, offset range and name of each record of each file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0), batch.column(1), strict=True):
                raw = unpacked(content.as_py())
                yield _batch(_leaf_rows(shard.as_py(), raw, cut(raw)))

    return _files(spark, path).mapInArrow(work, LEAVES)


def leaves_at(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """The same for a replica, at the ranges of known leaves.

    Where a file's own cuts are those ranges it is done; only the other files are read once more,
    and the ranges of each travel with it.
    """
    own = stored(leaves(spark, path))

    def ranges_of(of: DataFrame) -> DataFrame:
        place = F.xxhash64("leaf", "begin", "end")
        return of.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(place).alias("x"), F.max("end").alias("size"))

    same = ranges_of(known).intersect(ranges_of(own)).select("shard")
    moved = stored(known.join(same, "shard", "left_anti").groupBy("shard").agg(
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("ranges")
    ))
    if moved.isEmpty():
        return own

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content, ranges in zip(*batch.columns, strict=True):
                at = [(r["begin"], r["end"]) for r in ranges.as_py()]
                yield _batch(_leaf_rows(shard.as_py(), unpacked(content.as_py()), at))

    again = _files(spark, path).join(moved, "shard").select("shard", "content", "ranges").mapInArrow(work, LEAVES)
    return own.join(moved.select("shard"), "shard", "left_anti").unionByName(again)


def tree(of: DataFrame) -> DataFrame:
    """All nodes over the leaves of each file, level 0 being the leaves; the root's level depends on the file."""
    level = of.select("shard", F.lit(0).alias("level"), F.col("leaf").alias("node"), "begin", "end", "hash")
    nodes, number = level, 0
    while True:
        child = F.struct("node", F.col("begin"), F.col("end"), "hash")
        level = (
            level.groupBy("shard", F.floor(F.col("node") / FAN).alias("node"))
            .agg(
                F.min("begin").alias("begin"), F.max("end").alias("end"),
                F.array_sort(F.collect_list(child)).alias("children"), F.count(F.lit(1)).alias("n"),
            )
            .withColumn("hash", F.sha2(F.concat_ws(",", F.transform("children", lambda c: F.concat_ws(
                ":", c["begin"].cast("string"), c["end"].cast("string"), c["hash"]
            ))), 256))
        )
        number += 1
        level = stored(level.select("shard", F.lit(number).alias("level"), "node", "begin", "end", "hash"))
        nodes = nodes.union(level)
        if level.where("node > 0").isEmpty():
            return stored(nodes)


def audit(good: DataFrame, other: DataFrame) -> DataFrame:
    """Damaged leaves (shard, leaf, begin, end) of another replica, found from the roots downwards."""
    top = max((t.agg(F.max("level")).first()[0] or 0) for t in (good, other))
    keys, suspects = ["shard", "node"], None
    for level in range(top, -1, -1):
        mine, theirs = (t.where(F.col("level") == level).drop("level") for t in (good, other))
        if suspects is not None:
            parents = suspects.select("shard", F.col("node").alias("parent"))
            mine, theirs = (
                t.withColumn("parent", F.floor(F.col("node") / FAN)).join(parents, ["shard", "parent"], "left_semi").drop("parent")
                for t in (mine, theirs)
            )
        both = mine.join(theirs.select(*keys, F.col("begin").alias("b"), F.col("end").alias("e"), F.col("hash").alias("h")), keys, "full")
        differ = ~(F.col("hash").eqNullSafe(F.col("h")) & F.col("begin").eqNullSafe(F.col("b")) & F.col("end").eqNullSafe(F.col("e")))
        suspects = stored(both.where(differ).select(*keys, F.coalesce("begin", "b").alias("begin"), F.coalesce("end", "e").alias("end")))
    return suspects.withColumnRenamed("node", "leaf")


#: In the query's second replica, a digit of the date of every so many records has flipped.
ROTTEN, ROT = 101, 7


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, and whether the audit finds it damaged in a replica with known rot."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    sound = records(pages)

    def damage(record: F.Column, copy: F.Column) -> F.Column:
        rots = (copy == 1) & (F.col("page_id") % ROTTEN == ROT)
        return F.when(rots, F.replace(record, F.lit("Date: 1970"), F.lit("Date: 1971"))).otherwise(record)

    path = scratch_dir(spark) + "/warc"
    write(sound, path, 2, damage)
    known = stored(leaves(spark, f"{path}/replica=0"))
    found = audit(tree(known), tree(stored(leaves_at(spark, f"{path}/replica=1", known))))
    return known.join(found.select("shard", "leaf", F.lit(True).alias("hit")), ["shard", "leaf"], "left").select(
        F.expr(f"try_cast(name AS {pages.schema['page_id'].dataType.simpleString()})").alias("page_id"),
        "shard", F.col("begin").alias("offset"), (F.col("end") - F.col("begin")).alias("length"),
        F.col("hash").alias("record_sha256"), F.coalesce("hit", F.lit(False)).alias("damaged"),
    )


ORACLE = rf"""
WITH r AS (
    SELECT page_id, CAST(floor(page_id / {SHARD_RECORDS}) AS BIGINT) AS base,
           'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e
           || 'WARC-Date: 1970-01-01T00:00:00Z' || e || 'WARC-Target-URI: ' || coalesce(url, '') || e
           || 'Content-Type: text/html' || e || 'Content-Length: ' || strlen(coalesce(html, '')) || e || e
           || coalesce(html, '') || e || e AS record
    FROM pages, (SELECT chr(13) || chr(10) AS e)
)
SELECT page_id, shard,
       CAST(sum(strlen(record)) OVER (PARTITION BY shard ORDER BY page_id) - strlen(record) AS BIGINT) AS "offset",
       CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS record_sha256,
       page_id % {ROTTEN} = {ROT} AS damaged
FROM (
    SELECT page_id, record, CAST(base * {CUTS} + floor(
      (sum(strlen(record)) OVER (PARTITION BY base ORDER BY page_id) - strlen(record)) / {SHARD_BYTES}) AS BIGINT) AS shard
    FROM r)
"""
