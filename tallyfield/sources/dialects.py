"""Rank files in whatever text dialect: the encoding and the delimiter of each file found first.

The text source hands over the bytes of a line as they are, so one pass over all files, an
aggregation by file, sees byte order marks, NULs, lines that are no UTF-8, and which delimiter the heading and
the lines use. Then files are read in parallel as ever, those in UTF-16 with their own line ends, and each
line becomes UTF-8 with tabs, which is what the rest of the reader takes.

* A byte order mark decides the encoding. Without one, a file with NULs is ``binary`` and left as it is
  (the reader takes it for unreadable); one whose lines are all UTF-8 is UTF-8; any other one is
  Windows-1252, in which every byte has a meaning.
* The delimiter is the one after the first rank heading; without a heading the one that most
  lines hold, in the order of DELIMITERS where lines are as many; tab if none occurs.
* Parts of UTF-16 that mean nothing (half a surrogate pair, half a unit) become U+FFFD or go.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.session import stored
from tallyfield.sources.rankfiles import FILE_GLOB

# --- fixed values: byte order marks, delimiters, and the bytes in which Windows-1252 is not Latin-1 ---
MARKS = {"FFFE": "UTF-16LE", "FEFF": "UTF-16BE"}
DELIMITERS = ("\t", ";", "|", ",")
WINDOWS_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
WINDOWS_TEXT = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
# --- end of fixed values ---

HEADING = r'(?i)^[^\x21-\x7E]*"?(?:rank|rk)"?[ ]*([\t;|,])'
#: A comma outside of quotes, and the like for each delimiter.
_OUTSIDE_QUOTES = '(?=(?:[^"]*+"[^"]*+")*+[^"]*+$)'


def _lines(spark: SparkSession, glob: str, paths: list[str], **options: str) -> DataFrame:
    """(file_name, file_path, split, at, bytes) of each line, ordered inside a split by ``at``."""
    return spark.read.options(pathGlobFilter=glob, **options).text(paths).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("bytes"),
    )


def sniff(lines: DataFrame) -> DataFrame:
    """(file_name, file_path, encoding, delimiter) of each file with lines, from its lines' bytes."""
    raw = F.col("bytes").cast("string")
    # NULs left out, the signs looked for are the same bytes in every encoding here.
    bare = F.replace(raw, F.lit("\0"), F.lit(""))
    heading = F.regexp_extract(bare, HEADING, 1)
    facts = lines.select(
        "file_name", "file_path", F.struct("split", "at").alias("place"), F.hex(F.substring("bytes", 1, 2)).alias("head"),
        (raw.contains("\0")).alias("nul"), F.is_valid_utf8(raw).alias("utf8"), F.nullif(heading, F.lit("")).alias("heading"),
        *[bare.contains(d).alias(f"has{i}") for i, d in enumerate(DELIMITERS)],
    )
    files = facts.groupBy("file_name", "file_path").agg(
        F.min_by("head", "place").alias("head"), F.max("nul").alias("nul"), F.min("utf8").alias("utf8"),
        F.min_by("heading", F.when(F.col("heading").isNotNull(), F.col("place"))).alias("heading"),
        *[F.count_if(f"has{i}").alias(f"n{i}") for i in range(len(DELIMITERS))],
    )
    encoding = F.when(F.col("nul"), "binary").when(F.col("utf8"), "UTF-8").otherwise("Windows-1252")
    for mark, name in MARKS.items():
        encoding = F.when(F.col("head") == mark, name).otherwise(encoding)
    most = F.array_max(F.array(*[F.struct(F.col(f"n{i}").alias("n"), F.lit(-i).alias("i")) for i in range(len(DELIMITERS))]))
    common = F.element_at(F.array(*[F.lit(d) for d in DELIMITERS]), 1 - most["i"])
    return files.select("file_name", "file_path", encoding.alias("encoding"), F.coalesce("heading", common).alias("delimiter"))


def utf16_text(data: Column, little: bool) -> Column:
    """Text of UTF-16 bytes; what is no text becomes U+FFFD, a last odd byte goes."""
    units = F.regexp_replace(F.hex(data), "(..)(..)", "$2$1 " if little else "$1$2 ")
    units = F.regexp_replace(units, " ..$", " ")  # the odd byte
    units = F.regexp_replace(units, "^..$", "")
    units = F.regexp_replace(units, "D[89AB].. (?!D[C-F])", "FFFD ")
    units = F.regexp_replace(units, "(?<!D[89AB].. )D[C-F].. ", "FFFD ")
    return F.decode(F.unhex(F.replace(units, F.lit(" "), F.lit(""))), "UTF-16BE")


def windows_text(data: Column) -> Column:
    """Text of Windows-1252 bytes; the five bytes it does not define stay control characters."""
    return F.translate(F.decode(data, "ISO-8859-1"), WINDOWS_BYTES, WINDOWS_TEXT)


def _tabbed(value: Column, delimiter: Column) -> Column:
    """Cells of a line joined by tabs; in files with another delimiter quotes hold cells together."""
    cell = r'^\s*"(.*)"\s*$'
    plain = F.translate(value, "\t", " ")
    split = F.lit(None).cast("array<string>")
    for d in DELIMITERS[1:]:
        split = F.when(delimiter == d, F.split(plain, f"[{d}]{_OUTSIDE_QUOTES}")).otherwise(split)
    own = F.transform(
        split, lambda c: F.when(c.rlike(cell), F.replace(F.regexp_extract(c, cell, 1), F.lit('""'), F.lit('"'))).otherwise(c)
    )
    return F.when(delimiter == "\t", value).otherwise(F.array_join(own, "\t"))


def read_lines(spark: SparkSession, folder: str, glob: str = FILE_GLOB) -> DataFrame:
    """(file_name, split, at, value) as the reader's own, of files in any dialect."""
    lines = _lines(spark, glob, [folder])
    found = stored(sniff(lines))
    own = found.select("file_path", "encoding", "delimiter")
    narrow = lines.join(own.where(~F.col("encoding").isin(*MARKS.values())), "file_path")
    text = F.when(F.col("encoding") == "Windows-1252", windows_text(F.col("bytes"))).otherwise(F.col("bytes").cast("string"))
    parts = [narrow.withColumn("value", text)]
    for name in MARKS.values():
        # Names of files, which the driver has listed to plan the first read.
        paths = sorted(unquote(r[0]) for r in found.where(F.col("encoding") == name).select("file_path").collect())
        if paths:
            wide = _lines(spark, "*", paths, encoding=name, lineSep="\n").join(own, "file_path")
            parts.append(wide.withColumn("value", utf16_text(F.col("bytes"), name == "UTF-16LE")))
    every = reduce(DataFrame.unionByName, parts)
    # Lines are joined by the file's few facts, not moved: the order inside a split is in ``at``.
    value = F.regexp_replace(_tabbed(F.col("value"), F.col("delimiter")), "\r$|^﻿", "")
    return every.select("file_name", "split", "at", value.alias("value"))
