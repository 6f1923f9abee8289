"""Yearly expert-ranking text files: discovery, line reading, header lookup.

The files carry an ``.xls`` name but hold tab-separated text: a few title lines, a header,
then one ranked player per line.  Header names and order change from year to year, so all
files go through one plan that finds each file's header and maps columns by it.

Line order matters (a blank rank means "the next one").  Spark's text source gives no line
numbers, but within one file split rows arrive in order, so (split start, position in split)
orders a file's lines without reading a file as one value; windows below never span more
than one split.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfield.functions.names import clean_player_name, clean_position
from tallyfield.functions.typing import strip, to_double
from tallyfield.operators.ranking import rank_within

# --- fixed values: file naming, layout and header spellings ---
FILE_GLOB = "FantasyPros_*.xl*"
YEAR_IN_NAME = r"(\d{4})"
EARLY_MARK = "prepreseason"
TITLE_LINES = 4
BINARY_SUFFIX = ".xlsx"
HEADER_LINE = r"(?i)^\s*(rank|rk)\s*\t"
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
HEADER_ALIASES = {
    "player name": "player_name",
    "overall (team)": "player_name",
    "player": "player_name",
    "player (team)": "player_name",
    "pos": "position",
    "position": "position",
    "rk": "rank",
    "rank": "rank",
    "best": "best_rank",
    "best rank": "best_rank",
    "worst": "worst_rank",
    "worst rank": "worst_rank",
    "avg.": "avg_rank",
    "avg": "avg_rank",
    "average": "avg_rank",
    "ave rank": "avg_rank",
    "std.dev": "stddev_rank",
    "std dev": "stddev_rank",
    "stddev": "stddev_rank",
    "standard deviation": "stddev_rank",
    "adp": "adp",
    "ecr vs. adp": "vs_adp",
    "vs. adp": "vs_adp",
    "vs adp": "vs_adp",
    "versus adp": "vs_adp",
}
# --- end of fixed values ---

#: Spelling used by two of the yearly files; without it their average rank is lost.
EXTRA_ALIASES = {"avg rank": "avg_rank"}

CELLS = (
    "rank", "player_name", "position", "best_rank", "worst_rank", "avg_rank", "stddev_rank", "adp", "vs_adp",
)


def read_lines(spark: SparkSession, folder: str, glob: str = FILE_GLOB) -> DataFrame:
    """Lines of all rank files: (file_name, split, at, value); ``at`` orders lines in a split."""
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(folder)
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("at"),
            F.regexp_replace("value", "\r$", "").alias("value"),
        )
    )


def list_files(spark: SparkSession, folder: str, glob: str = FILE_GLOB) -> DataFrame:
    """Names of the rank files, empty ones too (a scan skips those); contents are not read."""
    paths = spark.read.option("pathGlobFilter", glob).text(folder).inputFiles()
    names = sorted((unquote(p.rsplit("/", 1)[-1]),) for p in paths)
    return spark.createDataFrame(names, "file_name string")


def file_year(name: Column) -> Column:
    """First four digits of the file name; NULL if there are none."""
    return F.regexp_extract(name, YEAR_IN_NAME, 1).try_cast("int")


def is_early(name: Column) -> Column:
    """Is it the list made before the preseason?"""
    return F.lower(name).contains(EARLY_MARK)


def _number_lines(lines: DataFrame) -> DataFrame:
    """Running counts inside each split: line_no, and filled_no without blank lines.

    One window over (file, split); a split is bounded by spark.sql.files.maxPartitionBytes.
    Everything below builds on this frame, so its shuffle is made once and reused.
    """
    upto = Window.partitionBy("file_name", "split").orderBy("at")
    filled = (F.trim("value") != "").cast("int")
    return lines.select(
        "file_name", "split", "value",
        F.row_number().over(upto).alias("line_no"),
        F.sum(filled).over(upto.rowsBetween(Window.unboundedPreceding, 0)).alias("filled_no"),
    )


def _layout(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where each readable file's header is, and how many filled lines precede each split.

    The header is the first line that starts with a rank heading, else the first filled line
    after the titles, if that holds a tab; a file with neither is not readable, nor is a binary
    one (a NUL anywhere, or a workbook's name).  One hash aggregation; what follows has a row per
    split or file.
    """
    titled = F.col("value").rlike(HEADER_LINE)
    after_titles = (F.trim("value") != "") & ((F.col("split") > 0) | (F.col("line_no") > TITLE_LINES))
    line = F.struct("line_no", "filled_no", F.col("value").contains("\t").alias("tab"))

    splits = numbered.groupBy("file_name", "split").agg(
        F.max("filled_no").alias("_filled"),
        F.max(F.col("value").contains("\0")).alias("_binary"),
        F.min(F.when(titled, line)).alias("_titled"),
        F.min(F.when(after_titles, line)).alias("_after"),
    )
    earlier = Window.partitionBy("file_name").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_filled").over(earlier), F.lit(0)))

    def place(found: str) -> Column:
        at = F.struct(
            "split", F.col(found)["line_no"].alias("line_no"),
            (F.col("_before") + F.col(found)["filled_no"]).alias("filled"), F.col(found)["tab"].alias("tab"),
        )
        return F.min(F.when(F.col(found).isNotNull(), at))

    headers = (
        splits.groupBy("file_name")
        .agg(F.coalesce(place("_titled"), place("_after")).alias("header"), F.max("_binary").alias("_binary"))
        .where(F.col("header.tab") & ~F.col("_binary"))
        .where(~F.lower("file_name").endswith(BINARY_SUFFIX))
        .select("file_name", "header.split", "header.line_no", "header.filled")
    )
    return headers, splits.select("file_name", "split", "_before")


def _header_positions(header: Column, aliases: dict[str, str]) -> list[Column]:
    """For each cell name its index in the header (-1 where absent)."""
    known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    named = F.transform(
        F.split(header, "\t"),
        lambda h: F.coalesce(F.element_at(known, strip(F.lower(h))), strip(F.lower(h))),
    )
    return [(F.array_position(named, c) - 1).cast("int").alias(f"_i_{c}") for c in CELLS]


def parse_rows(lines: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Data lines split into text cells by each file's own header.

    Returns file_name, row_no (1-based, blank lines not counted), has_adp and the cells as
    text, NULL where missing.
    """
    aliases = {**HEADER_ALIASES, **EXTRA_ALIASES} if aliases is None else aliases
    numbered = _number_lines(lines)
    headers, splits = _layout(numbered)
    columns = headers.join(numbered, ["file_name", "split", "line_no"]).select(
        "file_name", "filled", *_header_positions(F.col("value"), aliases)
    )
    # One row per split, so that the lines join by (file, split): they already lie that way,
    # and no file, however large, is one join key.
    data = (
        numbered.where(F.trim("value") != "")
        .join(splits.join(columns, "file_name"), ["file_name", "split"])
        .withColumn("row_no", (F.col("_before") + F.col("filled_no") - F.col("filled")).cast("bigint"))
        .where(F.col("row_no") > 0)
    )
    # One step each, so that a line is split once and a cell is trimmed once.
    parts = data.withColumn("_parts", F.split("value", "\t"))
    texts = parts.select(
        "file_name", "row_no", (F.col("_i_adp") >= 0).alias("has_adp"),
        *[F.expr(f"CASE WHEN _i_{c} >= 0 THEN get(_parts, _i_{c}) END").alias(c) for c in CELLS],
    )
    missing = ", ".join(f"'{m}'" for m in MISSING_TEXTS)
    return texts.select(
        "file_name", "row_no", "has_adp",
        *[F.expr(f"CASE WHEN trim({c}) NOT IN ({missing}) THEN {c} END").alias(c) for c in CELLS],
    )


def normalise_rows(rows: DataFrame, *, keep_generation: bool = False) -> DataFrame:
    """Cells to typed ranking columns, with position ranks; rows without a name leave last.

    Files whose name holds no year are left out (see :func:`rejected_files`).
    """
    rank = F.coalesce(to_double("rank"), F.col("row_no").cast("double"))
    vs_adp = to_double("vs_adp")
    typed = rows.select(
        "file_name",
        file_year(F.col("file_name")).alias("year"),
        is_early(F.col("file_name")).alias("before_preseason"),
        clean_player_name(F.col("player_name"), keep_generation=keep_generation).alias("player_name"),
        clean_position(F.col("position")).alias("position"),
        rank.alias("rank"),
        *[to_double(c).alias(c) for c in ("best_rank", "worst_rank", "avg_rank", "stddev_rank")],
        F.when(F.col("has_adp"), to_double("adp")).otherwise(rank - vs_adp).alias("adp"),
        vs_adp.alias("vs_adp"),
    ).where(F.col("year").isNotNull())
    ranked = rank_within(
        typed, ["file_name", "position"], {"position_rank": F.col("rank")},
        method="dense_rank", descending=False,
    )
    return ranked.where(~strip(F.col("player_name")).isin("", "nan"))


def read_rankings(spark: SparkSession, folder: str, glob: str = FILE_GLOB, *, sniff: bool = False, **options) -> DataFrame:
    """All rank files of a folder as one typed frame (file_name first).

    Files are UTF-8 with tabs; ``sniff`` finds each file's own encoding and delimiter first, by one more pass.
    """
    if sniff:
        from tallyfield.sources import dialects

        return normalise_rows(parse_rows(dialects.read_lines(spark, folder, glob)), **options)
    return normalise_rows(parse_rows(read_lines(spark, folder, glob)), **options)


def file_report(files: DataFrame, rankings: DataFrame) -> DataFrame:
    """Rows read per file; a file that gave none counts as failed."""
    counts = rankings.groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"))
    n = F.coalesce("row_count", F.lit(0))
    return files.join(counts, "file_name", "left").select(
        "file_name", n.alias("row_count"), F.when(n > 0, "processed").otherwise("failed").alias("status")
    )


def rejected_files(files: DataFrame) -> DataFrame:
    """Files that cannot be placed: no year in the name."""
    return files.where(file_year(F.col("file_name")).isNull())
