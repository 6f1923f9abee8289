"""Hard negatives of embeddings, by Four-Russians scoring on exact integer vectors.

A vector is kept as the bit planes of its components in two's complement, each plane packed into a
byte for every eight dimensions. An anchor has a table for each eight dimensions: the sums of all
256 subsets of its components there. A candidate's byte looks its subset up; look-ups of a plane are
added, planes are shifted and added, and the result is the exact inner product.

Candidates are dealt into slabs and anchors into groups, both of bounded size; each pair of them is
a cell, one stream of rows in which the anchors come first. Of a cell only the best rows of each
anchor leave, so what is shuffled afterwards grows with anchors times slabs. The first pass scores
rows of the anchor's own label and finds its positives, the second one all other rows.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part. Rows without an id take part as candidates and come last among ties; an anchor needs an id.
Repeated rows are rows of their own: a copy of an anchor is one of its positives. A shorter vector
counts as filled up with zeros; an empty one scores 0. Components beyond 64 bits are cut off there, and scores
wrap as 64-bit integers do. Anchors without a positive, or without a row in the band, give no row;
an empty table gives an empty result; other columns are ignored. Labels and ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfield.llm.common import stored, table

#: Dimensions of a table, and its entries.
GROUP, SUBSETS = 8, 256

#: Anchors of a cell, about, and at most so many candidates; fewer where the cluster has cores to spare.
CELL_ANCHORS, CELL_ROWS, LEAST_ROWS = 4096, 1 << 18, 1024

#: Anchors whose tables are open at once, and candidates that look them up together.
OPEN_ANCHORS, LOOKUP_ROWS = 128, 1024

#: Tasks of a pass at most; a task works through its cells one after the other.
MOST_TASKS = 50_000

_LEAST = np.iinfo(np.int64).min
_FOUND = "anchor_row long, anchor_id long, band long, score long, id long, row long"


def planes_of(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, planes, bytes) of an integer matrix, the sign's plane first."""
    shifts = np.arange(bits - 1, -1, -1, dtype=np.int64)
    return np.packbits((values[:, None, :] >> shifts[:, None]) & 1, axis=2, bitorder="little")


def values_of(planes: np.ndarray) -> np.ndarray:
    """The integer matrix of bit planes."""
    bits = np.unpackbits(planes, axis=2, bitorder="little")
    total = -bits[:, 0].astype(np.int64)
    for plane in range(1, bits.shape[1]):
        total = 2 * total + bits[:, plane]
    return total


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(tables, 256, anchors): the sum of every subset of eight components."""
    parts = anchors.T.reshape(-1, GROUP, len(anchors)).astype(kind)
    sums = np.zeros((len(parts), SUBSETS, len(anchors)), kind)
    for bit in range(GROUP):
        size = 1 << bit
        sums[:, size : 2 * size] = sums[:, :size] + parts[:, bit : bit + 1]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchors, rows): exact inner products by look-ups."""
    out = np.empty((len(planes), sums.shape[2]), sums.dtype)
    for at in range(0, len(planes), LOOKUP_ROWS):
        some = planes[at : at + LOOKUP_ROWS]
        total = out[at : at + LOOKUP_ROWS]
        for plane in range(planes.shape[1]):
            part = np.zeros_like(total) if not len(sums) else sums[0][some[:, plane, 0]]
            for place in range(1, len(sums)):
                part += sums[place][some[:, plane, place]]
            if plane:
                total += total
                total += part
            else:
                np.negative(part, out=total)
    return np.ascontiguousarray(out.T)


def _score_type(bits: int, dims: int) -> type:
    """The smallest integer that holds every score, or 64 bits, which wrap."""
    return np.int32 if dims << (2 * bits - 2) < 1 << 31 else np.int64


class Ranked:
    """Rows of each anchor by falling score; of equal scores the earlier row comes first."""

    def __init__(self, found: np.ndarray, allowed: np.ndarray, bound: int):
        self.n = found.shape[1]
        self.shift = self.n.bit_length()
        if bound < 1 << (62 - self.shift):  # score and place in one number sort fastest
            keys = (found.astype(np.int64) << self.shift) + np.arange(self.n - 1, -1, -1)
            keys[~allowed] = _LEAST
            keys.sort(axis=1)
            self.valid = allowed.sum(axis=1)
            self.scores = (keys >> self.shift)[:, ::-1]
            self.places = (self.n - 1 - (keys & ((1 << self.shift) - 1)))[:, ::-1]
        else:
            self.places = np.lexsort((~found.astype(np.int64), ~allowed), axis=1)
            self.scores = np.take_along_axis(found, self.places, axis=1).astype(np.int64)
            self.valid = allowed.sum(axis=1)

    def best(self, anchor: int, most: int, low: int | None = None, high: int | None = None) -> slice:
        """The first rows of an anchor inside a band."""
        mine = self.scores[anchor, : self.valid[anchor]][::-1]
        begin = 0 if high is None else len(mine) - int(np.searchsorted(mine, high, side="right"))
        end = len(mine) if low is None else len(mine) - int(np.searchsorted(mine, low, side="left"))
        return slice(begin, min(begin + most, max(begin, end)))


class Cell:
    """A group of anchors; rows pass by, and the best of each anchor and band are remembered."""

    def __init__(self, rows: dict, same_label: bool, most: int, percent: tuple[int, int]):
        order = np.argsort(rows["label"], kind="stable")
        self.row, self.id, self.label = (rows[k][order] for k in ("row", "id", "label"))
        self.values = values_of(rows["planes"][order])
        self.same_label, self.most, self.bits = same_label, most, rows["planes"].shape[1]
        bands = [rows["bands"][i] or [] for i in order.tolist()]
        self.bands = [[None]] * len(order) if same_label else bands
        self.percent = percent
        self.kept: dict[tuple[int, int], tuple] = {}

    def _limits(self, band: int | None) -> tuple[int | None, int | None]:
        if band is None:
            return None, None
        low, high = self.percent
        return -(-low * band // 100), high * band // 100

    def see(self, rows: dict) -> None:
        if self.same_label:
            order = np.argsort(rows["label"], kind="stable")
            labels, begins = np.unique(rows["label"][order], return_index=True)
            ends = np.append(begins[1:], len(order))
            for label, begin, end in zip(labels, begins, ends, strict=True):
                first, last = np.searchsorted(self.label, label), np.searchsorted(self.label, label, side="right")
                for at in range(first, last, OPEN_ANCHORS):
                    self._score(at, min(at + OPEN_ANCHORS, last), rows, order[begin:end])
        else:
            everything = np.arange(len(rows["row"]))
            for at in range(0, len(self.row), OPEN_ANCHORS):
                self._score(at, min(at + OPEN_ANCHORS, len(self.row)), rows, everything)

    def _score(self, first: int, last: int, rows: dict, chosen: np.ndarray) -> None:
        kind = _score_type(self.bits, self.values.shape[1])
        found = scores(subset_sums(self.values[first:last], kind), rows["planes"][chosen])
        if self.same_label:
            allowed = self.row[first:last, None] != rows["row"][chosen]
        else:
            allowed = self.label[first:last, None] != rows["label"][chosen]
        ranked = Ranked(found, allowed, self.values.shape[1] << (2 * self.bits - 2))
        for anchor in range(first, last):
            for slot, band in enumerate(self.bands[anchor]):
                part = ranked.best(anchor - first, self.most, *self._limits(band))
                if part.stop > part.start:
                    places = chosen[ranked.places[anchor - first, part]]
                    self._keep((anchor, slot), ranked.scores[anchor - first, part], places, rows)

    def _keep(self, key: tuple[int, int], found: np.ndarray, places: np.ndarray, rows: dict) -> None:
        new = found, rows["id"][places], rows["row"][places]
        if key in self.kept:  # rows seen earlier win ties: a cell's rows come by id
            old = self.kept[key]
            if len(old[0]) == self.most and old[0][-1] >= found[0]:
                return
            new = tuple(np.concatenate([a, b]) for a, b in zip(old, new, strict=True))
            order = np.argsort(~new[0], kind="stable")[: self.most]
            new = tuple(column[order] for column in new)
        self.kept[key] = new

    def result(self) -> pa.RecordBatch:
        keys = sorted(self.kept)
        sizes = [len(self.kept[key][0]) for key in keys]
        anchors = np.repeat(np.array([a for a, _ in keys], np.int64), sizes)
        bands = [self.bands[a][slot] for (a, slot), size in zip(keys, sizes, strict=True) for _ in range(size)]
        empty = [np.zeros(0, np.int64), np.ma.zeros(0, np.int64), np.zeros(0, np.int64)]
        parts = [np.ma.concatenate([empty[i], *(self.kept[key][i] for key in keys)]) for i in range(3)]
        columns = [
            pa.array(self.row[anchors]), _nullable(self.id[anchors]), pa.array(bands, pa.int64()),
            pa.array(np.asarray(parts[0])), _nullable(parts[1]), pa.array(np.asarray(parts[2])),
        ]
        return pa.record_batch(columns, names=["anchor_row", "anchor_id", "band", "score", "id", "row"])


def _nullable(column: np.ndarray) -> pa.Array:
    return pa.array(np.ma.getdata(column), mask=np.ma.getmaskarray(column))


def _arrays(batch: pa.RecordBatch, bits: int, width: int) -> dict:
    """Columns of a batch as arrays; ids are masked where they are null."""
    ids = batch.column(batch.schema.get_field_index("id"))
    masked = np.ma.array(ids.fill_null(0).to_numpy(), mask=ids.is_null().to_numpy(zero_copy_only=False))
    raw = b"".join(batch.column(batch.schema.get_field_index("planes")).to_pylist())
    plain = {k: batch.column(batch.schema.get_field_index(k)).to_numpy() for k in ("row", "label")}
    return {
        **plain, "id": masked, "planes": np.frombuffer(raw, np.uint8).reshape(batch.num_rows, bits, width),
        "bands": batch.column(batch.schema.get_field_index("bands")).to_pylist(),
    }


def _worker(bits: int, width: int, same_label: bool, most: int, percent: tuple[int, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, waiting, cell = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(batch.schema.get_field_index("cell")).to_numpy()
            query = batch.column(batch.schema.get_field_index("is_query")).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((cells[1:] != cells[:-1]) | (query[1:] != query[:-1])) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                part = batch.slice(begin, end - begin)
                if cells[begin] != place:
                    if cell:
                        yield cell.result()
                    place, waiting, cell = cells[begin], [], None
                if query[begin]:
                    waiting.append(part)
                elif waiting or cell:
                    if waiting:
                        anchors = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                        cell, waiting = Cell(_arrays(anchors, bits, width), same_label, most, percent), []
                    cell.see(_arrays(part, bits, width))
        if cell:
            yield cell.result()

    return work


def _packed(rows: DataFrame, bits: int, width: int) -> DataFrame:
    """Rows with their bit planes instead of their vectors."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(4)
            lengths = vectors.value_lengths().to_numpy()
            values = np.zeros((batch.num_rows, width * GROUP), np.int64)
            inside = np.arange(width * GROUP) < lengths[:, None]
            values[inside] = vectors.flatten().to_numpy()
            packed = [p.tobytes() for p in planes_of(values, bits)]
            yield pa.record_batch([*batch.columns[:4], pa.array(packed, pa.binary())], names=[*batch.schema.names[:4], "planes"])

    return rows.mapInArrow(work, "row long, id long, label long, is_anchor boolean, planes binary")


def _best(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    vectors: DataFrame, is_anchor: F.Column, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str | F.Column = "label", scale: float = 256, positives: int = 5, negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
) -> DataFrame:
    """Negatives of each anchor and positive: rows of other labels inside a band of the positive's score."""
    spark = vectors.sparkSession
    real = F.col(vector_col).cast("array<double>")
    finite = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = (
        vectors.where(F.col(vector_col).isNotNull() & finite)
        .select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
            F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.transform(real, lambda x: F.floor(x * scale)).alias("vector"),
        )
        .where("label IS NOT NULL")
    )
    reach = F.greatest(F.array_max("vector"), F.bitwise_not(F.array_min("vector")))
    known = rows.agg(
        F.count("*").alias("rows"), F.count_if(F.col("is_anchor") & F.col("id").isNotNull()).alias("anchors"),
        F.max(F.size("vector")).alias("dims"), F.max(reach).alias("reach"),
    ).first()
    bits, width = (known["reach"] or 0).bit_length() + 1, max(1, -(-(known["dims"] or 0) // GROUP))
    spread = max(LEAST_ROWS, known["rows"] // (2 * spark.sparkContext.defaultParallelism))
    slabs = max(1, -(-known["rows"] // min(CELL_ROWS, spread)))
    groups = max(1, -(-known["anchors"] // CELL_ANCHORS))
    packed = stored(_packed(rows, bits, width))

    def dealt(column: str, parts: int) -> F.Column:
        return F.pmod(F.xxhash64("row", F.lit(column)), F.lit(parts))

    def every(parts: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    def scored(queries: DataFrame, same_label: bool, most: int) -> DataFrame:
        """The best rows of each cell."""
        columns = ["row", "id", "label", "planes", "bands"]
        bands = F.lit(None).cast("array<long>").alias("bands")
        asked = queries.select(*columns, dealt("group", groups).alias("g"), every(slabs).alias("s"), F.lit(True).alias("is_query"))
        given = packed.select(*columns[:4], bands, every(groups).alias("g"), dealt("slab", slabs).alias("s"), F.lit(False).alias("is_query"))
        tasks = min(groups * slabs, MOST_TASKS)
        cells = asked.unionByName(given).withColumn("cell", F.col("g") * slabs + F.col("s"))
        return (
            cells.repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int"))
            .sortWithinPartitions("cell", F.desc("is_query"), F.asc_nulls_last("id"), "row")
            .mapInArrow(_worker(bits, width, same_label, most, percent), _FOUND)
        )

    anchors = packed.where("is_anchor AND id IS NOT NULL")
    no_bands = anchors.withColumn("bands", F.lit(None).cast("array<long>"))
    near = stored(_best(scored(no_bands, True, positives), ["anchor_row"], positives))
    asked = near.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_set("score")).alias("bands"))
    far = _best(scored(anchors.join(asked, "row"), False, negatives), ["anchor_row", "band"], negatives)
    pairs = near.select("anchor_row", F.col("score").alias("band"), F.col("id").alias("positive_id"))
    return far.join(pairs, ["anchor_row", "band"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        F.col("band").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % 100 == 0, label_col=moved)


ORACLE = """
WITH marked AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM marked a JOIN marked b ON a.r <> b.r
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n
  ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""
