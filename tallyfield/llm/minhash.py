"""Near-duplicates by min-max hashing.

A text's set of 5-word shingles is hashed by 120 permutations, and each gives two values of the
signature, its minimum and its maximum: 240 values for 120 evaluations, cut into 48 bands of 5.
Two sets of similarity 0.75 agree in no band with a chance of about 2 in a million.

Texts of equal sets are one class, represented by its row of the smallest id and numbered. A row is
known by its id and its text's hash, so rows of one id and different texts are different documents.
Representatives that share a band are compared without forming all pairs of a bucket: first each
with the bucket's smallest number, if their signatures agree enough; what is linked then forms components. Only buckets that
still hold several components are looked at again, in blocks of bounded size: there the full sets
of different components are compared, and only links that join components come out. Every link is
confirmed on the full shingle sets.

Defined results: null texts and texts without words have no shingle and are linked with nothing.
Rows without an id take part through equal sets only: they belong to the smallest id of their
class's component, or stay without one. Rows of one id and different texts each have the component
of their own text; where several rows share the smallest id, ``leads`` names one text. Repeated rows give the same result each. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm.common import stored, table
from tallyfield.llm.components import connected_components
from tallyfield.llm.shingles import mixed, shingles

PERMUTATIONS, BAND_ROWS, SEED = 120, 5, 7

#: Similarity that links, in hundredths.
THRESHOLD = 75

#: Share of agreeing signature values below which a pair is not confirmed: six standard errors under the threshold.
LEAST_AGREEMENT = 0.57

#: Documents of a block; a task holds two at most.
BLOCK = 512

#: Rows of the matrix that is hashed at once.
CHUNK = 512


def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    times = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
    in_band = rng.integers(0, 1 << 63, (2 * PERMUTATIONS // BAND_ROWS, BAND_ROWS), dtype=np.uint64) * np.uint64(2)
    return times, plus, in_band + np.uint64(1)


def signature(values: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """Minimum, then maximum, of each permutation over a set that is not empty."""
    least, most = None, None
    for at in range(0, len(values), CHUNK):
        hashed = values[at : at + CHUNK, None] * times + plus
        low, high = hashed.min(axis=0), hashed.max(axis=0)
        least = low if least is None else np.minimum(least, low)
        most = high if most is None else np.maximum(most, high)
    return np.concatenate([least, most])


SIGNED = "doc_id {id}, tie long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"


def _sign(id_type: pa.DataType):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, plus, in_band = _constants()
        for batch in batches:
            sizes, one, two, bands, signs = [], [], [], [], []
            for text in batch.column(1):
                values = shingles(text.as_py())
                sizes.append(len(values))
                if not len(values):
                    for column in (one, two, bands, signs):
                        column.append(None)
                    continue
                signs_of = signature(values, times, plus)
                keys = mixed((signs_of.reshape(-1, BAND_ROWS) * in_band).sum(axis=1, dtype=np.uint64))
                one.append(int(values.sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(np.bitwise_xor.reduce(mixed(values)).astype(np.int64)))
                bands.append(keys.astype(np.int64))
                signs.append(signs_of.astype(np.uint8).tobytes())
            yield pa.record_batch(
                [
                    batch.column(0).cast(id_type), batch.column(2), pa.array(sizes, pa.int64()),
                    pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary()),
                ],
                names=["doc_id", "tie", "n_shingles", "set_a", "set_b", "bands", "signature"],
            )

    return sign


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough values."""
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for i in (2, 3)
        )
        near = pa.array((left == right).mean(axis=1) >= LEAST_AGREEMENT)
        yield pa.record_batch(
            [batch.column(0).filter(near), batch.column(1).filter(near)],
            names=["a", "b"],
        )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough; rows come sorted by a, whose set is kept."""
    key, left = object(), None
    for batch in batches:
        linked = []
        for row in range(batch.num_rows):
            a = batch.column(0)[row].as_py()
            if a != key:
                key, left = a, shingles(batch.column(2)[row].as_py())
            right = shingles(batch.column(3)[row].as_py())
            common = len(np.intersect1d(left, right, assume_unique=True))
            linked.append(100 * common >= THRESHOLD * (len(left) + len(right) - common))
        linked = pa.array(linked, pa.bool_())
        yield pa.record_batch(
            [batch.column(0).filter(linked), batch.column(1).filter(linked)],
            names=["a", "b"],
        )


def _cluster_links(sets: list[np.ndarray], comp: np.ndarray, own: np.ndarray, two: bool) -> list[tuple[int, int]]:
    """Links that join different components: each set is compared with all later ones at once."""
    size = np.array([len(values) for values in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    root = np.unique(comp, return_inverse=True)[1]
    mark, out = np.zeros(int(place.max()) + 1, np.int32), []
    for at in range(len(sets) - 1):
        later = slice(at + 1, None)
        may = (root[later] != root[at]) & (
            100 * np.minimum(size[later], size[at]) >= THRESHOLD * np.maximum(size[later], size[at])
        )
        if two:
            may &= own[later] != own[at]
        if not may.any():
            continue
        mine = place[begin[at] : begin[at] + size[at]]
        mark[mine] = 1
        common = np.add.reduceat(mark[place[begin[at + 1] :]], begin[later] - begin[at + 1])
        mark[mine] = 0
        linked = may & (100 * common >= THRESHOLD * (size[later] + size[at] - common))
        for other in np.flatnonzero(linked) + at + 1:
            if root[other] != root[at]:
                out.append((at, int(other)))
                root[root == root[other]] = root[at]
    return out


def _block_links(members: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links inside the clusters (or between the two blocks of one) that a task holds."""
    out = []
    for _, cluster in members.groupby("cluster"):
        cluster = cluster.sort_values("rep", ignore_index=True)
        two = cluster["block_a"].iloc[0] != cluster["block_b"].iloc[0]
        sets = [shingles(text) for text in cluster["text"]]
        found = _cluster_links(sets, cluster["component"].to_numpy(), cluster["own"].to_numpy(), two)
        rep = cluster["rep"].to_numpy()
        out += [(rep[a], rep[b]) for a, b in found]
    return pd.DataFrame(out, columns=["a", "b"]).astype(members["rep"].dtype)


PAIR = "a long, b long"


class Linker:
    """Links between representatives, given their numbers, signatures and where their texts are."""

    def __init__(self, source: DataFrame, reps: DataFrame):
        self.source, self.reps = source, reps

    def alike(self, pairs: DataFrame) -> DataFrame:
        signs = self.reps.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
        joined = pairs.join(signs, "a").join(signs.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        return joined.mapInArrow(_agree, PAIR).distinct()

    def texts(self, wanted: DataFrame) -> DataFrame:
        """Texts of the numbers in the one column given; the texts' other rows move, but are not sorted."""
        wanted = stored(wanted.toDF("rep").distinct().join(self.reps.select("rep", "doc_id", "tie"), "rep"))
        return stored(self.source.join(wanted.hint("shuffle_hash"), ["doc_id", "tie"]).select("rep", "text"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the full sets confirm."""
        texts = self.texts(pairs.select("a").union(pairs.select("b")))
        joined = pairs.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a").select("a", "b", "ta", "tb")
        return stored(joined.mapInArrow(_confirm, PAIR).distinct())

    def left_over(self, members: DataFrame, parts: DataFrame) -> DataFrame:
        """Links that the stars missed, from buckets that still hold several components.

        Buckets with members in common are one cluster, so that a document's text goes to each
        pair of blocks once, however many bands it shares. Small clusters share tasks.
        """
        marked = stored(members.join(parts, members["rep"] == parts["node"], "left").select(
            "key", "pivot", "rep", F.coalesce("component", "rep").alias("component")
        ))
        mixed_keys = (
            marked.groupBy("key")
            .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
            .where("n > 2 AND low <> high")
            .select("key")
        )
        left = stored(marked.join(mixed_keys, "key").select("pivot", "rep", "component").distinct())
        clusters = stored(connected_components(left.select(F.col("pivot").alias("a"), F.col("rep").alias("b"))))
        nodes = stored(left.select("rep", "component").distinct().join(
            clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "rep"
        ))
        sizes = nodes.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
        tasks = max(1, nodes.count() // BLOCK)
        small = F.col("n") <= BLOCK
        dealt = (
            nodes.join(sizes, "cluster")
            .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "cluster", "rep", "component", "own",
                F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(-1).alias("task"),
                F.when(~small, F.col("cluster")).alias("alone"),
                F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"),
            )
        )
        texts = self.texts(nodes.select("rep"))
        work = dealt.join(texts, "rep").groupBy("task", "alone", "block_a", "block_b")
        return stored(work.applyInPandas(_block_links, PAIR).distinct())


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, leads) of each row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    kind = source.schema["doc_id"].dataType
    signed = source.mapInArrow(_sign(to_arrow_type(kind)), SIGNED.format(id=kind.simpleString()))
    signed = stored(signed.withColumn("row", F.monotonically_increasing_id()), "lz4")
    same, named = ["n_shingles", "set_a", "set_b"], F.struct("doc_id", "tie", "row")
    first = F.min(F.when(F.col("doc_id").isNotNull(), named)).alias("first")
    classes = stored(signed.where("n_shingles > 0").groupBy(*same).agg(first).select(*same, F.col("first.row").alias("rep"), "first"))
    reps = stored(
        signed.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select(
            F.col("row").alias("rep"), "doc_id", "tie", "bands", "signature"
        ), "lz4",
    )
    keys = reps.select("rep", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).where("pivot <> last")
    members = stored(keys.join(shared.select("key", "pivot"), "key"))
    linker = Linker(source, reps)
    stars = members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    tried = stored(linker.alike(stars))
    links = linker.confirmed(tried)
    parts = stored(connected_components(links))
    more = linker.left_over(members, parts)
    if not more.isEmpty():
        parts = stored(connected_components(links.union(more)))
    # Of a component the row of the smallest id leads; classes linked with nothing lead themselves.
    placed = classes.join(parts, classes["rep"] == parts["node"], "left").select(*same, "component", "first")
    linked = placed.where("component IS NOT NULL")
    leaders = linked.groupBy("component").agg(F.min("first").alias("leader"))
    of_class = linked.join(leaders, "component").select(*same, "leader").unionByName(
        placed.where("component IS NULL").select(*same, F.col("first").alias("leader"))
    )
    alone = F.col("n_shingles") == 0
    is_leader = F.col("doc_id").eqNullSafe(F.col("leader.doc_id")) & F.col("tie").eqNullSafe(F.col("leader.tie"))
    return signed.select("doc_id", "tie", *same).join(of_class, same, "left").select(
        "doc_id", "tie", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("component_id"),
        (alone | F.col("leader").isNull() | is_leader).alias("leads"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: the size of its set, its component, whether its id is the component's, and whether it leads."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return _grouped(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "leads")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that lead their components, with all their columns; rows without an id cannot be named and stay."""
    found = _grouped(docs, id_col, text_col).where("NOT leads AND doc_id IS NOT NULL")
    gone = stored(found.select(F.col("doc_id").alias("__near_id"), F.col("tie").alias("__near_tie")).distinct())
    same = (docs[id_col] == gone["__near_id"]) & (F.xxhash64(docs[text_col]) == gone["__near_tie"])
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
