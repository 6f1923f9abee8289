"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

Statistics are taken of many texts at once: a table gives every byte its class, and words, lines and
their hashes are sums over stretches of bytes. Trees grow from binned columns, one histogram for
the smaller child of a split and a subtraction for the other; they are flat arrays in the end, in
which all trees take a batch one level down at a time.

The trees learn from about TRAIN_ROWS labelled documents, chosen by a hash of their ids (all, if
there are fewer), of which every CHECK_SHARE-th only decides how many trees are kept.

Defined results: null and empty texts have no word and are scored by statistics of 0. Without labels
every score is 0.5; where labels are all alike it is their value. A document labelled more than once
counts as its worst label; an id on several rows teaches once, by the least of its statistics.
Repeated rows get the same score; rows without an id are scored, but teach nothing and are not held
out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm import histogram_trees
from tallyfield.llm.common import table
from tallyfield.llm.shingles import mixed

#: Labelled documents to learn from, about, and the share that is only used to choose the trees' number.
TRAIN_ROWS, CHECK_SHARE = 20_000, 8

#: Least score of a document that is predicted to be good.
LEAST_SCORE = 0.3

#: Bytes of text looked at together; a longer text is looked at alone.
SLICE_BYTES = 1 << 20

#: Classes of bytes.
CLASSES = {
    "space": b" \t\n\x0b\x0c\r", "line": b"\n", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)), "stop": b".?", "shout": b"!", "comma": b",;:", "mark": b"#*$%&|<>{}[]\\^~_=+@",
    "bar": b"|", "quote": b"\"'()", "more": bytes(range(0x80, 0xC0)), "wide": bytes(range(0xC0, 0x100)),
}

FEATURES = [
    "log_words", "word_length", "length_spread", "words_a_line", "same_as_last", "distinct", "commonest", "repeated_triples",
    "repeated_lines", "cap_words", "upper", "digit", "stop", "shout", "comma", "mark", "bar", "quote", "wide", "space",
    "longest",
]

_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))
_TRIPLE = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_IS = {name: np.isin(np.arange(256), np.frombuffer(some, np.uint8)) for name, some in CLASSES.items()}


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring bounds."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _stretches(inside: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of stretches of marked bytes, which also end at breaks."""
    cut = np.zeros(len(inside) + 1, bool)
    cut[breaks] = True
    before = np.append(False, inside)
    after = np.append(inside, False)
    return np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))


def _hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes; stretches follow one another."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    sizes = ends - begins
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    some = raw[np.repeat(begins, sizes) + place].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(some * _POWERS[place & 255], np.cumsum(sizes) - sizes)
    return mixed(sums + sizes.astype(np.uint64))


def _repeats(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each owner: distinct keys, keys equal to an earlier one, and how often its commonest comes."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    first = np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])) if len(k) else np.zeros(0, bool)
    begins = np.flatnonzero(first)
    counts = np.diff(np.append(begins, len(k)))
    most = np.zeros(n)
    np.maximum.at(most, o[begins], counts)
    distinct = np.bincount(o[begins], minlength=n).astype(float)
    return distinct, np.bincount(o, minlength=n) - distinct, most


def statistics(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; bounds cut the UTF-8 bytes of all texts into theirs."""
    n = len(bounds) - 1
    of = {name: _sums(marks[raw], bounds) for name, marks in _IS.items()}
    space = _IS["space"][raw]
    begins, ends = _stretches(~space, bounds)
    owner = np.searchsorted(bounds, begins, side="right") - 1
    words = np.bincount(owner, minlength=n).astype(float)
    some = np.maximum(words, 1)
    lengths = (ends - begins).astype(float)
    chars = np.maximum(np.diff(bounds) - of["more"], 1)
    square = np.bincount(owner, lengths**2, n) / some
    mean = np.bincount(owner, lengths, n) / some
    longest = np.zeros(n)
    np.maximum.at(longest, owner, lengths)
    hashes = _hashes(raw, begins, ends)
    distinct, _, commonest = _repeats(hashes, owner, n)
    same = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    same_as_last = np.bincount(owner[1:][same], minlength=n)
    inside = np.append(owner[2:] == owner[:-2], np.zeros(min(2, len(owner)), bool))[: len(owner)]
    at = np.flatnonzero(inside)
    triples = mixed(hashes[at] * _TRIPLE[0] + hashes[at + 1] * _TRIPLE[1] + hashes[at + 2] * _TRIPLE[2])
    _, again, _ = _repeats(triples, owner[at], n)
    line_begins, line_ends = _stretches(~_IS["line"][raw], bounds)
    line_owner = np.searchsorted(bounds, line_begins, side="right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    _, line_again, _ = _repeats(_hashes(raw, line_begins, line_ends), line_owner, n)
    caps = np.bincount(owner, _IS["upper"][raw[begins]], n)
    shares = [of[name] / chars for name in ("upper", "digit", "stop", "shout", "comma", "mark", "bar", "quote", "wide", "space")]
    return np.stack(
        [
            np.log1p(words), mean, np.sqrt(np.maximum(square - mean**2, 0)), words / np.maximum(lines, 1), same_as_last / some,
            distinct / some, commonest / some, again / some, line_again / np.maximum(lines, 1), caps / some, *shares,
            np.log1p(longest),
        ],
        axis=1,
    )


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """FEATURES of the texts, slice by slice."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
        part = texts.slice(begin, end - begin)
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        yield statistics(raw, offsets - offsets[0])
        begin = end


def taught_by(column: str = "doc_id") -> F.Column:
    """The query's fold: rows that may teach."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def _draw(salt: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(salt)), F.lit(1 << 30))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> histogram_trees.Trees | float:
    """Trees from (doc_id, text) and (doc_id, quality), or the one score of every text."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    count = known.count()
    if not count:
        return 0.5
    # Broadcast: about train_rows pairs of an id and a label, whatever the tables' sizes.
    sample = F.broadcast(known.where(_draw("taught") < int(min(1.0, train_rows / count) * (1 << 30))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for part in features(batch.column(0)) for row in part.tolist()]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.float64())), *batch.columns[1:]], names=["row", "good", "checked", "place"])

    rows = (
        docs.select("doc_id", "text").join(sample, "doc_id")
        .select("text", F.col("good").cast("double").alias("good"), (_draw("checked") % CHECK_SHARE == 0).alias("checked"),
                F.xxhash64(F.col("doc_id").cast("string")).alias("place"))
        .mapInArrow(work, "row array<double>, good double, checked boolean, place long")
        .groupBy("place").agg(F.min(F.struct("row", "good", "checked")).alias("one")).select("one.*")
        .toArrow()
    )
    good = rows["good"].to_numpy()
    if len(set(good.tolist())) < 2:
        return float(np.clip(good[0], 0, 1)) if len(good) else 0.5
    matrix, checked = np.array(rows["row"].to_pylist()), rows["checked"].to_numpy()
    order = np.lexsort([*matrix.T, good, checked])  # the same trees whatever order the rows came in
    return histogram_trees.fit(matrix[order], good[order], checked[order])


def score(
    docs: DataFrame, trees: histogram_trees.Trees | float, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, score) of each row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if isinstance(trees, float):
                found = np.full(batch.num_rows, trees)
            else:
                found = np.concatenate([trees.probability(rows) for rows in features(batch.column(1))] or [np.zeros(0)])
            yield pa.record_batch([batch.column(0).cast(arrow), pa.array(found)], names=["doc_id", "score"])

    return source.mapInArrow(work, f"doc_id {kind.simpleString()}, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = learn(docs, labels.select("doc_id", "quality").where(taught_by()))
    held_out = F.coalesce(~taught_by(), F.lit(False)) & F.col("doc_id").isNotNull()
    return score(docs, trees).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted")
    )
