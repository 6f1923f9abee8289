"""Quality of documents: fixed rules, then boosted trees over statistics of the whole text.

The trees learn from labelled documents: about TRAIN_ROWS of them, chosen by a hash of their ids
(all, if there are fewer). More repetition, symbols, shouting or table bars never raises a score:
those features are constrained. The trees are flat node arrays, which score a batch at once.

Defined results: null and empty texts have no word, fail the base rules and are dropped. Where
labels are missing or all alike there are no trees, and the base rules alone decide. A document
labelled more than once counts as its worst label. Repeated rows give the same result each; rows
without an id are scored but never learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm import boosting
from tallyfield.llm.common import table
from tallyfield.llm.shingles import mixed

#: Labelled documents to learn from, about.
TRAIN_ROWS = 20_000

#: Score under which the trees drop a document.
LEAST_SCORE = 0.5

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Features and their constraints.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_a_word": -1, "dup_lines": -1, "repeated_words": -1,
    "same_as_last": -1, "distinct_words": 0, "upper": -1, "exclamations": -1, "bars": -1, "digits": 0,
    "beyond_ascii": 0, "words_a_line": 0, "stops": 0,
}

_TIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """Counts and features of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(of[0x80:0xC0].sum())
    word_chars = points - int(of[list(SPACES)].sum())
    symbols = int(of[list(SYMBOLS)].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    repeated = 0
    if n >= 3:
        windows = mixed(hashes[:-2] * _TIMES[0] + hashes[1:-1] * _TIMES[1] + hashes[2:] * _TIMES[2])
        _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[where] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : shift + len(twice)] |= twice
        repeated = int(covered.sum())
    some, chars = max(n, 1), max(word_chars, 1)
    same = int((hashes[1:] == hashes[:-1]).sum()) if n > 1 else 0
    features = [
        np.log1p(n), word_chars / some, symbols / some, dup_lines / max(len(lines), 1), repeated / some,
        same / some, len(np.unique(hashes)) / some, int(of[65:91].sum()) / chars, int(of[33]) / some,
        int(of[124]) / some, int(of[48:58].sum()) / chars, int(of[0xC0:].sum()) / chars,
        n / max(len(lines), 1), int(of[[46, 63]].sum()) / some,
    ]
    return [n, word_chars, symbols, dup_lines, repeated], features


def base_failed(counts: list[int]) -> bool:
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, pa.DataType, str]:
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    return source, to_arrow_type(kind), kind.simpleString()


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> boosting.Forest | None:
    """Trees from (doc_id, text) and (doc_id, quality)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    count = known.count()
    if not count:
        return None
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("train")), F.lit(1 << 30))
    sample = known.where(draw < int(min(1.0, train_rows / count) * (1 << 30)))
    source, _, _ = _prepared(docs, "doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [statistics(text.as_py())[1] for text in batch.column(0)]
            yield pa.record_batch([pa.array(features, pa.list_(pa.float64())), batch.column(1)], names=["features", "good"])

    rows = (
        source.join(F.broadcast(sample), "doc_id")
        .select("text", F.col("good").cast("double").alias("good"))
        .mapInArrow(work, "features array<double>, good double")
        .toArrow()
    )
    good = rows["good"].to_numpy()
    if len(set(good.tolist())) < 2:
        return None
    features = np.array(rows["features"].to_pylist())
    order = np.lexsort([*features.T, good])  # the same trees whatever order the rows came in
    return boosting.fit(features[order], good[order], list(FEATURES.values()))


def judge(
    docs: DataFrame, forest: boosting.Forest | None, id_col: str = "doc_id", text_col: str = "text",
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """Counts, verdict of the rules, score and verdict of each row."""
    source, arrow, sql = _prepared(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [statistics(text.as_py()) for text in batch.column(1)]
            counts = np.array([f[0] for f in found], np.int64)
            failed = np.array([base_failed(f[0]) for f in found])
            score = forest.probability(np.array([f[1] for f in found])) if forest else np.ones(len(found))
            columns = [batch.column(0).cast(arrow), *map(pa.array, counts.T), pa.array(failed)]
            yield pa.record_batch(
                [*columns, pa.array(~failed & (score >= least_score)), pa.array(score)],
                names=["doc_id", *COUNTS, "base_failed", "kept", "score"],
            )

    longs = ", ".join(f"{name} long" for name in COUNTS)
    return source.mapInArrow(work, f"doc_id {sql}, {longs}, base_failed boolean, kept boolean, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, learn(docs, table(spark, sf_dir, "labels")))
