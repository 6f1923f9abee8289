"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

A text longer than one leaf is halved until its parts are leaves; Spark encodes the leaves of all
texts in parallel, wherever they were cut. Going back up the tree, each join encodes a window of
text around the cut again and lets it grow until its tokens agree with the left part's on one side
and with the right part's on the other, over several tokens each; the window's tokens then replace
both ends. A window that reaches both ends is the plain encoding, so the result is exact for any
text. Long runs without white space inside a leaf go the same way.

Defined results: null and empty texts have no token; repeated rows give the same result each; rows
without an id are encoded too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm.common import table, vocabulary_path
from tallyfield.llm.parts import PartIds

VOCABULARY = "word_bpe_49k.json"

#: Characters of a leaf, and of a run without white space that is encoded in one go.
LEAF_CHARS, RUN_CHARS = 1 << 15, 1 << 12

#: Parts that a worker remembers: it shares an executor with those that decode.
CACHE_PARTS = 300_000

#: Rows that a worker encodes or decodes at once.
BATCH_ROWS = 512

#: First window, in characters to each side of a cut, and tokens over which both sides must agree.
WINDOW_CHARS, AGREE_TOKENS = 64, 8


def _same_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _same_suffix(a: np.ndarray, b: np.ndarray) -> int:
    return _same_prefix(a[::-1], b[::-1])


class TreeBpe:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.names = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.parts = PartIds(self._learn, most=CACHE_PARTS)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2")

    def _learn(self, given: pa.Array) -> pa.Array:
        """Ids of parts between spaces; the vocabulary drops white space and never crosses it."""
        parts = given.to_pylist()
        short = self.tokenizer.encode_batch_fast(
            [part if len(part) <= RUN_CHARS else "" for part in parts], add_special_tokens=False
        )
        ids = [
            np.array(found.ids, "<u2").tobytes() if len(part) <= RUN_CHARS else self.tree(part).tobytes()
            for part, found in zip(parts, short, strict=True)
        ]
        return pa.array(ids, pa.large_binary())

    def encode_many(self, texts: pa.Array) -> Iterator[np.ndarray]:
        return self.parts.encode(pc.fill_null(texts, ""))

    def tree(self, text: str, most: int = RUN_CHARS) -> np.ndarray:
        """Halves, their halves, and so on, joined two by two."""
        if len(text) <= most:
            return self.plain(text)
        left, right = text[: len(text) // 2], text[len(text) // 2 :]
        return self.join(left, self.tree(left, most), right, self.tree(right, most))

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """Ids of both texts as one, from the ids of each."""
        size = WINDOW_CHARS
        while size < len(left) or size < len(right):
            tail, head = left[-size:], right[:size]
            before, after, both = self.plain(tail), self.plain(head), self.plain(tail + head)
            # Tokens of the window up to `keep` are the left part's; its last `rest` are the right part's.
            low, high = len(before) - _same_suffix(left_ids, before), _same_prefix(before, both)
            first, last = len(after) - _same_prefix(right_ids, after), _same_suffix(after, both)
            keep, rest = (low + high) // 2, (first + last) // 2
            if high - low >= AGREE_TOKENS and last - first >= AGREE_TOKENS and keep + rest <= len(both):
                return np.concatenate([
                    left_ids[: len(left_ids) - len(before) + keep], both[keep : len(both) - rest],
                    right_ids[len(after) - rest :],
                ])
            size *= 2
        return self.plain(left + right)

    def decode(self, ids: list[int]) -> str:
        if self.tokenizer.decoder is None:
            return " ".join([self.names[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def tree_bpe(vocabulary: str | None = None) -> TreeBpe:
    """One encoder for each Python worker."""
    return TreeBpe(vocabulary_path(vocabulary, VOCABULARY))


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of BATCH_ROWS rows: what a worker holds follows from them."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """(doc_id, ids) for each row."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType
    sql, arrow = kind.simpleString(), to_arrow_type(kind)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_bpe(vocabulary)
        for batch in _small(batches):
            ids = _lists(list(encoder.encode_many(batch.column(1))))
            yield pa.record_batch([batch.column(0).cast(arrow), ids], names=["doc_id", "ids"])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_bpe(vocabulary)
        for batch in _small(batches):
            ids = _lists(list(encoder.encode_many(batch.column(batch.schema.get_field_index("text")))))
            yield pa.record_batch([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    def joined(leaves: pd.DataFrame) -> pd.DataFrame:
        encoder = tree_bpe(vocabulary)
        leaves = leaves.sort_values("leaf")
        nodes = [(text, np.array(ids, "<u2")) for text, ids in zip(leaves["text"], leaves["ids"], strict=True)]
        while len(nodes) > 1:
            pairs = zip(nodes[::2], nodes[1::2], strict=True)
            nodes = [(a[0] + b[0], encoder.join(*a, *b)) for a, b in pairs]
        return pd.DataFrame({"doc_id": leaves["doc_id"].iloc[:1].to_numpy(), "ids": [nodes[0][1].astype(np.int32)]})

    short = source.where(F.char_length("text") <= leaf_chars)
    size = F.char_length("text")
    leaves = (
        source.where(size > leaf_chars)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("n", F.pow(F.lit(2), F.ceil(F.log2(size / leaf_chars))).cast("long"))
        .withColumn("leaf", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .withColumn("begin", F.expr("char_length(text) * leaf div n"))
        .withColumn("end", F.expr("char_length(text) * (leaf + 1) div n"))
        .select("doc_id", "row", "leaf", F.expr("substring(text, cast(begin + 1 AS int), cast(end - begin AS int))").alias("text"))
        .repartition("row", "leaf")
        .mapInArrow(leaf, f"doc_id {sql}, row long, leaf long, text string, ids array<int>")
    )
    long = leaves.groupBy("row").applyInPandas(joined, f"doc_id {sql}, ids array<int>")
    return short.mapInArrow(whole, f"doc_id {sql}, ids array<int>").unionByName(long)


def _rows(ids: pa.Array) -> Iterator[list[int]]:
    bounds, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield values[begin:end].tolist()


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows of encode() with the text of their ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_bpe(vocabulary)
        for batch in _small(batches):
            texts = [encoder.decode(ids) for ids in _rows(batch.column(batch.schema.get_field_index("ids")))]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(work, f"{columns}, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode(encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
