"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The words of many documents make one sequence, in which a word of one document never equals one of
another. Prefix doubling sorts its suffixes and keeps the ranks of every power of two; from these
come the array, its inverse, the common prefixes of neighbours, and any later comparison of two
places. An interval of suffixes with a common prefix of q words has children, in which the next
word is the same too. For each suffix i of all children but the largest, the inverse array says
whether i + q or i - q stands in another child: then a square of period q ends where its two
suffixes part. Rotating it to the left as long as words agree gives the whole repetition, and
repetitions with one place and several periods are one run of the least period. Intervals come from
nearest smaller values, so no tree is built.

A run of at least LEAST_WORDS words and LEAST_PERIODS periods repeats some prefix of COMMON_WORDS
words. Documents in which the first four doublings leave no such repeat need no further sorting.

Defined results: null and empty texts and those of white space alone have no word and no run, and
collapse to the empty text. Repeated rows give the same result each, rows without an id too; an
empty table gives an empty result; other columns are ignored. A document is worked on by one task,
in about 200 bytes a word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyfield.llm.common import table

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_PERIODS = 24, 3

#: Words that some two suffixes of a run share: of a run of period q, max(24, 3 q) - q, at least 16.
COMMON_WORDS = 16

#: Words sorted as one sequence; a longer document is a sequence of its own.
SEQUENCE_WORDS = 1 << 18


def _regrouped(order: np.ndarray, new_group: np.ndarray, places: np.ndarray, groups: np.ndarray) -> None:
    """Write each group's first place in the array as the rank of its members."""
    begins = np.flatnonzero(new_group)
    sizes = np.diff(np.append(begins, len(order)))
    groups[order] = np.repeat(places[begins], sizes)


def _doubling(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(array, ranks, places still shared) for prefixes of 1, 2, 4, ... words, until all differ."""
    n = len(codes)
    array = np.argsort(codes, kind="stable")
    ranks = np.empty(n, np.int64)
    shared = np.arange(n)
    sorted_keys = codes[array]
    length = 0
    while True:
        first = np.append(True, sorted_keys[1:] != sorted_keys[:-1])
        _regrouped(array[shared], first, shared, ranks)
        # A place is settled once its group has no other member.
        alone = first & np.append(first[1:], True)
        shared = shared[~alone]
        yield array, ranks, shared
        if not len(shared):
            return
        length = 2 * length or 1
        members = array[shared]
        after = members + length
        later = np.where(after < n, ranks[np.minimum(after, n - 1)], -1)
        keys = ranks[members] * (n + 1) + later + 1
        by = np.argsort(keys, kind="stable")
        array[shared] = members[by]
        sorted_keys = keys[by]


class Ranks:
    """The suffix array of a sequence, its inverse, and the ranks of all powers of two."""

    def __init__(self, codes: np.ndarray):
        self.levels = []
        for self.array, ranks, _ in _doubling(codes):
            self.levels.append(ranks.astype(np.int32 if len(codes) < 1 << 31 else np.int64))
        self.inverse = self.levels[-1]

    def common_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that two places have in common from there on."""
        return self._common(a, b, forward=True)

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that two places have in common just before them."""
        return self._common(a, b, forward=False)

    def _common(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        n, total = len(self.array), np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            ranks, step = self.levels[level], 1 << level
            x, y = (a + total, b + total) if forward else (a - total - step, b - total - step)
            inside = (np.maximum(x, y) < n) & (np.minimum(x, y) >= 0)
            same = np.zeros(len(a), bool)
            same[inside] = ranks[x[inside]] == ranks[y[inside]]
            total[same] += step
        return total


def _nearest(values: np.ndarray, at: np.ndarray, below: np.ndarray, longest: int) -> np.ndarray:
    """For each place, the first later one whose value is below a bound; it is within `longest`."""
    tables, size = [values], 1
    while size < longest:
        last = tables[-1]
        least = last.copy()
        least[:-size] = np.minimum(last[:-size], last[size:])
        least[len(least) - size :] = -1
        tables.append(least)
        size *= 2
    place = at + 1
    for level in range(len(tables) - 1, -1, -1):
        inside = place < len(values)
        whole = np.zeros(len(at), bool)
        whole[inside] = tables[level][place[inside]] >= below[inside]
        place = np.where(whole, place + (1 << level), place)
    return place


def _children(common: np.ndarray, longest: int) -> tuple[np.ndarray, ...]:
    """(depth, interval begin and end, child begin and end) of all children but the largest one.

    common[j] is the common prefix of places j - 1 and j; ends are exclusive.
    """
    n = len(common)
    cuts = np.flatnonzero(common > 0)
    depth = common[cuts]
    backwards = common[::-1]
    mirrored = n - 1 - cuts
    end = _nearest(common, cuts, depth, longest)
    begin = n - 1 - _nearest(backwards, mirrored, depth, longest)
    next_cut = _nearest(common, cuts, depth + 1, longest)
    last_cut = n - 1 - _nearest(backwards, mirrored, depth + 1, longest)
    # Every cut has the child before it; the last cut of an interval has the one after it as well.
    last = next_cut == end
    parts = [
        (np.concatenate([whole, whole[last]])) for whole in (depth, begin, end)
    ] + [np.concatenate([last_cut, cuts[last]]), np.concatenate([cuts, end[last]])]
    depth, begin, end, low, high = parts
    size = high - low
    order = np.lexsort((low, -size, depth, begin))
    largest = np.append(True, (begin[order][1:] != begin[order][:-1]) | (depth[order][1:] != depth[order][:-1]))
    kept = np.sort(order[~largest])
    return depth[kept], begin[kept], end[kept], low[kept], high[kept]


def runs_of(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, least period) of every maximal repetition of two periods or more, by place.

    No repetition is longer than `longest` words.
    """
    ranks = Ranks(codes)
    array = ranks.array
    common = np.zeros(len(codes), np.int64)
    common[1:] = ranks.common_after(array[:-1], array[1:])
    depth, begin, end, low, high = _children(common, longest)
    sizes = high - low
    child = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[child]
    ends, periods = [], []
    for sign in (1, -1):
        suffix = array[place]
        other = suffix + sign * depth[child]
        inside = (other >= 0) & (other < len(codes))
        where = np.where(inside, ranks.inverse[np.where(inside, other, 0)], -1)
        found = (where >= begin[child]) & (where < end[child]) & ~((where >= low[child]) & (where < high[child]))
        square = np.minimum(suffix, other)[found]
        periods.append(depth[child][found])
        ends.append(square + 2 * periods[-1])
    end, period = np.unique(np.stack([np.concatenate(ends), np.concatenate(periods)]), axis=1)
    first = end - 2 * period
    begin = first - ranks.common_before(first, first + period)
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    least = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))[: len(begin)]
    return begin[least], end[least], period[least]


def _coded(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One number for each word, no two documents sharing one; and where documents begin."""
    sizes = np.array([len(words) for words in documents], np.int64)
    words = pa.array([word for words in documents for word in words], pa.large_binary())
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    numbers = np.repeat(np.arange(len(sizes)), sizes)
    return numbers * (len(codes) + 1) + codes, np.append(0, np.cumsum(sizes))


def _suspects(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Documents in which some COMMON_WORDS words come twice."""
    for round_, (array, _, shared) in enumerate(_doubling(codes)):
        if not len(shared) or 1 << round_ == COMMON_WORDS:
            return np.unique(np.searchsorted(bounds, array[shared], side="right") - 1)
    return np.zeros(0, np.int64)


def find_runs(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, by start and period."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not any(documents):
        return found
    codes, bounds = _coded(documents)
    suspects = _suspects(codes, bounds).tolist()
    if not suspects:
        return found
    codes = np.concatenate([codes[bounds[d] : bounds[d + 1]] for d in suspects])
    sizes = np.array([bounds[d + 1] - bounds[d] for d in suspects])
    begins = np.append(0, np.cumsum(sizes))
    start, end, period = runs_of(codes, int(sizes.max()))
    enough = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, end, period = start[enough], end[enough], period[enough]
    owner = np.searchsorted(begins, start, side="right") - 1
    order = np.lexsort((period, start))
    for d, s, e, p in zip(owner[order].tolist(), start[order].tolist(), end[order].tolist(), period[order].tolist(), strict=True):
        found[suspects[d]].append((s - int(begins[d]), e - s, p))
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside runs, and of each run its first period; a word of several runs goes if one drops it."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _sequences(texts: pa.Array, ids: pa.Array, words_of: Callable) -> Iterator[list[list[bytes]]]:
    waiting, size = [], 0
    for doc_id, text in zip(ids, texts, strict=True):
        words = words_of(doc_id.as_py(), (text.as_py() or "").encode().split())
        if waiting and size + len(words) > SEQUENCE_WORDS:
            yield waiting
            waiting, size = [], 0
        waiting.append(words)
        size += len(words)
    if waiting:
        yield waiting


def detect(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words_of: Callable[[object, list[bytes]], list[bytes]] = lambda doc_id, words: words,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every run of each text, and the text with runs cut to one period.

    words_of may give other words for an id and its words; texts are cut at ASCII white space.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column(0).cast(arrow), 0
            for documents in _sequences(batch.column(1), ids, words_of):
                found = find_runs(documents)
                columns = [
                    ids.slice(at, len(documents)), pa.array([len(words) for words in documents], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], pa.list_(run)),
                    pa.array([collapsed(*pair) for pair in zip(documents, found, strict=True)], pa.binary()).cast(pa.string()),
                ]
                at += len(documents)
                yield pa.record_batch(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    schema = (
        f"doc_id {kind.simpleString()}, n_words long, "
        "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    )
    return source.mapInArrow(work, schema)


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The query's words: about a tenth of the documents repeat a stretch of their own to the end."""
    n = len(words)
    if doc_id is None or not n:
        return words
    draw, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    begin = draw % n
    period = 1 + (n - begin) // (3 + draw % 8)
    times = -(-(n - begin) // period)
    return words[:begin] + (words[begin : begin + period] * times)[: n - begin]


def report(found: DataFrame) -> DataFrame:
    """Digests of runs and collapsed texts, and the run of the greatest exponent."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")

    def better(best: F.Column, r: F.Column) -> F.Column:
        # Lengths over periods, compared as products; runs come by start and period, so ties keep the first.
        mine, its = (x["length"].cast("decimal(19,0)") for x in (r, best))
        more = mine * best["period"].cast("decimal(19,0)") > its * r["period"].cast("decimal(19,0)")
        return F.when(best.isNull() | more, r).otherwise(best)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    top = F.aggregate("runs", none, better)
    return found.select("*", top.alias("top"), text.alias("listed")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"),
        F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * top.length DIV top.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(detect(table(spark, sf_dir, "documents"), words_of=planted))
