"""Language identification by compression.

Each language has a zstandard dictionary of raw text. A text is compressed with every dictionary
and belongs to the language that makes it smallest; if the runner-up comes close, the operator
rejects it. A text longer than BLOCK_BYTES is compressed block by block, all of it, and the sizes are
summed: a dictionary helps by some bytes each time it is used, so that the lead of a text
compressed as a whole would shrink with its length. Letters alone count: texts and dictionaries are lower-cased, and whatever is no letter
becomes one space, so that shouting, tables and junk marks look like any other text.

The dictionaries come from a bounded sample: about SAMPLE_DOCS labelled documents of each of the
MOST_LANGS commonest languages, chosen by a hash of their ids, of which PIECE_CHARS letters each go
into a dictionary. The least lead is learned from about as many other labelled documents: predicted
whole, they show which leads wrong and right predictions have.

A letter is what Unicode calls one (categories L*): digits, fractions, circled and Roman numerals
are none.

Defined results: texts that are null, empty or without a letter are ``und`` with score 0 and
rejected; ties go to the language that comes first by name and are rejected. Without documents to
learn the least lead from, it is MOST_LEAD. With one learned language every text with a
letter gets it, with score 1; with none, everything is ``und``. Rows without an id are predicted
but never learned from; repeated rows give the same result each; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyfield.llm.common import table

#: Labelled documents of a language in the sample, about.
SAMPLE_DOCS = 400

#: Letters taken of a sampled document, and bytes of a dictionary.
PIECE_CHARS, DICTIONARY_BYTES = 1024, 1 << 16

LEVEL = 9

#: Bytes of a text that are compressed on their own.
BLOCK_BYTES = 2048

#: Languages that are learned, at most.
MOST_LANGS = 200

#: The least lead over the runner-up, as a share of its size, is learned, but never above this one.
MOST_LEAD = 0.05

UNKNOWN = "und"

#: A run before the text that always compresses: without it short texts are stored as they are,
#: and no dictionary would show.
CARRIER = b"\n" * 256 + b" "

_NO_LETTERS = re.compile(r"[\W\d_]+")


@lru_cache(maxsize=1)
def _numerals() -> frozenset[str]:
    """Python's word characters that are neither letters nor decimal digits."""
    return frozenset(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha())


def letters(text: str | None) -> bytes:
    lowered = (text or "").lower()
    if not lowered.isascii() and not _numerals().isdisjoint(lowered):
        lowered = "".join([" " if c in _numerals() else c for c in lowered])
    return _NO_LETTERS.sub(" ", lowered).strip().encode()


def _draw(salt: str) -> F.Column:
    """A number from 0 to 1 that an id always draws."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _sampled(counts: dict[str, int], draw: F.Column, docs: int) -> F.Column:
    """Whether a row is among about so many of its language."""
    chosen = F.lit(False)
    for lang, count in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (draw < docs / count))
    return chosen


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[dict[str, bytes], float]:
    """A dictionary for each language of (doc_id, text, lang), and the least lead."""
    labelled = labelled.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    most = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    if not counts:
        return {}, MOST_LEAD
    draw, teaches = _draw("dictionary"), _draw("fold") < 0.75
    # Of a text only as much travels as may go into a dictionary, with room for what is no letter.
    piece = F.substring("text", 1, 8 * PIECE_CHARS).alias("text")
    rows = labelled.where(teaches & _sampled(counts, draw, sample_docs)).select("lang", draw.alias("draw"), "doc_id", piece).collect()
    found: dict[str, bytes] = {}
    for row in sorted(rows, key=lambda r: (r["draw"], str(r["doc_id"]), r["text"])):
        known = found.setdefault(row["lang"], b"")
        if len(known) < DICTIONARY_BYTES and (piece := letters(row["text"])[:PIECE_CHARS]):
            found[row["lang"]] = known + piece + b" "
    dictionaries = {lang: raw[:DICTIONARY_BYTES] for lang, raw in sorted(found.items()) if raw}
    tried = predict(labelled.where(~teaches & _sampled(counts, draw, sample_docs)), (dictionaries, 0.0), also=["lang"])
    leads = [(r["score"], r["lang_pred"] == r["lang"]) for r in tried.select("score", "lang_pred", "lang").collect()]
    return dictionaries, least_lead(leads)


def least_lead(leads: list[tuple[float, bool]]) -> float:
    """Of all thresholds with the fewest errors (wrong ones kept, right ones rejected) the middle of the widest gap."""
    leads = sorted((lead, right) for lead, right in leads if 0 < lead <= 1)
    if not leads:
        return MOST_LEAD
    errors, best, begin = sum(not right for _, right in leads), None, 0.0
    for lead, right in [*leads, (leads[-1][0], True)]:
        gap = (-errors, lead - begin)
        if lead > begin and (best is None or gap > best[0]):
            best = gap, (begin + lead) / 2
        errors += 1 if right else -1
        begin = lead
    return min(best[1], MOST_LEAD)


@lru_cache(maxsize=2)
def _packers(dictionaries: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang, raw in dictionaries:
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        made.append((lang, zstandard.ZstdCompressor(
            level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
        )))
    return made


def classify(text: str | None, packers, least: float) -> tuple[str, float, bool]:
    """Language, lead over the runner-up from 0 to 1, and whether it is too narrow."""
    raw = letters(text)
    if not raw or not packers:
        return UNKNOWN, 0.0, True
    pieces = [CARRIER + raw[at : at + BLOCK_BYTES] + b" " for at in range(0, len(raw), BLOCK_BYTES)]
    sizes = sorted((sum(len(packer.compress(piece)) for piece in pieces), lang) for lang, packer in packers)
    if len(sizes) == 1:
        return sizes[0][1], 1.0, False
    lead = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
    return sizes[0][1], lead, lead < least or not lead


def predict(
    docs: DataFrame, model: tuple[dict[str, bytes], float], id_col: str = "doc_id", text_col: str = "text", also: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row, with other columns if asked for."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *also)
    passed = T.StructType([source.schema["doc_id"], *source.schema.fields[2:]])
    arrow, known, least = to_arrow_schema(passed), tuple(sorted(model[0].items())), model[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = _packers(known)
        for batch in batches:
            found = [classify(text.as_py(), packers, least) for text in batch.column(1)]
            kept = [batch.column(0), *batch.columns[2:]]
            yield pa.record_batch(
                [
                    *[column.cast(field.type) for column, field in zip(kept, arrow, strict=True)],
                    pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_()),
                ],
                names=[*arrow.names, "lang_pred", "score", "rejected"],
            )

    out = T.StructType([*passed]).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return source.mapInArrow(work, out)


def held_out(column: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, learn(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: tuple[dict[str, bytes], float]) -> DataFrame:
    """The rows whose language is not in doubt, with all their columns, in one pass over the texts."""
    schema, known, least = docs.schema, tuple(sorted(model[0].items())), model[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = _packers(known)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([not classify(text.as_py(), packers, least)[2] for text in texts], pa.bool_()))

    return docs.mapInArrow(work, schema)
