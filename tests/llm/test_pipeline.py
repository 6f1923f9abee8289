"""The pipeline, each stage against a plain version on its own input."""

import zlib

import brute

import corpus_pipeline
from tallyfield.llm import stages
from tallyfield.llm.common import stored


def test_stages(spark, sf_dir, documents):
    frame, columns = documents, documents.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language id", "exact dedup", "near dedup", "personal data", "packing"
    ]
    given = frame.collect()
    results = []
    for _, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, sf_dir))
        results.append(frame.collect())
    for found in results[:4]:
        assert list(found[0].asDict()) == columns
    language, exact, near, private, pieces = results
    assert len(language) > 0.95 * len(given)
    best = {}
    for row in language:
        best[row["text"]] = max(row["doc_id"], best.get(row["text"], -1))
    assert sorted(r["doc_id"] for r in exact) == sorted(best.values())
    components = brute.near([(r["doc_id"], r["text"]) for r in exact])
    assert sorted(r["doc_id"] for r in near) == sorted(i for i, (_, c) in components.items() if i == c)
    assert len(private) == len(near)
    before = {r["doc_id"]: r["text"] for r in near}
    for row in private:
        assert row["n_chars"] == len(row["text"]) and not brute.base_spans(row["text"])
        if not brute.base_spans(before[row["doc_id"]]):
            assert row["text"] == before[row["doc_id"]]
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in private}


def test_run(spark, sf_dir):
    again = [corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "ids_crc32").collect() for _ in range(2)]
    assert sorted(again[0]) == sorted(again[1]) and again[0]


def test_ids_are_in_the_result(spark, docs):
    rows = [(1, "the house on the hill and the sea"), (2, "word " * 3000), (3, "")]
    pieces = stages.packed(spark, docs(rows), "").collect()
    assert {p["doc_id"] for p in pieces} == {1, 2, 3}
    for piece in pieces:
        assert len(piece["ids"]) == 4 * piece["length"] and zlib.crc32(piece["ids"]) == piece["ids_crc32"]


def test_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "word " * 80), (3, "word " * 80), (None, "the house on the hill and the sea"), (4, "x" * 90000)]
    for given in ([], rows):
        frame = docs(given)
        for _, stage in stages.STAGES[1:]:
            frame = stored(stage(spark, frame, ""))
        assert (frame.count() > 0) == bool(given)
    assert stored(stages.known_language(spark, docs(rows), "")).count() == 0  # nothing is labelled
