"""Statistics against plain counting, trees against a walk through them, quality on held-out rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyfield.llm import histogram_trees, quality_classifier
from tallyfield.llm.quality_classifier import CLASSES, FEATURES, features

PIECES = ["a", "Bc", "the", "the", "é!", "12", "x|y", "\n", "\n", " ", "\t", "$$$", "ÀB", "日本", "“q”", "same line\n", "end.", "\r\n"]


def texts(seed, many):
    draw = random.Random(seed)
    made = [" ".join(draw.choice(PIECES) for _ in range(draw.randint(0, 80))) for _ in range(many)]
    return [*made, "", " ", "\n\n", "w", None, "word " * 3000, "x" * 70000]


def plain(text):
    raw = (text or "").encode()
    words, lines = raw.split(), [line for line in raw.split(b"\n") if line]
    chars = max(len(raw.decode()), 1)
    n, some = len(words), max(len(words), 1)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / some
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    of = {name: len(re.findall(b"[" + re.escape(marks) + b"]", raw)) for name, marks in CLASSES.items()}
    return [
        math.log1p(n), mean, math.sqrt(max(sum(x * x for x in lengths) / some - mean**2, 0)), n / max(len(lines), 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / some, len(set(words)) / some,
        max(Counter(words).values(), default=0) / some, sum(c - 1 for c in triples.values()) / some,
        (len(lines) - len(set(lines))) / max(len(lines), 1), sum(w[:1].isupper() for w in words) / some,
        *(of[k] / chars for k in ("upper", "digit", "stop", "shout", "comma", "mark", "bar", "quote", "wide", "space")),
        math.log1p(max(lengths, default=0)),
    ]


@pytest.mark.parametrize("slice_bytes", [1, 300, 1 << 20])
def test_statistics(monkeypatch, slice_bytes):
    monkeypatch.setattr(quality_classifier, "SLICE_BYTES", slice_bytes)
    given = texts(4, 150)
    got = np.concatenate(list(features(pa.array(given).slice(1))))
    assert got.shape == (len(given) - 1, len(FEATURES))
    np.testing.assert_allclose(got, [plain(t) for t in given[1:]], rtol=1e-9, atol=1e-9)


def made_rows(n=1500):
    draw = np.random.default_rng(3)
    rows = np.round(draw.normal(size=(n, 5)), 2)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] < -0.5)).astype(float)
    return rows, labels, np.arange(n) % 8 == 0


def walked(trees, row):
    total = trees.base
    for node in trees.roots:
        while trees.left[node] != node:
            side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
            node = side[node]
        total += trees.value[node]
    return total


def test_trees_learn_and_walk():
    rows, labels, checked = made_rows()
    trees = histogram_trees.fit(rows, labels, checked)
    np.testing.assert_allclose(trees.margin(rows[:200]), [walked(trees, row) for row in rows[:200]])
    assert ((trees.probability(rows) > 0.5) == labels)[checked].mean() > 0.97
    assert trees.probability(np.full((1, 5), 1e9)).shape == (1,)


def test_first_split_is_the_best_one():
    rows, labels, _ = made_rows(400)
    trees = histogram_trees.fit(rows, labels, np.zeros(400, bool))
    share = labels.mean()
    grad, hess = share - labels, np.full(400, share * (1 - share))

    def gain(side):
        return sum(grad[s].sum() ** 2 / (hess[s].sum() + histogram_trees.SHRINK) for s in (side, ~side))

    root = trees.roots[0]
    chosen = gain(rows[:, trees.feature[root]] <= trees.threshold[root])
    for column in rows.T:
        edges = np.unique(np.quantile(column, np.linspace(0, 1, histogram_trees.BINS)[1:-1], method="lower"))
        assert all(gain(column <= edge) <= chosen + 1e-9 for edge in edges if 2 < (column <= edge).sum() * hess[0] < 398 * hess[0])


def test_histograms_subtract():
    rows, labels, _ = made_rows(300)
    binned = np.argsort(np.argsort(rows, axis=0), axis=0) % histogram_trees.BINS
    made = histogram_trees._Histograms(binned)
    left, right, everything = np.arange(100), np.arange(100, 300), np.arange(300)
    grad, hess = labels - 0.5, np.full(300, 0.25)
    whole = made.of(everything, grad, hess)
    np.testing.assert_allclose(whole - made.of(left, grad, hess), made.of(right, grad, hess), atol=1e-12)
    np.testing.assert_allclose(whole[0, 2, 7], grad[binned[:, 2] == 7].sum(), atol=1e-12)


ROWS = [(1, None), (2, ""), (3, "good words of a text " * 20), (3, "other"), (None, "no id"), (4, "$$$ !!! " * 40), (5, "x " * 50000)]


def test_edges(spark, docs):
    given = docs(ROWS)
    schema = "doc_id long, quality int, score double"
    none = quality_classifier.learn(given, spark.createDataFrame([], schema))
    assert none == 0.5
    assert quality_classifier.learn(given, spark.createDataFrame([(3, 1, 0.0), (None, 0, 0.0), (4, None, 0.0)], schema)) == 1.0
    trees = quality_classifier.learn(given, spark.createDataFrame([(3, 1, 0.0), (4, 0, 0.0), (3, 0, 0.0), (5, 1, 0.0)] * 3, schema))
    for model in (none, trees):
        got = quality_classifier.score(given, model).collect()
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in ROWS)
        assert all(0 <= r["score"] <= 1 for r in got)
    assert quality_classifier.score(docs([]), trees).collect() == []


def test_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = quality_classifier.query(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    assert found.count() == 1000


def test_scores_are_those_of_the_trees(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality_classifier.learn(documents, labels.where(quality_classifier.taught_by()))
    got = {r["doc_id"]: r for r in quality_classifier.query(spark, sf_dir).collect()}
    for row in documents.limit(50).collect():
        margin = walked(trees, plain(row["text"]))
        one = got[row["doc_id"]]
        assert abs(one["score"] - 1 / (1 + math.exp(-margin))) < 1e-6
        assert one["predicted"] == (one["score"] >= 0.3)
