"""Periodic runs against every stretch of every period."""

import hashlib
import random
import zlib

import pytest

from tallyfield.llm import periodic_runs


def plain_runs(words):
    """Maximal stretches of each period, the least period of each stretch."""
    n, found = len(words), {}
    for period in range(1, n // 3 + 1):
        at = 0
        while at + period < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(24, 3 * period):
                found.setdefault((at, end + period), period)
            at = end + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda run: (run[0], run[2]))


def plain_row(words):
    runs = plain_runs(words)
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()


def plain_planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def drawn(seed, many):
    draw, out = random.Random(seed), []
    for _ in range(many):
        kinds, n = draw.choice([1, 2, 2, 3, 5, 50]), draw.choice([0, 1, 5, 23, 24, 30, 60, 120, 200])
        words = [b"w%d" % draw.randrange(kinds) for _ in range(n)]
        for _ in range(draw.randrange(3) if n > 3 else 0):
            begin, period = draw.randrange(n), draw.randrange(1, max(2, n // 4))
            for i in range(begin + period, min(n, begin + period * draw.randrange(2, 8) + draw.randrange(period))):
                words[i] = words[i - period]
        out.append(words)
    return out


@pytest.mark.parametrize("together", [1, 7, 500])
def test_all_runs(together):
    documents = drawn(together, 500)
    found = [runs for at in range(0, 500, together) for runs in periodic_runs.find_runs(documents[at : at + together])]
    assert found == [plain_runs(words) for words in documents]
    assert sum(map(len, found)) > 50


def test_fibonacci_and_nested_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 900:
        a, b = b, b + a
    nested = ([b"x"] * 30 + [b"y"]) * 4 + [b"z"]
    for words in (b, nested, nested * 3):
        assert periodic_runs.find_runs([words]) == [plain_runs(words)]
    assert len(plain_runs(nested)) == 5


def test_common_prefixes():
    words = drawn(9, 1)[0] * 3 + [b"q", b"r"] * 40
    codes, _ = periodic_runs._coded([words])
    ranks = periodic_runs.Ranks(codes)
    assert sorted(range(len(words)), key=lambda i: codes[i:].tolist()) == ranks.array.tolist()


ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a " * 23), (5, "a " * 24), (6, "one two " * 30 + "end"), (6, "one two " * 30 + "end"),
    (None, "x y z " * 20), (7, "é ü " * 40 + "    "), (8, ("p q r " * 9 + "s ") * 5), (9, " ".join(map(str, range(3000))) + " 7 8" * 20000),
]


def test_edges(docs):
    got = periodic_runs.report(periodic_runs.detect(docs(ROWS))).collect()
    # The long one by rule: its run starts where the numbers end and has period 2.
    short = [r for r in got if r["doc_id"] != 9]
    want = sorted((str(i), *map(str, plain_row((t or "").encode().split()))) for i, t in ROWS if i != 9)
    assert sorted((str(r["doc_id"]), *map(str, tuple(r)[1:])) for r in short) == want
    (long,) = [r for r in got if r["doc_id"] == 9]
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 3000, 40000, 2)
    assert periodic_runs.report(periodic_runs.detect(docs([]))).collect() == []


def test_query(spark, sf_dir, documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in periodic_runs.query(spark, sf_dir).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        words = plain_planted(row["doc_id"], (row["text"] or "").encode().split())
        if len(words) < 1500:
            assert got[row["doc_id"]] == plain_row(words)
    assert sum(r[0] > 0 for r in got.values()) > 5
