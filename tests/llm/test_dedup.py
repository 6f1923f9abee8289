"""Exact and near copies, components, fixity."""

import gzip
import hashlib
import random

import brute
import numpy as np
from oracle_check import compare, connect
from pyspark.sql import functions as F

from tallyfield.llm import exact_dedup, golomb, minhash, registry, warc_fixity
from tallyfield.llm.components import connected_components

EDGES = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a b"), (5, "a b"), (None, "a b"), (None, None), (7, "x" * 200000)]


def test_golomb_round_trip():
    draw = np.random.default_rng(1)
    for n, universe in ((0, 9), (1, 1), (5, 5), (2000, 1 << 45), (4000, 5000), (1, 1 << 61)):
        values = np.sort(draw.choice(universe, n, replace=False)) if universe < 1e6 else np.unique(draw.integers(0, universe, n))
        assert (golomb.decode(golomb.encode(values, universe)) == values).all()


def exact(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for i, text in rows:
        group = groups[text or ""]
        keep = max((x for x in group if x is not None), default=None)
        out.append((i, keep, len(group), i == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_edges(docs):
    for rows in ([], EDGES, [(i, f"text {i % 7}") for i in range(200)]):
        for parts in (1, 5):
            frame = docs(rows).repartition(parts)
            got = exact_dedup.find_copies(frame).collect()
            assert sorted(map(tuple, got), key=str) == exact(rows)
            left = exact_dedup.drop_copies(frame)
            assert left.columns == frame.columns
            want = sorted(str(i) for i, _, _, kept, _ in exact(rows) if kept)
            assert sorted(str(r["doc_id"]) for r in left.collect()) == want


def test_short_fingerprints_only_make_suspects(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SPARE_BITS", -3)
    rows = [(i, f"text {i}") for i in range(300)] + [(900, "text 4")]
    got = exact_dedup.find_copies(docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == exact(rows)


def test_sql(spark, sf_dir):
    con = connect(sf_dir)
    for name, sql in registry.ORACLES.items():
        assert compare(spark, con, sf_dir, registry.QUERIES[name], sql) is None


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(300, 300), (200, 201)]
    edges += [(draw.randint(400, 460), draw.randint(400, 460)) for _ in range(40)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {n: find(n) for n in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def changed(text, draw, share):
    return " ".join(w if draw.random() > share else f"new{draw.randint(0, 999)}" for w in text.split())


def corpus():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(1, 220)))) for i in range(60)]
    hot = " ".join(draw.choices(words, k=150))
    rows += [(100 + i, changed(hot, draw, draw.choice([0.005, 0.02, 0.04]))) for i in range(80)]
    passage = " ".join(draw.choices(words, k=60))
    rows += [(300 + i, passage + " " + " ".join(draw.choices(words, k=60))) for i in range(40)]
    rows += [(400 + i, rows[i][1].upper()) for i in range(10)]
    return rows


def near_is_right(rows, got):
    want = brute.near(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_against_brute_force(docs, monkeypatch):
    rows = corpus()
    near_is_right(rows, minhash.near_duplicates(docs(rows).repartition(4)).collect())
    monkeypatch.setattr(minhash, "BLOCK", 8)
    near_is_right(rows, minhash.near_duplicates(docs(rows).repartition(4)).collect())


def test_near_query(spark, sf_dir, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    near_is_right(rows, minhash.query(spark, sf_dir).collect())


def test_near_edges(docs):
    got = minhash.near_duplicates(docs(EDGES)).collect()
    found = {(r["doc_id"], r["component_id"], r["n_shingles"], r["kept"]) for r in got}
    assert len(got) == len(EDGES)
    assert found == {
        (1, 1, 0, True), (2, 2, 0, True), (3, 3, 1, True), (4, 3, 1, False), (5, 3, 1, False), (None, 3, 1, False),
        (None, None, 0, True), (7, 7, 1, True),
    }
    assert minhash.near_duplicates(docs([])).count() == 0
    left = minhash.drop_near(docs(EDGES))
    assert left.columns == docs([]).columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "3", "7", "None", "None"]


def test_min_and_max_estimate_similarity():
    draw = np.random.default_rng(3)
    times, plus, _ = minhash._constants()
    pool = draw.integers(0, 1 << 63, 4000).astype(np.uint64)
    a, b = pool[:3000], pool[1000:]
    same = minhash.signature(a, times, plus) == minhash.signature(b, times, plus)
    assert len(same) == 240 and abs(same.mean() - 0.5) < 0.12


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 3) for i, u, h in rows], "page_id long, url string, html string, hash string, leaf int")


def test_fixity(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>é {'x' * (i * 7 % 50)}\r\n\r\n{i}</p>") for i in range(200)]
    rows += [(None, None, None), (3, "http://h/3", "again")]
    path = str(tmp_path / "w")

    def damage(record, copy):
        return F.when((copy == 1) & record.contains("page:77>"), F.replace(record, F.lit("WARC-Type"), F.lit("WARC-Tape"))).otherwise(
            F.when((copy == 2) & record.contains("page:150>"), F.concat(record, F.lit("more"))).otherwise(record)
        )

    warc_fixity.write(warc_fixity.records(pages(spark, rows), 64), path, 3, damage)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("replica=0/shard=0/part*")))
    cuts = warc_fixity.cut(raw)
    assert len(cuts) == 65 and all(raw[a:b].startswith(b"WARC/1.1") and raw[a:b].endswith(b"\r\n\r\n") for a, b in cuts)
    known = warc_fixity.leaves(spark, f"{path}/replica=0")
    assert known.count() == len(rows)
    good = warc_fixity.tree(known)
    again = warc_fixity.tree(warc_fixity.leaves_at(spark, f"{path}/replica=0", known))
    assert warc_fixity.audit(good, again).count() == 0
    one = warc_fixity.audit(good, warc_fixity.tree(warc_fixity.leaves_at(spark, f"{path}/replica=1", known))).collect()
    assert [(r["shard"], r["leaf"]) for r in one] == [(warc_fixity.CUTS, 13)]
    two = warc_fixity.audit(good, warc_fixity.tree(warc_fixity.leaves_at(spark, f"{path}/replica=2", known))).collect()
    assert {r["shard"] for r in two} == {2 * warc_fixity.CUTS} and min(r["leaf"] for r in two) == 22
    third = F.col("shard") == 2 * warc_fixity.CUTS
    lost = warc_fixity.tree(known.where(~third))
    assert warc_fixity.audit(good, lost).where(third).count() == 64


def test_fixity_of_nothing(spark):
    nothing = warc_fixity.tree(spark.createDataFrame([], warc_fixity.LEAVES))
    assert warc_fixity.audit(nothing, nothing).count() == 0


def near_rows(rows):
    """(id, text, set size, component) of each row; rows of one id are documents of their own."""
    numbered = brute.near(list(enumerate(t for _, t in rows)))
    least = {}
    for place, (i, _) in enumerate(rows):
        root = numbered[place][1]
        least[root] = min(i, least.get(root, i))
    return [(i, t, numbered[n][0], least[numbered[n][1]]) for n, (i, t) in enumerate(rows)]


def test_rows_that_share_an_id(docs, monkeypatch):
    words = [f"word{i}" for i in range(400)]
    text = lambda at, n=40, change="": " ".join(words[at : at + n]) + change
    rows = [(1, text(0)), (3, text(0, change=" x")), (3, text(100)), (5, text(100, change=" y")), (5, text(200)), (1, text(300))]
    rows += [(9, text(40)), (9, text(40, change=" z")), (9, text(40, change=" z")), (9, None), (9, "")]
    assert {(i, t): c for i, t, _, c in near_rows(rows)}[(3, text(100))] == 3
    draw = random.Random(5)
    rows += [(draw.randrange(20, 30), text(draw.randrange(0, 340, 20), 30, draw.choice(["", " q", " r s"]))) for _ in range(80)]
    frame = docs(rows).repartition(3)
    want = near_rows(rows)
    for block in (512, 4):
        monkeypatch.setattr(minhash, "BLOCK", block)
        got = minhash.near_duplicates(frame).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((i, n, c) for i, _, n, c in want)
    left = minhash.drop_near(frame).collect()
    # One text of each component stays, of the smallest id; each component is there, so no text is lost.
    sets = {}
    for i, t, n, c in want:
        if n:
            sets.setdefault(brute_component(rows, t), []).append((i, t))
    kept = {(r["doc_id"], r["text"]) for r in left if brute.shingle_set(r["text"])}
    assert len(kept) == len(sets)
    for members in sets.values():
        (one,) = kept & set(members)
        assert one[0] == min(i for i, _ in members)
    assert [r["text"] for r in left if r["doc_id"] == 9 and not r["text"]] in ([None, ""], ["", None])


def brute_component(rows, text):
    """The number of the component that a text is in."""
    texts = [t for _, t in rows]
    return brute.near(list(enumerate(texts)))[texts.index(text)][1]


def rotten(folder, change, checksums=False):
    """Change a stored file; its side file of checksums goes too unless the file system shall notice."""
    (file,) = folder.glob("part*")
    if not checksums:
        for side in folder.glob(".part*.crc"):
            side.unlink()
    change(file)


def test_damage_on_disk(spark, tmp_path):
    draw = random.Random(6)
    rows = [(i, f"http://h/{i}", "".join(draw.choice("abcdefgh <>") for _ in range(900))) for i in range(64 * 7)]
    path = str(tmp_path / "w")
    warc_fixity.write(warc_fixity.records(pages(spark, rows), 64), path, 2)
    known = warc_fixity.leaves(spark, f"{path}/replica=0")
    assert sorted(int(r["name"]) for r in known.collect()) == list(range(len(rows)))
    shard = lambda n: tmp_path / f"w/replica=1/shard={n * warc_fixity.CUTS}"

    def flip(file):
        raw = bytearray(file.read_bytes())
        raw[len(raw) // 2] ^= 0x10
        file.write_bytes(bytes(raw))

    rotten(shard(1), flip)
    rotten(shard(2), lambda file: file.write_bytes(file.read_bytes()[:-2000]))
    rotten(shard(3), lambda file: file.write_bytes(b""))
    rotten(shard(4), lambda file: file.unlink())
    rotten(shard(5), flip, checksums=True)
    found = warc_fixity.audit(warc_fixity.tree(known), warc_fixity.tree(warc_fixity.leaves_at(spark, f"{path}/replica=1", known)))
    hit = {n: set() for n in range(7)}
    for r in found.collect():
        hit[r["shard"] // warc_fixity.CUTS].add(r["leaf"])
    assert not hit[0] and not hit[6]
    everything = set(range(64))
    assert hit[3] == hit[4] == hit[5] == everything
    # What lies before the damage is still sound; from there on nothing can be read.
    for n in (1, 2):
        assert hit[n] == set(range(min(hit[n]), 64)) and min(hit[n]) > 20
    assert min(hit[2]) > 55


def test_unpacking_stops_at_damage():
    raw = bytes(random.Random(1).choices(range(97, 110), k=300_000))
    packed = gzip.compress(raw)
    assert warc_fixity.unpacked(packed) == raw and warc_fixity.unpacked(packed + gzip.compress(b"more")) == raw + b"more"
    assert warc_fixity.unpacked(b"") == b"" and warc_fixity.unpacked(b"no gzip at all") == b""
    cut = warc_fixity.unpacked(packed[: len(packed) // 2])
    assert raw.startswith(cut) and len(cut) > len(raw) // 3
    assert raw.startswith(warc_fixity.unpacked(packed[:-3]))


def test_shards_are_cut_by_bytes_and_unnamed_rows_are_dealt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_fixity, "SHARD_BYTES", 3000)
    rows = [(i, None, "y" * 400) for i in range(40)] + [(None, f"u{i}", f"z{i}") for i in range(90)]
    path = str(tmp_path / "w")
    warc_fixity.write(warc_fixity.records(pages(spark, rows), 16), path)
    known = warc_fixity.leaves(spark, f"{path}/replica=0").collect()
    assert len(known) == len(rows)
    sizes = {}
    for r in known:
        sizes.setdefault(r["shard"], []).append(r["end"] - r["begin"])
    assert all(sum(s) - s[-1] <= 3000 for s in sizes.values())
    assert len([n for n in sizes if n >= 0]) >= 6 and len([n for n in sizes if n < 0]) >= 6
    assert all((r["name"] == "") == (r["shard"] < 0) for r in known)
