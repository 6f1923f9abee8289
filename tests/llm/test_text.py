"""Personal data, quality, main text, language."""

import hashlib
import random
import re
import zlib

import brute
import numpy as np

from tallyfield.llm import boosting, html_main, language_id, pii, quality
from tallyfield.llm.html_blocks import blocks

EDGES = [(1, None), (2, ""), (3, "   \n"), (4, "a"), (4, "a"), (None, "mail me@x.org"), (5, "9" * 60000), (6, "1 " * 9000), (7, "a.b-" * 15000)]


def random_texts(seed, many):
    draw = random.Random(seed)
    pieces = [
        "a@b.co", "x_", "@", ".", "..", "1.2.3.4", "300.1.1.1", "256", " ", "  ", "\n", "4111 1111 1111 1111", "4111-1111",
        "+1 (706) 555-3138", "+", "(", "é", "😀", "12", "0", "-", "a", "b@c", ".de", "%", "4012888888881881",
    ]
    return ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 25))) for _ in range(many)]


def text_of(spans):
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def test_base_spans_against_brute_force(docs):
    rows = list(enumerate(random_texts(1, 1500))) + [(9000 + n, t) for n, (_, t) in enumerate(EDGES)]
    got = {r["doc_id"]: r for r in pii.find(docs(rows)).collect()}
    for i, text in rows:
        assert text_of(got[i]["base"]) == ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_spans(text)), text
    assert pii.find(docs([])).count() == 0


def test_bootstrap_finds_unseen_and_leaves_clean(docs):
    draw = random.Random(2)
    plain = ["the", "house", "of", "green", "river", "walked", "along"]
    rows = [(i, f"{' '.join(draw.choices(plain, k=9))} cardno 4111111111111111 valid") for i in range(3)]
    cards = ["4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "6011111111111117", "4222222222222220"]
    rows += [(10 + i, f"the cardno {card} valid the {' '.join(draw.choices(plain, k=5))}") for i, card in enumerate(cards)]
    rows += [(50, "his cardno 1234567890123456 valid then"), (51, "room 123456 of the house"), (52, "the 2024-01-05 house")]
    rows += [(50, "another text without any")]
    got = pii.find(docs(rows)).collect()
    added = [(r["doc_id"], text_of(r["added"])) for r in got if r["added"]]
    assert (50, "card:11:27") in added
    assert all(i in (50, 13) for i, _ in added)
    masked = pii.masked(docs(rows))
    assert masked.columns == docs([]).columns
    texts = {(r["doc_id"], r["text"]) for r in masked.collect()}
    assert (50, "his cardno <CARD> valid then") in texts and (51, "room 123456 of the house") in texts
    assert (0, rows[0][1].replace("4111111111111111", "<CARD>")) in texts


def test_bootstrap_weighs_occurrences(docs):
    rows = [(i, "contact: help@x.org") for i in range(1000)]
    rows += [(2000 + i, f"contact: name{i}@x.org") for i in range(10)]
    rows += [(3000, "contact: sales7(at)x.org"), (3001, "call: sales8(at)x.org")]
    found = {r["doc_id"]: text_of(r["added"]) for r in pii.find(docs(rows)).collect() if r["added"]}
    assert found == {3000: "email:9:24"}


def test_bootstrap_goes_on_from_discovered(docs):
    tokens = [[f"u{i}@x.org" for i in range(6)]] + [[f"tok{step}x{i}" for i in range(6)] for step in range(1, 6)]
    rows = []
    for step in range(5):
        known = " ".join(f"cue{'abcde'[step]} {token} the the the the" for token in tokens[step])
        rows += [(100 * step + i, known) for i in range(90)]
        rows += [(1000 + 10 * step + i, f"cue{'abcde'[step]} {token} the") for i, token in enumerate(tokens[step + 1])]
    found = {r["doc_id"]: text_of(r["added"]) for r in pii.find(docs(rows)).collect() if r["doc_id"] >= 1000}
    assert found == {1000 + 10 * step + i: "email:5:11" for step in range(5) for i in range(6)}


def test_masked_keeps_rows_whole(docs):
    rows = EDGES + list(enumerate(random_texts(3, 200), 100))
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in pii.masked(docs(rows)).collect())
    want = []
    for i, text in rows:
        out, at = "", 0
        for begin, end, kind in sorted((a, b, k) for k, a, b in brute.base_spans(text)):
            if begin >= at:
                out += text[at:begin] + f"<{kind.upper()}>"
            at = max(at, end)
        want.append((str(i), str(text if text is None else out + text[at:])))
    assert got == sorted(want)


def test_pii_query_is_native(spark, sf_dir, documents):
    found = pii.query(spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for row in found.collect():
        spans = brute.base_spans(texts[row["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in brute.PII] == [sum(s[0] == k for s in spans) for k in brute.PII]


def test_quality_counts():
    draw = random.Random(5)
    pieces = ["a", "b", "c", " ", "\n", "\t", "é", "#", "|", "x y z", "\x1f", " "]
    for _ in range(800):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 60)))
        assert quality.statistics(text)[0] == brute.quality_counts(text)


def test_trees_are_monotone_and_learn():
    draw = np.random.default_rng(6)
    rows = draw.normal(size=(3000, 3))
    labels = (rows[:, 0] + np.sin(3 * rows[:, 1]) + draw.normal(size=3000) / 3 < 0).astype(float)
    forest = boosting.fit(rows, labels, [-1, 0, 0])
    assert ((forest.probability(rows) > 0.5) == (labels > 0)).mean() > 0.9
    base = np.repeat(draw.normal(size=(200, 3)), 40, axis=0)
    base[:, 0] = np.tile(np.linspace(-3, 3, 40), 200)
    assert (np.diff(forest.probability(base).reshape(200, 40), axis=1) <= 1e-12).all()


def test_quality_query(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in quality.query(spark, sf_dir).collect()}
    for row in documents.collect():
        counts, one = brute.quality_counts(row["text"]), got[row["doc_id"]]
        assert [one[name] for name in quality.COUNTS] == counts
        assert one["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (one["kept"] and one["base_failed"])


def test_quality_holds_out(spark):
    from tallyfield.llm.common import table

    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    train = docs.where("doc_id % 2 = 0")
    forest = quality.learn(train, labels)
    rest = quality.judge(docs.where("doc_id % 2 = 1"), forest).join(labels, "doc_id").collect()
    right = [(r["score"] >= 0.5) == (r["quality"] == 1) for r in rest]
    assert sum(right) / len(right) > 0.93


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.learn(docs(EDGES), labels) is None
    got = quality.judge(docs(EDGES), None).collect()
    assert len(got) == len(EDGES) and all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judge(docs([]), None).count() == 0


def main_of(page):
    return [b.text for b in blocks(page) if (b.article or b.main) and not b.dropped]


def test_blocks():
    assert main_of("<nav>menu</nav><article><h1>T &amp; t</h1><p><b>a\n b<br>c<p>d</article><footer>f</footer>") == ["T & t", "a b c", "d"]
    assert main_of('<div class="ad"><p>buy<article><p>x</p><script>var a="</p>";</script><p>y') == ["x", "y"]
    assert main_of('<article>a<aside>no</aside>b<div id="comments"><p>no</div><form>no</form>c</article>') == ["a", "b", "c"]
    assert main_of('<article><p title="a>b">x &lt; y < z</p><!-- <p>no</p> --><style>no</style></article>') == ["x < y < z"]
    assert [b.text for b in blocks("plain &copy; text")] == ["plain © text"]
    assert blocks(None) == [] and blocks("") == [] and blocks("<p") == [] and blocks("<!-- x") == []
    assert len(blocks("<div>" * 50000 + "x")) == 1
    assert main_of('<article><div class="leading">kept</div><section class="share">no</section></article>') == ["kept"]


def test_suffix_array_against_brute_force():
    draw = np.random.default_rng(0)
    for _ in range(150):
        n = int(draw.integers(1, 50))
        stream = draw.integers(0, int(draw.integers(2, 6)), n)
        order, shared = html_main.suffix_array(stream)
        assert order.tolist() == sorted(range(n), key=lambda i: list(stream[i:]))
        for a, b, k in zip(order[:-1], order[1:], shared, strict=True):
            assert list(stream[a : a + k]) == list(stream[b : b + k])
            assert max(a, b) + k == n or stream[a + k] != stream[b + k]
        rows = [draw.integers(0, 3, int(draw.integers(0, 15))).tolist() for _ in range(4)]
        for i, mask in enumerate(html_main.repeated(rows, [0, 1, 2, 3], 3)):
            want = np.zeros(len(rows[i]), bool)
            for at in range(len(rows[i]) - 2):
                if any(rows[i][at : at + 3] == o[k : k + 3] for j, o in enumerate(rows) if j != i for k in range(len(o) - 2)):
                    want[at : at + 3] = True
            assert (mask == want).all()


def test_main_text(spark):
    common = "<div>Home News Sport Weather Travel Future Culture</div>"
    same = "a passage that two articles of one host share word for word"
    own = [" ".join(f"own{i}word{k}" for k in range(9)) for i in range(6)]
    rows = [(i, "http://h.example/x", f"{common}<div>{own[i]}</div><div>(c) all rights reserved by the host</div>") for i in range(6)]
    rows += [(10 + i, "http://h.example/y", f"{common}<article><h1>Title {i}</h1><p>{same}</p></article>") for i in range(3)]
    rows += [(20, None, None), (21, "http://other.example/", ""), (22, None, "<p>alone</p>"), (0, "http://h.example/x", rows[0][2])]
    frame = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, host string, part int")
    for size in (256, 2000):
        got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_main.extract(frame, size).collect())
        want = [*enumerate(own), (0, own[0])]
        want += [(10 + i, f"Title {i}\n\n{same}") for i in range(3)] + [(20, ""), (21, ""), (22, "alone")]
        assert got == sorted((i, t, len(t)) for i, t in want)
    assert html_main.extract(frame, 2).count() == len(rows)
    assert html_main.extract(frame.limit(0)).count() == 0


def test_main_text_of_a_large_host(spark):
    draw = random.Random(11)
    words = [[f"own{i}word{k}" for k in range(12)] for i in range(60)]
    for pair in range(30):  # each passage stands on two pages
        passage = [f"both{pair}word{k}" for k in range(draw.choice([5, 6, 9]))]
        for page in draw.sample(range(60), 2):
            words[page] = words[page][:6] + passage + words[page][6:]
    pages_of = {}
    for i, row in enumerate(words):
        for at in range(len(row) - 5):
            pages_of.setdefault(tuple(row[at : at + 6]), set()).add(i)
    want = []
    for i, row in enumerate(words):
        gone = {at + k for at in range(len(row) - 5) if len(pages_of[tuple(row[at : at + 6])]) > 1 for k in range(6)}
        want.append((i, " ".join(word for at, word in enumerate(row) if at not in gone)))
    rows = [(i, f"http://h.example/{i}", f"<div>{' '.join(row)}</div>") for i, row in enumerate(words)]
    rows += [(100, "http://other.example/", rows[0][2]), (0, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (1000, 7):
        got = sorted((r["page_id"], r["text"]) for r in html_main.extract(frame, size).collect())
        assert got == sorted([*want, want[0], (100, " ".join(words[0]))])


def test_language_query(spark, sf_dir):
    folder = "/root/testdata/sf0.01"
    got = language_id.query(spark, folder).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(folder + "/documents.parquet").collect()}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert sum(r["rejected"] for r in got) / len(got) < 0.01 and all(0 <= r["score"] <= 1 for r in got)


def test_language_margin(documents):
    model = language_id.learn(documents.where(~language_id.held_out()))
    packers, least = language_id._packers(tuple(sorted(model[0].items()))), model[1]
    assert 0.005 < least <= language_id.MOST_LEAD
    draw = random.Random(9)
    junk = [" ".join("".join(draw.choices("bcdfghjklmnpqrstvwxz", k=7)) for _ in range(n)) for n in [5, 20, 60, 300] * 10]
    assert sum(language_id.classify(text, packers, least)[2] for text in junk) >= 34
    held = documents.where(language_id.held_out()).collect()
    for lang in model[0]:
        clean = " ".join(r["text"] for r in held if r["lang"] == lang and language_id.classify(r["text"], packers, least)[0] == lang)
        for size in (20_000, 16_000_000 if lang == "en" else 500_000):
            text = (clean * (size // len(clean) + 1))[:size]
            got, lead, rejected = language_id.classify(text, packers, least)
            assert got == lang and lead > 0.05 and not rejected


def test_least_lead():
    right, wrong = [(x / 100, True) for x in range(6, 60)], [(0.004, False), (0.01, False), (0.0, False), (0.0, True)]
    assert abs(language_id.least_lead(right + wrong) - 0.035) < 1e-9
    assert language_id.least_lead(right) == 0.03
    assert language_id.least_lead([]) == language_id.least_lead([(0.9, True)] * 3) == language_id.MOST_LEAD
    assert 0.01 < language_id.least_lead([*right, (0.005, True), *wrong]) < 0.06


def test_predictions_recomputed(documents):
    """Every prediction again, from the dictionaries, one compressor and one text at a time."""
    import unicodedata

    import zstandard

    model = language_id.learn(documents.where(~language_id.held_out()))
    got = {r["doc_id"]: r for r in language_id.predict(documents, model).collect()}
    for row in documents.limit(40).collect():
        text = (row["text"] or "").lower()
        words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text).split()
        raw, sizes = " ".join(words).encode(), {}
        if not raw:
            assert got[row["doc_id"]]["lang_pred"] == "und"
            continue
        for lang, dictionary in model[0].items():
            known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(
                level=language_id.LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            size = language_id.BLOCK_BYTES
            sizes[lang] = sum(len(packer.compress(language_id.CARRIER + raw[at : at + size] + b" ")) for at in range(0, len(raw), size))
        (least, best), (second, _) = sorted((n, lang) for lang, n in sizes.items())[:2]
        one = got[row["doc_id"]]
        assert (one["lang_pred"], one["score"]) == (best, (second - least) / second)
        assert one["rejected"] == (one["score"] < model[1] or one["score"] == 0)


def test_letters():
    assert [language_id.letters(t) for t in ("½ ² ①", "Ⅷ ৪ 12_3", "", None, "٣ %")] == [b""] * 5
    assert language_id.letters("Aé½b 日本 一 x2y_Z") == "aé b 日本 一 x y z".encode()


def test_language_of_dirty_labels(docs, spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGS", 3)
    rows = [(i, "the quick words of a text " * 5, lang) for i, lang in enumerate(["en"] * 30 + ["de"] * 20 + ["fr"] * 10 + [f"x{n}" for n in range(40)])]
    found, least = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(found) == ["de", "en", "fr"] and 0 < least <= language_id.MOST_LEAD


def test_language_edges(docs):
    rows = [*EDGES, (8, "12 !! 34"), (8, "½ ² ①"), (9, "日本語")]
    none = language_id.learn(docs(rows))
    assert none[0] == {} and {r["lang_pred"] for r in language_id.predict(docs(rows), none).collect()} == {"und"}
    got = language_id.predict(docs(rows), ({"en": b"the house of the", "de": b"das haus der"}, 0.02)).collect()
    by = {(r["doc_id"], r["lang_pred"]) for r in got}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "und"), (8, "und")} <= by and len(got) == len(rows)
    assert {r["lang_pred"] for r in got} <= {"und", "en", "de"}
    assert all(r["score"] == 1 for r in language_id.predict(docs([(1, "a b")]), ({"en": b"the"}, 0.02)).collect())
    kept = language_id.accepted(docs([(1, "the house of the house"), (2, None)]), ({"en": b"the house of the", "de": b"das haus der"}, 0.02))
    assert kept.columns == docs([]).columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_class_names_do_not_empty_pages():
    def text_of(page):
        return html_main.main_texts([blocks(page)], [1])[0]

    for page in (
        '<article class="post has-comments"><p>the story</p></article>', '<body class="no-sidebar page"><div>the story</div></body>',
        '<html class="menu-closed"><body id="sidebar"><p>the story</p>', '<article><div class="notice-period">the story</div></article>',
        '<main id="footer"><div class="social-science">the story</div></main>', '<div class="add headers advertorials">the story</div>',
        '<article class="ad"><p>the story</p><div class="ad">buy</div></article>',
    ):
        assert text_of(page) == "the story", page
    for name in ("sidebar", "x sidebar y", "site-header", "sidebar_left", "ad-slot-2", "cookie-banner", "main-menu", "COMMENTS"):
        assert text_of(f'<div class="{name}">other</div><p>the story</p>') == "the story", name
        assert text_of(f"<div id='{name.split()[-1]}'>other</div><p>the story</p>") == ("the story" if name != "x sidebar y" else "other\n\nthe story")


SAFE, OTHER = ["", "post", "has-comments", "no-ad", "widgetry", "story-menu-x"], ["ad", "sidebar", "comments list", "nav-bar", "a cookie-banner"]


def drawn_page(draw, depth, dropped, out, article):
    """Nested elements with one text each; out gets the texts that belong to the page's main text."""
    html = ""
    for _ in range(draw.randrange(1, 4)):
        name = draw.choice(["div", "section", "p", "ul", "nav", "footer", "form", "span-less"])
        if name == "span-less":
            html += draw.choice(["<!-- <p>no</p> -->", "<script>var a='<p>no</p>'</script>", "<style>p{}</style>", "<hr>", "<img alt='<no'>"])
            continue
        other = draw.random() < 0.25 and name in ("div", "section", "p")
        words = draw.choice(OTHER if other else SAFE)
        quote = draw.choice(['"', "'"])
        gone = dropped or other or name in ("nav", "footer", "form")
        text = f"t{draw.randrange(10**9)} &amp;  &lt;x&gt;\n y"
        html += f"<{name} {draw.choice(['class', 'id'])}={quote}{words}{quote}>" if words else f"<{name}>"
        if name == "ul":
            html += f"<li>{text}<li>{text}</ul>"
            count = 2
        else:
            html += f"<b>{text[:3]}</b>{text[3:]}"
            count = 1
        if not gone:
            out += [" ".join(text.replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">").split())] * count
        if name != "ul":
            if depth and name != "p":
                html += drawn_page(draw, depth - 1, gone, out, article)
            html += f"</{name}>"
    return html


def test_tag_reader_on_drawn_pages():
    draw, some = random.Random(12), 0
    for _ in range(400):
        kind, out, outside = draw.choice(["article", "main", "body"]), [], []
        inner = drawn_page(draw, 3, False, out, kind)
        before, after = (drawn_page(draw, 1, False, outside, kind) for _ in range(2))
        page = inner if kind == "body" else f"{before}<{kind} class='{draw.choice(SAFE + OTHER)}'>{inner}</{kind}>{after}"
        page = f"<html class='menu-open'><head><title>no</title></head><body class='{draw.choice(SAFE)}'>{page}</body></html>"
        if kind != "body" and not out:
            out = outside if not any(b.article or b.main for b in blocks(page) if not b.dropped) else out
        assert html_main.main_texts([blocks(page)], [1])[0] == "\n\n".join(out), page
        some += len(out)
    assert some > 500


def test_array_decides_inside_main(spark):
    """Pages with a main element and no article: passages that pages of a host share go, wherever pages are dealt."""
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefgh", k=6))
    shared = " ".join(word() for _ in range(9))
    own = {i: " ".join(word() for _ in range(30)) for i in range(40)}
    rows = [(i, "http://h/x", f"<div>out</div><main><p>{shared}</p><p>{own[i]}</p></main>") for i in own]
    rows += [(100 + i, "http://h/x", f"<main><article><p>{shared}</p><p>{own[i]} a</p></article></main>") for i in range(3)]
    rows += [(None, "http://h/x", f"<main><p>{shared}</p><p>{n}one own</p></main>") for n in range(3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (1000, 7):
        got = {}
        for r in html_main.extract(frame, size).collect():
            got.setdefault(r["page_id"], []).append(r["text"])
        assert all(got[i] == [own[i]] for i in own)
        assert all(got[100 + i] == [f"{shared}\n\n{own[i]} a"] for i in range(3))
        assert sorted(got[None]) == [f"{n}one own" for n in range(3)]


def test_array_decides_inside_articles(spark):
    """A host's template inside its articles goes, whole blocks only; copies and shared passages stay."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=7))
    notice = "Read our terms before you copy any of this"
    own = {i: " ".join(word() for _ in range(30)) for i in range(40)}
    shared = " ".join(word() for _ in range(9))
    rows, want = [], {}

    def page(host, i, *texts, lost=()):
        rows.append((len(rows), f"http://{host}/{i}", f"<nav>menu</nav><article>{''.join(f'<p>{t}</p>' for t in texts)}</article>"))
        want[len(rows) - 1] = "\n\n".join(t for t in texts if t not in lost)

    for i in own:  # the notice in most articles, in some as a part of a block, a passage in a few
        if i % 4:
            page("most", i, own[i], notice, f"{notice} {i}", "short block", *[shared] * (i < 12), lost=[notice])
        else:
            page("most", i, own[i], "short block")
        page("few", i, own[i], *[notice] * (i < 18))  # less than half of them
        page("copies", i, own[0], notice)
        page("near", i, f"{own[0]} {i}", own[1], notice)
    for i in range(7):
        page("small", i, own[i], notice)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (1000, 7):
        got = {r["page_id"]: r["text"] for r in html_main.extract(frame, size).collect()}
        assert got == want, size
