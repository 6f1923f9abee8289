"""Main text of web pages, with a suffix array over each host's pages.

Pages are dealt into groups of one host, large hosts into several of at most about PAGES_A_GROUP
pages. In a group, the token streams of whole pages are put one after another, what lies outside
article elements first and then each block inside one, and their suffixes sorted. Outside articles,
neighbours in that order that share at least REPEAT_TOKENS tokens and come from different pages mark
boilerplate. Covered tokens are removed, unique runs stay. Groups of one host exchange hashes of
their windows of REPEAT_TOKENS tokens, so that a passage on two pages is found wherever they were
dealt, and the result does not depend on the groups.

Inside articles, neighbours that share a whole block give the pages it stands on. Passages that a few
articles repeat belong to them; a block goes only if it is the host's template: of REPEAT_TOKENS
tokens or more, and found in more than half of the host's articles, TEMPLATE_PAGES at least, counting
only articles that have half of their tokens in blocks that no other article has. Copies and near
copies of an article are thus no sign of a template. Of a host in several groups, the articles that
hold a block are counted over all of them.

Elements that name themselves as menu, header, footer, sidebar, notice, advert, form or comments are
never main text; a class or id counts as such a name only if all its parts do. A page's article is
its text; where it has none, its main element is, and without one all other blocks are, less the
boilerplate found.

Defined results: null, empty and tag-free pages are their plain text, or empty; pages without a
URL form a host of their own; repeated rows give the same result each, and as they share an id they
count as one page; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import stored, table
from tallyfield.llm.html_blocks import Block, blocks

#: Pages of a host that are looked at together, about.
PAGES_A_GROUP = 256

#: Shortest repeat that counts, and tokens by which suffixes are told apart.
REPEAT_TOKENS, DEPTH = 6, 64

#: Articles at least that hold a block of the host's template.
TEMPLATE_PAGES = 8


def suffix_array(stream: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first tokens (by prefix doubling), and how many neighbours share."""
    n = len(stream)
    values, ids, counts = np.unique(stream, return_inverse=True, return_counts=True)
    # The rank of a suffix is its class's first place in the order, so that classes can be cut alone.
    levels = [(np.cumsum(counts) - counts)[ids].astype(np.int32)]
    length = 1
    while length < depth:
        rank = levels[-1]
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            break
        base = rank[tied].astype(np.int64)
        after = np.zeros(len(tied), np.int64)
        follows = tied + length < n
        after[follows] = rank[tied[follows] + length] + 1
        key = base * (n + 1) + after
        by_key = np.argsort(key, kind="stable")
        key, base = key[by_key], base[by_key]
        at = np.arange(len(tied))
        old = np.maximum.accumulate(np.where(np.diff(base, prepend=-1) != 0, at, 0))
        new = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, at, 0))
        cut = rank.copy()
        cut[tied[by_key]] = base + new - old
        levels.append(cut)
        length *= 2
    order = np.argsort(levels[-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(max(n - 1, 0), np.int64)
    for level in reversed(range(len(levels))):
        inside = (left < n) & (right < n)
        same = np.zeros(len(shared), bool)
        same[inside] = levels[level][left[inside]] == levels[level][right[inside]]
        shared += same * (1 << level)
        left += same * (1 << level)
        right += same * (1 << level)
    return order, shared


def sorted_pages(
    tokens: list[list[int]], pages: list[int], passages: list[list[int]], least: int = REPEAT_TOKENS
) -> tuple[list[np.ndarray], np.ndarray]:
    """What one suffix array says of a group's streams and of the blocks inside its articles.

    For each page's stream, which tokens lie in a substring that another page's stream has too; for
    each block, a number that equal blocks share.
    """
    if not any(tokens) and not passages:
        return [np.zeros(len(row), bool) for row in tokens], np.zeros(0, np.int64)
    # Every stream and block ends in a mark of its own, so that nothing shared runs over it.
    stream = np.concatenate([np.array([*row, -1 - i], np.int64) for i, row in enumerate([*tokens, *passages])])
    owner = np.concatenate([np.full(len(row) + 1, page) for row, page in zip(tokens, pages, strict=True)])
    sizes = np.array([len(row) for row in passages], np.int64)
    order, shared = suffix_array(stream, max(DEPTH, sizes.max(initial=0) + 1))
    # Outside articles: runs of suffixes that share enough, of streams only.
    run = np.concatenate([[0], np.cumsum(shared < least)])
    of_stream = order < len(owner)
    among, own = run[of_stream], owner[order[of_stream]]
    first = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    last = np.full(run[-1] + 1, -1)
    np.minimum.at(first, among, own)
    np.maximum.at(last, among, own)
    begins = order[of_stream][(first != last)[among]]
    covered = np.zeros(len(stream) + least + 1, np.int64)
    np.add.at(covered, begins, 1)
    np.add.at(covered, begins + least, -1)
    covered = np.cumsum(covered)[: len(stream)] > 0
    ends = np.cumsum([len(row) + 1 for row in tokens])
    masks = [covered[end - len(row) - 1 : end - 1] for row, end in zip(tokens, ends, strict=True)]
    if not passages:
        return masks, np.zeros(0, np.int64)
    # Inside them: blocks next to each other in the order that share all their tokens.
    place = np.empty(len(stream), np.int64)
    place[order] = np.arange(len(stream))
    at = place[len(owner) + np.cumsum(sizes + 1) - sizes - 1]
    by_place = np.argsort(at)
    common = np.minimum.reduceat(np.append(shared, 0), at[by_place])[:-1]
    ordered = sizes[by_place]
    differs = (common < ordered[:-1]) | (ordered[:-1] != ordered[1:])
    equal = np.empty(len(passages), np.int64)
    equal[by_place] = np.concatenate([[0], np.cumsum(differs)])
    return masks, equal


def repeated(tokens: list[list[int]], pages: list[int], least: int = REPEAT_TOKENS) -> list[np.ndarray]:
    """For each page's stream, which tokens lie in a substring that another page has too."""
    return sorted_pages(tokens, pages, [], least)[0]


def template_blocks(equal: np.ndarray, pages: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which blocks inside a host's articles are its template, by their numbers, pages and tokens."""
    pairs = np.unique(np.stack([equal, pages]), axis=1)
    lone = np.bincount(pairs[0])[equal] == 1
    whole, own = np.bincount(pages, sizes), np.bincount(pages, sizes * lone)
    telling = 2 * own >= whole
    held = np.bincount(pairs[0], telling[pairs[1]])[equal]
    return (held >= TEMPLATE_PAGES) & (2 * held > len(np.unique(pages))) & (sizes >= REPEAT_TOKENS)


#: Odd factors of the two halves of a window's hash, and rows of windows sent on at once, about.
FACTORS, WINDOW_ROWS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), 100_000


def outside(page: list[Block]) -> list[str]:
    """The tokens of what lies outside a page's articles."""
    return [word for block in page if not block.article for word in block.text.split()]


def inside(page: list[Block]) -> list[str]:
    """Each block of a page's articles; its tokens stand one space apart."""
    return [block.text for block in page if block.article and not block.dropped]


def block_hash(text: str) -> bytes:
    """A 128-bit hash of a whole block."""
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16, person=b"block").digest()


def numbers(hashes: list[bytes]) -> np.ndarray:
    """128-bit hashes as two columns."""
    return np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)


def windows(words: list[str], known: dict[str, bytes], size: int = REPEAT_TOKENS) -> np.ndarray:
    """A 128-bit hash of each window of tokens, as two columns; known keeps the hashes of words."""
    if len(words) < size:
        return np.zeros((0, 2), np.int64)
    for word in words:
        if word not in known:
            known[word] = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    each = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u8").reshape(-1, 2)
    total = np.zeros((len(words) - size + 1, 2), np.uint64)
    for at in range(size):
        total = total * np.array(FACTORS, np.uint64) + each[at : at + len(total)]
    return total.view(np.int64)


#: Kinds of rows that _windows() gives.
WINDOW, BLOCK, ARTICLE = 0, 1, 2


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct windows of each page and the blocks of its articles, and which pages have an article."""
    for batch in batches:
        known: dict[str, bytes] = {}
        made, counts, where, rows = [], [], [], 0

        def frame() -> pd.DataFrame:
            hashes = np.concatenate(made)
            kinds = np.repeat(np.tile([WINDOW, BLOCK, ARTICLE], len(where)), counts)
            each = pd.DataFrame(where, columns=["host", "part", "page"]).iloc[
                np.repeat(np.arange(len(where)), np.reshape(counts, (-1, 3)).sum(axis=1))
            ]
            return each.reset_index(drop=True).assign(kind=kinds, a=hashes[:, 0], b=hashes[:, 1])

        for html, *of in zip(batch["html"], batch["host"], batch["part"], batch["page"], strict=True):
            read = blocks(html)
            held = inside(read)
            told = {block_hash(text) for text in held if text.count(" ") >= REPEAT_TOKENS - 1}
            found, article = windows(outside(read), known), np.zeros((1 if held else 0, 2), np.int64)
            made += [found, numbers([*told]), article]
            counts += [len(found), len(told), len(article)]
            where.append(of)
            rows += len(found) + len(told)
            if rows >= WINDOW_ROWS:
                yield frame()
                made, counts, where, rows = [], [], [], 0
        if made:
            yield frame()


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct blocks of each page's articles, with their tokens on the page."""
    for batch in batches:
        rows = []
        for html, host, page in zip(batch["html"], batch["host"], batch["page"], strict=True):
            sizes: dict[bytes, int] = {}
            for text in inside(blocks(html)):
                told = block_hash(text)
                sizes[told] = sizes.get(told, 0) + len(text.split())
            rows += [(host, page, *pair, size) for pair, size in zip(numbers([*sizes]).tolist(), sizes.values(), strict=True)]
        yield pd.DataFrame(rows, columns=["host", "page", "a", "b", "tokens"])


def _template(pages: DataFrame) -> DataFrame:
    """As template_blocks(), of hosts in several groups: (host, a, b) from (html, host, page)."""
    block = ["host", "a", "b"]
    every = pages.mapInPandas(_blocks, "host string, page long, a long, b long, tokens long")
    held = stored(every.groupBy("host", "page", "a", "b").agg(F.sum("tokens").alias("tokens")))
    several = held.groupBy(*block).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*block)
    common = held.join(several, block)
    whole = held.groupBy("host", "page").agg(F.sum("tokens").alias("whole"))
    repeats = common.groupBy("host", "page").agg(F.sum("tokens").alias("repeats"))
    telling = whole.join(repeats, ["host", "page"]).where("2 * (whole - repeats) >= whole").select("host", "page")
    counts = common.join(telling, ["host", "page"]).groupBy(*block).agg(F.count(F.lit(1)).alias("held"))
    articles = whole.groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    return counts.where(F.col("held") >= TEMPLATE_PAGES).join(articles, "host").where("2 * held > articles").select(*block)


def _shared(dealt: DataFrame) -> DataFrame:
    """For each group, what it can't tell alone: hashes of windows and of blocks.

    Its windows that stand on one of its pages and on a page of another group, and the blocks that
    are its host's template. A block in more than half of a host's articles is in more than half of
    those of some group; only hosts that have such a block are looked at for their template.
    """
    pages = dealt.where("groups > 1").select("html", "host", "part", F.xxhash64("page_id").alias("page"))
    every = pages.mapInPandas(_windows, "host string, part long, page long, kind int, a long, b long")
    holder = F.when(F.col("kind") == ARTICLE, F.col("page")).alias("holder")
    seen = stored(
        every.groupBy("host", "part", "kind", "a", "b", holder).agg(
            F.min("page").alias("low"), F.max("page").alias("high"), F.count(F.lit(1)).alias("n")
        )
    )
    windows_seen, window = seen.where(F.col("kind") == WINDOW), ["host", "a", "b"]
    twice = windows_seen.groupBy(*window).agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first <> last")
    marks = windows_seen.where("low = high").join(twice, window, "left_semi").select("host", "part", "a", "b")
    # Pages without an id are one page in several groups: none of theirs.
    with_id = (F.col("kind") == ARTICLE) & (F.col("holder") != F.xxhash64(F.lit(None).cast("long")))
    groups = seen.groupBy("host", "part").agg(F.count_if(with_id).alias("articles"))
    often = seen.where(F.col("kind") == BLOCK).join(F.broadcast(groups), ["host", "part"]).where("2 * n > articles")
    hosts = stored(often.select("host").distinct())
    if hosts.isEmpty():
        return stored(marks)
    template = _template(pages.join(hosts, "host").select("html", "host", "page"))
    return stored(marks.unionByName(template.join(groups.select("host", "part"), "host").select("host", "part", "a", "b")))


def main_texts(pages: list[list[Block]], keys: list, marks: np.ndarray | None = None) -> list[str]:
    """Main text of each page of one host's group.

    Of a host in several groups, marks are the windows that other groups have too, and the blocks
    that are its template.
    """
    number: dict[str, int] = {}
    page_of: dict = {}
    streams = []
    for page in pages:
        streams.append([number.setdefault(word, len(number)) for word in outside(page)])
    owners = [page_of.setdefault(key, len(page_of)) for key in keys]
    held = [(owner, text) for page, owner in zip(pages, owners, strict=True) for text in inside(page)]
    passages = [[number.setdefault(word, len(number)) for word in text.split()] for _, text in held]
    sizes = np.array([len(passage) for passage in passages], np.int64)
    covered, equal = sorted_pages(streams, owners, passages)
    marked, known = set() if marks is None else set(map(tuple, marks.tolist())), {}
    gone = np.zeros(len(held), bool)
    if held and marks is None:
        gone = template_blocks(equal, np.array([owner for owner, _ in held]), sizes)
    elif held and marked:  # equal blocks are told by one of them
        _, one, which = np.unique(equal, return_index=True, return_inverse=True)
        told = [tuple(pair) in marked for pair in numbers([block_hash(held[i][1]) for i in one]).tolist()]
        gone = np.array(told)[which] & (sizes >= REPEAT_TOKENS)
    if marked:
        for page, mask in zip(pages, covered, strict=True):
            for at, window in enumerate(windows(outside(page), known).tolist()):
                if tuple(window) in marked:
                    mask[at : at + REPEAT_TOKENS] = True
    texts, stays = [], iter(~gone)
    for page, mask in zip(pages, covered, strict=True):
        has_article = any(block.article and not block.dropped for block in page)
        has_main = any(block.main and not block.dropped for block in page)
        kept, at = [], 0
        for block in page:
            if block.article:
                if not block.dropped and next(stays):
                    kept.append(block.text)
                continue
            words = block.text.split()
            hit = mask[at : at + len(words)]
            at += len(words)
            if not has_article and not block.dropped and block.main >= has_main:
                kept.append(" ".join(word for word, gone in zip(words, hit, strict=True) if not gone))
        texts.append("\n\n".join(text for text in kept if text))
    return texts


def _group(pages: pd.DataFrame) -> pd.DataFrame:
    return _marked_group(pages, None)


def _marked_group(pages: pd.DataFrame, marks: pd.DataFrame | None) -> pd.DataFrame:
    read = [blocks(page) for page in pages["html"]]
    keys = [None if pd.isna(key) else key for key in pages["page_id"]]
    split = marks is not None and (pages["groups"] > 1).any()
    texts = main_texts(read, keys, marks[["a", "b"]].to_numpy() if split else None)
    return pd.DataFrame({
        "page_id": pages["page_id"], "url": pages["url"], "text": texts, "n_chars": [len(text) for text in texts]
    })


def extract(pages: DataFrame, pages_a_group: int = PAGES_A_GROUP) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of (page_id, url, html)."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    source = pages.select("page_id", "url", "html", host.alias("host"))
    large = stored(source.groupBy("host").count().where(F.col("count") > pages_a_group).toDF("host", "pages"))
    groups = F.ceil(F.coalesce("pages", F.lit(1)) / pages_a_group)
    # Pages without an id are one page to the suffix array, but not one group.
    dealt_by = F.when(F.col("page_id").isNull(), F.xxhash64("html")).otherwise(F.xxhash64("page_id"))
    dealt = source.join(large, "host", "left").select(
        "page_id", "url", "html", "host", F.pmod(dealt_by, groups).alias("part"), groups.alias("groups")
    )
    kind = source.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long"
    grouped = dealt.groupBy("host", "part")
    if large.isEmpty():
        return grouped.applyInPandas(_group, schema)
    return grouped.cogroup(_shared(dealt).groupBy("host", "part")).applyInPandas(_marked_group, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
