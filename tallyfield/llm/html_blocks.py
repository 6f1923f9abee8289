"""Blocks of text of one web page, in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Element names of HTML, and words that name what is no main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title template noscript iframe object svg math select canvas audio video".split())
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = set("nav header footer aside form menu dialog head button search".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "disqus footer header menu nav navbar navigation newsletter notice notices popup promo related share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that a compound name may add to one of those: "site-header", "sidebar_left", "ad-slot-2".
COMPANION_WORDS = set(
    "area bar block body bottom box col column container content desktop global group inner item items left link links "
    "list main mobile outer panel placeholder primary right row secondary section site slot sticky top unit wrap wrapper".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
MAIN = set("article main".split())
#: Elements that no class or id can make something else.
WHOLE = set("html body article main".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
_OPEN_QUOTE = re.compile(r"""=\s*(["'])""")
_NAME_PART = re.compile(r"[-_]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    article: bool  # inside an article element
    main: bool  # inside a main element
    dropped: bool  # inside an element that names itself as something else


def _tag_end(page: str, begin: int) -> int:
    """Place of a tag's closing bracket, not one inside a quoted value; -1 if there is none."""
    end = page.find(">", begin)
    if end < 0 or ("=" not in page[begin:end]):
        return end
    left = _OPEN_QUOTE.search(_QUOTED.sub("", page[begin:end]))
    if left:
        close = page.find(left[1], end)
        if close >= 0 and (after := page.find(">", close)) >= 0:
            return after
    return end


def _names_other(token: str) -> bool:
    """Whether a class or id says that its element is no main text: all its parts must agree to it."""
    parts = [part for part in _NAME_PART.split(token) if part and not part.isdigit()]
    return any(part in DROPPED_WORDS for part in parts) and all(
        part in DROPPED_WORDS or part in COMPANION_WORDS for part in parts
    )


def _is_dropped(name: str, attributes: str) -> bool:
    if name in DROPPED:
        return True
    if "=" not in attributes or name in WHOLE:
        return False
    for key, value in _NAMED.findall(attributes):
        value = value.strip("\"'").lower()
        if key.lower() == "role":
            if value in DROPPED_ROLES:
                return True
        elif any(map(_names_other, value.split())):
            return True
    return False


class _Reader:
    def __init__(self) -> None:
        self.stack: list[tuple[str, bool]] = []  # open elements, and whether each is dropped
        self.names: dict[str, int] = {}
        self.dropped = 0
        self.parts: list[str] = []
        self.blocks: list[Block] = []

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.blocks.append(Block(text, *[self.names.get(name, 0) > 0 for name in ("article", "main")], self.dropped > 0))
        self.parts.clear()

    def open(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name in BLOCK:
            self.flush()
            if self.names.get("p"):
                self.close_to("p")
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            return
        if name == "body":
            self.close_to("head")
        dropped = _is_dropped(name, attributes)
        if name in MAIN and not any(self.names.get(main) for main in MAIN):
            while self.dropped:  # an article does not lie in an advert that was never closed
                self.pop()
        self.stack.append((name, dropped))
        self.names[name] = self.names.get(name, 0) + 1
        self.dropped += dropped

    def pop(self) -> str:
        name, dropped = self.stack.pop()
        self.names[name] -= 1
        self.dropped -= dropped
        return name

    def close_to(self, name: str) -> None:
        if self.names.get(name):
            while self.pop() != name:
                pass

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        self.close_to(name)


def blocks(page: str | None) -> list[Block]:
    """The page's text blocks: references decoded, white space inside a block made one space."""
    page = page or ""
    reader, at, size = _Reader(), 0, len(page)
    lowered = None
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            reader.parts.append(html.unescape(page[at:]))
            break
        if begin > at:
            reader.parts.append(html.unescape(page[at:begin]))
        follows = page[begin + 1 : begin + 2]
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
        elif follows in ("!", "?"):
            end = page.find(">", begin)
            at = size if end < 0 else end + 1
        elif follows == "/" or follows.isalpha():
            end = _tag_end(page, begin)
            found = _NAME.match(page, begin + 1 + (follows == "/"))
            if end < 0:
                break
            at = end + 1
            if not found:
                continue
            name = found[0].lower()
            if follows == "/":
                reader.close(name)
            elif name in RAW:
                lowered = lowered if lowered is not None else page.lower()
                lowered = lowered if len(lowered) == size else page  # a page whose lower case is longer
                close = lowered.find("</" + name, at)
                end = -1 if close < 0 else page.find(">", close)
                at = size if end < 0 else end + 1
            else:
                reader.open(name, page[found.end() : end])
        else:
            reader.parts.append("<")
            at = begin + 1
    reader.flush()
    return reader.blocks
