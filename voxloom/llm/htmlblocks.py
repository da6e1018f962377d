"""Leaf blocks of a page: its visible text between block-level tags, each with what its path of tags says.

One pass over the page, linear in its length whatever it holds. Tags end at ``>`` outside quoted values; elements whose content isn't
text of the page (scripts, styles, templates) are passed over; an unfinished tag, comment or script at the end of the page is markup. End tags without a start
are ignored; a new block ends an open paragraph, a new item an open item.
"""

from __future__ import annotations

import html
import re
import zlib
from typing import NamedTuple

#: Buckets of path tokens and of words.
PATH_BUCKETS, WORD_BUCKETS = 4096, 4096
#: Tokens of a path that count, from the innermost element, and words of an element's attributes.
PATH_TOKENS, NAME_WORDS = 48, 12
#: Elements that begin and end blocks. Fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul label textarea title".split()
)
#: Elements without an end tag, with raw content, and whose content isn't shown. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes title textarea xmp".split())
UNSEEN = frozenset("template noscript svg math canvas object audio video select datalist".split())
#: An element that ends an open one of the same group, unless a parent of the group has begun since. Fixed values.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}
HOLDERS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "td": ("table", "tr"), "th": ("table", "tr"), "tr": ("table",)}
#: Elements beyond which a paragraph isn't ended.
SCOPE = frozenset("td th caption table html button".split())
#: Elements that hold a page's article, and those that never do.
ARTICLE, ASIDE = ("article", "main"), ("nav", "aside", "footer", "form", "dialog")

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTR = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}


class Leaf(NamedTuple):
    text: str
    path: tuple[int, ...]
    linked: float  # share of characters in links
    place: int  # 1 in the page's article by its elements, 0 outside of it


class _Element:
    __slots__ = ("tag", "path", "tail", "paragraphs")

    def __init__(self, tag: str, path: tuple[int, ...], tail: tuple[int, ...], paragraphs: int) -> None:
        self.tag, self.path, self.tail, self.paragraphs = tag, path, tail, paragraphs


def _bucket(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) % PATH_BUCKETS


def names_of(attrs: str) -> list[str]:
    """Words of the attributes that name an element's part in a page."""
    out = []
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role", "itemprop", "aria-label", "data-role", "data-component"):
            out += [w.lower() for w in _NAME.findall(value[:400])]
        elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value[:400])) or (key == "aria-hidden" and value == "true"):
            out.append("hidden")
    return out[:NAME_WORDS]


class Reader:
    """Reads pages; remembers the tokens of elements that it has seen."""

    def __init__(self) -> None:
        self.known: dict[tuple[str, str], tuple[tuple[int, ...], tuple[int, ...]]] = {}

    def tokens(self, tag: str, attrs: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Buckets of an element on a path, and as its innermost element."""
        key = (tag, attrs)
        if (got := self.known.get(key)) is None:
            named = names_of(attrs) if attrs else []
            words = [f"t:{tag}", *[f"n:{w}" for w in named]]
            got = tuple(map(_bucket, words)), tuple(_bucket(f"i{w}") for w in words)
            if len(attrs) < 300:
                if len(self.known) > 20_000:
                    self.known.clear()
                self.known[key] = got
        return got

    def leaves(self, page: str) -> list[Leaf]:
        out: list[Leaf] = []
        root = _Element("", (), (), 0)
        stack, open_of = [root], {}
        parts: list[str] = []
        begun, linked, unseen, at, n = None, 0, 0, 0, len(page)

        def close() -> None:
            nonlocal begun, linked
            if begun is not None:
                text = " ".join("".join(parts).split())
                top, place = begun
                out.append(Leaf(text, top.path + top.tail, min(1.0, linked / max(len(text), 1)), place))
            begun, linked = None, 0
            parts.clear()

        def pop() -> None:
            nonlocal unseen
            gone = stack.pop()
            open_of[gone.tag] -= 1
            unseen -= gone.tag in UNSEEN

        while at < n:
            i = page.find("<", at)
            text = page[at : i if i >= 0 else n]
            if text and not unseen:
                if "&" in text:
                    text = html.unescape(text)
                if begun is None and not text.isspace() and text:
                    inside = any(open_of.get(t) for t in ARTICLE) and not any(open_of.get(t) for t in ASIDE)
                    begun = (stack[-1], int(inside))
                parts.append(text)
                if open_of.get("a"):
                    linked += len(text)
            if i < 0:
                break
            following = page[i + 1 : i + 2]
            if following == "!" or following == "?":
                if page.startswith("<!--", i):
                    end = page.find("-->", i + 4)
                    at = n if end < 0 else end + 3
                else:
                    end = page.find(">", i)
                    at = n if end < 0 else end + 1
                continue
            if not (following.isascii() and following.isalpha()) and not (following == "/" and page[i + 2 : i + 3].isascii() and page[i + 2 : i + 3].isalpha()):
                if begun is None:
                    begun = (stack[-1], int(any(open_of.get(t) for t in ARTICLE) and not any(open_of.get(t) for t in ASIDE)))
                if not unseen:
                    parts.append("<")
                else:
                    begun = None
                at = i + 1
                continue
            m = _TAG.match(page, i)
            if m:
                slash, tag, attrs, at = m[1], m[2].lower(), m[3], m.end()
            else:
                end = page.find(">", i)
                if end < 0:
                    break
                slash, attrs, at = "/" if following == "/" else "", "", end + 1
                tag = re.match(r"[^\s/>]*", page[i + 1 + len(slash) : i + 65])[0].lower()
            block = tag in BLOCKS
            if block:
                close()
            elif tag == "br":
                parts.append(" ")
            if slash:
                if open_of.get(tag):
                    while stack[-1].tag != tag:
                        pop()
                    pop()
                continue
            if tag in VOID:
                continue
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                if end is None:
                    break
                close_at = page.find(">", end.end())
                at = n if close_at < 0 else close_at + 1
                continue
            if tag in UNSEEN and attrs.endswith("/"):
                continue
            if block and tag != "button" and stack[-1].paragraphs and open_of.get("p"):
                while stack[-1].tag != "p":
                    pop()
                pop()
            if tag in ENDS:
                for j in range(len(stack) - 1, max(len(stack) - 9, 0), -1):
                    if stack[j].tag in HOLDERS[tag]:
                        break
                    if stack[j].tag in ENDS[tag]:
                        while len(stack) > j:
                            pop()
                        break
            top = stack[-1]
            own, inner = self.tokens(tag, attrs)
            path = top.path if not block and len(own) == 1 else (top.path + own)[-PATH_TOKENS:]
            paragraphs = 0 if tag in SCOPE else top.paragraphs + (tag == "p")
            stack.append(_Element(tag, path, inner if block else top.tail, paragraphs))
            open_of[tag] = open_of.get(tag, 0) + 1
            unseen += tag in UNSEEN
        close()
        return [x for x in out if x.text]
