"""HTML, CSS and srcset: a tolerant tree over the standard tokenizer, references and rewriting."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from palimpsest.functions.urls import REFERENCES, resolve
from palimpsest.profile import FORUM, SiteProfile
from palimpsest.session import release_memory

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag on the left closes an open element on the right.
CLOSES = {"li": {"li", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, "p": {"p"}, "div": {"p"}, "table": {"p"}, "ul": {"p"}, "option": {"option"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
BARRIERS = frozenset({"table", "div", "ul", "ol", "html", "body", "select", "dl"})
#: Elements that are not published.
DROPPED = frozenset("animate animatemotion animatetransform applet base discard embed foreignobject frame frameset iframe object script set".split())
#: Texts whose references are turned into a piece of an Arrow column at a time.
SLICE = 64


class Node:
    """An element; children are nodes and strings."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in ("script", "style"):
                out.append("\n" if node.tag in ("br", "p", "div", "tr", "li") else "")
                stack.extend(reversed(node.children))
        return "".join(out)

    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def find(self, tag: str | None = None, cls: str | None = None) -> list[Node]:
        return [n for n in self.walk() if (tag is None or n.tag == tag) and (cls is None or cls in n.classes())]

    def up(self, *tags: str) -> Node | None:
        node = self.parent
        while node is not None and node.tag not in tags:
            node = node.parent
        return node

    def serialize(self) -> str:
        attrs = "".join(f' {k}="{escape(v or "")}"' for k, v in self.attrs.items())
        inner = "".join(c.serialize() if isinstance(c, Node) else (c if self.tag in ("script", "style") else escape(c, quote=False)) for c in self.children)
        if self.tag == "#root":
            return inner
        return f"<{self.tag}{attrs}>" + ("" if self.tag in VOID else f"{inner}</{self.tag}>")


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        closed = CLOSES.get(tag, ())
        node = self.at
        while node.parent is not None and node.tag not in BARRIERS and closed:
            if node.tag in closed:
                self.at = node.parent
            node = node.parent
        own: dict[str, str] = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        child = Node(tag, own, self.at)
        self.at.children.append(child)
        if tag not in VOID:
            self.at = child

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag and self.at.parent is not None:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(text: str) -> Node:
    """The tree of a document; an XML declaration is dropped, nothing raises."""
    builder = _Builder()
    builder.feed(re.sub(r"^\s*<\?xml[^>]*\?>", "", text))
    builder.close()
    return builder.root


# --- CSS -------------------------------------------------------------------------------------

_CSS = re.compile(
    r"""/\*.*?(?:\*/|$)                                                    # comment
      | @import\s+(?:url\(\s*)?(?P<iq>["']?)(?P<import>[^"')\s;]+)(?P=iq)\s*\)?[^;]*;?
      | url\(\s*(?:"(?P<dq>(?:[^"\\]|\\.)*)"|'(?P<sq>(?:[^'\\]|\\.)*)'|(?P<bare>[^"'()\s]*))\s*\)
      | "(?:[^"\\]|\\.)*" | '(?:[^'\\]|\\.)*'                              # other strings""",
    re.X | re.S | re.I,
)


def _css_url(m: re.Match) -> str | None:
    for name in ("import", "dq", "sq", "bare"):
        if m[name] is not None:
            return unescape_css(m[name])
    return None


def css_references(css: str) -> list[str]:
    """Addresses in ``url()`` and ``@import``, outside comments and strings."""
    return [u for m in _CSS.finditer(css) if (u := _css_url(m))]


def rewrite_css(css: str, target: Callable[[str], str | None]) -> str:
    """Addresses replaced; a missing ``url()`` becomes an empty data address, a missing import goes."""

    def swap(m: re.Match) -> str:
        u = _css_url(m)
        if not u:
            return m[0]
        new = target(u)
        if m["import"] is not None:
            return f'@import url("{new}");' if new else ""
        return f'url("{new or "data:,"}")'

    return _CSS.sub(swap, css)


#: What runs code in a style sheet, and what fetches.
RUNS = re.compile(r"expression\s*\(|behavior\s*:|-moz-binding\s*:|javascript\s*:", re.I)
ODD_FETCH = re.compile(r"image-set\s*\(|cross-fade\s*\(", re.I)
ANY_FETCH = re.compile(r"url\s*\(|@import\b|image-set\s*\(|cross-fade\s*\(", re.I)

_QUIET = re.compile(r"""/\*.*?(?:\*/|$) | "(?:[^"\\]|\\.)*(?:"|$) | '(?:[^'\\]|\\.)*(?:'|$)""", re.X | re.S)
_ESCAPE = re.compile(r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))", re.S)


def css_outline(css: str) -> str:
    """The sheet with comments and strings blanked, every other character in its place."""
    return _QUIET.sub(lambda m: " " * len(m[0]), css)


def unescape_css(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[2] or "" if not m[1] else chr(int(m[1], 16)) if int(m[1], 16) < 0x110000 else "", text)


def fetches_oddly(css: str) -> bool:
    """Does the sheet fetch by functions that aren't rewritten, or by escaped names?"""
    outline = css_outline(css)
    plain = unescape_css(outline)
    return bool(ODD_FETCH.search(outline)) or (plain != outline and bool(ANY_FETCH.search(plain)))


def clean_css(css: str) -> str:
    """The sheet (or style attribute) without declarations that run code; nothing of one that fetches oddly."""
    if fetches_oddly(css):
        return ""
    outline = css_outline(css)
    if not RUNS.search(unescape_css(outline)):
        return css
    kept, start, depth = [], 0, 0
    for m in re.finditer(r"[(){};]|\Z", outline):
        sign, end = m[0], m.start()
        depth = max(0, depth + (sign == "(") - (sign == ")"))
        if sign in "()" and sign or (depth and sign):
            continue
        runs = sign != "{" and RUNS.search(unescape_css(outline[start:end]))
        kept.append("" if runs else css[start:end])
        if not (runs and sign == ";"):
            kept.append(sign)
        start = end + len(sign)
    return "".join(kept)


def parse_srcset(value: str) -> list[tuple[str, str]]:
    """(address, descriptor) pairs; commas inside data addresses don't part candidates."""
    out, rest = [], value.strip()
    while rest := rest.lstrip(" \t\r\n,"):
        url, _, rest = re.match(r"(\S+)(\s*)(.*)", rest, re.S).groups()
        if url.endswith(",") and not url.startswith("data:"):
            out.append((url.rstrip(","), ""))
            continue
        if not url.startswith("data:") and "," in url:
            url, _, more = url.partition(",")
            out.append((url, ""))
            rest = f"{more} {rest}"
            continue
        descriptor, _, rest = rest.partition(",")
        out.append((url, descriptor.strip()))
    return out


def serialize_srcset(candidates: list[tuple[str, str]]) -> str:
    return ", ".join(f"{u} {d}".strip() for u, d in candidates)


# --- references ------------------------------------------------------------------------------


def references(root: Node) -> list[tuple[str, bool]]:
    """(address as written, is it an asset) in document order, without unpublished elements."""
    out: list[tuple[str, bool]] = []
    skipped: set[int] = set()
    for node in root.walk():
        if node.tag in DROPPED or (node.parent is not None and id(node.parent) in skipped):
            skipped.add(id(node))
            continue
        a = node.attrs
        out += [(a[k], True) for k in ("src", "background", "poster") if a.get(k)]
        if a.get("data") and node.tag == "object":
            out.append((a["data"], True))
        if a.get("href"):
            if node.tag != "link":
                out.append((a["href"], False))
            elif set((a.get("rel") or "").lower().split()) & {"stylesheet", "icon", "preload"}:
                out.append((a["href"], True))
        out += [(u, True) for k in ("srcset", "imagesrcset") if a.get(k) for u, _ in parse_srcset(a[k])]
        if a.get("style"):
            out += [(u, True) for u in css_references(a["style"])]
        if node.tag == "style":
            out += [(u, True) for u in css_references("".join(c for c in node.children if isinstance(c, str)))]
    return out


def _column(find: Callable[[str, str], list[tuple[str, bool]]]):
    """Column function (text, url) -> array<struct<url, is_asset>>, a few rows of an Arrow batch at a time.

    Declared nondeterministic: else Spark copies it into the filter that it infers from an ``explode``,
    which has every text parsed twice, each time by a worker of its own.
    """
    kind = to_arrow_type(REFERENCES)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, urls in batches:
            for at in range(0, len(texts), SLICE):
                rows = zip(texts.slice(at, SLICE), urls.slice(at, SLICE), strict=True)
                yield pa.array([[{"url": u, "is_asset": a} for u, a in find(t, b)] if t and b else [] for t, b in ((t.as_py(), b.as_py()) for t, b in rows)], kind)
        release_memory()

    return F.arrow_udf(run, REFERENCES).asNondeterministic()


def page_references(profile: SiteProfile = FORUM):
    """Column function (html, url) -> array<struct<url, is_asset>>, Arrow-batched."""
    return _column(lambda text, base: resolve(base, references(parse(text)), profile))


def stylesheet_references(profile: SiteProfile = FORUM):
    """The same for style sheets; all their references are assets."""
    return _column(lambda text, base: [(u, True) for u, _ in resolve(base, [(r, True) for r in css_references(text)], profile)])
