"""HTML pages: splitting at page breaks and converting to text.

The tree work runs in Arrow UDFs over the standard library's parser; the
counters over found break elements are ordinary aggregates.
"""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BREAK_STYLES = ("page-break-before", "page-break-after", "break-before:page", "break-before: page")
_MARK = "\u0000"
_BREAK_ELEMENTS = ("hr", *_BREAK_STYLES)


class Node:
    """An element, a text or the root of a page."""

    __slots__ = ("attrs", "children", "parent", "tag", "text")

    def __init__(self, tag: str, parent: Node | None, attrs: list[tuple[str, str | None]] | None = None, text: str = ""):
        self.tag, self.parent, self.attrs, self.text = tag, parent, attrs or [], text
        self.children: list[Node] = []

    def get(self, name: str) -> str:
        return next((v or "" for k, v in self.attrs if k == name), "")

    def walk(self):
        stack = [iter(self.children)]
        while stack:
            node = next(stack[-1], None)
            if node is None:
                stack.pop()
            else:
                yield node
                stack.append(iter(node.children))


class _Builder(HTMLParser):
    """A tolerant tree: an end tag closes up to its element, an unknown one is dropped."""

    def __init__(self, comments: bool = False):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", None)
        self.comments = comments

    def _add(self, node: Node) -> Node:
        self.at.children.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        node = self._add(Node(tag, self.at, attrs))
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self._add(Node(tag, self.at, attrs))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self._add(Node("#text", self.at, text=data))

    def handle_comment(self, data):
        if self.comments:
            self._add(Node("#comment", self.at, text=data))


def parsed(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def drop_first_hidden(root: Node) -> None:
    """Only the first div that is not displayed goes, with all it holds."""
    for node in root.walk():
        if node.tag == "div" and "display:none" in node.get("style").replace(" ", ""):
            node.parent.children.remove(node)
            return


def _opening(node: Node) -> str:
    attrs = "".join(f' {k}="{html.escape(v or "", quote=True)}"' for k, v in node.attrs)
    return f"<{node.tag}{attrs}{'/' if node.tag in _VOID else ''}>"


def breaks_of(root: Node) -> list[tuple[str, Node]]:
    """(kind, element) of all break elements: rules, break styles of any value,
    and a lone ruled line in a full-width div, where the div counts."""
    out: list[tuple[str, Node]] = []
    for node in root.walk():
        if node.tag == "hr":
            out.append(("hr", node))
        style = node.get("style")
        out += [(kind, node) for kind in _BREAK_STYLES if kind in style]
        p = node.parent
        if "border-top" in style and p.tag == "div" and "width: 100%" in p.get("style") and len(p.children) == 1:
            out.append(("border-top", p))
    return out


def split_pages(page: str | None) -> list[str]:
    """The pages of one document; the untouched input if it has no break.

    A page starts at each break element, also one that asks for a break after
    itself.  Comments and the first hidden div are gone from split pages,
    rules too; tags cut by a break are closed and stray ends dropped.  Pages
    without visible text are left out.
    """
    if page is None:
        return []
    root = parsed(page)
    drop_first_hidden(root)
    marked = {id(node) for _, node in breaks_of(root)}
    if not marked:
        return [page]
    body = next((n for n in root.walk() if n.tag == "body"), root)
    parts: list[str] = []

    def write(node: Node) -> None:
        # an explicit stack, as filings nest deeper than Python recurses
        todo: list[Node | str] = [node]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                parts.append(n)
                continue
            if id(n) in marked:
                parts.append(_MARK)
                if n.tag == "hr":
                    continue
            if n.tag == "#text":
                parts.append(html.escape(n.text, quote=False).replace(_MARK, ""))
                continue
            if n.tag[0] != "#":
                parts.append(_opening(n))
            if n.tag not in _VOID and n.tag[0] != "#":
                todo.append(f"</{n.tag}>")
            todo.extend(reversed(n.children))

    write(body)
    return [p for p in map(tidy, "".join(parts).split(_MARK)) if p]


_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)[^>]*?(/?)>")


def tidy(fragment: str) -> str:
    """A fragment with its tags balanced; empty if it shows no text."""
    root = parsed(fragment)
    if not any(n.tag == "#text" and n.text.strip() for n in root.walk()):
        return ""
    opened: list[str] = []
    out, last = [], 0
    for m in _TAG.finditer(fragment):
        out.append(fragment[last : m.start()])
        last = m.end()
        end, tag, self_closed = m.group(1), m.group(2).lower(), m.group(3)
        if not end:
            out.append(m.group())
            if tag not in _VOID and not self_closed:
                opened.append(tag)
        elif tag in opened:
            while (top := opened.pop()) != tag:
                out.append(f"</{top}>")
            out.append(m.group())
    out.append(fragment[last:])
    return "".join(out + [f"</{t}>" for t in reversed(opened)]).strip()


_LINES = frozenset("p div tr table ul ol li h1 h2 h3 h4 h5 h6 pre br hr blockquote body section article center dl dt dd".split())


#: A private sign for blanks that stay when others are joined.
_INDENT = "\ue003"


def _above(node: Node):
    while (node := node.parent) is not None:
        yield node


def html_text(page: str | None) -> str:
    """Text of a page in plain Markdown manner: headings, items indented by
    depth with ``*`` or their number, table rows as ``a | b``, links as
    ``[text](target)``; no images, no emphasis, no wrapping.

    The first hidden div is left out.  Null and empty give the empty text.
    """
    if not page:
        return ""
    root = parsed(page)
    drop_first_hidden(root)
    out: list[str] = []
    todo: list[Node | str] = list(reversed(root.children))
    pre = 0
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            if n == "</pre>":
                pre -= 1
            else:
                out.append(n)
            continue
        if n.tag == "#text":
            out.append(n.text if pre else re.sub(r"[ \t\r\n\f]+", " ", n.text))
            continue
        if n.tag in ("script", "style", "img", "head", "title"):
            continue
        after = ""
        if n.tag in ("td", "th"):
            after = " | " if any(s.tag in ("td", "th") for s in n.parent.children[n.parent.children.index(n) + 1 :]) else ""
        elif n.tag == "a" and n.get("href"):
            out.append("[")
            after = f"]({n.get('href')})"
        elif n.tag == "li":
            lists = [a for a in _above(n) if a.tag in ("ul", "ol")]
            sign = f"{1 + sum(s.tag == 'li' for s in n.parent.children[: n.parent.children.index(n)])}." if lists and lists[0].tag == "ol" else "*"
            out.append("\n" + _INDENT * (2 * max(1, len(lists))) + sign + _INDENT)
        elif n.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            out.append("\n\n" + "#" * int(n.tag[1]) + " ")
            after = "\n\n"
        elif n.tag in ("p", "table", "ul", "ol", "pre", "blockquote"):
            out.append("\n\n")
            after = "\n\n"
        elif n.tag in _LINES:
            out.append("\n")
            after = "" if n.tag == "tr" else "\n"
        if after:
            todo.append(after)
        if n.tag == "pre":
            pre += 1
            todo.append("</pre>")
        todo.extend(reversed(n.children))
    text = "".join(out)
    if "<pre" in page:
        text = re.sub(r"[ \t]+\n", "\n", text)
    else:
        text = re.sub(r"[ \t]*\n[ \t]*", "\n", re.sub(r"[ \t]{2,}", " ", text))
    return re.sub(r"\n{3,}", "\n\n", text).strip().strip(_INDENT).replace(_INDENT, " ")


@F.pandas_udf(T.ArrayType(T.StringType()))
def pages_udf(s: pd.Series) -> pd.Series:
    return s.map(split_pages)


@F.pandas_udf(T.StringType())
def html_text_udf(s: pd.Series) -> pd.Series:
    return s.map(html_text)


@F.pandas_udf(T.ArrayType(T.StringType()))
def break_kinds_udf(s: pd.Series) -> pd.Series:
    def kinds(page: str | None) -> list[str]:
        if not page:
            return []
        root = parsed(page)
        drop_first_hidden(root)
        return [k for k, _ in breaks_of(root) if k in _BREAK_ELEMENTS]

    return s.map(kinds)


def split_documents(df: DataFrame, id_cols: list[str], html_col: str) -> DataFrame:
    """``(<id_cols>, page_no, page)``: the pages of every document, in order; null documents have none."""
    d = df.where(F.col(html_col).isNotNull()).select(*id_cols, pages_udf(html_col).alias("_pages"))
    return d.select(*id_cols, F.posexplode("_pages").alias("page_no", "page"))


def break_stats(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """``(selector, filings, elements)``: how often each kind of break was found, most filings first."""
    d = df.select(F.col(id_col).alias("_id"), F.explode(break_kinds_udf(html_col)).alias("selector"))
    return d.groupBy("selector").agg(F.countDistinct("_id").alias("filings"), F.count(F.lit(1)).alias("elements")).orderBy(F.desc("filings"), "selector")
