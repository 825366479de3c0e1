"""Markup residue: what is left of HTML, Markdown, wiki and LaTeX, and clean text.

Three parts:

* token classes of the four languages, as patterns for the JVM that no length of a span bounds;
* wrappers: union-free regular expressions over the token streams of one
  host's pages or chunks, inferred by iterative alignment.  Mismatches become
  optional or repeated groups, differing texts become slots; what stays
  constant is the host's page furniture, or its leftover markup;
* clean text that keeps headings, lists, tables, code and formulas.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from folioforge.runtime import cut

#: Element names of HTML.
TAGS = (
    "a abbr address article aside b base big blockquote body br button caption center cite code col colgroup dd del "
    "details dfn dir div dl dt em fieldset figcaption figure font footer form frame h1 h2 h3 h4 h5 h6 head header hr "
    "html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol optgroup option "
    "p param pre q s samp script section select small span strike strong style sub summary sup svg table tbody td "
    "textarea tfoot th thead title tr tt u ul var video"
).split()

#: What a token of each language looks like.
TOKENS = {
    "html": (
        rf"(?i)</?(?:{'|'.join(TAGS)})(?:\s[^<>]*+)?/?>|</(?:{'|'.join(TAGS)})(?=\s|$)"
        r"|<!--|-->|<!DOCTYPE[^<>]*+>"
        r"|&(?:[a-z][a-z0-9]{1,31}|#0*[0-9]{1,7}|#x0*[0-9a-f]{1,6});"
    ),
    "markdown": (
        r"(?m)^#{1,6}[ \t]+\S|^[ \t]{0,3}```"
        r"|\*\*[^\s*][^*\n]*+\*\*|(?<![\w_])__[\p{L}\p{N}][^_\n]*+__(?![\w_])"
        r"|~~[\p{L}\p{N}][^~\n]++(?<=[\p{L}\p{N}.)])~~|`[^`\n]++`"
        r"|!?\[[^\]\[\n]++\]\([^()\s]++\)"
    ),
    "wiki": (
        r"(?m)\[\[[^\]\[\n]++\]\]|\{\{[^{}\n]++\}\}|'''?[^'\n]++'''?"
        r"|^={2,6}[^=\n]++={2,6}[ \t]*$|^\{\|.*$|^\|\}[ \t]*$|^\|-[ \t]*$"
    ),
    "latex": (
        r"\\[A-Za-z]{2,}|\$\$[^$]++\$\$|\$[^$\n]{0,200}[\\_^][^$\n]{0,200}\$|\\\[|\\\]|\\\(|\\\)"
        # longer ones stand close to their signs, as two amounts do not
        r"|\$(?!\s)[^$\n\\_^]*+[\\_^][^$\n]*+(?<!\s)\$(?!\d)"
    ),
}


def _chunks(df: DataFrame, id_col: str, chunks_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("_id"), F.posexplode(chunks_col).alias("chunk_no", "_chunk"))


#: Signs that stand around or before a text, longest first, for the name of a token.
_AROUND = ("```", "**", "__", "~~", "`", "![", "[[", "{{", "'''", "''", "{|", "|}", "|-", "$$", "$", "[")


def sign_of(kind: str, token: str) -> str:
    """What a token is called in a stream: its element, its command, or the signs around its text."""
    if kind == "html":
        m = re.match(r"</?[A-Za-z][A-Za-z0-9]*", token)
        return m.group().lower() + ">" if m else "&;" if token[0] == "&" else "<!>"
    if kind == "latex" and token[0] == "\\":
        return token
    if token[0] in "#=":
        return token[0]
    return next((x for x in _AROUND if token.startswith(x)), kind)


def chunk_stream(chunk: str, tokens: dict[str, list[str]]) -> list[list]:
    """The token stream of a chunk as a folded wrapper: markup tokens by kind and sign, texts between them as slots."""
    found = []
    for kind, own in tokens.items():
        at = 0
        for token in own:
            at = chunk.index(token, at)
            found.append((at, at + len(token), f"{kind} {sign_of(kind, token)}"))
            at += len(token)
    elements, done = [], 0
    for a, b, name in sorted(found):
        if chunk[done:a].strip():
            elements.append(["slot", "", False])
        elements.append(["tag", name, False])
        done = max(done, b)
    if chunk[done:].strip():
        elements.append(["slot", "", False])
    return fold_repeats(elements)


def signs_in(wrapper: list[list]) -> list[str]:
    """The constant tokens of a wrapper, those in groups too, each once."""
    out: dict[str, None] = {}
    todo = list(reversed(wrapper))
    while todo:
        kind, value, _ = todo.pop()
        if kind == "rep":
            todo.extend(reversed(value))
        elif kind == "tag":
            out[value] = None
    return list(out)


def _streams(df: DataFrame, id_col: str, host_col: str, chunks_col: str) -> DataFrame:
    """(_id, _host, chunk_no, _tokens, _stream, _signs) of the chunks that hold any token."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.posexplode(chunks_col).alias("chunk_no", "_chunk"))
    every = F.struct(*(F.regexp_extract_all("_chunk", F.lit(p), F.lit(0)).alias(kind) for kind, p in TOKENS.items()))
    # the outer form keeps the patterns from being run once for the test and once for the result
    rows = rows.where(F.length("_chunk") > 0).select("_id", "_host", "chunk_no", "_chunk", F.explode_outer(F.array(every)).alias("_tokens"))
    some = F.lit(0)
    for kind in TOKENS:
        some = some + F.size(f"_tokens.{kind}")

    @F.pandas_udf("_stream string, _signs array<string>")
    def stream(chunks: pd.Series, tokens: pd.DataFrame) -> pd.DataFrame:
        out = []
        for chunk, own in zip(chunks, tokens.to_dict("records"), strict=True):
            w = chunk_stream(chunk, {k: list(v) for k, v in own.items()})
            out.append((json.dumps(w), signs_in(w)))
        return pd.DataFrame(out, columns=["_stream", "_signs"])

    rows = rows.where(some > 0).withColumn("_s", stream("_chunk", "_tokens"))
    return rows.select("_id", "_host", "chunk_no", "_tokens", "_s._stream", "_s._signs")


def chunk_wrappers(df: DataFrame, id_col: str = "chunked_id", host_col: str = "cik", chunks_col: str = "text_chunks") -> DataFrame:
    """``(<host_col>, chunks BIGINT, wrapper STRING)``: one wrapper of the leftover markup for each host that has any."""
    w = inferred(_streams(df, id_col, host_col, chunks_col).select("_host", "_stream"))
    return w.select(F.col("_host").alias(host_col), F.col("_count").alias("chunks"), _shown("_wrapper").alias("wrapper"))


def markup_residue(df: DataFrame, id_col: str = "chunked_id", host_col: str = "cik", chunks_col: str = "text_chunks") -> DataFrame:
    """``(<id_col>, chunk_no, markup, tokens)``: chunks with leftover markup,
    one row for each language, with its tokens in order.

    The streams of a host's chunks are aligned to one wrapper; its constant
    elements are the host's markup, and a chunk has leftovers of a language if
    its stream holds constant elements of that language.  Texts become slots,
    tokens never do, so no token of a stream is lost on the way.

    Null arrays, null chunks and empty chunks give nothing; a null host is a
    host of its own; repeated rows repeat theirs.

    Scale: chunks without any token are dropped where they are read.  Equal
    streams of a host are merged once, with their count; the elements of a
    wrapper are few (tag names, commands, signs), and join the chunks by host
    and sign, where the runtime broadcasts them if they measure small and
    otherwise splits skewed hosts.
    """
    streams = cut(_streams(df, id_col, host_col, chunks_col).withColumn("_row", F.monotonically_increasing_id()))
    elements = inferred(streams.select("_host", "_stream")).select(F.col("_host").alias("_of"), F.explode(_elements("_wrapper")).alias("_constant"))
    signs = streams.select("_row", "_host", F.explode("_signs").alias("_sign"))
    met = signs.join(elements, F.col("_host").eqNullSafe(F.col("_of")) & (F.col("_sign") == F.col("_constant")))
    kinds = met.select("_row", F.split_part("_sign", F.lit(" "), F.lit(1)).alias("markup")).distinct()
    own = F.coalesce(*(F.when(F.col("markup") == kind, F.col(f"_tokens.{kind}")) for kind in TOKENS))
    return streams.join(kinds, "_row").select(F.col("_id").alias(id_col), "chunk_no", "markup", own.alias("tokens"))


#: Rewrites that turn leftover markup into text, in order.
_HTML_STEPS = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)<h([1-6])(?:\s[^<>]*)?>", "\n# "),
    (r"(?i)<li(?:\s[^<>]*)?>", "\n- "),
    (r"(?i)<sub>([^<]*+)</sub>", "_{$1}"),
    (r"(?i)<sup>([^<]*+)</sup>", "^{$1}"),
    (r"(?i)</?code>", "`"),
    (r"(?i)</t[dh]>\s*<t[dh](?:\s[^<>]*)?>", " | "),
    (r"(?i)</?(?:p|div|tr|ul|ol|table|h[1-6])(?:\s[^<>]*)?/?>", "\n"),
    (rf"(?i)</?(?:{'|'.join(TAGS)})(?:\s[^<>]*)?/?>|</(?:{'|'.join(TAGS)})(?=\s|$)|<!--|-->", ""),
]
_OTHER_STEPS = [
    (r"\\(?:part|chapter|(?:sub)*section|(?:sub)?paragraph)\*?\{([^{}\n]++)\}", "# $1"),
    (r"\\(?:textbf|textit|emph|underline)\{([^{}\n]++)\}", "$1"),
    (r"\\item\b[ \t]*", "- "),
    (r"\\(?:begin|end)\{(?:itemize|enumerate|document|center)\}", ""),
    (r"(?m)^={2,6}[ \t]*([^=\n]+?)[ \t]*={2,6}[ \t]*$", "# $1"),
    (r"\[\[(?:[^\]\[|\n]*+\|)*+([^\]\[|\n]++)\]\]", "$1"),
    (r"\{\{[^{}]++\}\}[ \t]?", ""),
    (r"(?m)^\[[^\]\[\n]++\]:[ \t]+\S++.*$\n?", ""),
    (r"\[([^\]\[\n]++)\]\[[^\]\[\n]*+\]", "$1"),
    (r"(?m)^([^\s=].*)\n={3,}[ \t]*$", "# $1"),
    (r"'''?([^'\n]++)'''?", "$1"),
    (r"(?m)^(?:\{\|.*|\|\}|\|-)[ \t]*\n?", ""),
    (r"!?\[([^\]\[\n]++)\]\([^()\s]++\)", "$1"),
    (r"\*\*([^\s*][^*\n]*+)\*\*", "$1"),
    (r"(?<![\w_])__([^\s_][^_\n]*+)__(?![\w_])", "$1"),
    (r"~~([^~\n]++)~~", "$1"),
    (r"(?m)^#{2,6}[ \t]+", "# "),
]
#: Entities by name or by number; more digits than these name no character.
_ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]+|#0*[0-9]{1,7}|#[Xx]0*[0-9A-Fa-f]{1,6});"


def _character(entity: str) -> str:
    """What one entity stands for, a plain blank for a fixed one; unknown names stay."""
    name = entity[1:]
    if name[0] == "#":
        out = html.unescape(entity)
    else:
        out = html5.get(name) or html5.get(name.lower()) or entity
    return " " if out == "\xa0" else out


def decoded(text: Column) -> Column:
    """Text with its entities read once, so ``&amp;lt;`` gives ``&lt;``; only texts that hold any go to Python."""
    entity = re.compile(_ENTITY)
    read = F.pandas_udf(lambda s: s.map(lambda t: None if t is None else entity.sub(lambda m: _character(m.group()), t)), "string")
    return F.coalesce(read(F.when(text.rlike(_ENTITY), text)), text)


def clean_chunk(chunk: Column) -> Column:
    """Text of one chunk without its leftover markup, entities still as they are; null stays null.

    Headings become ``# ``, items ``- ``, table cells ``a | b``; code keeps
    its marks and formulas their source.
    """
    out = chunk
    for pattern, by in _HTML_STEPS + _OTHER_STEPS:
        out = F.regexp_replace(out, pattern, by)
    return out


def clean_chunks(df: DataFrame, id_col: str = "chunked_id", chunks_col: str = "text_chunks") -> DataFrame:
    """``(<id_col>, chunk_no, text)`` of every chunk, null ones as null."""
    rows = _chunks(df, id_col, chunks_col)
    touched = F.col("_chunk").rlike("|".join(f"(?:{p})" for p in TOKENS.values()))
    rows = rows.withColumn("_text", F.when(touched, clean_chunk(F.col("_chunk"))).otherwise(F.col("_chunk")))
    return rows.select(F.col("_id").alias(id_col), "chunk_no", decoded(F.col("_text")).alias("text"))


# ---- pages -----------------------------------------------------------------

_VOID = {"br", "hr", "img", "input", "meta", "link", "col", "base", "param"}
_BLOCK = {"p", "div", "tr", "table", "ul", "ol", "li", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr", "br", "body", "html", "blockquote", "center"}


class _PageText(HTMLParser):
    """Clean text of one page, block by block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.hidden: list[str] = []
        self.pre = 0
        self.cells: list[list[str]] = []

    def _put(self, s: str) -> None:
        (self.cells[-1] if self.cells else self.out).append(s)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        style = (dict(attrs).get("style") or "").replace(" ", "").lower()
        if self.hidden:
            if tag not in _VOID:
                self.hidden.append(tag)
            return
        if "display:none" in style or tag in ("script", "style"):
            if tag not in _VOID:
                self.hidden.append(tag)
            return
        if tag == "table":
            self._put("\n")
        elif tag == "tr":
            self._put("\n")
            self.first = True
        elif tag in ("td", "th"):
            self._put("" if getattr(self, "first", True) else " | ")
            self.first = False
        elif tag == "li":
            self._put("\n- ")
        elif tag[0] == "h" and tag[1:] in "123456" and tag != "h":
            self._put("\n" + "#" * int(tag[1:]) + " ")
        elif tag == "pre":
            self.pre += 1
            self._put("\n```\n")
        elif tag == "code":
            self._put("`")
        elif tag == "sub":
            self._put("_{")
        elif tag == "sup":
            self._put("^{")
        elif tag in _BLOCK:
            self._put("\n")

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
            return
        if tag == "pre":
            self.pre = max(0, self.pre - 1)
            self._put("\n```\n")
        elif tag == "code":
            self._put("`")
        elif tag in ("sub", "sup"):
            self._put("}")
        elif tag in _BLOCK and tag not in ("br", "li", "tr"):
            self._put("\n")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self._put(data if self.pre else re.sub(r"[ \t\r\xa0]+", " ", data))


def page_text(page: str | None) -> str | None:
    """Clean text of one HTML page; null stays null."""
    if page is None:
        return None
    p = _PageText()
    p.feed(page)
    p.close()
    text = "".join(p.out)
    return re.sub(r"\n[ \t]*(?:\n[ \t]*)+", "\n\n", text).strip()


#: One token of a page: a comment, a tag or a text.
_STREAM = re.compile(r"<!--.*?-->|<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*>|[^<]+|<", re.S)


def token_stream(page: str) -> list[str]:
    """Tags as ``<p>`` and ``</p>``, whole texts as themselves with blanks and digits unified."""
    out = []
    for m in _STREAM.finditer(page):
        if m.group(2):
            out.append(f"<{m.group(1)}{m.group(2).lower()}>")
        elif not m.group(0).startswith("<!--"):
            t = re.sub(r"\d+", "0", re.sub(r"\s+", " ", html.unescape(m.group(0))).strip().lower())
            if t:
                out.append(t)
    return out


# A wrapper is a list of [kind, value, optional]: kind "tag" (value: the tag),
# "text" (a constant text), "slot" (any text) or "rep" (value: a list of
# elements that stands once or more).

def _same(a: list, b: list) -> bool:
    if a[0] in ("text", "slot") and b[0] in ("text", "slot"):
        return True
    return a[0] == b[0] and a[1] == b[1]


def fold_repeats(elements: list[list], longest: int = 12) -> list[list]:
    """Adjacent equal groups of up to ``longest`` elements become one repeated group."""
    out: list[list] = []
    for e in elements:
        out.append(e)
        folded = True
        while folded:
            folded = False
            for n in range(1, min(longest, len(out)) + 1):
                tail = out[-n:]
                if n == 1 and tail[0][0] == "slot":
                    break
                if len(out) > n and out[-n - 1][0] == "rep" and len(out[-n - 1][1]) == n and all(map(_same, out[-n - 1][1], tail)):
                    body = out[-n - 1][1]
                    for k, t in enumerate(tail):
                        body[k] = _join(body[k], t)
                    del out[-n:]
                    folded = True
                    break
                if len(out) >= 2 * n and all(map(_same, out[-2 * n:-n], tail)) and any(t[0] == "tag" for t in tail):
                    body = [_join(x, y) for x, y in zip(out[-2 * n:-n], tail, strict=True)]
                    del out[-2 * n:]
                    out.append(["rep", body, False])
                    folded = True
                    break
    return out


def _join(a: list, b: list) -> list:
    """One element for two that align."""
    optional = a[2] or b[2]
    if a[0] in ("text", "slot"):
        return [a[0], a[1], optional] if a[0] == b[0] and a[1] == b[1] else ["slot", "", optional]
    return [a[0], a[1], optional]


def _sign(e: list) -> str:
    """Equal for two elements exactly if they are the same to ``_same``."""
    return "" if e[0] in ("text", "slot") else e[0] + repr(e[1])


def align(a: list[list], b: list[list]) -> list[list]:
    """One wrapper for two: aligned elements join, the others become optional.

    The longest common subsequence, whole whatever the lengths.  Its table is
    kept as one number for each element of ``a``: the bit of ``b``'s element j
    says that best[i][j] is best[i][j + 1] + 1, so best[i][j] is the count of
    the bits from j on.
    """
    n, m = len(a), len(b)
    ours, theirs = [_sign(e) for e in a], [_sign(e) for e in b]
    at: dict[str, int] = {}
    for j, sign in enumerate(theirs):
        at[sign] = at.get(sign, 0) | 1 << m - 1 - j
    full = (1 << m) - 1
    flat, rises = full, [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        met = flat & at.get(ours[i], 0)
        flat = (flat + met | flat - met) & full
        rises[i] = full & ~flat
    out, i, j = [], 0, 0
    while i < n and j < m:
        if ours[i] == theirs[j]:
            out.append(_join(a[i], b[j]))
            i, j = i + 1, j + 1
        elif (rises[i + 1] & (1 << m - j) - 1).bit_count() >= (rises[i] & (1 << m - j - 1) - 1).bit_count():
            out.append([a[i][0], a[i][1], True])
            i += 1
        else:
            out.append([b[j][0], b[j][1], True])
            j += 1
    return out + [[*e[:2], True] for e in a[i:]] + [[*e[:2], True] for e in b[j:]]


def wrapper_of(page: str) -> list[list]:
    elements = [["tag" if t[0] == "<" and t[-1] == ">" and len(t) > 2 else "text", t, False] for t in token_stream(page)]
    return fold_repeats(elements)


def shown(wrapper: list[list]) -> str:
    """A wrapper as a union-free regular expression over tokens."""
    parts = []
    for kind, value, optional in wrapper:
        body = {"tag": str(value), "text": f'"{value}"', "slot": "#"}.get(kind) or "(" + shown(value) + ")+"
        parts.append(f"({body})?" if optional else body)
    return " ".join(parts)


def inferred(streams: DataFrame, salts: int = 1024) -> DataFrame:
    """(_host, _count, _wrapper): one wrapper for each host of rows (_host, _stream).

    Equal streams are merged once, with their count.  The others go, by a hash
    of the stream, into ``salts`` parts of their host and are aligned there in
    their order, one after the other as they arrive; then the parts are.  So
    the wrapper depends on the streams alone, no group is held in memory, and
    a hot host is spread over many tasks.  No wrapper is cut: its length
    follows the variety of the host's streams.
    """
    host = streams.schema["_host"]
    schema = T.StructType([T.StructField("_host", host.dataType), T.StructField("_salt", T.IntegerType()), T.StructField("_count", T.LongType()), T.StructField("_stream", T.StringType())])
    arrow = to_arrow_schema(schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(at: tuple, n: int, w: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"_host": at[0], "_salt": at[1], "_count": n, "_stream": json.dumps(w, ensure_ascii=False)}], schema=arrow)

        at, n, held = None, 0, []
        for batch in batches:
            for *key, count, stream in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                new = json.loads(stream)
                if at == tuple(key):
                    n, held = n + count, align(held, new)
                    continue
                if at is not None:
                    yield out(at, n, held)
                at, n, held = tuple(key), count, new
        if at is not None:
            yield out(at, n, held)

    once = streams.groupBy("_host", "_stream").agg(F.count(F.lit(1)).alias("_count"))
    rows = once.select("_host", F.pmod(F.xxhash64("_stream"), F.lit(salts)).cast("int").alias("_salt"), "_count", "_stream")
    parts = rows.repartition("_host", "_salt").sortWithinPartitions("_host", "_salt", "_stream").mapInArrow(merge, schema)
    whole = parts.repartition("_host").sortWithinPartitions("_host", "_salt").select("_host", F.lit(0).alias("_salt"), "_count", "_stream").mapInArrow(merge, schema)
    return whole.select("_host", "_count", F.col("_stream").alias("_wrapper"))


@F.pandas_udf(T.StringType())
def _shown(s: pd.Series) -> pd.Series:
    return s.map(lambda w: shown(json.loads(w)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _elements(s: pd.Series) -> pd.Series:
    return s.map(lambda w: signs_in(json.loads(w)))


@F.pandas_udf(T.StringType())
def _page_stream(s: pd.Series) -> pd.Series:
    return s.map(lambda page: json.dumps(wrapper_of(page), ensure_ascii=False))


def host_wrappers(df: DataFrame, host_col: str = "cik", pages_col: str = "html_pages") -> DataFrame:
    """``(<host_col>, pages BIGINT, wrapper STRING)``: one wrapper for each host.

    Hosts whose pages are all null, empty or missing do not appear; a null
    host is a host of its own.
    """
    rows = df.select(F.col(host_col).alias("_host"), F.explode(pages_col).alias("_page")).where(F.length("_page") > 0)
    w = inferred(rows.select("_host", _page_stream("_page").alias("_stream")))
    return w.select(F.col("_host").alias(host_col), F.col("_count").alias("pages"), _shown("_wrapper").alias("wrapper"))


def clean_pages(df: DataFrame, id_col: str = "chunked_id", pages_col: str = "html_pages") -> DataFrame:
    """``(<id_col>, page_no, text)``: clean text of every page, null ones as null."""
    rows = df.select(F.col(id_col).alias("_id"), F.posexplode(pages_col).alias("page_no", "_page"))
    text = F.pandas_udf(lambda s: s.map(page_text), "string")
    return rows.select(F.col("_id").alias(id_col), "page_no", text("_page").alias("text"))
