"""From documents to size-bounded chunks, all as array expressions.

A document stays in one row until its chunks are exploded, so packing needs
no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.binding import let
from folioforge.functions.text import is_empty_line, is_table_row, needs_sentences, sanitized, sentences_of, stripped

CHUNK_SIZE = 2_000
SMALLEST = 100
Sentences = Callable[[Column], Column]


def content_lines(text: Column) -> Column:
    """The stripped lines of a sanitised text that are not empty."""
    return F.filter(F.transform(F.split(text, "\n", -1), stripped), lambda line: ~is_empty_line(line))


def proportional_sentences(lines: Column, sentences: Sentences = sentences_of) -> Column:
    """ARRAY<ARRAY<STRING>>: the sentences of a batch of lines, dealt out by length.

    The lines are split as one text.  Line i gets floor(n * its share of the
    characters) of the n sentences, one at least, from where the line before
    stopped; a line for which none is left gets itself.  As the shares are
    rounded, sentences can be lost; ``pieces_of_lines`` splits line by line
    instead and loses none.
    """
    found = sentences(F.array_join(lines, "\n"))
    total = F.greatest(F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x)), F.lit(1))

    def share(x: Column) -> Column:
        return F.greatest(F.floor(F.size(found) * F.length(x) / total), F.lit(1)).cast("int")

    def dealt(x: Column, i: Column) -> Column:
        start = F.aggregate(F.slice(lines, F.lit(1), i), F.lit(0), lambda n, y: n + share(y))
        own = F.slice(found, start + 1, share(x))
        return F.when(F.size(own) > 0, own).otherwise(F.array(x))

    return F.transform(lines, dealt)


def pieces_of_lines(lines: Column, sentences: Sentences | None = sentences_of) -> Column:
    """Runs of table rows become one piece, long prose lines their sentences, other lines themselves."""
    n = F.size(lines)
    rows = F.transform(lines, is_table_row)

    def begins(row: Column) -> Column:
        """Where pieces start, from 1: everywhere but inside a run of rows."""
        return F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: ~(F.get(row, i - 1) & F.coalesce(F.get(row, i - 2), F.lit(False))))

    def piece(start: Column, k: Column, row: Column, starts: Column) -> Column:
        length = F.coalesce(F.get(starts, k + 1), n + 1) - start
        first = F.get(lines, start - 1)
        table = F.array(F.array_join(F.slice(lines, start, length), "\n"))
        if sentences is None:
            return table
        return F.when(F.get(row, start - 1), table).when(needs_sentences(first), sentences(first)).otherwise(F.array(first))

    every = let(rows, lambda row: let(begins(row), lambda starts: F.flatten(F.transform(starts, lambda start, k: piece(start, k, row, starts)))))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(every)


def packed(pieces: Column, size: int = CHUNK_SIZE) -> Column:
    """Greedy packing: a piece starts a new chunk if it would exceed the size.

    Joints do not count and no piece is split, so a chunk can be larger than
    the size; a first piece over the size leaves an empty chunk before it.
    The fold keeps borders only, so its state grows with chunks, not pieces.
    """
    lengths = F.transform(pieces, F.length)
    seed = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(0).alias("held"), F.lit(0).alias("seen"))

    def step(s: Column, length: Column) -> Column:
        full = s["held"] + length > size
        return F.struct(
            F.when(full, F.concat(s["ends"], F.array(s["seen"]))).otherwise(s["ends"]).alias("ends"),
            F.when(full, length).otherwise(s["held"] + length).alias("held"), (s["seen"] + 1).alias("seen"),
        )

    ends = F.aggregate(lengths, seed, step, lambda s: F.concat(s["ends"], F.array(s["seen"])))

    def joined(borders: Column) -> Column:
        before = lambda k: F.coalesce(F.get(borders, k - 1), F.lit(0))
        return F.transform(borders, lambda end, k: F.array_join(F.slice(pieces, before(k) + 1, end - before(k)), "\n\n"))

    chunks = let(ends, joined)
    return F.when(F.size(pieces) == 0, F.array().cast("array<string>")).otherwise(chunks)


#: Words that are no content between rows of a table.
GAP_WORDS = ("capital", "allocation", "aggressive", "moderate", "conservative")


def _row(line: str) -> bool:
    s = line.strip()
    return "|" in s and s != "|"


def close_table_gaps(chunk: str) -> str:
    """Between two rows of a table, more than two lines shrink to their content
    and single blanks; fewer stay, as does what follows the last row."""
    lines = chunk.split("\n")
    rows = [i for i, line in enumerate(lines) if _row(line)]
    if len(rows) < 2 or all(b - a <= 3 for a, b in zip(rows, rows[1:], strict=False)):
        return chunk
    out = lines[: rows[0] + 1]
    for a, b in zip(rows, rows[1:], strict=False):
        gap = lines[a + 1 : b]
        if len(gap) > 2:
            kept: list[str] = []
            for line in gap:
                bare = line.strip()
                if len(bare) > 10 and bare.lower() not in GAP_WORDS:
                    kept.append(line)
                elif not bare and (not kept or kept[-1].strip()):
                    kept.append("")
            gap = kept if any(k.strip() for k in kept) else [""]
        out += [*gap, lines[b]]
    return "\n".join(out + lines[rows[-1] + 1 :])


#: A private sign that stands for rows of a table between prose lines.
_ROWS = "\ue002"


def _runs_of_sentences(lines: Column, long: Column, sentences: Sentences) -> Column:
    """ARRAY<ARRAY<STRING>>: for each run of lines between table rows, the sentences of its long prose lines, split as one text."""
    kept = F.filter(F.zip_with(lines, long, lambda x, n: F.when(is_table_row(x), F.lit(_ROWS)).when(n, x)), lambda x: x.isNotNull())
    runs = F.split(F.array_join(kept, "\n"), rf"\n?{_ROWS}(?:\n{_ROWS})*\n?", -1)
    return F.transform(runs, sentences)


def _dealt(lines: list[str], found: list[str]) -> dict[str, list[str]]:
    """Sentences of a run, dealt out to its lines by length; of equal lines the last one's count."""
    total = sum(map(len, lines))
    out, start = {}, 0
    for line in lines:
        share = max(1, len(found) * len(line) // total)
        out[line] = found[start : start + share] or [line]
        start += share
    return out


def _chunks_of(lines: list[str], long: list[bool], found: list[list[str]], size: int, faithful: bool) -> list[str]:
    """One text's chunks from its lines, what each line is, and the sentences of runs (``faithful``) or lines."""
    rows = [_row(x) for x in lines]
    batches: list[list[str]] = [[]]
    batch_of, in_rows = [], False
    for line, row, splits in zip(lines, rows, long, strict=True):
        if row:
            batches += [] if in_rows else [[]]
            in_rows = True
        elif splits:
            batches[-1].append(line)
            in_rows = False
        batch_of.append(len(batches) - 1)
    dealt = [_dealt(b, f) for b, f in zip(batches, found, strict=True)] if faithful else []
    pieces: list[str] = []
    table: list[str] = []
    for i, line in enumerate(lines):
        if rows[i]:
            table.append(line)
            continue
        if table:
            pieces.append("\n".join(table))
            table = []
        pieces += [line] if not long[i] else dealt[batch_of[i]][line] if faithful else found[i]
    if table:
        pieces.append("\n".join(table))
    out, pack, n = [], [], 0
    for piece in pieces:
        if n + len(piece) > size:
            out.append(pack)
            pack, n = [], 0
        pack.append(piece)
        n += len(piece)
    chunks = ("\n\n".join(c) for c in (*out, pack))
    return [close_table_gaps(c) for c in chunks if len(c.strip()) > SMALLEST]


def chunk_texts(
    df: DataFrame, id_cols: list[str], text_col: str, size: int = CHUNK_SIZE, sentences: Sentences = sentences_of, faithful: bool = True
) -> DataFrame:
    """``(<id_cols>, chunk_no, chunk)``: the chunks of every text, in order.

    Runs of table rows stay together, long prose lines are split into
    sentences, and pieces are packed greedily.  Chunks of at most 100
    characters are dropped, so short, empty and null texts have none.

    If ``faithful``, the long lines between two tables are split as one text
    and its sentences dealt out by length (``proportional_sentences``), which
    can lose some; otherwise every line is split by itself and none is lost.
    ``sentences`` turns a text column into an array of sentences; another
    provider can be given.  Lines and sentences are found in the JVM, one
    Arrow pass assembles the chunks; its time is linear in a text.
    """
    d = df.select(*id_cols, sanitized(F.col(text_col)).alias("_text"))
    # one-element arrays, exploded: a plain column would be computed again in each place that uses it
    d = d.select(*id_cols, F.explode_outer(F.array(content_lines(F.col("_text")))).alias("_lines"))
    d = d.select(*id_cols, "_lines", F.explode_outer(F.array(F.transform("_lines", needs_sentences))).alias("_long"))
    lines, long = F.col("_lines"), F.col("_long")
    found = _runs_of_sentences(lines, long, sentences) if faithful else F.zip_with(lines, long, lambda x, n: F.when(n, sentences(x)).otherwise(F.array(x)))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def assembled(lines: pd.Series, long: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_chunks_of(list(x), list(n), [list(s) for s in f], size, faithful) for x, n, f in zip(lines, long, found, strict=True)], dtype=object)

    d = d.select(*id_cols, assembled(lines, long, found).alias("_chunks"))
    # the outer form: an inner one would add a test of the array's size, evaluated by inlining all steps above
    return d.select(*id_cols, F.posexplode_outer("_chunks").alias("chunk_no", "chunk")).where(F.col("chunk").isNotNull())


def chunk_with_context(chunks: Column, start: Column, end: Column | None = None, context_size: int = 500, faithful: bool = True) -> Column:
    """Chunks ``start`` to ``end`` (counted from 0, both included) with the last
    characters of the chunk before and the first of the chunk after.

    Null if the range is outside the chunks or ends before it starts.  A
    context of 0 gives the whole chunk before, unless not ``faithful``.
    """
    end = start if end is None else end
    valid = (start >= 0) & (end < F.size(chunks)) & (start <= end)
    before, after = F.get(chunks, start - 1), F.get(chunks, end + 1)
    head = before if context_size == 0 and faithful else F.right(before, F.lit(context_size))
    parts = F.array_compact(F.array(head, F.array_join(F.slice(chunks, start + 1, end - start + 1), "\n\n"), F.left(after, F.lit(context_size))))
    return F.when(valid, F.array_join(parts, "\n\n"))
