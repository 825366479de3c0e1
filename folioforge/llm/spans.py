"""Long spans that occur verbatim in more than one record.

Content-defined chunking: a gear rolling hash runs over the characters, and a
place is a chunk border if its hash is the least of some window.  Window and
gear width together equal the span length asked for, so every string of that
length holds a border that depends on nothing outside the string: texts that
share it share the border, wherever insertions moved it.  Borders are
deduplicated by digest; only texts with a shared border are looked at again,
and there the strings are compared by hashes of 128 bits together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.runtime import cut, discard

#: Characters the gear hash covers.
GEAR = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _gears(codes: np.ndarray) -> np.ndarray:
    """A pseudo-random 64-bit number for each character code."""
    with np.errstate(over="ignore"):
        return _mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", errors="surrogatepass"), np.uint32)


def gear_hash(gears: np.ndarray) -> np.ndarray:
    """At i: the gear hash of the 64 characters that end at i (fewer at the start)."""
    h = gears.copy()
    with np.errstate(over="ignore"):
        width = 1
        while width < GEAR:
            older = h[:-width] << np.uint64(width)
            h[width:] += older
            width *= 2
    return h


def window_hash(gears: np.ndarray, length: int) -> np.ndarray:
    """At i: a polynomial hash of the ``length`` characters that start at i."""
    n = len(gears) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = 0x9FB21C651E98DF25
    with np.errstate(over="ignore"):
        power, h, width, out, done = base, gears.copy(), 1, np.zeros(n, np.uint64), 0
        while True:
            if length & width:
                out = out * np.uint64(power) + h[done: done + n]
                done += width
            width *= 2
            if width > length:
                return _mix(out)
            h = h[: len(h) - width // 2] * np.uint64(power) + h[width // 2:]
            power = power * power % (1 << 64)


def _sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """f over each window of ``width`` values."""
    n = len(x) - width + 1
    out, at, step, part = None, 0, 1, x
    while True:
        if width & step:
            piece = part[at: at + n]
            out = piece if out is None else f(out, piece)
            at += step
        step *= 2
        if step > width:
            return out
        part = f(part[: len(part) - step // 2], part[step // 2:])


def _least(gears: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The mixed gear hashes of whole gear widths, and the least one of each window."""
    h = _mix(gear_hash(gears))[GEAR - 1:]
    return h, _sliding(np.minimum, h, span - GEAR + 1)


def borders(gears: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Borders of one text: (index of the last character each digest covers, digest,
    first window, window after the last), over windows of ``span`` characters;
    every window has one border, the least and of equal ones the first."""
    n = len(gears) - span + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    width = span - GEAR + 1
    h, least = _least(gears, span)
    last = len(h)
    # the first place of each least value: where it changes, or where the old one left the window
    at = np.zeros(n, np.int64)
    holds = np.flatnonzero(_sliding(np.maximum, np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width)[:last] == h)
    values = h[holds]
    order = np.lexsort((holds, values))
    key, place = values[order], holds[order]
    # for each window: the first place >= its start with its least value
    lo = np.searchsorted(key, least, "left")
    hi = np.searchsorted(key, least, "right")
    at = place[lo]
    late = np.flatnonzero((at < np.arange(n)) & (hi - lo > 1))
    for w in late:
        same = place[lo[w]: hi[w]]
        at[w] = same[np.searchsorted(same, w)]
    change = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    end = np.append(change[1:], n)
    spots = at[change]
    return spots + GEAR - 1, h[spots], change.astype(np.int64), end.astype(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


#: Digests or ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _small(t: DataFrame) -> DataFrame:
    """Broadcast if a count shows few rows."""
    return F.broadcast(t) if t.count() <= BROADCAST_ROWS else t


def shared_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 240) -> DataFrame:
    """``(<id_col>, start_pos, end_pos)``: maximal stretches in which every
    character lies in a string of ``span`` characters that also occurs in a
    record of another id.

    Null, empty and shorter texts give nothing; a null id is no record.  Rows
    that repeat an id are one record with each other: a string that only they
    share counts as not shared.  Positions are code points, ends exclusive.
    Strings are equal if two independent 64-bit hashes are, that of the border
    inside and that of the string around it.

    Scale: step one shuffles one digest for about ``(span - 63) / 2``
    characters.  Step two compares, around each shared border, the whole
    stretch of text that its windows cover; where that is the same in another
    record, one row settles all windows.  Only borders whose surroundings
    differ between records send their single windows.  No group is ever
    gathered: all three steps are counts by digest of the least and greatest
    id, so a passage that a third of all records hold costs no more than its
    own rows.  Texts are read where they lie in every step; they are shuffled
    only for step three, and only if more than ``BROADCAST_ROWS`` records have
    windows to look at.
    """
    if span < 2 * GEAR:
        raise ValueError(f"a span has at least {2 * GEAR} characters")
    rows = df.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).where(F.col("_doc").isNotNull()).where(F.length("_text") >= span)
    doc_type = rows.schema["_doc"].dataType

    in_two = F.min("_doc") != F.max("_doc")
    every = cut(_contexts(rows, doc_type, span))
    shared = cut(every.groupBy("_digest").agg(in_two.alias("_two")).where("_two").select("_digest"))
    contexts = cut(every.join(_small(shared), "_digest", "left_semi"))
    discard(every, shared)

    # one class for each digest and each text around it
    classes = contexts.groupBy("_digest", "_around").agg(F.min("_doc").alias("_lo"), F.max("_doc").alias("_hi"))
    classes = classes.select("_digest", "_around", "_lo", (F.col("_lo") != F.col("_hi")).alias("_two"))
    open_digests = classes.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_two").alias("_all_two")
    ).where((F.col("_n") > 1) & ~F.col("_all_two")).select("_digest", F.lit(True).alias("_open"))
    judged = contexts.join(classes, ["_digest", "_around"]).join(open_digests, "_digest", "left")
    look = F.col("_open") & (~F.col("_two") | (F.col("_doc") == F.col("_lo")))
    judged = cut(judged.select("_doc", "_digest", "_start", "_windows", "_two", look.alias("_look")))
    discard(contexts)

    settled = judged.where("_two").select("_doc", "_start", "_windows")
    looks = cut(judged.where("_look").groupBy("_doc").agg(F.collect_list(F.struct("_digest", "_start", "_windows")).alias("_looks")))
    windows = cut(_windows(rows.join(_small(looks), "_doc"), doc_type, span))
    discard(looks)
    twice = windows.groupBy("_digest", "_hash").agg(in_two.alias("_two")).where("_two").select("_digest", "_hash")
    single = windows.join(twice, ["_digest", "_hash"], "left_semi").select("_doc", "_start", F.lit(1).alias("_windows"))

    found = settled.unionByName(single).groupBy("_doc").agg(F.collect_list(F.struct("_start", "_windows")).alias("_found"))
    return _merged(found, doc_type, span, id_col)


def _contexts(rows: DataFrame, doc_type: T.DataType, span: int) -> DataFrame:
    """For each border of each record: its windows and one hash of them all."""
    schema = T.StructType([
        T.StructField("_doc", doc_type), T.StructField("_digest", T.LongType()), T.StructField("_around", T.LongType()),
        T.StructField("_start", T.IntegerType()), T.StructField("_windows", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, parts = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                gears = _gears(codes_of(text))
                _, digest, first, after = borders(gears, span)
                with np.errstate(over="ignore"):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(window_hash(gears, span) + np.uint64(1)))])
                    whole = _mix(sums[after] - sums[first] + (after - first).astype(np.uint64))
                at.append(np.full(len(digest), k, np.int32))
                parts.append((_signed(digest), _signed(whole), first.astype(np.int32), (after - first).astype(np.int32)))
            if at:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(at))), *(pa.array(np.concatenate(c)) for c in zip(*parts, strict=True))],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def _windows(rows: DataFrame, doc_type: T.DataType, span: int) -> DataFrame:
    """The single windows of the stretches to look at, each with the digest of its border."""
    schema = T.StructType([
        T.StructField("_doc", doc_type), T.StructField("_digest", T.LongType()), T.StructField("_hash", T.LongType()), T.StructField("_start", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (text, looks) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                hashes = window_hash(_gears(codes_of(text)), span)
                n = len(hashes)
                # rows may repeat an id with another text: places outside this one are of the other
                looks = [(x["_digest"], x["_start"], min(x["_start"] + x["_windows"], n)) for x in looks if x["_start"] < n]
                if not looks:
                    continue
                start = np.concatenate([np.arange(a, b) for _, a, b in looks])
                digest = np.repeat(np.array([d for d, _, _ in looks], np.int64), [b - a for _, a, b in looks])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(start), k, np.int32))), pa.array(digest), pa.array(_signed(hashes[start])), pa.array(start.astype(np.int32))],
                    names=schema.names,
                )

    return rows.select("_doc", "_text", "_looks").mapInArrow(run, schema)


def _merged(found: DataFrame, doc_type: T.DataType, span: int, id_col: str) -> DataFrame:
    """One row for each stretch; stretches that touch or overlap are one."""
    schema = T.StructType([
        T.StructField(id_col, doc_type), T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, ends = [], [], []
            for k, ranges in enumerate(batch.column(1).to_pylist()):
                reach = -1
                for a, n in sorted((x["_start"], x["_windows"]) for x in ranges):
                    end = a + n - 1 + span
                    if a <= reach:
                        reach = ends[-1] = max(reach, end)
                    else:
                        at.append(k)
                        starts.append(a)
                        ends.append(end)
                        reach = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=schema.names
            )

    return found.mapInArrow(run, schema)


def shared_ratio(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 240) -> DataFrame:
    """``(<id_col>, spans, shared_chars, shared_ratio)`` of every row of ``df``:
    how much of each record is shared elsewhere; 0 for null and empty texts."""
    rows = df.select(F.col(id_col).alias("_doc"), F.coalesce(F.length(text_col), F.lit(0)).alias("_n"))
    spans = shared_spans(df, id_col, text_col, span).groupBy(F.col(id_col).alias("_doc")).agg(
        F.count(F.lit(1)).alias("_spans"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("_shared")
    )
    shared = F.coalesce(F.col("_shared"), F.lit(0))
    return rows.join(spans, "_doc", "left").select(
        F.col("_doc").alias(id_col), F.coalesce("_spans", F.lit(0)).alias("spans"), shared.alias("shared_chars"),
        F.when(F.col("_n") > 0, shared / F.col("_n")).otherwise(0.0).alias("shared_ratio"),
    )
