"""Near-duplicate records: all pairs above a similarity, and their groups.

The similarity of two records is the share of their union that their sets of
``shingle``-word runs have in common.  The candidates come from a sparse
matrix product of record by n-gram, from which the most frequent n-grams stay
out, but never so many of a record's that a pair could hide in them.  Rows of one n-gram are multiplied block by block, the overlap counts
of each pair add up, and pairs below the bound that follows from their sizes
are discarded.  Candidates are then compared set against set.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.runtime import cut, discard

WORD = re.compile(r"[^\W_]+")
#: Words of an n-gram of the product.
GRAM = 5
#: How many n-grams in a row one is taken from, by the least words of a record.
WINDOWS = ((40, 4), (0, 2))
#: Of the smaller record's n-grams, the share a pair has in common at least, by its least runs.
BOUNDS = ((40, 0.25), (0, 0.35))
#: The part of all occurrences of n-grams, the most frequent ones, that stays out of the product.
FREQUENT_PART = 0.12
#: Common n-grams that two records of one size must show in the product at least, and as a share of theirs: a record keeps frequent ones too if it has too few others.
LEAST_SHOWN, LEAST_SHOWN_SHARE = 3, 0.05
#: Ids that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Records that one block of an n-gram's row holds at most, about.
BLOCK = 1_000
#: The frequency sketch has two to this power counters, so its size is fixed: one byte each.
SKETCH_BITS = 24
_PARTS = 256


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hash = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[j: j + n]
        return _mix(h)


def words_of(text: str) -> np.ndarray:
    found = WORD.findall(text.lower())
    return np.fromiter(map(_hash.__getitem__, found), np.uint64, len(found))


def shingles_of(words: np.ndarray, shingle: int) -> np.ndarray:
    """The sorted set of a record's runs."""
    return np.unique(_runs(words, shingle))


def anchors_of(words: np.ndarray) -> np.ndarray:
    """The n-grams of a record that enter the product.

    Of every ``window`` n-grams in a row the least hash is one, so two records
    with ``GRAM + window - 1`` words in a row in common share an n-gram there;
    the window of the longer record counts.
    """
    window = next(w for least, w in WINDOWS if len(words) >= least)
    h = _runs(words, min(GRAM, len(words)))
    n = len(h)
    if n <= 1:
        return h
    width = min(window, n)
    m = n - width + 1
    least = h[:m].copy()
    for j in range(1, width):
        np.minimum(least, h[j: j + m], out=least)
    chosen = np.zeros(n, bool)
    for j in range(width):
        chosen[j: j + m] |= h[j: j + m] == least
    return np.unique(h[chosen])


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(flat)))


#: Bits of an internal id that hold the record's own id; the kind's code stands above.
_SHIFT = 56


def filing_records(chunked: DataFrame) -> DataFrame:
    """Whole filings as records: all non-empty chunks joined by line ends."""
    text = F.array_join(F.filter("text_chunks", lambda c: c.isNotNull() & (c != "")), "\n")
    return chunked.select(
        F.lit("filing").alias("record_kind"), F.col("chunked_id").alias("record_id"),
        F.col("accession_number").alias("origin"), text.alias("text"), F.lit(0).alias("min_words"),
    )


def extract_records(extracts: DataFrame, min_words: int = 20) -> DataFrame:
    return extracts.select(
        F.lit("extract").alias("record_kind"), F.col("extract_id").alias("record_id"),
        F.col("document_key").alias("origin"), F.col("text"), F.lit(min_words).alias("min_words"),
    )


def _kinds(records: DataFrame) -> list[str]:
    """The kinds of records, in order; there may be 127."""
    if not isinstance(records.schema["record_id"].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError("record_id must be a whole number")
    rows = records.select("record_kind").where(F.col("record_kind").isNotNull()).distinct().limit(128).collect()
    if len(rows) > 127:
        raise ValueError("more than 127 kinds of records")
    return sorted(r[0] for r in rows)


def _coded(records: DataFrame, kinds: list[str]) -> DataFrame:
    """(_uid, _origin, _text, _least): the kind's code stands in the high bits of the id."""
    code = F.lit(None).cast("long")
    for k, kind in enumerate(kinds):
        code = F.when(F.col("record_kind") == kind, F.lit(k).cast("long")).otherwise(code)
    own = F.col("record_id").cast("long")
    fits = F.when((own >= 0) & (own < 1 << _SHIFT), own).when(own.isNotNull(), F.raise_error(F.lit("a record_id lies in [0, 2**56)")).cast("long"))
    uid = fits + F.shiftleft(code, _SHIFT)
    return records.select(uid.alias("_uid"), F.col("origin").cast("string").alias("_origin"), F.col("text").alias("_text"), F.col("min_words").alias("_least")).where(
        F.col("_uid").isNotNull()
    )


def _salts(kinds: list[str]) -> list[np.uint64]:
    return [np.uint64(xxhash.xxh64_intdigest(k)) for k in kinds]


def _set_hash(runs: np.ndarray, salt: np.uint64) -> np.uint64:
    """A hash of a set of runs, which no order changes."""
    return runs.sum(dtype=np.uint64) * np.uint64(3) + np.bitwise_xor.reduce(_mix(runs)) + salt


def bitmap(runs: np.ndarray) -> bytes:
    """Two bits or more for each run; a bit tells whether an odd number of runs falls on it."""
    width = max(64, 1 << (2 * len(runs) - 1).bit_length())
    return np.packbits(np.bincount((runs & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def unlike(x: bytes, y: bytes) -> int:
    """Runs that only one of two sets holds, at least."""
    a, b = (np.frombuffer(v, np.uint8) for v in (x, y))
    if len(a) > len(b):
        a, b = b, a
    if len(b) > len(a):  # a wide bitmap folds into a narrow one
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int.from_bytes((a ^ b).tobytes(), "little").bit_count()


def _alike(pairs: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose bitmaps allow the threshold: a whole set need not be sent for the others."""
    known = heads.select("_uid", "_n", "_bits")
    x = known.select(F.col("_uid").alias("_a"), F.col("_n").alias("_na"), F.col("_bits").alias("_x"))
    y = known.select(F.col("_uid").alias("_b"), F.col("_n").alias("_nb"), F.col("_bits").alias("_y"))
    both = pairs.join(x, "_a").join(y, "_b").select("_a", "_b", "_na", "_nb", "_x", "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)
            keep = [unlike(x, y) <= (n + m) * (1 - threshold) / (1 + threshold) + 1e-6 for n, m, x, y in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["_a", "_b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "_a bigint, _b bigint").distinct()


def _features(coded: DataFrame, kinds: list[str], shingle: int) -> DataFrame:
    """(_uid, _origin, _n, _set, _bits, _grams): size, hash and bitmap of the shingle set, and the n-grams."""
    schema = T.StructType([
        *(coded.schema[c] for c in ("_uid", "_origin")), T.StructField("_n", T.IntegerType()),
        T.StructField("_set", T.LongType()), T.StructField("_bits", T.BinaryType()), T.StructField("_grams", T.ArrayType(T.LongType())),
    ])
    salts = _salts(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, sets, bits, grams = [], [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), strict=True)
            for k, (uid, text, least) in enumerate(rows):
                if not text:
                    continue
                words = words_of(text)
                if len(words) < max(shingle, least or 0):
                    continue
                salt = salts[uid >> _SHIFT]
                with np.errstate(over="ignore"):
                    runs = shingles_of(words, shingle)
                    at.append(k)
                    sizes.append(len(runs))
                    sets.append(_set_hash(runs, salt))
                    bits.append(bitmap(runs))
                    grams.append(anchors_of(words) ^ salt)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(sizes, pa.int32()),
                 pa.array(_signed(np.array(sets, np.uint64))), pa.array(bits, pa.binary()), _lists(grams)],
                names=schema.names,
            )

    return coded.select("_uid", "_origin", "_text", "_least").mapInArrow(run, schema)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of an array of lists, and the length of each list."""
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _frequencies(features: DataFrame):
    """A sketch of how often each n-gram occurs, and the level above which one is frequent, on every worker.

    Each task counts all of its n-grams in a fixed number of counters; the
    counters of all tasks add up part by part, and one byte of each, on a
    logarithmic scale, is kept.  A counter is never less than the count of an
    n-gram that falls on it.
    """
    width = (1 << SKETCH_BITS) // _PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in batches:
            place, n = np.unique(_bucket(_flat(batch.column(0))[0]), return_counts=True)
            local[place] += n.astype(np.uint32)
        for part in range(_PARTS):
            own = local[part * width: (part + 1) * width]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(own.tobytes(), 1)])], names=["_part", "_counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: int, total: np.ndarray) -> pa.RecordBatch:
            level = np.minimum(np.ceil(8 * np.log2(total + 1.0)), 255).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(level.tobytes(), 1)])], names=["_part", "_counts"])

        at, total = None, np.zeros(width, np.float64)
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at is not None and part != at:
                    yield out(at, total)
                    total = np.zeros(width, np.float64)
                at = part
                total += np.frombuffer(zlib.decompress(counts), np.uint32)
        if at is not None:
            yield out(at, total)

    schema = "_part int, _counts binary"
    parts = features.select("_grams").mapInArrow(count, schema).repartition("_part").sortWithinPartitions("_part").mapInArrow(add, schema)
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for part, level in parts.collect():  # one byte for each counter, whatever the corpus
        levels[part * width: (part + 1) * width] = np.frombuffer(zlib.decompress(level), np.uint8)
    # the level above which n-grams are frequent
    mass = np.bincount(levels, minlength=256) * (2.0 ** (np.arange(256) / 8) - 1)
    above = mass.sum() - np.cumsum(mass)
    common = int(np.argmax(above <= FREQUENT_PART * mass.sum()))
    return features.sparkSession.sparkContext.broadcast((levels, common))


def most_left_out(sizes: np.ndarray) -> np.ndarray:
    """How many of a record's n-grams may stay out of the product: so few that of the common
    ones of two records of this size ``LEAST_SHOWN`` or the share given must still meet there."""
    shown = np.maximum(LEAST_SHOWN, np.ceil(LEAST_SHOWN_SHARE * sizes))
    return np.maximum(0, np.floor(BOUNDS[0][1] * sizes) - 1 - shown).astype(np.int64)


def needed(runs: tuple, sizes: tuple, frequent: tuple, ends: tuple) -> np.ndarray:
    """Common n-grams that a pair must show in the product, from each record's
    runs, n-grams, frequent n-grams and the place in the order where its kept
    ones end.

    What is common but not kept by both is frequent for both.  It also lies in
    what the record left out whose kept ones end first.
    """
    n, share = np.minimum(*runs), np.zeros(len(runs[0]))
    for least, part in reversed(BOUNDS):
        share = np.where(n >= least, part, share)
    out = [np.minimum(f, most_left_out(s)) for f, s in zip(frequent, sizes, strict=True)]
    first = np.where(ends[0] < ends[1], out[0], np.where(ends[1] < ends[0], out[1], np.maximum(*out)))
    hidden = np.minimum(first, np.minimum(*frequent))
    return np.maximum(1, np.ceil(share * np.minimum(*sizes)).astype(np.int64) - 1 - hidden)


def _packed(runs, sizes, frequent, ends, side) -> np.ndarray:
    """One number of five: bounds stay safe where a field is cut off or rounded."""
    runs, short = np.minimum(runs, (1 << 24) - 1), np.minimum(sizes, (1 << 18) - 1)
    part = np.minimum(np.ceil(1023 * frequent / np.maximum(sizes, 1)).astype(np.int64), 1023)
    return (((runs << 18 | short) << 10 | part) << 8 | ends) << 2 | side


def _unpacked(facts: np.ndarray):
    """(runs, sizes, frequent, ends, side)"""
    sizes = facts >> 20 & (1 << 18) - 1
    return facts >> 38, sizes, np.ceil((facts >> 10 & 1023) * sizes / 1023).astype(np.int64), facts >> 2 & 255, facts & 3


def _rows(heads: DataFrame, frequencies) -> DataFrame:
    """(_gram, _uid, _facts): the n-grams of each record that are multiplied, and what bounds need to know.

    The order is that of the sketch, then of the hash.  An n-gram of more than
    ``BLOCK`` records is cut into blocks of records; a record's row goes once
    to each pair of blocks that holds its own, so no task multiplies more than
    two blocks.
    """
    levels = np.arange(256)
    parts = np.maximum(1, np.ceil((2.0 ** (levels / 8) - 1) / BLOCK)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, common = frequencies.value
        for batch in batches:
            flat, sizes = _flat(batch.column(2))
            uid, runs = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            starts = np.cumsum(sizes) - sizes
            record = np.repeat(np.arange(len(sizes)), sizes)
            level = sketch[_bucket(flat)]
            order = np.lexsort((flat, level, record))
            frequent = np.bincount(record[level > common], minlength=len(sizes))
            keep = sizes - np.minimum(frequent, most_left_out(sizes))
            ends = np.full(len(sizes), 255, np.int64)
            cut_off = np.flatnonzero(keep < sizes)
            ends[cut_off] = level[order[starts[cut_off] + keep[cut_off]]]
            order = order[np.arange(len(flat)) - np.repeat(starts, sizes) < np.repeat(keep, sizes)]
            gram, who, blocks = flat[order], record[order], parts[level[order]]
            hot = blocks > 1
            keys, owners, sides = [gram[~hot]], [who[~hot]], [np.zeros(int((~hot).sum()), np.int64)]
            if hot.any():
                g, w, n = gram[hot], who[hot], blocks[hot]
                own = (_mix(uid[w].view(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
                other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                g, w, own = np.repeat(g, n), np.repeat(w, n), np.repeat(own, n)
                with np.errstate(over="ignore"):
                    pair = np.minimum(own, other).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(own, other).astype(np.uint64) + np.uint64(1)
                    keys.append(_mix(g + _mix(pair)))
                owners.append(w)
                sides.append(np.where(own == other, 0, np.where(own < other, 1, 2)))
            who = np.concatenate(owners)
            facts = _packed(runs, sizes, frequent, ends, 0)[who] | np.concatenate(sides)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(keys))), pa.array(uid[who]), pa.array(facts)], names=["_gram", "_uid", "_facts"])

    return heads.select("_uid", "_n", "_grams").mapInArrow(run, "_gram bigint, _uid bigint, _facts bigint")


def _product(threshold: float):
    """Rows (_gram, _uid, _facts), sorted by _gram, to counted pairs (_a, _b, _needed, _common) of sizes that allow the threshold."""

    def counted(gram: np.ndarray, uid: np.ndarray, facts: np.ndarray) -> pa.RecordBatch:
        *known, side = _unpacked(facts)
        runs = known[0]
        found = [np.zeros((0, 3), np.int64)]
        x = np.arange(len(gram))
        for step in range(1, len(gram)):
            x = x[x < len(gram) - step]
            x = x[gram[x + step] == gram[x]]
            if not len(x):
                break
            a, b = x, x + step
            # a repeated row is no partner; of two blocks only rows of different ones are
            fits = (np.minimum(runs[a], runs[b]) >= threshold * np.maximum(runs[a], runs[b]) - 1e-9) & (uid[a] != uid[b]) & ((side[a] == 0) | (side[a] != side[b]))
            a, b = a[fits], b[fits]
            need = needed(*((f[a], f[b]) for f in known))
            found.append(np.stack([np.minimum(uid[a], uid[b]), np.maximum(uid[a], uid[b]), need], 1))
        pairs = np.concatenate(found)
        pairs = pairs[np.lexsort(pairs.T[::-1])]
        first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)])) if len(pairs) else np.zeros(0, np.int64)
        common = np.diff(np.append(first, len(pairs)))
        columns = [np.ascontiguousarray(pairs[first, 0]), np.ascontiguousarray(pairs[first, 1]), pairs[first, 2].astype(np.int32), common.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["_a", "_b", "_needed", "_common"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            cols = [np.concatenate([old, batch.column(c).to_numpy()]) for c, old in enumerate(rest)]
            if not len(cols[0]):
                continue
            # the last n-gram may go on in the next batch
            done = int(np.argmax(cols[0] == cols[0][-1]))
            rest = [c[done:] for c in cols]
            if done:
                yield counted(*(c[:done] for c in cols))
        yield counted(*rest)

    return run


def _candidates(heads: DataFrame, frequencies, threshold: float) -> DataFrame:
    """(_a, _b) of records whose sizes and common n-grams allow the threshold.

    The bound on the count: a similarity of 0.6 over runs of three words
    leaves room for one insertion in nine words, one changed word in twelve or
    one cut in eight, and between two such edits every window of n-grams that
    lies inside gives a common one.  A pair shares the part in ``BOUNDS`` at
    least, but for one.
    """
    rows = _rows(heads, frequencies).repartition("_gram").sortWithinPartitions("_gram")
    pairs = rows.mapInArrow(_product(threshold), "_a bigint, _b bigint, _needed int, _common int")
    total = pairs.groupBy("_a", "_b", "_needed").agg(F.sum("_common").alias("_common"))
    return total.where(F.col("_common") >= F.col("_needed")).select("_a", "_b").distinct()


def _small(ids: DataFrame) -> DataFrame:
    """Ids or n-grams: broadcast if a count shows that they are few, else joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _verified(coded: DataFrame, kinds: list[str], pairs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """(_a, _sa, _b, _sb): the pairs whose whole shingle sets are similar enough, with the hashes of those sets."""
    # few are broadcast, so the texts of all other records are not shuffled
    ids = cut(pairs.select(F.explode(F.array("_a", "_b")).alias("_uid")).distinct())
    schema = T.StructType([T.StructField("_uid", T.LongType()), T.StructField("_set", T.LongType()), T.StructField("_runs", T.ArrayType(T.LongType()))])

    salts = _salts(kinds)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                runs = [shingles_of(words_of(t or ""), shingle) for t in batch.column(1).to_pylist()]
                sets = [_set_hash(r, salts[uid >> _SHIFT]) for r, uid in zip(runs, batch.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_signed(np.array(sets, np.uint64))), _lists(runs)], names=schema.names)

    texts = coded.join(_small(ids), "_uid", "left_semi").select("_uid", "_text").mapInArrow(whole, schema)
    sets = cut(texts)
    both = pairs.join(sets.select(F.col("_uid").alias("_a"), F.col("_set").alias("_sa"), F.col("_runs").alias("_x")), "_a").join(
        sets.select(F.col("_uid").alias("_b"), F.col("_set").alias("_sb"), F.col("_runs").alias("_y")), "_b"
    ).select("_a", "_sa", "_b", "_sb", "_x", "_y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= threshold * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in range(4)], names=["_a", "_sa", "_b", "_sb"]).filter(pa.array(keep, pa.bool_()))

    # repeated rows of a record repeat its links
    links = cut(both.mapInArrow(compare, "_a bigint, _sa bigint, _b bigint, _sb bigint").distinct())
    discard(ids, sets)
    return links


def _classes(records: DataFrame, kinds: list[str], shingle: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Members (_uid, _origin, _head, _set, _copies) and links (_a, _sa, _b, _sb) between heads.

    A class is named by its least id and the hash of its set, as an id may
    stand in rows of several texts.
    """
    coded = _coded(records, kinds)
    features = cut(_features(coded, kinds, shingle))
    named = features.select("_uid", "_origin", "_set", "_n")
    classes = named.groupBy("_set", "_n").agg(F.min("_uid").alias("_head"), F.countDistinct("_uid").alias("_copies"))
    members = cut(named.join(classes, ["_set", "_n"]).select("_uid", "_origin", "_head", "_set", "_copies").distinct())
    copies = cut(members.where(F.col("_uid") != F.col("_head")).select("_uid", "_set"))
    heads = features.join(_small(copies), ["_uid", "_set"], "left_anti")
    frequencies = _frequencies(features)
    pairs = cut(_alike(_candidates(heads, frequencies, threshold), heads, threshold))
    discard(copies, features)
    links = _verified(coded, kinds, pairs, shingle, threshold)
    discard(pairs)
    return members, links


def near_duplicate_pairs(records: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``(record_kind, id_a, id_b)`` with id_a < id_b: all pairs of records of one
    kind and different origin whose shingle sets share ``threshold`` of their union.

    ``records`` has ``record_kind, record_id, origin, text, min_words``
    (see ``filing_records`` and ``extract_records``).  Ids are whole numbers in
    [0, 2**56) that name a record of a kind, any others are an error; there may
    be 127 kinds.  Rows that repeat an id are one record, with all their texts.
    Null texts, and texts of fewer words than a shingle or ``min_words``, have
    no pairs; a null origin differs from every origin; a null id or kind is no
    record.  Empty tables give an empty result.

    Which pairs are found: every candidate is compared in full, so no wrong
    pair comes out.  Two records share an n-gram of the product wherever 6
    words in a row are common (under 40 words) or 8 (longer), and a pair is a
    candidate if its common n-grams reach the part in ``BOUNDS``.  That is an
    argument about edits of words, not a proof for any two sets; results
    equalled the comparison of all pairs wherever that was made.  Sets are
    those of 64-bit hashes of runs.

    Scale: records with equal sets are one class, and only classes are
    multiplied.  A sketch of fixed size over all n-grams puts the frequent
    ones last, so few records meet in one row of the product, and rows of many
    records are multiplied in blocks.  The result lists every pair, so it
    grows with the square of a group; ``near_duplicate_groups`` does not.
    """
    kinds = _kinds(records)
    members, links = _classes(records, kinds, shingle, threshold)
    a = members.select(F.col("_head").alias("_a"), F.col("_set").alias("_sa"), F.col("_uid").alias("_ra"), F.col("_origin").alias("_oa"))
    b = members.select(F.col("_head").alias("_b"), F.col("_set").alias("_sb"), F.col("_uid").alias("_rb"), F.col("_origin").alias("_ob"))
    between = links.join(a, ["_a", "_sa"]).join(b, ["_b", "_sb"]).select("_ra", "_rb", "_oa", "_ob")
    copied = members.where(F.col("_copies") > 1)
    x = copied.select("_head", "_set", F.col("_uid").alias("_ra"), F.col("_origin").alias("_oa"))
    y = copied.select("_head", "_set", F.col("_uid").alias("_rb"), F.col("_origin").alias("_ob"))
    within = x.join(y, ["_head", "_set"]).where(F.col("_ra") < F.col("_rb")).select("_ra", "_rb", "_oa", "_ob")
    other = F.col("_oa").isNull() | F.col("_ob").isNull() | (F.col("_oa") != F.col("_ob"))
    pairs = between.unionByName(within).where(other & (F.col("_ra") != F.col("_rb"))).select(F.least("_ra", "_rb").alias("_ra"), F.greatest("_ra", "_rb").alias("_rb"))
    return pairs.distinct().select(_kind_of("_ra", kinds), _id_of("_ra").alias("id_a"), _id_of("_rb").alias("id_b"))


def _kind_of(uid: str, kinds: list[str]):
    every = F.array(*(F.lit(k) for k in kinds)) if kinds else F.array().cast("array<string>")
    return F.get(every, F.shiftright(uid, _SHIFT).cast("int")).alias("record_kind")


def _id_of(uid: str):
    return F.col(uid).bitwiseAND(F.lit((1 << _SHIFT) - 1))


def near_duplicate_groups(records: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``(record_kind, record_id, group_id, links)``: one row for each record long
    enough; the group is named by its least id, ``links`` counts the classes of
    other texts that are linked to the record's own.

    Groups are connected components over classes: every round each class takes
    the least name among its neighbours and their names, through scratch
    tables, until no name moves; rounds grow with the logarithm of a group's
    diameter and no group or link ever reaches the driver.
    """
    kinds = _kinds(records)
    members, links = _classes(records, kinds, shingle, threshold)
    # an id that stands in rows of several texts ties their classes
    several = members.groupBy("_uid").agg(F.collect_set("_head").alias("_heads")).where(F.size("_heads") > 1)
    tied = several.select(F.array_min("_heads").alias("_a"), F.explode("_heads").alias("_b")).where(F.col("_a") != F.col("_b"))
    one_way = links.select("_a", "_b").unionByName(tied)
    edges = cut(one_way.unionByName(one_way.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))).distinct())
    names = cut(edges.groupBy("_a").agg(F.min("_b").alias("_m")).select("_a", F.least("_a", "_m").alias("_name")))
    while True:
        near = edges.join(names.select(F.col("_a").alias("_b"), F.col("_name").alias("_theirs")), "_b").groupBy("_a").agg(F.min("_theirs").alias("_theirs"))
        new = names.join(near, "_a").select("_a", "_name", F.least("_name", "_theirs").alias("_new"))
        # pointer jumping: take the name of one's name
        jump = new.select(F.col("_a").alias("_new"), F.col("_new").alias("_far"))
        new = cut(new.join(jump, "_new", "left").select("_a", "_name", F.least("_new", F.coalesce("_far", "_new")).alias("_new")))
        discard(names)
        moved = new.where(F.col("_name") != F.col("_new")).limit(1).count()
        names = cut(new.select("_a", F.col("_new").alias("_name")))
        discard(new)
        if not moved:
            break
    degree = links.select("_a", "_b").unionByName(links.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"))).groupBy("_a").agg(F.count(F.lit(1)).alias("_links"))
    of = names.join(degree, "_a", "left").select(F.col("_a").alias("_head"), "_name", F.coalesce("_links", F.lit(0)).alias("_links"))
    out = members.join(of, "_head", "left").groupBy("_uid").agg(F.min(F.coalesce("_name", "_head")).alias("_name"), F.max(F.coalesce("_links", F.lit(0))).alias("_links"))
    return out.select(_kind_of("_uid", kinds), _id_of("_uid").alias("record_id"), _id_of("_name").alias("group_id"), F.col("_links").alias("links"))
