"""Token ids of whole texts under a public byte-level tokenizer.

The rank file stays where it is; its path is a parameter.  Long texts are
cut before encoding, only at places where the tokenizer's own pre-splitting
always has a border, so the ids are those of the uncut text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-splitting pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters a piece of a long text has at least.
PIECE = 100_000

_encodings: dict[str, object] = {}


def encoding(path: str = DEFAULT_RANKS):
    """The tokenizer of a local rank file, loaded once in a worker."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _encodings[path] = tiktoken.Encoding(
            os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[path]


#: White space as the pattern knows it.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where the pattern always has a border: no pre-token goes on from another
#: sign to white space, from a letter to what is none, or from a number to what is none.
_SAFE = regex.compile(rf"(?<=[^{_WHITE}\x1c-\x1f])(?=[{_WHITE}])|(?<=\p{{L}})(?=[^\p{{L}}\p{{M}}])|(?<=\p{{N}})(?=[^\p{{N}}\p{{M}}])")


def safe_pieces(text: str, piece: int = PIECE) -> Iterator[str]:
    """Cut a text at places where the pattern has a border, whatever surrounds them.

    White space ends a piece, and so does a change from letters or from
    numbers to other signs; only one run of one class is longer than a piece.
    """
    start, n = 0, len(text)
    while n - start > piece:
        at = _SAFE.search(text, start + piece)
        if at is None or at.start() >= n:
            break
        yield text[start: at.start()]
        start = at.start()
    yield text[start:]


def token_ids(text: str | None, path: str = DEFAULT_RANKS) -> list[int]:
    """Ids of one text; null and empty texts have none."""
    if not text:
        return []
    enc = encoding(path)
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    return [i for part in safe_pieces(text) for i in enc.encode_ordinary(part)]


def text_of(ids: list[int], path: str = DEFAULT_RANKS) -> str:
    """The text of ids, decoded from raw bytes."""
    enc = encoding(path)
    return b"".join(enc.decode_single_token_bytes(i) for i in ids).decode("utf-8", errors="strict")


def encode_texts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str = DEFAULT_RANKS
) -> DataFrame:
    """``(<id_col>, ids ARRAY<INT>)`` for every row of ``df``.

    Null and empty texts have the empty list.  Repeated rows stay repeated,
    an empty table gives an empty result.  A narrow map: no shuffle, memory
    bounded by an Arrow batch.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [token_ids(t, ranks_path) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"]
            )

    return rows.mapInArrow(run, schema)
