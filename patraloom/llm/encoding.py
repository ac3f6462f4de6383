"""Problem 6: token ids of whole texts by a public byte-level BPE, with tiktoken.

The vocabulary is a local rank file, named by a parameter and read by each
Python worker once. Long texts are cut before encoding, only where the
splitting pattern cuts in any case, so the ids are those of the whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The public rank files' folder; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
DEFAULT = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern of the public byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts above this many characters are cut before they are encoded.
LONG = 20_000
#: Bytes of text that are encoded, and sent on, at once, about.
BATCH_BYTES = 32_000_000
#: A character after which the pattern always cuts: a visible one before a
#: blank, or the change between ASCII letters and digits.
SAFE = re.compile(r"\S(?=[ \n])|[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")


@lru_cache(maxsize=4)
def encoder(rank_file: str = DEFAULT):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """The text in runs of about ``long`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > long:
        found = SAFE.search(text, at + long - 1)
        if not found or found.end() >= len(text):
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def encode(text: str | None, enc, long: int = LONG) -> np.ndarray:
    if not text:
        return np.empty(0, np.uint32)
    if len(text) <= long:
        return enc.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([enc.encode_to_numpy(p, disallowed_special=()) for p in pieces(text, long)])


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """Texts of a binary Arrow column; bytes that aren't UTF-8 become U+FFFD."""
    for raw in column:
        raw = raw.as_py()
        yield None if raw is None else raw.decode("utf-8", "replace")


def _parts(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts, in the last column, have about ``most``
    bytes at most, so that long ones neither fill a worker nor the 32 bits of a
    list's offsets. A text has no more tokens than bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows or not batch.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, "right"))) if batch.num_rows else 0
        yield batch.slice(at, end - at)
        if not batch.num_rows:
            break
        at = end


def _over_texts(df: DataFrame, keep: list[str], text: str, out: T.DataType, name: str, make) -> DataFrame:
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(name, out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], make(part.columns[-1])], [*keep, name])

    return df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("binary").alias("the text")).mapInArrow(run, schema)


def token_ids(df: DataFrame, id_column: str = "doc_id", text: str = "text", rank_file: str = DEFAULT, long: int = LONG) -> DataFrame:
    """One row per row of ``df``: its id and ``ids``, the token ids of its text
    without special tokens. An empty text and a null text both give ``[]``."""

    def make(column: pa.Array) -> pa.Array:
        enc = encoder(rank_file)
        each = [encode(t, enc, long) for t in texts_of(column)]
        ends = np.zeros(len(each) + 1, np.int32)
        np.cumsum([len(x) for x in each], out=ends[1:])
        values = np.concatenate(each) if each else np.empty(0, np.uint32)
        return pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32)))

    return _over_texts(df, [id_column], text, T.ArrayType(T.IntegerType()), "ids", make)


def token_counts(df: DataFrame, keep: list[str], text: str = "text", rank_file: str = DEFAULT, long: int = LONG) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` (bigint) of every row; 0 for a null text."""

    def make(column: pa.Array) -> pa.Array:
        enc = encoder(rank_file)
        return pa.array([len(encode(t, enc, long)) for t in texts_of(column)], pa.int64())

    return _over_texts(df, keep, text, T.LongType(), "n_tokens", make)


def decoded(df: DataFrame, id_column: str = "doc_id", ids: str = "ids", rank_file: str = DEFAULT) -> DataFrame:
    """The inverse of :func:`token_ids`: the bytes of the ids, joined, as
    ``bytes`` (binary). A null list gives null, an empty list no bytes."""
    schema = T.StructType([T.StructField(id_column, df.schema[id_column].dataType), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file)
        for batch in batches:
            made = [None if x is None else enc.decode_bytes(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], [id_column, "bytes"])

    return df.select(F.col(f"`{id_column}`"), F.col(f"`{ids}`")).mapInArrow(run, schema)
