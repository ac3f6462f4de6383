"""Problem 8: cutting texts above a token limit at natural boundaries.

Each text becomes a string with one letter per token, telling what ends there
(paragraph, line, sentence, word, character, or nothing: inside a character).
A regular expression with bounded quantifiers takes pieces from that string:
alternatives in the order of boundary strength consume up to the limit, and a
character end is the fallback. SQL array functions turn the pieces into
offsets, look back for the overlap, and put the text of each piece together from
that of its tokens, so that the time grows as the length of a text does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patraloom.llm.encoding import BATCH_BYTES, DEFAULT, LONG, encode, encoder, texts_of

# What may end a sentence, and what may close after it.
ENDERS, CLOSERS = ".!?…।॥。！？", "\"')]}»”’"
PARAGRAPH, LINE, SENTENCE, WORD, CHARACTER, INSIDE = "PLSWCu"
#: Tokens of one character at most, less one: how far an overlap may grow to start at a character.
SLACK = 3


def marks(text: str, ids: np.ndarray, lengths: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """One letter for the end of each token, and the ends of tokens in characters
    and in bytes, both of the last whole character."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    starts = np.flatnonzero((raw & 0xC0) != 0x80)
    bytes_at = np.append(starts, len(raw))
    ends = np.cumsum(lengths[ids])
    chars = np.searchsorted(bytes_at, ends, "right") - 1
    whole = bytes_at[chars] == ends

    blank = np.isin(codes, np.array([*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32))
    line = codes == 10
    next_blank = np.append(blank[1:], True)
    kind = np.full(len(codes) + 1, ord(CHARACTER), np.uint8)
    at = kind[1:]  # by the last character before the end
    at[~blank & next_blank] = ord(WORD)
    ender = np.isin(codes, np.frombuffer(ENDERS.encode("utf-32-le"), np.uint32))
    closer = np.isin(codes, np.frombuffer(CLOSERS.encode("utf-32-le"), np.uint32))
    closed = ender | (closer & np.append(False, ender[:-1]))
    at[closed & next_blank] = ord(SENTENCE)
    at[line] = ord(LINE)
    # A blank run with two line ends or more, at its last line end, closes a paragraph.
    run = np.cumsum(np.append(True, blank[1:] != blank[:-1]))
    before = np.cumsum(line) - line
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    seen = before - before[first][run - 1]
    later = np.append(first[1:], len(codes))[run - 1]
    upto = np.append(before, before[-1] + line[-1] if len(line) else 0)
    at[line & (seen >= 1) & (upto[later] == before + line)] = ord(PARAGRAPH)
    letters = np.where(whole, kind[chars], ord(INSIDE)).astype(np.uint8)
    return letters.tobytes().decode("ascii"), chars.astype(np.int32), bytes_at[chars]


def pattern(limit: int, least: int = 0) -> str:
    """The piece of at most ``limit`` letters: the strongest boundary of the
    piece's second half, else any boundary after ``least`` letters, else a
    character end."""
    half = limit // 2
    late = [f".{{{half},{limit - 1}}}{k}" for k in PARAGRAPH + LINE + SENTENCE + WORD]
    early = [f".{{{least},{half - 1}}}{k}" for k in PARAGRAPH + LINE + SENTENCE + WORD]
    return "|".join([f".{{1,{limit}}}$", *late, *early, f".{{0,{limit - 1}}}[^{INSIDE}]"])


def split_texts(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int = 512, overlap: int = 32, rank_file: str = DEFAULT, long: int = LONG
) -> DataFrame:
    """Ordered pieces of every text above ``limit`` tokens.

    Columns: the id, ``n_tokens`` of the whole text, ``piece`` (from 0),
    ``start`` and ``stop`` (characters), ``piece_tokens``, ``shared`` (tokens in
    common with the piece before) and ``piece_text``. A piece has at most
    ``limit`` tokens; it starts ``overlap`` tokens before the end of the piece
    before, or up to three more where that would cut a character. Null, empty
    and shorter texts give no row; repeated rows are cut each on its own.
    """
    if limit < 2 * (overlap + SLACK) + 8 or overlap < 0:
        raise ValueError("the limit must be more than twice the overlap")
    schema = T.StructType([
        T.StructField("id", df.schema[id_column].dataType), T.StructField("letters", T.StringType()),
        T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("parts", T.ArrayType(T.StringType())),
    ])

    def packed(column: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        rows, bodies, letters, ends, cuts = zip(*found, strict=True)
        at = np.cumsum([0, *map(len, bodies)])
        offsets = np.concatenate([np.zeros(1, np.int64), *(a + c for a, c in zip(at, cuts))]).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(b"".join(bodies)))
        lists = np.cumsum([0, *map(len, ends)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [column.take(pa.array(rows, pa.int32())), pa.array(letters, pa.string()), pa.ListArray.from_arrays(lists, pa.array(np.concatenate(ends))), pa.ListArray.from_arrays(lists, parts)],
            ["id", "letters", "ends", "parts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file)
        lengths = np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)])
        for batch in batches:
            found, size = [], 0
            for k, body in enumerate(texts_of(batch.column(1))):
                ids = encode(body, enc, long)
                if len(ids) > limit:
                    one, end, at = marks(body, ids, lengths)
                    # The end of a token inside a character is none to cut at.
                    end[np.frombuffer(one.encode("ascii"), np.uint8) == ord(INSIDE)] = -1
                    found.append((k, body.encode("utf-8"), one, end, at))
                    size += len(found[-1][1])
                    if size > BATCH_BYTES:
                        yield packed(batch.column(0), found)
                        found, size = [], 0
            if found:
                yield packed(batch.column(0), found)

    marked = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("binary")).mapInArrow(run, schema)
    # The first piece is long enough to hold what the second shares with it.
    first, later = pattern(limit, overlap + SLACK), pattern(limit - overlap - SLACK)
    # Back from a turn to the end of a whole character.
    back = "t"
    for k in range(SLACK, -1, -1):
        back = f"if(t <= {k} or ends[t - {k + 1}] >= 0, greatest(t - {k}, 0), {f't - {SLACK}' if k == SLACK else back})"
    turns = f"transform(tails, (tail, p) -> named_struct('piece', p, 'tail', tail, 'before', if(p = 0, 0, tails[p - 1])))"
    heads = f"transform({turns}, x -> named_struct('x', x, 't', if(x.piece = 0, 0, x.before - {overlap})))"
    heads = f"transform({heads}, y -> named_struct('x', y.x, 'head', transform(array(y.t), t -> {back})[0]))"
    pieces = f"""transform({heads}, z -> named_struct(
        'piece', z.x.piece, 'start', if(z.head = 0, 0, ends[z.head - 1]), 'stop', ends[z.x.tail - 1], 'piece_tokens', z.x.tail - z.head,
        'shared', if(z.x.piece = 0, 0, z.x.before - z.head), 'piece_text', array_join(slice(parts, z.head + 1, z.x.tail - z.head), '')))"""
    cut = (
        marked.withColumn("head", F.regexp_extract("letters", f"^(?:{first})", 0))
        .withColumn("rest", F.expr("substring(letters, length(head) + 1)"))
        .withColumn("sizes", F.concat(F.array(F.length("head")), F.transform(F.regexp_extract_all("rest", F.lit(f"({later})"), F.lit(1)), F.length)))
        .select("id", F.length("letters").alias("n_tokens"), "ends", "parts", "sizes")
    )
    return _with_tails(cut).select(F.col("id").alias(id_column), "n_tokens", F.inline(F.expr(pieces)))


#: SQL: the running sums of an array ``{0}``; each step copies what it appends to.
_SUMS = "aggregate({0}, cast(array() as array<int>), (a, x) -> array_append(a, coalesce(try_element_at(a, -1), 0) + x))"


def _with_tails(df: DataFrame) -> DataFrame:
    """Adds ``tails``, the running sums of ``sizes``: in blocks of the root of
    its size, and of the blocks' sums, so that little is copied."""
    block = "cast(ceil(sqrt(size(sizes))) as int)"
    blocks = f"transform(sequence(0, (size(sizes) - 1) div {block}), j -> slice(sizes, cast(j * {block} + 1 as int), {block}))"
    return (
        df.withColumn("blocks", F.expr(f"transform({blocks}, b -> {_SUMS.format('b')})"))
        .withColumn("upto", F.expr(_SUMS.format("transform(blocks, b -> b[size(b) - 1])")))
        .withColumn("tails", F.expr("flatten(zip_with(blocks, upto, (b, u) -> transform(b, x -> x + u - b[size(b) - 1])))"))
    )
