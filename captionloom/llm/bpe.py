"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut at safe boundaries first: places where the splitting pattern always ends a
match, whatever stands around them (a letter or digit, then a space or a new line, then a letter;
a letter, then plain punctuation). So the pieces' tokens, joined, are the whole text's tokens, and
no call holds more than one piece. Long runs of white space, in which no such place is, are cut out as the one match that
the pattern makes of them. Ids are kept as packed little-endian unsigned 32-bit integers;
decoding joins the ids' raw bytes and needs no valid UTF-8 inside a token.

Defined cases: null and empty texts have no tokens and decode to no bytes; strings of special
tokens are ordinary text; further columns pass through; a text without a safe boundary or
a long run of white space is encoded in one call; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from captionloom.llm.common import safe_name, ship

#: Characters after which a long text is cut at its next safe boundary.
PIECE_CHARS = 50_000
#: White space that stands in one run of so many characters or more is given to the encoder as one match, without the pattern,
#: whose look-ahead overflows the stack on runs of about a million.
BLANK_CHARS = 10_000
#: Rows that a worker turns over at once.
SLICE_ROWS = 256
_SAFE = regex.compile(r"(?<=[0-9A-Za-z])(?=[ \n][A-Za-z])|(?<=[A-Za-z])(?=[.,;:!?])|(?<=[一-鿿])(?=[、。，！？])")


@functools.lru_cache(maxsize=4)
def encoder(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """One encoder for each worker process."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _blank_run(chars: int) -> regex.Pattern:
    return regex.compile(rf"\p{{White_Space}}{{{max(chars, 2)},}}")


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    at = 0
    while len(text) - at > limit:
        found = _SAFE.search(text, at + limit)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str | None, limit: int = PIECE_CHARS, blank: int = BLANK_CHARS) -> list[int]:
    if not text:
        return []
    if len(text) <= min(limit, blank):
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text, limit):
        at = 0
        for run in _blank_run(blank).finditer(piece):
            # The match that the pattern makes of the run: all of it at the text's end, else all but its last character.
            end = run.end() - (run.end() < len(piece))
            ids += enc.encode_ordinary(piece[at : run.start()])
            ids += enc._encode_single_piece(piece[run.start() : end])
            at = end
        ids += enc.encode_ordinary(piece[at:])
    return ids


def pack(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def unpack(packed: bytes | None) -> list[int]:
    return np.frombuffer(packed or b"", "<u4").tolist()


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that ids as Python numbers and copies of texts stay small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(lo, SLICE_ROWS)


def _appended(df: DataFrame, names: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType(df.schema.fields + [T.StructField(n, t) for n, t in names])


def encode(
    docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", count_col: str = "n_tokens", decoded_col: str | None = None, keep_text: bool = True, piece_chars: int = PIECE_CHARS
) -> DataFrame:
    """Adds packed ids (binary) and their number, and, if asked for, the raw bytes decoded from the ids in the same pass;
    columns of these names that exist already are replaced. The text may be left out of the result."""
    new = [(ids_col, T.BinaryType(), pa.binary()), (count_col, T.LongType(), pa.int64())]
    if decoded_col:
        new.append((decoded_col, T.BinaryType(), pa.binary()))
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n, _, _ in new}])
    kept = [c for c in docs.columns if keep_text or c != text_col]

    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in _sliced(batches):
            got = [pack(encode_text(enc, t, piece_chars)) for t in batch.column(text_col).to_pylist()]
            made = [got, [len(x) // 4 for x in got]]
            if decoded_col:
                made.append([enc.decode_bytes(unpack(x)) for x in got])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *[pa.array(x, kind) for x, (_, _, kind) in zip(made, new, strict=True)]], names=[*kept, *[n for n, _, _ in new]])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t, _ in new]))


def decode(tokens: DataFrame, rank_file: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """Adds the raw bytes that the packed ids stand for; an unknown id raises KeyError."""
    bytes_col = safe_name(tokens, bytes_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_file, pattern)
        for batch in _sliced(batches):
            got = [enc.decode_bytes(unpack(x)) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], names=[*batch.schema.names, bytes_col])

    return tokens.mapInArrow(run, _appended(tokens, [(bytes_col, T.BinaryType())]))
