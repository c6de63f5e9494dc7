"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The rank file's path is a parameter; the driver reads it and broadcasts the
encoding (a vocabulary, whatever the input), which a worker builds once.
Long texts are cut at safe boundaries, before a space that follows a letter or
digit: no match of the split pattern spans such a place, so the pieces encode
to the same ids as the whole text. Decoding joins the ids' raw bytes.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.llm.names import by_place

LONG = 1 << 16                                   # characters encoded at a time
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?= )")


def load(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, without special tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, long: int = LONG):
    """The text cut at the first safe boundary after every ``long`` characters."""
    at = 0
    while len(text) - at > long:
        cut = _SAFE.search(text, at + long)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str | None) -> list[int]:
    if not text:
        return []
    if len(text) <= LONG:
        return enc.encode_ordinary(text)
    return [i for p in pieces(text) for i in enc.encode_ordinary(p)]


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "token_ids",
           keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) and ``out``, the ids as an
    array<int>, in one scan. NULL and
    empty texts have no ids; very long texts are encoded whole, in pieces;
    repeated rows encode alike; an empty table gives no rows. A column named
    ``out`` is replaced."""
    docs = docs.drop(out)
    keep = list(docs.columns if keep is None else keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text_col in keep else [F.col(f"`{text_col}`")]))
    at, n = rows.columns.index(text_col), len(keep)

    enc = docs.sparkSession.sparkContext.broadcast(load(path, pattern))

    def run(batches):
        for b in small(batches, at):
            ids = [np.array(encode_text(enc.value, t), np.int32) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(ids, pa.list_(pa.int32()))], names=[*keep, out])

    return by_place(rows)[0].mapInArrow(run, rows.select(*[f"`{c}`" for c in keep]).withColumn(out, F.array(F.lit(0))).schema)


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``rows`` and ``out``, the ids' raw bytes; NULL and empty ids decode to no
    bytes, repeated rows decode alike, an empty table gives no rows. A column named
    ``out`` is replaced."""
    rows = rows.drop(out)
    names, at = rows.columns, rows.columns.index(ids_col)

    enc = rows.sparkSession.sparkContext.broadcast(load(path, pattern))

    def run(batches):
        for b in small(batches, at):
            got = [enc.value.decode_bytes(i) if i else b"" for i in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], names=[*names, out])

    return by_place(rows)[0].mapInArrow(run, rows.withColumn(out, F.lit(b"")).schema)
