"""SHA-256 of a text that lies in several rows."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_sha256(pieces: DataFrame, key: str, order: str, text: str, joint: str) -> DataFrame:
    """(key, sha256): lowercase hex of the key's pieces in order, with ``joint``
    between them; NULL pieces are left out, a key without any hashes nothing. One
    piece is held at a time, so a key's text may be of any length."""
    rows = pieces.select(key, order, F.col(text).cast("binary").alias("piece")).repartition(key).sortWithinPartitions(F.col(key).asc_nulls_first(), order)
    link = joint.encode()

    def run(batches):
        at, digest, some, kind = None, None, False, None
        for b in batches:
            kind, keys, shas = b.schema.field(0).type, [], []
            for k, piece in zip(b.column(0).to_pylist(), b.column(2)):
                if digest is None or k != at:
                    if digest is not None:
                        keys.append(at)
                        shas.append(digest.hexdigest())
                    at, digest, some = k, hashlib.sha256(), False
                if piece.is_valid:
                    digest.update(link if some else b"")
                    digest.update(piece.as_buffer())
                    some = True
            yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(shas, pa.string())], names=[key, "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], kind), pa.array([digest.hexdigest()])], names=[key, "sha256"])

    return rows.mapInArrow(run, rows.select(key, F.lit("").alias("sha256")).schema)
