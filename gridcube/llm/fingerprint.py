"""Document fingerprints: threshold-scaled sketches of five-word shingles.

A sketch keeps every distinct shingle hash below ``FRACTION`` of the hash
range; a text with fewer than ``FLOOR`` of those keeps its ``FLOOR`` smallest
hashes, so that short texts have a sketch too. Each sketch therefore holds all
hashes up to a known cover. Sketches merge by union and give containment over
the range that both cover, however unequal the documents are. Where that range
holds no hash of a text, sketches alone leave its containment undefined (None);
where both texts are at hand (``pair_likeness``), the range is then widened to
what the shorter text's sketch covers, so that there is always a value.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.llm.names import by_place
from gridcube.session import materialize

SHINGLE, FLOOR, SCALE = 5, 16, 16
FRACTION = np.uint64(2 ** 64 // SCALE)
_TOP = np.uint64(2 ** 64 - 1)
_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, i, 2 ** 64) for i in range(1, SHINGLE + 1)], np.uint64)


def shingle_hashes(raw: bytes) -> np.ndarray:
    """Distinct hashes of a UTF-8 text's five-word shingles, sorted. A text of
    fewer words is one shingle, one without words has none."""
    words = raw.split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(h))):
        mixed += h[i:i + n] * _MULTIPLIERS[i]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def sketch(raw: bytes) -> np.ndarray:
    return kept(shingle_hashes(raw))


def kept(h: np.ndarray) -> np.ndarray:
    """The sketch within a text's sorted hashes."""
    return h[:max(int(np.searchsorted(h, FRACTION)), min(FLOOR, len(h)))]


def cover(s: np.ndarray) -> np.uint64:
    """All hashes of the text up to this value are in its sketch."""
    return _TOP if len(s) < FLOOR else max(FRACTION, s[-1])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    h = np.union1d(a, b)
    h = h[h <= min(cover(a), cover(b))]
    return h[:max(int(np.searchsorted(h, FRACTION)), min(FLOOR, len(h)))]


def containment(a: np.ndarray, b: np.ndarray) -> float | None:
    """Estimated share of a's shingles that b has; two texts without words: 1.
    None if a has shingles but no hash in the range that both cover."""
    if not len(a):
        return float(not len(b))
    top = min(cover(a), cover(b))
    a, b = a[a <= top], b[b <= top]
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else None


def likeness(a: np.ndarray, b: np.ndarray) -> float | None:
    """The larger of the two containments; 0 if only one has shingles, None if
    one of them is undefined."""
    if not (len(a) and len(b)):
        return float(len(a) == len(b))
    both = containment(a, b), containment(b, a)
    return None if None in both else max(both)


def pair_likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Likeness of two texts from all their hashes: that of their sketches, or
    where a short text has no hash in the range both sketches cover, the larger
    containment over all that the shorter text's sketch covers."""
    s, t = kept(a), kept(b)
    found = likeness(s, t)
    if found is None:
        top = max(cover(s), cover(t))
        s, t = a[a <= top], b[b <= top]
        found = len(np.intersect1d(s, t, assume_unique=True)) / min(len(s), len(t))
    return found


def packed(s: np.ndarray) -> bytes:
    return s.astype(">u8").tobytes()


def as_text(s: np.ndarray) -> str:
    return packed(s).hex()


def with_sketch(docs: DataFrame, text_col: str = "text", out: str = "sketch") -> DataFrame:
    """``docs`` and its sketch as hexadecimal text, 16 digits a hash. NULL and
    empty texts have the empty sketch; whole texts are hashed. A column named
    ``out`` is replaced."""
    docs = docs.drop(out)
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches):
        for b in small(batches, at):
            got = [as_text(sketch(t or b"")) for t in b.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], names=[*names, out])

    return by_place(docs)[0].mapInArrow(run, docs.withColumn(out, F.lit("")).schema)


_FIELDS = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double")


def _compare(text: str, own: np.ndarray, next_text: str, next_own: np.ndarray) -> tuple:
    """``own`` and ``next_own`` are all hashes of the two texts."""
    k = len(text) // 3
    edited = (text[:len(text) - k] + next_text[:k]).encode()
    h = shingle_hashes(edited)
    return (len(text), hashlib.sha256(edited).digest(), packed(kept(own)), packed(kept(h)), pair_likeness(own, h), pair_likeness(own, next_own))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its sketch, that of its edited text (the last third of its code
    points replaced by as many first ones of the next row's text) and likenesses,
    a value from 0 to 1 for every row (``pair_likeness``).

    The next row is the one with the next smaller id; after the last comes the
    first again. NULL ids come last; rows that share an id follow each other by
    the hash of their texts; a single row is its own next. NULL texts are empty.
    Rows are range-partitioned by (id, hash) and walked in order, so a text is
    moved once. A partition's last row waits for the first row of the following
    partition; only those two rows of each partition are joined afterwards."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")) \
        .withColumn("h", F.xxhash64("text"))
    order = [F.col("id").desc_nulls_last(), F.col("h").asc()]
    id_type = rows.schema["id"].dataType
    schema = f"id {id_type.simpleString()}, {_FIELDS}, part int, first string, last string"

    def walk(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        before = opening = None
        kind = None
        for b in small(batches, 1):
            kind, out_ids, out = b.schema.field(0).type, [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = shingle_hashes(text.encode())
                if before is None:
                    opening = text
                else:
                    out_ids.append(before[0])
                    out.append(_compare(before[1], before[2], text, own))
                before = (i, text, own)
            yield _batch(out_ids, kind, out, part, None, None)
        if before is not None:
            yield _batch([before[0]], kind, [(None,) * 6], part, opening, before[1])

    t = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text").mapInArrow(walk, schema), "fingerprint")
    ends = t.where("first is not null").select("id", "part", "first", "last")
    parts = ends.select("part")              # one row a partition
    turn = Window.orderBy("part")
    follow = parts.select("part", F.coalesce(F.lead("part").over(turn), F.min("part").over(Window.partitionBy())).alias("then"))
    pairs = ends.select("id", "part", "last").join(follow, "part") \
        .join(ends.select(F.col("part").alias("then"), "first"), "then").select("id", "last", "first")

    def close(batches):
        for b in batches:
            out = [_compare(x, shingle_hashes(x.encode()), y, shingle_hashes(y.encode()))
                   for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield _batch(b.column(0).to_pylist(), b.schema.field(0).type, out, 0, None, None)

    fields = ["id", *[f.split()[0] for f in _FIELDS.split(", ")]]
    hexed = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return t.where("first is null").select(*fields).union(pairs.mapInArrow(close, schema).select(*fields)) \
        .withColumns(hexed).withColumnRenamed("id", id_col)


def _batch(ids, kind, rows, part, first, last):
    cols = list(zip(*rows)) if rows else [()] * 6
    types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), *(pa.array(list(c), t) for c, t in zip(cols, types)),
         pa.array([part] * n, pa.int32()), pa.array([first] * n, pa.string()), pa.array([last] * n, pa.string())],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "first", "last"])
