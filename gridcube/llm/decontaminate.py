"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the
normalised test items, run once over every whole text.

Texts and items are lower-cased (A-Z) and cut into words of ASCII letters, digits
and any character beyond ASCII; joined by single spaces, with one at either end,
a window can only match whole words. The walk is over bytes, so the places of the
hit words are carried back to code point offsets in the original text.

The items are the stated query set. Their windows are cut into blocks of at most
``BLOCK_BYTES`` (counted on the cluster); a block's automaton is broadcast, and
every block scans the texts once. One block is the usual case; with several, the
hits of a document are merged by its row number afterwards.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.session import materialize

BLOCK_BYTES = 2 << 20                            # of windows and item ids in one broadcast automaton
_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))
SPANS = "array<struct<first:int,last:int,start:int,end:int>>"
_SPAN = pa.list_(pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window binary, words, items array<string>): every run of ``size`` words
    of an item, or all words of a shorter one. Items without an id or a word have none."""
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("binary").alias("text")) \
        .where("item is not null and text is not null")

    def run(batches):
        for b in small(batches, 1):
            found = [[], [], []]
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                for at in range(max(1, len(words) - size + 1) if words else 0):
                    some = words[at:at + size]
                    for column, v in zip(found, (item, b" " + b" ".join(some) + b" ", len(some))):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.string()), pa.array(found[1], pa.binary()), pa.array(found[2], pa.int32())],
                                             names=["item", "window", "words"])

    return rows.mapInArrow(run, "item string, window binary, words int").groupBy("window").agg(
        F.max("words").alias("words"), F.sort_array(F.collect_set("item")).alias("items"))


def automaton(rows) -> ahocorasick.Automaton | None:
    """Of (window, words, items) rows; None where there are none."""
    found = ahocorasick.Automaton()
    for window, words, items in rows:
        found.add_word(bytes(window).decode("latin-1"), (words, items))
    if not len(found):
        return None
    found.make_automaton()
    return found


def _runs(spans) -> list[tuple]:
    """Spans by their words, those that overlap or touch as one."""
    out: list[tuple] = []
    for first, last, start, end in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2], max(out[-1][3], end))
        else:
            out.append((first, last, start, end))
    return out


def hits_of(text: bytes, found) -> tuple[int, list, list[str]]:
    """(words, spans of hit words, items) of a UTF-8 text."""
    plain = text.translate(TABLE)
    words = plain.split()
    matches = list(found.iter((b" " + b" ".join(words) + b" ").decode("latin-1"))) if found and words else []
    if not matches:
        return len(words), [], []
    after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)       # the space behind each word
    last = np.searchsorted(after, [end for end, _ in matches])
    hit = np.zeros(len(words) + 1, np.int64)
    np.add.at(hit, last + 1 - np.array([n for _, (n, _) in matches]), 1)
    np.add.at(hit, last + 1, -1)
    edge = np.diff(np.concatenate([[0], np.cumsum(hit)[:-1] > 0, [0]]).astype(np.int8))
    first, upto = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    raw = np.frombuffer(text, np.uint8)
    letter = np.diff(np.concatenate([[0], np.frombuffer(plain, np.uint8) != 0x20, [0]]).astype(np.int8))
    begin, end = np.flatnonzero(letter == 1), np.flatnonzero(letter == -1)          # of each word, in bytes
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])                 # code points before each byte
    spans = list(zip(first.tolist(), upto.tolist(), points[begin[first]].tolist(), points[end[upto]].tolist()))
    return len(words), spans, sorted({i for _, (_, items) in matches for i in items})


def _scan(rows: DataFrame, keep: list[str], found) -> DataFrame:
    """``keep``, n_words, spans and items of rows whose last column is the text in bytes."""
    n, rows = len(keep), rows.toDF(*[f"_{i}" for i in range(len(keep) + 1)])     # by place: names may hold anything

    def run(batches):
        for b in small(batches, n):
            got = [hits_of(t or b"", found.value) for t in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array([g[0] for g in got], pa.int64()),
                 pa.array([[dict(zip(("first", "last", "start", "end"), s)) for s in g[1]] for g in got], _SPAN),
                 pa.array([g[2] for g in got], pa.list_(pa.string()))], names=[*keep, "n_words", "spans", "items"])

    schema = rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], F.lit(0).cast("long").alias("n_words"),
                         F.lit(None).cast(SPANS).alias("spans"), F.array(F.lit("")).alias("items")).schema
    return rows.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, text_col: str = "text", keep: list[str] | None = None,
                  item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns (all by default) of every row of ``docs`` and n_words,
    n_hit (words inside any window of an item), spans (runs of hit words: first
    and last word, start and end code point in the original text, end exclusive)
    and items (ids as text, sorted, each once).

    NULL and empty texts have no words; NULL or empty items have no window, items
    without an id are left out and items that share an id count once; repeated
    rows are found alike; very long texts are scanned whole; no items or no
    documents give no hits or no rows. Columns of ``docs`` with an output's name are
    left out; the text may have any name."""
    added = ["n_words", "n_hit", "spans", "items"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    patterns = materialize(windows(items, size, item_id, item_text), "windows")
    weight = patterns.agg(F.sum(F.octet_length("window") + 8 + F.aggregate("items", F.lit(0), lambda a, i: a + F.octet_length(i) + 8))).first()[0] or 0
    blocks = max(1, -(-weight // block_bytes))
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))

    def of(k):                                   # at most about block_bytes reach the driver at a time
        return sc.broadcast(automaton(patterns.where(block == k).collect()))

    text = F.col(f"`{text_col}`").cast("binary").alias("__text")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.last - s.first + 1).alias("n_hit")
    results = ["n_words", n_hit, "spans", "items"]
    if blocks == 1:
        return _scan(docs.select(*[f"`{c}`" for c in keep], text), keep, of(0)).select(*[F.col(f"`{c}`") for c in keep], *results)

    rows = docs.select(*[f"`{c}`" for c in keep], text).toDF(*[f"_{i}" for i in range(len(keep))], "__text")     # by place, as in _scan
    rows = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "decontaminate")
    parts = [_scan(rows.select("__row", "__text"), ["__row"], of(k)) for k in range(blocks)]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p.where(F.size("spans") > 0))
    grouped = found.groupBy("__row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def joined(batches):
        for b in batches:
            spans = [[dict(zip(("first", "last", "start", "end"), s)) for s in _runs([tuple(x.values()) for x in some])]
                     for some in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, _SPAN), b.column(3)], names=b.schema.names)

    return rows.join(grouped.mapInArrow(joined, grouped.schema), "__row").select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *results)
