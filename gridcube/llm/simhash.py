"""SimHash near-duplicates with a bit-sliced comparison.

A document's fingerprint has bit b set if over half of its shingles' XXH64
values (seed 42) have it set. Two fingerprints link at ``radius`` or fewer
differing bits. The candidate search is exact: the 64 bits are cut into
``radius + 2`` slices, two fingerprints within the radius agree on at least
two slices, so every pair of slices is a table keyed by those slices' bits
(10 tables of about 25 bits for radius 3). Inside a bucket the fingerprints
are stored as vertical bit planes, 64 fingerprints to a machine word. The
distance of one fingerprint to 64 others is summed with carry-save counters,
two planes at a time, and a word is abandoned once all of its lanes have
exceeded the radius. A bucket yields the edges of a spanning forest only,
never its pairs; buckets above ``MAX_BUCKET`` are cut into chunks that meet
pairwise, so that no task holds an unbounded bucket.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.llm.components import connected_components
from gridcube.llm.names import by_place, named
from gridcube.session import materialize

MAX_BUCKET = 16384      # fingerprints compared together in one group; larger buckets meet chunk by chunk
PAIRS_AT_ONCE = 1 << 14  # (fingerprint, word of 64 fingerprints) comparisons held in memory
SHINGLES_AT_ONCE = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint_bytes(raw: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text as an unsigned 64-bit number. Only A-Z
    is lower-cased, words are runs of non-white-space ASCII-wise, a text with
    fewer words than a shingle is one shingle, and one without words is 0."""
    words = (raw or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, total, SHINGLES_AT_ONCE):
        to = min(total, at + SHINGLES_AT_ONCE)
        s, e = starts[at:to].tolist(), ends[at + width - 1:to + width - 1].tolist()
        h = np.fromiter(map(xxhash.xxh64_intdigest, [joined[i:j] for i, j in zip(s, e)], repeat(seed)),
                        np.uint64, to - at)
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fingerprint",
                     keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) and the fingerprint as a long. A
    column named ``out`` is replaced."""
    docs = docs.drop(out)
    keep = list(docs.columns if keep is None else keep)
    text = keep.index(text_col) if text_col in keep else len(keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if text < len(keep) else [F.col(f"`{text_col}`")]))

    def fp(batches):
        for b in small(batches, text):
            texts = b.column(text).cast(pa.binary()).to_pylist()
            got = np.fromiter((fingerprint_bytes(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(got, pa.int64())], names=[*keep, out])

    schema = rows.select(*[f"`{c}`" for c in keep]).withColumn(out, F.lit(0).cast("long")).schema
    return by_place(rows)[0].mapInArrow(fp, schema)


# --- bit-sliced comparison -------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words) planes: bit j of planes[b, w] is bit b of fps[64 * w + j]."""
    words = -(-len(fps) // 64)
    lanes = np.zeros(words * 64, np.uint64)
    lanes[:len(fps)] = fps
    bits = np.unpackbits(lanes.view(np.uint8), bitorder="little").reshape(words, 64, 64)
    packed = np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]


def _below(x: np.ndarray) -> np.ndarray:
    """Words whose lanes 0 .. x-1 are set (x clipped to 0 .. 64)."""
    x = np.clip(x, 0, 64).astype(np.uint64)
    return np.where(x == 64, _ALL, (np.uint64(1) << np.minimum(x, np.uint64(63))) - np.uint64(1))


def compare(planes: np.ndarray, fps: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray,
            radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Comparisons that found something: their numbers, and the words of lanes
    (among ``lanes``) that are within ``radius`` of the query fingerprint."""
    k = max(1, radius.bit_length())
    start = (1 << k) - 1 - radius            # counters start here, so they overflow just above the radius
    alive, mine = np.arange(len(query)), fps[query]
    count = [np.full(len(query), _ALL if start >> t & 1 else 0, np.uint64) for t in range(k)]
    over = ~lanes
    for b in range(0, 64, 2):
        x = planes[b, word] ^ (np.uint64(0) - (mine >> np.uint64(b) & np.uint64(1)))
        y = planes[b + 1, word] ^ (np.uint64(0) - (mine >> np.uint64(b + 1) & np.uint64(1)))
        s = x ^ y                            # full adder: counter bit 0 takes two planes, one carry goes up
        carry = (x & y) | (count[0] & s)
        count[0] = count[0] ^ s
        for t in range(1, k):
            count[t], carry = count[t] ^ carry, count[t] & carry
        over = over | carry
        if b % 8 == 6:
            on = over != _ALL
            if not on.all():                 # abandon the words whose lanes have all exceeded the radius
                alive, mine, word, over = alive[on], mine[on], word[on], over[on]
                count = [c[on] for c in count]
                if not len(alive):
                    break
    hit = over != _ALL
    return alive[hit], ~over[hit]


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        ra, rb = parent[a], parent[b]
        on = ra != rb
        if not on.any():
            return parent
        a, b = a[on], b[on]
        np.minimum.at(parent, np.maximum(ra, rb)[on], np.minimum(ra, rb)[on])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def forest(fps: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the first position of its linked group. ends[i]:
    where the bucket of fingerprint i ends; buckets are contiguous."""
    n = len(fps)
    parent, at = np.arange(n), np.arange(n)
    planes = bit_planes(fps)
    first = (at + 1) // 64
    words = np.where(ends > at + 1, (ends - 1) // 64 - first + 1, 0)
    upto = np.cumsum(words)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS_AT_ONCE, "right")))
        w = words[i:j]
        if w.any():
            query = np.repeat(at[i:j], w)
            word = np.arange(len(query)) - np.repeat(np.cumsum(w) - w, w) + first[query]
            lanes = _below(ends[query] - 64 * word) & ~_below(query + 1 - 64 * word)
            who, found = compare(planes, fps, query, word, lanes, radius)
            if len(who):
                row, lane = np.nonzero(np.unpackbits(found.view(np.uint8), bitorder="little").reshape(-1, 64))
                parent = _merge(parent, query[who[row]], 64 * word[who[row]] + lane)
        i = j
    return parent


def _forest_edges(radius: int):
    """Partition function over rows (g, fp) sorted by g: a bucket's rows are
    neighbours; the last bucket of a batch waits for the next batch."""
    def run(batches):
        def edges(g, fps):
            ends = np.searchsorted(g, g, "right")
            root = forest(fps, ends, radius)
            on = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays([pa.array(fps[on].view(np.int64)), pa.array(fps[root[on]].view(np.int64))],
                                              names=["a", "b"])

        held_g, held = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            g = np.concatenate([held_g, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(g):
                continue
            cut = int(np.searchsorted(g, g[-1], "left"))
            held_g, held = g[cut:], fps[cut:]
            if cut:
                yield edges(g[:cut], fps[:cut])
        if len(held_g) > 1:
            yield edges(held_g, held)
    return run


def _slice_keys(fp: Column, radius: int) -> list[Column]:
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    part = [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(cuts, cuts[1:])]
    return [F.struct(F.lit(t).alias("t"), F.shiftleft(part[i], cuts[j + 1] - cuts[j]).bitwiseOR(part[j]).alias("k"))
            for t, (i, j) in enumerate(combinations(range(radius + 2), 2))]


def link_edges(fps: DataFrame, radius: int, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``radius`` bits, from
    a DataFrame of distinct longs ``fp``. The full link graph has the same
    components; the edges are a spanning forest of each bucket."""
    keyed = fps.select("fp", F.explode(F.array(*_slice_keys(F.col("fp"), radius))).alias("s")).select("fp", "s.t", "s.k")
    big = materialize(keyed.groupBy("t", "k").count().where(F.col("count") > max_bucket)
                      .select("t", "k", F.ceil(F.col("count") / max_bucket).cast("int").alias("n")), "simhash-big")
    chunk = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    other = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda d: d != chunk)
    meets = F.when(F.col("n").isNull(), F.array(F.lit(0))) \
        .otherwise(F.transform(other, lambda d: F.least(chunk, d) * F.col("n") + F.greatest(chunk, d)))
    # a group id that mixes two buckets by a hash collision costs a few comparisons and no link
    grouped = keyed.join(big, ["t", "k"], "left").select("fp", F.explode(meets).alias("c"), "t", "k") \
        .select(F.xxhash64("t", "k", "c").alias("g"), "fp")
    return grouped.repartition("g").sortWithinPartitions("g").mapInArrow(_forest_edges(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 3) -> DataFrame:
    """(id, fingerprint long, component_id, root): one row per input row.

    root is the component's smallest fingerprint as a long; component_id is the smallest id reachable over links, itself included.
    NULL and empty texts have fingerprint 0 and link like any other. A NULL id
    keeps its row and counts only where a whole component has no other id (its
    component_id is then NULL); repeated rows are kept, each with the same
    result. Very long texts are hashed whole, in pieces. An empty table gives
    no rows. Other columns are not read."""
    t = materialize(with_fingerprint(docs, text_col, shingle, keep=[id_col]), "simhash")
    return _rooted(t, id_col, radius)


def _rooted(t: DataFrame, id_col: str, radius: int) -> DataFrame:
    """``near_duplicates`` of a written table of ids and fingerprints."""
    per_fp = t.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(f"`{id_col}`").alias("first_id"))
    root = connected_components(link_edges(per_fp.select("fp"), radius))
    rooted = per_fp.join(root, per_fp.fp == root.node, "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root") \
        .select(F.col("fp").alias("fingerprint"), "component_id", "root")
    return t.join(named, "fingerprint").select(F.col(f"`{id_col}`"), "fingerprint", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with
    the smallest id, which of several rows with that id is fixed by their
    texts' hash. A component whose ids are all NULL keeps one of those rows. The
    rows are written once with their fingerprints, so every text is hashed once.
    Other columns may have any name."""
    docs, at = by_place(docs)
    id_col, text_col = at[id_col], at[text_col]
    t = materialize(with_fingerprint(docs, text_col, shingle, out="__f"), "simhash-rows", codec="zstd")
    found = _rooted(t.select(id_col, F.col("__f").alias("fingerprint")), id_col, radius)
    name = F.col(id_col)
    key = F.coalesce(name.cast("string"), F.lit("null"))
    best = F.struct(name.isNull().alias("none"), name.alias("id"), F.col("fingerprint").alias("f"), key.alias("k"))
    keepers = found.groupBy("root").agg(F.min(best).alias("best")).select(F.col("best.k").alias("__k"), F.col("best.f").alias("__f"))
    rows = t.withColumn("__k", key)
    w = Window.partitionBy("__k", "__f").orderBy(F.xxhash64(text_col))
    return rows.join(keepers, ["__k", "__f"], "left_semi").withColumn("__n", F.row_number().over(w)) \
        .where("__n = 1").select(*named(at))
