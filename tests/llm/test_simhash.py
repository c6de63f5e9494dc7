import random
import re

import numpy as np
import xxhash

from gridcube.llm import simhash as S


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=3):
    """rows: (id, fingerprint); smallest id of each linked group, by all pairs."""
    fps = sorted({f for _, f in rows})
    group = {f: f for f in fps}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return sorted(((i, f, least.get(root(f))) for i, f in rows), key=repr)


def test_fingerprint_equals_definition():
    rng = random.Random(3)
    words = ["Is", "the", "ÉCOLE", "a b", "x", "of", "idé", " q"]
    for n in (0, 1, 2, 3, 4, 50, 700):
        text = "".join(rng.choice(words) + rng.choice([" ", "\t\n", "\x0b", "  "]) for _ in range(n))
        assert S.fingerprint_bytes(text.encode()) == plain_fingerprint(text)
    assert S.fingerprint_bytes(None) == S.fingerprint_bytes(b" \n") == 0


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = S.fingerprint_bytes(text.encode())
    monkeypatch.setattr(S, "SHINGLES_AT_ONCE", 64)
    assert S.fingerprint_bytes(text.encode()) == whole


def test_bit_sliced_compare_equals_popcount():
    rng = np.random.default_rng(0)
    for radius in (0, 1, 2, 3, 5, 7):
        fps = rng.integers(0, 2 ** 63, 700, dtype=np.uint64)
        for k in range(1, 8):
            flips = np.uint64(0)
            for b in rng.choice(64, k, replace=False):
                flips |= np.uint64(1) << np.uint64(b)
            fps[k * 70:(k + 1) * 70] = fps[:70] ^ flips
        ends = np.sort(rng.integers(1, 701, 700))
        ends = np.maximum(ends, np.arange(1, 701))
        ends = np.array([100 * (i // 100 + 1) for i in range(700)]) if radius % 2 else np.full(700, 700)
        near = np.bitwise_count(fps[:, None] ^ fps[None]) <= radius
        same = ends[:, None] == ends[None]
        a, b = np.nonzero(near & same)
        assert (S.forest(fps, ends, radius) == S._merge(np.arange(700), a, b)).all()


def planted(rng):
    rows, n = [], 0
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.choice([1, 2, 8, 60, 200]))) for _ in range(60)]
    for text in base:
        rows.append((n, text))
        n += 1
        for _ in range(rng.choice([0, 0, 3])):
            words = text.split()
            words[rng.randrange(len(words))] = "edited"
            rows.append((n, " ".join(words)))
            n += 1
    return rows + [(n, None), (n + 1, ""), (None, base[0]), (None, "only null ids here at all"), (0, base[0])]


def test_components_equal_brute_force_with_split_buckets(spark, monkeypatch):
    rows = planted(random.Random(5))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fingerprint string, root string")
    want = brute_components([(i, plain_fingerprint(t)) for i, t in rows])
    got = [(r.doc_id, r.fingerprint % 2 ** 64, r.component_id) for r in S.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == want
    fps = S.with_fingerprint(docs, keep=["doc_id"]).select(S.F.col("fingerprint").alias("fp")).distinct()
    whole = S.connected_components(S.link_edges(fps, 3)).collect()
    split = S.connected_components(S.link_edges(fps, 3, max_bucket=2)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split))


def test_keep_one_keeps_one_row_of_each_group(spark):
    rows = planted(random.Random(6))
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component_id int")
    kept = S.keep_one(docs).collect()
    found = S.near_duplicates(docs).collect()
    assert len(kept) == len({r.root for r in found})
    assert {r.doc_id for r in kept if r.doc_id is not None} == {r.component_id for r in found if r.component_id is not None}
    assert S.keep_one(docs.limit(0)).count() == 0 and S.keep_one(docs).columns == docs.columns
