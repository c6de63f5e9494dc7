import hashlib
import random

import numpy as np
import pytest
import xxhash

from gridcube.llm import fingerprint as G


def texts(rng, n, words):
    return [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice(words))) for _ in range(n)]


def hashes_by_hand(text):
    """Shingle hashes with Python's own whole numbers, word by word."""
    words, top = text.encode().split(), 1 << 64
    out = set()
    for at in range(max(1, len(words) - 4) if words else 0):
        h = 0
        for i, w in enumerate(words[at:at + 5]):
            h = (h + xxhash.xxh64_intdigest(w) * pow(0x9E3779B97F4A7C15, i + 1, top)) % top
            h ^= h >> 29
        h = h * 0xBF58476D1CE4E5B9 % top
        out.add(h ^ (h >> 32))
    return out


def sketch_by_hand(h):
    """All hashes below a sixteenth of the range, or the 16 smallest if those are
    fewer, and the value up to which that is all there is."""
    low = {x for x in h if x < 2 ** 60}
    own = low if len(low) >= 16 else set(sorted(h)[:16])
    return own, 2 ** 64 if len(own) < 16 else max(2 ** 60, max(own))


def likeness_by_hand(a, b):
    a, b = hashes_by_hand(a), hashes_by_hand(b)
    if not a or not b:
        return float(a == b)
    (_, x), (_, y) = sketch_by_hand(a), sketch_by_hand(b)
    for top in (min(x, y), max(x, y)):
        s, t = {h for h in a if h <= top}, {h for h in b if h <= top}
        if s and t:
            return max(len(s & t) / len(s), len(s & t) / len(t))


def brute(rows):
    """rows: (id, text) in order; every next text is the following row's."""
    out = []
    shown = lambda t: "".join(f"{h:016x}" for h in sorted(sketch_by_hand(hashes_by_hand(t))[0]))
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), shown(text), shown(edited),
                    likeness_by_hand(text, edited), likeness_by_hand(text, after)))
    return sorted(out, key=repr)


def test_walk_equals_brute_force_for_any_partitioning(spark):
    rng = random.Random(4)
    rows = [(i * 3, t) for i, t in enumerate(texts(rng, 157, [0, 1, 4, 30, 300]))] + [(10 ** 6, "é😀" * 50)]
    want = brute(sorted(rows, reverse=True))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted((tuple(r) for r in G.compare_with_next(docs).collect()), key=repr) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_nulls_ties_single_and_none(spark):
    docs = spark.createDataFrame([(None, "a b c d e f g"), (None, None), (2, ""), (2, "x y z x y z"), (2, "x y z x y z"), (7, "longer text here now")], "doc_id long, text string")
    got = G.compare_with_next(docs).collect()
    assert len(got) == 6 and sorted(r.n_chars for r in got) == [0, 0, 11, 11, 13, 20]
    one = G.compare_with_next(docs.where("doc_id = 7")).collect()[0]
    assert one.near_next == 1 and one.n_chars == 20
    assert G.compare_with_next(docs.limit(0)).count() == 0


def test_estimates_follow_true_containment():
    rng = random.Random(8)
    for words in (6000, 1500):
        text = texts(rng, 1, [words])[0].split()
        part = text[: words // 5]
        a, b = (G.sketch(" ".join(t).encode()) for t in (part, text))
        assert G.containment(a, b) == 1 and G.containment(b, a) == pytest.approx(0.2, abs=0.09)
        mixed = text[: words // 2] + texts(rng, 1, [words // 2])[0].split()
        assert G.containment(G.sketch(" ".join(mixed).encode()), b) == pytest.approx(0.5, abs=0.13)


def exact(a, b):
    a, b = (set(G.shingle_hashes(t.encode()).tolist()) for t in (a, b))
    return len(a & b) / len(a)


def test_short_in_long_is_right_or_undefined():
    assert G.SCALE <= 16
    rng = random.Random(12)
    for shingles in (10, 30, 50, 80):
        unknown, halves = 0, []
        for _ in range(60):
            words = texts(rng, 1, [rng.choice([2000, 5000])])[0].split()
            at = rng.randrange(len(words) - 100)
            long, short = " ".join(words), " ".join(words[at:at + shingles + 4])
            half = " ".join(words[at:at + shingles // 2 + 4]) + " " + texts(rng, 1, [shingles // 2])[0]
            a, h, b = (G.sketch(t.encode()) for t in (short, half, long))
            assert exact(short, long) == 1
            got = G.containment(a, b)
            unknown += got is None
            assert got in (1, None) and G.likeness(a, b) == got and G.likeness(b, a) == got
            assert G.containment(b, a) == pytest.approx(exact(long, short), abs=0.05)
            if (got := G.containment(h, b)) is not None:
                halves.append(got - exact(half, long))
        assert abs(unknown / 60 - (15 / 16) ** shingles) < 0.2      # at 1/24: 0.65 for 10 shingles
        assert abs(sum(halves) / len(halves)) < 0.2


def test_short_in_long_always_has_a_value(spark):
    rng = random.Random(3)
    rows, share = [], {}
    for i in range(0, 160, 2):
        n = (10, 20, 40, 80)[i // 2 % 4]
        words = texts(rng, 1, [3000])[0].split()
        own = rng.choice([0, n // 2, n])                                    # shingles that the long one has
        short = words[50:54 + own] + (texts(rng, 1, [n - own])[0].split() if own < n else [])
        rows += [(i + 1, " ".join(short)), (i, " ".join(words))]            # a short one is followed by the long one
        share[i + 1] = exact(rows[-2][1], rows[-1][1])
    got = {r.doc_id: r.near_next for r in G.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(v is not None and 0 <= v <= 1 for v in got.values())
    off = [got[i] - v for i, v in share.items()]
    assert all(got[i] == v for i, v in share.items() if v in (0, 1)) and abs(np.mean(off)) < 0.05 and np.mean(np.abs(off)) < 0.1
    assert all(got[i + 1] == likeness_by_hand(dict(rows)[i + 1], dict(rows)[i]) for i in range(0, 160, 2))


def test_no_likeness_is_missing_on_the_table(spark):
    from gridcube.llm import queries as Q
    got = Q.op7_fingerprint(spark, "/root/testdata/sf0.01").where("near_edited is null or near_next is null or not near_next between 0 and 1")
    assert got.count() == 0


def test_merge_is_the_sketch_of_the_union():
    rng = random.Random(5)
    for n in (1, 6, 20, 40, 900):
        a, b = texts(rng, 2, [n])
        union = np.union1d(G.shingle_hashes(a.encode()), G.shingle_hashes(b.encode()))
        whole = union[:max(int(np.searchsorted(union, G.FRACTION)), min(G.FLOOR, len(union)))]
        merged = G.merge(G.sketch(a.encode()), G.sketch(b.encode()))
        assert set(merged) <= set(whole) and (len(merged) == len(whole) or len(whole) <= 2 * G.FLOOR)


def test_with_sketch_column(spark):
    docs = spark.createDataFrame([(1, "a b c", "z"), (2, "a b c", "z"), (3, None, "z")], "doc_id long, text string, sketch string")
    got = {r.doc_id: r.sketch for r in G.with_sketch(docs).collect()}
    assert got[1] == got[2] and len(got[1]) == 16 and got[3] == ""
