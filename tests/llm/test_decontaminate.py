import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gridcube.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [(m.group(), m.start(), m.end()) for m in WORD.finditer((text or "").translate(LOWER))]


def by_hand(docs, items, size):
    """Per document: words, hit words and items, by comparing every window with every place."""
    grams = {}
    for item, text in items:
        w = [x[0] for x in words(text)]
        for at in range(max(1, len(w) - size + 1) if w else 0):
            grams.setdefault(tuple(w[at:at + size]), set()).add(str(item))
    out = []
    for _, text in docs:
        w = [x[0] for x in words(text)]
        hit, found = set(), set()
        for at in range(len(w)):
            for n in {len(g) for g in grams}:
                if tuple(w[at:at + n]) in grams and at + n <= len(w):
                    hit |= set(range(at, at + n))
                    found |= grams[tuple(w[at:at + n])]
        out.append((len(w), hit, sorted(found)))
    return out


def _texts(seed, n):
    rnd = random.Random(seed)
    vocab = ["a", "B", "été", "9", "naïve", "the", "Ü", "日本", "x1", "İ"]
    joints = [" ", "  ", "\n", "-", ", ", "\x00", "'", "\x7f", "_"]
    return ["".join(rnd.choice(vocab) + rnd.choice(joints) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 120])
def test_against_every_window(spark, block):
    """The same with one automaton and with many small ones."""
    docs = list(enumerate(_texts(1, 40))) + [(None, None), (50, ""), (51, "--- ..."), (0, "a B été"), (0, "a B été")]
    items = list(enumerate(_texts(2, 6))) + [(6, "A b ÉTÉ"), (7, None), (8, " . "), (6, "9 the"), (9, "The, ü")]
    d = spark.createDataFrame([(*x, 3) for x in docs], "doc_id long, text string, n_hit int").withColumn("a.b", F.lit(1))
    found = D.contamination(d, spark.createDataFrame(items, "item_id long, text string"), size=3, block_bytes=block)
    assert found.columns == ["doc_id", "text", "a.b", "n_words", "n_hit", "spans", "items"]
    got = sorted([(r.text or "", str(r.doc_id), r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in found.collect()])
    want = []
    for (doc, text), (n, hit, ids) in zip(docs, by_hand(docs, items, 3)):
        spans, at = [], words(text)
        for j in sorted(hit):
            if spans and spans[-1][1] == j - 1:
                spans[-1] = (spans[-1][0], j, spans[-1][2], at[j][2])
            else:
                spans.append((j, j, at[j][1], at[j][2]))
        want.append((text or "", str(doc), n, len(hit), ids, spans))
    assert got == sorted(want)


def test_long_text_and_offsets(spark):
    passage = "One two three four five six seven eight nine TEN eleven"
    text = "é-word " * 60000 + passage + " tail" * 50000
    d = spark.createDataFrame([(1, text), (2, "one two three four five six seven eight nine")], "doc_id long, text string")
    r = {x.doc_id: x for x in D.contamination(d, spark.createDataFrame([("q1", passage)], "item_id string, text string")).collect()}
    assert r[1].n_hit == 11 and [text[s.start:s.end] for s in r[1].spans] == [passage] and r[1]["items"] == ["q1"]
    assert r[2].n_hit == 0 and r[2].spans == [] and r[2].n_words == 9


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in D.contamination(docs, items).collect()] == [(2, 0)]
    assert D.contamination(docs.limit(0), items).collect() == []


def test_query_digest(spark, tmpdir_path):
    from gridcube.llm import queries as Q
    text = " ".join(f"w{i}" for i in range(14))
    spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(10, text), (9, "w3 w4"), (100, "w0 w2")], "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in Q.op13_decontaminate(spark, tmpdir_path).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {1: (14, 14, 2, h("10,9"), True), 2: (0, 0, 0, h(""), False)}
