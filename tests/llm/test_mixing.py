import random
import re

import pytest
from pyspark.sql import functions as F

from gridcube.llm import mixing as M


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, budget = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        rest = budget - sum(full.values())
        over = [s for s in free if rest * w[s] / sum(w[x] for x in free) > cap * sizes[s] + 1e-9]
        if not over:
            return full | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        full |= {s: cap * sizes[s] for s in over}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for i in range(900):
        source = rng.choice(["a", "b", "é", None, "hot", "hot", "hot"])
        words = 3000 if i == 7 else rng.choice([0, 1, 3, 10, 10, 40])
        out.append((i, source, " \t".join("w" for _ in range(words)) if words else rng.choice(["", None, " \n"])))
    return out + [(None, "a", "x y")] * 3 + [(5, "b", "same row")] * 4


def test_targets_copies_and_reruns(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, copies int")
    got = M.copies(docs).collect()
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    goal = plain_targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert mine[0].target == pytest.approx(goal[s])
        taken = sum(r.size * r.copies for r in mine)
        largest = max((r.size for r in mine), default=0)
        assert abs(taken - goal[s]) <= 2 * largest + 1
        assert all(0 <= r.copies <= 2 for r in mine)
    assert sorted(map(repr, got)) == sorted(map(repr, M.copies(docs.repartition(5)).collect()))


def test_mix_repeats_rows_as_planned(spark, rows):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, size int")
    plan = M.copies(docs).agg(F.sum("copies")).first()[0]
    mixed = M.mix(docs)
    assert mixed.count() == plan and mixed.columns == docs.columns
    count = lambda df, n: {(r.source, r.size or 0): r.n for r in df.groupBy("source", "size").agg(n.alias("n")).collect() if r.n}
    words = mixed.withColumn("size", M.words(F.col("text")))
    assert count(words, F.count("*")) == count(M.copies(docs), F.sum("copies"))


@pytest.mark.parametrize("same", [True, False])
def test_repeated_rows_come_near_their_share(spark, monkeypatch, same):
    """Most rows have no id, one size, and perhaps one text: they are taken one by
    one, not all or none, and equal ones differ by one copy at most."""
    monkeypatch.setattr(M, "RUN", 16)
    rows = [(None, "a", "w w w" if same else f"w w {i}") for i in range(400)] + [(i, "b", "x y") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    got = [r for r in M.copies(docs).collect() if r.source == "a"]
    assert len(got) == 400 and abs(sum(r.copies for r in got) * 3 - got[0].target) <= 6
    assert max(r.copies for r in got) - min(r.copies for r in got) <= 1
    mixed = M.mix(docs).where("source = 'a'")
    assert mixed.count() == sum(r.copies for r in got)
    assert max(r["count"] for r in mixed.groupBy("text").count().collect()) <= (800 if same else 2)


def test_very_long_text_is_counted_whole(spark):
    docs = spark.createDataFrame([(1, "a", "w " * 300_000), (2, "a", "w w")], "doc_id long, source string, text string")
    assert {r.id: r.size for r in M.copies(docs).collect()} == {1: 300_000, 2: 2}


def test_no_rows_and_sources_without_words(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, "b", "x y z")], "doc_id long, source string, text string")
    got = {r.id: r for r in M.copies(docs).collect()}
    assert got[1].copies == got[2].copies == 0 and got[3].target == pytest.approx(4.5)
    assert M.copies(docs.limit(0)).count() == 0 and M.mix(docs.limit(0)).count() == 0


def test_plan_has_no_python(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert "Python" not in M.mix(docs)._jdf.queryExecution().toString().replace("PythonRDD", "")
