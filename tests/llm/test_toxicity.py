import os
import random

import numpy as np
from pyspark.sql import functions as F

from gridcube.llm import queries as Q
from gridcube.llm import toxicity as T

CALM = "the of and river stone walk green table letter under window morning after bread".split()
BAD = ["gnarfbag", "snotwurm", "blarghead"]


def corpus(n, rng, long=False):
    out = []
    for i in range(n):
        words = [rng.choice(CALM) + rng.choice(["", "s", "ing"]) for _ in range(rng.choice([5, 30, 400 if long else 80]))]
        y = int(rng.random() < 0.3)
        for _ in range(y * rng.choice([1, 2, 3])):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append((" ".join(words), y))
    return out


def test_held_out_accuracy_and_misspellings():
    rng = random.Random(1)
    seen, unseen = corpus(400, rng), corpus(300, rng, long=True)
    model = T.train([t for t, _ in seen], [y for _, y in seen])
    p = np.array([model.probability(t, {}) for t, _ in unseen])
    y = np.array([y for _, y in unseen])
    assert (p[y == 1] >= 0.7).mean() > 0.95 and (p[y == 0] < 0.7).mean() > 0.97
    clean = "the river and the green table under the window"
    assert model.probability(clean + " gnarfbagg", {}) > 0.5 > model.probability(clean, {})
    assert model.probability("the snootwurm walk", {}) > model.probability("the walk", {})


def test_same_seed_same_model():
    seen = corpus(60, random.Random(2))
    a, b = (T.train([t for t, _ in seen], [y for _, y in seen], epochs=5) for _ in range(2))
    assert (a.value == b.value).all() and a.bias == b.bias


def test_windows_read_the_whole_text():
    seen = corpus(300, random.Random(3))
    model = T.train([t for t, _ in seen], [y for _, y in seen])
    calm = " ".join(random.Random(4).choice(CALM) for _ in range(30_000))
    assert model.probability(calm, {}) < 0.7 <= model.probability(calm + " gnarfbag snotwurm", {})


def test_cache_is_bounded(monkeypatch):
    seen = corpus(50, random.Random(3))
    model = T.train([t for t, _ in seen], [y for _, y in seen], epochs=3)
    text = " ".join(f"w{i}" for i in range(500))
    whole = model.probability(text, {})
    monkeypatch.setattr(T, "CACHE_WORDS", 10)
    known = {}
    assert model.probability(text, known) == whole and len(known) <= 10


def test_edge_rows_and_missing_labels(spark):
    rng = random.Random(5)
    rows = [(i, t, y) for i, (t, y) in enumerate(corpus(120, rng))]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows] + [(None, None, None, None), (500, "", "x", 0.1), (500, "", "x", 0.1), (501, " \n", "x", 0.1)],
                                 "doc_id long, text string, toxicity string, y double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, 1), (None, 1), (2, None), (9999, 1)], "doc_id long, toxic int")
    model = T.fit(docs, labels, F.col("id") % 2 == 0, max_per_class=20)
    got = T.score(docs, model).collect()
    assert len(got) == 124 and all(0 <= r.toxicity <= 1 for r in got)
    assert len({round(r.toxicity, 12) for r in got if not (r.text or "").strip()}) == 1
    assert T.score(docs.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("toxic = 0")):
        flat = T.score(docs, T.fit(docs, none, F.lit(True)), keep=["doc_id"]).select("toxicity").distinct().collect()
        assert len(flat) == 1 and flat[0][0] < 0.7


def test_sample_is_bounded_and_honours_allowed(spark):
    docs = spark.range(100).selectExpr("id as doc_id", "concat('word', id) as text")
    labels = spark.range(100).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    rows = T.sample(docs, labels, F.col("id") < 40, max_per_class=7)
    assert len(rows) == 14 and all(int(t[4:]) < 40 and int(t[4:]) % 2 == y for t, y in rows)


def test_long_texts_are_learnt_from_whole(spark):
    words = [f"w{i:06d}" for i in range(30_000)]
    texts = {1: " ".join(words), 2: "short text", 3: "x" * 60_000, 4: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1)], "doc_id long, toxic int")
    assert sorted(T.sample(docs, labels, F.lit(True))) == sorted([(texts[1], 0), ("short text", 1), (texts[3], 0), ("", 1)])


def test_the_driver_neither_holds_the_texts_nor_trains(spark, monkeypatch):
    rows = corpus(60, random.Random(12))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    seen = T.sample(docs, labels, F.col("id") % 3 != 1)
    want = T.train([t for t, _ in seen], [y for _, y in seen])

    driver, train = os.getpid(), T.train

    def elsewhere(*a, **kw):
        assert os.getpid() != driver
        return train(*a, **kw)
    monkeypatch.setattr(T, "train", elsewhere)
    monkeypatch.setattr(T, "sample", None)
    got = T.fit(docs, labels, F.col("id") % 3 != 1)
    assert (got.value == want.value).all() and got.bias == want.bias


def test_texts_without_spaces_are_learnt_from():
    bad, good = ["那个坏词" + "x" * i for i in range(40)], ["一个好词" + "x" * i for i in range(40)]
    model = T.train(bad + good, [1] * 40 + [0] * 40)
    assert model.probability("那个坏词xx", {}) >= 0.7 > 0.3 > model.probability("一个好词xx", {})


def by_hand(model, text):
    """The worst window's probability, word by word."""
    words = T.words_of(text) or [None]
    if words == [None]:
        return 1 / (1 + np.exp(-model.bias))
    value = [float(np.mean([model.value[g] for g in T.word_grams(w)])) for w in words]
    windows, at = [], 0
    while True:
        windows.append(np.mean(value[at:at + T.WINDOW]))
        if at + T.WINDOW >= len(words):
            return 1 / (1 + np.exp(-(max(windows) + model.bias)))
        at += T.STEP


def test_scores_equal_a_plain_walk_over_the_windows(spark):
    rng = random.Random(9)
    seen = corpus(80, rng)
    model = T.train([t for t, _ in seen], [y for _, y in seen], epochs=8)
    rows = [(i, " ".join(rng.choice(CALM + BAD) for _ in range(n))) for i, n in enumerate([0, 1, 3, 4, 5, 7, 8, 9, 11, 12, 13, 16, 17, 200])] + [(99, None)]
    got = T.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    for r in got:
        assert abs(r.toxicity - by_hand(model, r.text)) < 1e-6


def test_a_phrase_over_a_border_is_in_one_window():
    model = T.Model(np.zeros(T.BUCKETS, np.float32), 0.0)
    for w in BAD:
        for g in T.word_grams(w):
            model.value[g] = 8.0
    calm = CALM[:1] * 30
    apart = [model.probability(" ".join(calm[:k] + BAD + calm[k:]), {}) for k in range(20)]
    assert min(apart) == max(apart) > 0.99              # wherever they stand


def test_the_kept_round_is_the_best_one_watched():
    seen = corpus(40, random.Random(11))
    texts, y = [t for t, _ in seen], [y for _, y in seen]
    one, two = (T.train(texts, y, epochs=e, warm=0) for e in (1, 2))
    assert one.bias == 0.0 and two.value.shape == one.value.shape
    watched = [i for i in range(40) if i % 5 == 4]

    def loss(m):
        p = np.clip([m.probability(texts[i], {}) for i in watched], 1e-12, 1 - 1e-12)
        t = np.array([y[i] for i in watched])
        w = np.where(np.array(y) == 1, 0.5 / sum(y), 0.5 / (40 - sum(y)))[watched]
        return float(-(w * np.where(t == 1, np.log(p), np.log(1 - p))).sum())
    assert loss(T.train(texts, y, epochs=20)) <= loss(one) + 1e-9      # the kept round is the best one watched


def test_query_on_the_given_tables(spark):
    got = Q.op2_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    pos, neg = held[held.toxic == 1].score.to_numpy(), held[held.toxic == 0].score.to_numpy()
    assert len(got) == got.doc_id.nunique() and (pos[:, None] > neg[None]).mean() > 0.94
    assert (pos >= 0.7).mean() > 0.8 and (neg >= 0.7).mean() < 0.03
