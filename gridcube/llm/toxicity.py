"""Toxicity: subword-bag embeddings under a linear softmax, trained jointly.

A word is the bag of its character n-grams (with word ends marked) and itself;
every n-gram hashes into one row of an embedding table. The n-gram vectors of
a word are averaged, the words of a window of ``WINDOW`` words are averaged,
and a linear softmax gives the window's probability. Windows overlap by half, so
a phrase of a few words lies whole in one. A document's score is that of its most
toxic window, so a few words are not averaged away in a long text, and the whole
text counts. Table and softmax are trained together in numpy by gradient descent
on whole texts of a bounded, documented number of labelled rows, in a task. An
unseen misspelling shares n-grams, and so vectors, with words that were seen.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.llm.names import by_place

BUCKETS, DIM, WINDOW, GRAMS = 1 << 17, 8, 2, (3, 4, 5)
STEP = WINDOW // 2          # words from one window to the next
MAX_PER_CLASS = 1000        # bound of the training sample: rows of each label
MIN_TEXTS = 4               # an n-gram of fewer training texts keeps a zero vector
CACHE_WORDS = 200_000       # words whose value a task remembers at a time
EDGES = ".,;:!?\"'()[]{}<>*#$%&|"


def word_grams(word: str) -> list[int]:
    """Rows of the embedding table for a word and its character n-grams."""
    marked = f"<{word}>"
    if marked.isascii():
        raw = marked.encode()        # characters are bytes: the same hashes, with less work
        return [crc32(raw) % BUCKETS, *[crc32(raw[i:i + n]) % BUCKETS for n in GRAMS for i in range(len(raw) - n + 1)]]
    return [crc32(marked.encode()) % BUCKETS,
            *[crc32(marked[i:i + n].encode()) % BUCKETS for n in GRAMS for i in range(len(marked) - n + 1)]]


def words_of(text: str | None) -> list[str]:
    return [w.strip(EDGES) for w in (text or "").lower().split()]


@dataclass
class Model:
    value: np.ndarray        # per n-gram row: its vector times (toxic minus clean) softmax weights
    bias: float
    numbers: list | None = None    # value as Python floats, made where the model is used

    def word(self, w: str) -> float:
        if self.numbers is None:
            self.numbers = self.value.tolist()
        rows = word_grams(w)
        return sum(map(self.numbers.__getitem__, rows)) / len(rows)

    def probability(self, text: str | None, known: dict) -> float:
        words = words_of(text)
        if not words:
            return 1 / (1 + np.exp(-self.bias))
        got = np.empty(len(words))
        for i, w in enumerate(words):
            v = known.get(w)
            if v is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                v = known[w] = self.word(w)
            got[i] = v
        starts = np.arange(max(1, -(-len(words) // STEP) - 1)) * STEP
        ends = np.minimum(starts + WINDOW, len(words))
        upto = np.concatenate([[0.0], np.cumsum(got)])
        return float(1 / (1 + np.exp(-((upto[ends] - upto[starts]) / (ends - starts) + self.bias).max())))


def train(texts: list[str], toxic: list[int], epochs: int = 120, warm: int = 15, patience: int = 40, rate: float = 20.0, seed: int = 7) -> Model:
    """Full-batch gradient descent with momentum. In the first ``warm`` rounds
    every window of a toxic text counts as toxic, then only its worst one; of a
    clean text the worst window always counts, beside all others together. Every
    fifth text is not learnt from; the round that suits those best is kept, and
    ``patience`` rounds without a better one end the training."""
    y = np.array(toxic)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    index: dict[str, int] = {}
    tokens, sizes, doc_units = array("i"), array("i"), array("i")
    for t in texts:
        ids = [index.setdefault(w, len(index)) for w in words_of(t)] or [index.setdefault("", len(index))]
        tokens.extend(ids)
        k = -(-len(ids) // STEP)
        sizes.extend([STEP] * (k - 1) + [len(ids) - STEP * (k - 1)])
        doc_units.append(k)
    # steps of words; a window is one and the next, or the only one of a short text
    tok, step, units = np.array(tokens), np.array(sizes), np.array(doc_units)
    per_doc = np.maximum(units - 1, 1)
    unit_at, step_at, doc_at = np.cumsum(units) - units, np.cumsum(step) - step, np.cumsum(per_doc) - per_doc
    doc_of = np.repeat(np.arange(len(y)), per_doc)
    one = np.arange(len(doc_of)) - doc_at[doc_of] + unit_at[doc_of]
    pair = (units > 1)[doc_of]
    two = one + pair
    size = step[one] + np.where(pair, step[two], 0)
    flat, n_grams = array("i"), np.empty(len(index), np.int64)
    for i, w in enumerate(index):
        grams = word_grams(w)
        flat.extend(grams)
        n_grams[i] = len(grams)
    rows = np.array(flat)
    n_words, word_at, word_of = len(index), np.cumsum(n_grams) - n_grams, np.repeat(np.arange(len(index), dtype=np.int32), n_grams)
    tok_step = np.repeat(np.arange(len(step), dtype=np.int32), step)
    watch = np.arange(len(y)) % 5 == 4           # not learnt from: the round that suits them best is kept
    if len(np.unique(y[~watch])) < 2:
        watch[:] = False
    seen = np.zeros((2, BUCKETS))                # texts learnt from, of each label, with an n-gram
    for i, t in enumerate(np.split(tok, np.cumsum(np.add.reduceat(step, unit_at))[:-1])):
        if not watch[i]:
            seen[y[i], np.unique(np.concatenate([rows[word_at[w]:word_at[w] + n_grams[w]] for w in np.unique(t)]))] += 1
    shared = seen.sum(0) >= MIN_TEXTS            # rarer n-grams keep a zero vector
    n = np.bincount(y[~watch], minlength=2)
    rate_of, unsure = seen / n[:, None], 5 / n.min()
    lead = np.log((rate_of[1] + unsure) / (rate_of[0] + unsure)) * shared

    # every vector starts on the softmax axis by its n-gram's smoothed log-odds, plus noise
    rng = np.random.default_rng(seed)
    soft = rng.normal(0, 0.5, (DIM, 2))
    toward = soft[:, 1] - soft[:, 0]
    emb = rng.normal(0, 0.02, (BUCKETS, DIM)) * shared[:, None] + WINDOW * lead[:, None] * toward / (toward @ toward)
    bias = np.zeros(2)
    speed = [np.zeros_like(emb), np.zeros_like(soft), np.zeros_like(bias)]
    weight_of = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())     # both labels weigh the same
    learn = np.where(watch, 0.0, weight_of)
    best = (np.inf, None, None)
    for epoch in range(epochs):
        # averages are linear, so each n-gram vector is projected on the softmax first and averaged after
        toward = soft[:, 1] - soft[:, 0]
        words = np.add.reduceat((emb @ toward)[rows], word_at) / n_grams
        steps = np.add.reduceat(words[tok], step_at)
        margin = (steps[one] + np.where(pair, steps[two], 0)) / size + bias[1] - bias[0]
        p = 1 / (1 + np.exp(-margin))
        worst = np.lexsort((margin, doc_of))[np.cumsum(per_doc) - 1]
        loss = float((weight_of * np.logaddexp(0, np.where(y == 1, -margin[worst], margin[worst])))[watch if watch.any() else slice(None)].sum())
        if loss < best[0] or best[1] is None:
            best, since = (loss, (emb @ toward).astype(np.float32), float(bias[1] - bias[0])), epoch
        if epoch > warm and epoch - since > patience:
            break
        weight = np.where((y[doc_of] == 0) | (epoch < warm), 0.5 * (learn / per_doc)[doc_of], 0)
        weight[worst] += learn * np.where((y == 1) & (epoch < warm), 0.5, 1)
        g = weight * (p - y[doc_of])
        gs = np.bincount(one, g / size, len(step)) + np.bincount(two[pair], (g / size)[pair], len(step))
        gw = np.bincount(tok, gs[tok_step], n_words) / n_grams
        c = np.bincount(rows, gw[word_of], BUCKETS) * shared
        pull = emb.T @ c
        for x, s, d, r in ((emb, speed[0], c[:, None] * toward + 1e-5 * emb, rate),
                           (soft, speed[1], np.stack([-pull, pull], 1), 0.5),
                           (bias, speed[2], np.array([-g.sum(), g.sum()]), 0.5)):
            s *= 0.9
            s -= r * d
            x += s
    return Model(best[1], best[2])


def chosen(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic", max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """id, y and text of at most ``max_per_class`` labelled texts of each label,
    whole, the first in a fixed pseudo-random order of their ids, from rows where
    ``allowed`` (an expression over ``id``) holds. An id labelled twice takes the
    larger label; ids or labels that are NULL are not learnt from; of rows that
    repeat an id one is taken; empty and NULL texts count as texts without words.
    No labelled rows give an empty sample. Other columns are not read."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")) \
        .where(allowed)
    ids = texts.select("id").distinct().join(known, "id")
    pick = None
    for y in (0, 1):
        part = ids.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_per_class)
        pick = part if pick is None else pick.union(part)
    # the sample holds at most 2 * max_per_class ids, so it is broadcast
    text = F.coalesce("text", F.lit("")).alias("text")
    return texts.join(F.broadcast(pick), "id").select("id", "y", text).groupBy("id", "y").agg(F.min("text").alias("text"))


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, **kw) -> list:
    """The rows of ``chosen`` as (text, label), in the order in which ``fit``
    learns from them. For tests and small tables: they come to the driver."""
    rows = chosen(docs, labels, allowed, **kw).orderBy(F.xxhash64("id"), "id").collect()
    return [(r.text, r.y) for r in rows]


def learn(batches):
    """One row, the model of all rows (y, text) of the batches."""
    texts, toxic = [], []
    for b in batches:
        toxic += b.column(0).to_pylist()
        texts += b.column(1).to_pylist()
    model = train(texts, toxic)
    yield pa.RecordBatch.from_arrays([pa.array([model.value.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], names=["value", "bias"])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, **kw) -> Model:
    """A model of ``chosen``'s rows. It is trained in a task, as the sample is
    bounded; the driver gets the model's numbers only, never a text. Without
    labelled rows, or with one label only, every text scores that label's
    smoothed share."""
    rows = chosen(docs, labels, allowed, **kw).repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("y", "text")
    got = rows.mapInArrow(learn, "value binary, bias double").collect()
    # a plan that is known to be empty has no task
    return Model(np.frombuffer(got[0].value, np.float32), got[0].bias) if got else train([], [])


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, out: str = "toxicity") -> DataFrame:
    """The ``keep`` columns (all by default) and ``out``: the probability of
    the toxic label, 0 to 1, in one scan without a shuffle. NULL, empty and
    white-space texts get the softmax's answer without words; repeated rows
    score alike; an empty table gives no rows; a column of ``docs`` with the
    name of ``out`` is replaced."""
    docs = docs.drop(out)
    keep = list(docs.columns if keep is None else keep)
    inside = text_col in keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *([] if inside else [F.col(f"`{text_col}`")]))
    at = keep.index(text_col) if inside else len(keep)

    def run(batches):
        known: dict[str, float] = {}
        for b in small(batches, at):
            got = [model.probability(t, known) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(got, pa.float64())], names=[*keep, out])

    return by_place(rows)[0].mapInArrow(run, rows.select(*[f"`{c}`" for c in keep]).withColumn(out, F.lit(0.0)).schema)
