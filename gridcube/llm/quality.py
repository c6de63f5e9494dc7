"""Quality classifier: random Fourier features over document statistics,
ridge regression from partition-summed normal equations, isotonic calibration.

One scan turns every whole text into ``STATISTICS``. Labelled rows are joined
to that narrow table; the feature map cos(x W + b) with Gaussian W approximates
a Gaussian kernel. Each partition sums its part of Z'Z and Z'y, Spark adds the
parts cell by cell, and the driver solves one FEATURES x FEATURES system,
whose size does not depend on the data. The ridge scores of the labelled rows
are counted in BINS equal bins; pooling adjacent violators over those bins
gives a monotone map from ridge score to probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.session import materialize

STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "lower", "digit", "stop", "bang", "bar", "symbol",
              "space", "line", "wide", "type_share", "line_share", "longest_word", "capitals")
FEATURES, WIDTH, RIDGE, SEED = 256, 4.0, 1e-3, 11
BINS, LOW, HIGH = 1024, -0.5, 1.5

# byte classes of the ratios, in the order of STATISTICS[3:13]
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:", b"!?", b"|",
            b"#$%&*@^~<>{}[]()\\/=+_`\"'", b" \t\r", b"\n", bytes(range(128, 256)))


def statistics(raw: bytes | None) -> list[float]:
    """The statistics of one UTF-8 text; all 0 for a NULL or empty one."""
    if not raw:
        return [0.0] * len(STATISTICS)
    n = len(raw)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    sizes = [len(w) for w in words] or [0]
    return [np.log1p(n), np.log1p(len(words)), sum(sizes) / len(sizes),
            *(float(count[np.frombuffer(c, np.uint8)].sum()) / n for c in _CLASSES),
            len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines), np.log1p(max(sizes)),
            sum(map(bytes.isupper, words)) / max(1, len(words))]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats array<double>) for every row, in one scan."""
    def run(batches):
        for b in small(batches, 1):
            rows = [statistics(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["id", "stats"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, rows.select("id").withColumn("stats", F.array(F.lit(0.0))).schema)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.normal(0, 1 / WIDTH, (len(STATISTICS), FEATURES))
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.sqrt(2 / FEATURES) * np.cos(x @ w + b), np.ones((len(x), 1))], 1)

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, LOW, HIGH)

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; inside a flat step of the isotonic fit a
        thousandth of the ridge score keeps the order of the documents."""
        r = self.ridge(x)
        return np.clip(0.999 * np.interp(r, self.knots, self.levels) + 0.001 * (r - LOW) / (HIGH - LOW), 0, 1)


def _stacked(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _scored(rows: DataFrame, fn, out: str) -> DataFrame:
    """``rows`` with ``stats`` replaced by fn(statistics) as ``out``."""
    keep = [c for c in rows.columns if c != "stats"]
    at = rows.columns.index("stats")
    others = [i for i in range(len(rows.columns)) if i != at]

    def run(batches):
        for b in batches:
            got = fn(_stacked(b.column(at))) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in others), pa.array(got, pa.float64())], names=[*keep, out])

    return rows.mapInArrow(run, rows.select(*keep).withColumn(out, F.lit(0.0)).schema)


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing fit of least weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def fit(stats: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Fit on all rows of ``stats`` (id, stats) with a label where ``allowed``
    (an expression over ``id``) holds. An id labelled twice takes the larger
    label; NULL ids and labels are not learnt from. Without labelled rows, or
    with one label only, every document scores that label's share."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0.0, 1.0)).groupBy("id").agg(F.max("y").alias("y"))
    rows = materialize(stats.where(allowed).join(known, "id").select("y", "stats"), "quality")
    k = len(STATISTICS)
    sums = rows.agg(F.count("*"), F.sum("y"), *[F.sum(F.col("stats")[i]) for i in range(k)],
                    *[F.stddev_pop(F.col("stats")[i]) for i in range(k)]).first()
    n, pos = sums[0], sums[1] or 0
    if not 0 < pos < n:
        share = (pos + 0.5) / (n + 1)
        return Model(np.zeros(k), np.ones(k), np.zeros(FEATURES + 1), np.array([LOW, HIGH]), np.array([share, share]))
    scale = np.array(sums[2 + k:])
    model = Model(np.array(sums[2:2 + k]) / n, np.where(scale > 1e-9, scale, 1.0), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))
    m = FEATURES + 1
    upper = np.triu_indices(m)

    def normal(batches):
        a, b, some = np.zeros((m, m)), np.zeros(m), False
        for batch in batches:
            if batch.num_rows:
                z, y = model.features(_stacked(batch.column(1))), batch.column(0).to_numpy(zero_copy_only=False)
                a, b, some = a + z.T @ z, b + z.T @ y, True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]) + m), pa.int32()),
                                              pa.array(np.concatenate([a[upper], b]))], names=["cell", "v"])

    cells = np.zeros(len(upper[0]) + m)
    for r in rows.mapInArrow(normal, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():
        cells[r.cell] = r.v                     # FEATURES * FEATURES / 2 numbers, whatever the input
    a = np.zeros((m, m))
    a[upper] = cells[:len(upper[0])]
    a = a + a.T - np.diag(np.diag(a)) + RIDGE * n * np.diag([1.0] * FEATURES + [1e-9]) / FEATURES
    model.weights = np.linalg.solve(a, cells[len(upper[0]):])

    width = (HIGH - LOW) / BINS
    counted = _scored(rows, model.ridge, "r") \
        .groupBy(F.least(F.floor((F.col("r") - LOW) / width), F.lit(BINS - 1)).alias("bin")) \
        .agg(F.count("*").alias("n"), F.avg("y").alias("y"), F.avg("r").alias("r")).orderBy("bin").collect()
    level = pool_adjacent(np.array([c.y for c in counted]), np.array([float(c.n) for c in counted]))
    model.knots, model.levels = np.array([c.r for c in counted]), level
    return model


def score(stats: DataFrame, model: Model, out: str = "quality") -> DataFrame:
    """(id, out) with the probability of the good label, 0 to 1. NULL and empty
    texts are scored from their all-zero statistics, repeated rows alike."""
    return _scored(stats, model.probability, out)
