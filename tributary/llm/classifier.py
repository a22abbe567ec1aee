"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text's features are indicators of its n-grams: runs of three bytes, words and pairs of words, and how many of its words
are distinct, by tenths (so that a text of repetitions shows). All are hashed into a fixed number of columns. Each
indicator is scaled by its log-count ratio between the classes, counted over all labelled training texts, and rows are scaled
to length one. A linear hinge-loss model is fitted by dual coordinate descent on a sample of labelled texts of at most about
``sample`` rows, chosen by a hash of the id (this bound is the one sampled step; ratios and scores use all rows). A
logistic curve over the margins of a part of the sample that was kept aside turns them into scores from 0 to 1.

A null text counts as empty; an empty text has no n-grams and gets the score of a margin of the bias alone. Equal texts score alike.
Of an id labelled twice, the greatest label counts; null labels and null ids don't. Without labelled rows of
both classes the score is the share of label 1 (one half without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Rolling, as_bytes, batch, distinct, mix, pieces, rows_of, windows, word_spans

COLUMNS = 1 << 17
SAMPLE = 12_000
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.3
_COUNTS = pa.schema([("feature", pa.int32()), ("positive", pa.int64()), ("negative", pa.int64())])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


class Model(NamedTuple):
    weights: np.ndarray  # of the columns, log-count ratios included
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float


def features(data: np.ndarray, at: np.ndarray, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of every row of a piece, ascending, and where each row's begin."""
    n_rows = len(at) - 1
    rolling = Rolling(data)
    starts, ends, first = word_spans(data, at)
    words = rolling.of(starts, ends)
    pairs, pair_first = windows(words, first, 2)
    begin = np.arange(max(0, len(data) - 2))
    row = np.repeat(np.arange(n_rows), np.diff(at))[: len(begin)]
    inside = begin + 3 <= at[1:][row]
    hashes = [mix(words ^ np.uint64(1)), mix(pairs ^ np.uint64(2)), mix(rolling.of(begin[inside], begin[inside] + 3) ^ np.uint64(3))]
    rows = [rows_of(first), rows_of(pair_first), row[inside]]
    n_words = np.diff(first)
    keyed = np.unique(mix(words + mix(rows[0].astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    n_distinct = np.bincount(rows[0][keyed], minlength=n_rows)
    some = np.flatnonzero(n_words)
    tenths = (10 * n_distinct[some] // n_words[some]).astype(np.uint64)
    hashes.append(mix(tenths ^ np.uint64(4 << 32)))
    rows.append(some)
    keys = distinct(np.concatenate(rows) * columns + (np.concatenate(hashes) % np.uint64(columns)).astype(np.int64))
    return keys % columns, np.searchsorted(keys, np.arange(n_rows + 1) * columns)


def log_ratios(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    p, q = positive + 1.0, negative + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, columns: int, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model, by dual coordinate descent (labels 1 and -1)."""
    weights, bias = np.zeros(columns), 0.0
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(0)
    square = [float(v @ v) + 1.0 for v in values]
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            gradient = labels[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            moved = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            if moved != alpha[i]:
                step = (moved - alpha[i]) * labels[i]
                weights[rows[i]] += step * values[i]
                bias += step
                alpha[i] = moved
    return weights, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of least loss, by Newton steps; labels 0 and 1."""
    n1 = labels.sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, text, label`` of the documents with a label of 0 or 1."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(marks.hint("merge"), "doc_id")


def fit(training: DataFrame, columns: int = COLUMNS, sample: int = SAMPLE, cost: float = COST) -> Model:
    """Model of ``doc_id, text, label``. What reaches the driver: a row per column, and the columns of the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, columns), np.int64)
        n = np.zeros(2, np.int64)
        for b in batches:
            own = b.column("label").to_numpy(zero_copy_only=False)
            for row, end, data, at in pieces(*as_bytes(b.column("text"))):
                found, first = features(data, at, columns)
                own_rows = own[row:end][rows_of(first)]
                for k in (0, 1):
                    total[k] += np.bincount(found[own_rows == k], minlength=columns)
            n += np.bincount(own, minlength=2)
        seen = np.flatnonzero(total.any(axis=0))
        yield batch(_COUNTS, np.concatenate(([-1], seen)).astype(np.int32), np.concatenate(([n[1]], total[1, seen])), np.concatenate(([n[0]], total[0, seen])))

    counts = training.select("text", "label").mapInArrow(count, "feature int, positive long, negative long").groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative")).toArrow()
    at = counts.column("feature").to_numpy()
    positive, negative = counts.column("positive").to_numpy(), counts.column("negative").to_numpy()
    seen, total = np.zeros((2, columns)), np.zeros(2)
    seen[0, at[at >= 0]], seen[1, at[at >= 0]] = positive[at >= 0], negative[at >= 0]
    total[:] = positive[at < 0].sum(), negative[at < 0].sum()
    ratios = log_ratios(seen[0], seen[1])
    if not total.all():
        share = total[0] / total.sum() if total.sum() else 0.5
        return Model(np.zeros(columns), ratios, 0.0, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))

    def columns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, end, data, at in pieces(*as_bytes(b.column("text"))):
                found, first = features(data, at, columns)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(row, end - row), b.column("label").slice(row, end - row), lists], names=["doc_id", "label", "found"])

    chosen = training.where(F.pmod(F.xxhash64("doc_id"), F.lit(int(total.sum()))) < sample)
    rows, labels = [], []
    for b in chosen.mapInArrow(columns_of, "doc_id long, label int, found array<int>").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().to_batches():
        first = b.column("found").offsets.to_numpy()
        found = b.column("found").values.to_numpy()
        rows += [found[a:z] for a, z in zip(first[:-1], first[1:], strict=True)]
        labels.append(b.column("label").to_numpy())
    labels = np.concatenate(labels) if labels else np.zeros(0, int)
    values = [_scaled(ratios[r]) for r in rows]
    aside = np.arange(len(rows)) % 4 == 3
    own = np.flatnonzero(~aside)
    weights, bias = descend([rows[i] for i in own], [values[i] for i in own], 2.0 * labels[own] - 1, columns, cost)
    margins = np.array([weights[r] @ v + bias for r, v in zip(rows, values, strict=True)])
    slope, offset = logistic(margins[aside], labels[aside]) if aside.any() else (1.0, 0.0)
    return Model(weights, ratios, bias, slope, offset)


def _scaled(values: np.ndarray) -> np.ndarray:
    return values / (np.sqrt(values @ values) or 1.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every document."""
    columns = len(model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        weighted, squared = m.weights * m.ratios, m.ratios * m.ratios
        for b in batches:
            for row, end, data, at in pieces(*as_bytes(b.column("text"))):
                found, first = features(data, at, columns)
                own = rows_of(first)
                sums = np.bincount(own, weights=weighted[found], minlength=end - row)
                norms = np.sqrt(np.bincount(own, weights=squared[found], minlength=end - row))
                margins = sums / np.where(norms > 0, norms, 1) + m.bias
                yield batch(_SCORES, b.column("doc_id").slice(row, end - row), 1 / (1 + np.exp(-np.clip(m.slope * margins + m.offset, -500, 500))))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scored, "doc_id long, score double")


