"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

A text is the set of its n-grams, hashed to ``DIMENSIONS`` places: words and pairs of words, and runs of one to
four word shapes (which kinds of characters a word has, about how long it is, whether it repeats the
one before). Each indicator is scaled by the log ratio of its smoothed counts in both classes, every
text is brought to unit length, and a linear hinge-loss model is fitted by dual coordinate descent. A
logistic curve, fitted on labelled rows that the model has not seen, turns margins into scores.

The model is fitted on at most ``MAX_ROWS`` labelled documents, picked by a seeded order (that bound is what
reaches the driver); every document is scored. Inputs are texts only.

Cases: NULL and empty texts have no n-grams and get the score of the bias alone; documents without label are
scored only; several labels of one document: the lowest counts; no labelled rows: every score is 0.5; rows
repeat as they come; an empty table gives no rows. Extra columns do not enter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import seeded
from callpay.llm.textcodes import NOT_BLANK, batches_of, grams, mix, word_codes, word_masks

DIMENSIONS = 1 << 18
MAX_ROWS = 6_000
CUT = 0.7


def _features(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text of a slice, and the offsets of the texts in them."""
    codes, offsets = word_codes(part.column("text"), NOT_BLANK)
    masks, lengths = word_masks(part.column("text"), NOT_BLANK)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    again = np.zeros(len(codes), np.uint64)
    again[1:] = (codes[1:] == codes[:-1]) & (text[1:] == text[:-1])
    size = np.digitize(lengths, (2, 4, 7, 11, 16, 24)).astype(np.uint64)
    shapes = mix(masks.astype(np.uint64) + np.uint64(256) * size + np.uint64(2048) * again + np.uint64(1))
    kinds = [(codes, 1), (codes, 2), *[(shapes, k) for k in (1, 2, 3, 4)]]
    found = []
    for salt, (units, k) in enumerate(kinds):
        code = mix(grams(units, k) + np.uint64(salt))
        n = len(code)
        inside = text[:n] == text[k - 1 :] if n else np.zeros(0, bool)
        place = (code >> np.uint64(64 - 18)).astype(np.int64)
        found.append((text[:n] * DIMENSIONS + place)[inside])
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return (both % DIMENSIONS).astype(np.int32), np.searchsorted(both, np.arange(len(offsets)) * DIMENSIONS)


@dataclass(frozen=True)
class Model:
    """Weights per place (scaled), squared scales for the text's length, bias, and the logistic curve."""

    weights: bytes
    squares: bytes
    bias: float
    slope: float
    middle: float

    def margins(self, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
        weights, squares = np.frombuffer(self.weights), np.frombuffer(self.squares)
        total = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x[places])])[ends])
        return total(weights) / np.sqrt(np.maximum(total(squares), 1e-12)) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margins - self.middle), -40, 40)))


def descend(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, size: int, cost: float = 1.0, rounds: int = 15, seed: int = 7):
    """Dual coordinate descent of the hinge loss: one multiplier per row in [0, cost], moved to its best place in turn."""
    weights, bias = np.zeros(size), 0.0
    dual, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    norm = np.array([v @ v + 1.0 for v in values])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            step = np.clip(dual[i] - gradient / norm[i], 0, cost) - dual[i]
            if step:
                dual[i] += step
                weights[rows[i]] += step * signs[i] * values[i]
                bias += step * signs[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def _curve(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and middle of a logistic curve by Newton's method, with targets drawn a little inwards."""
    good, bad = positive.sum(), (~positive).sum()
    target = np.where(positive, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g = np.array([(p - target) @ margins + 1e-3 * a, (p - target).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[w @ margins**2 + 1e-3, w @ margins], [w @ margins, w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return (float(a), float(-b / a)) if a > 1e-6 else (0.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS, seed: int = 11) -> Model | None:
    """A model of the 0/1 column ``label``; every fifth labelled row is kept for the curve. None without rows."""
    wanted = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    wanted = wanted.groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    wanted = wanted.orderBy(seeded(seed, "doc_id"), "doc_id").limit(max_rows)
    train = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("doc_id", "text", "y")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                found, ends = _features(part)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), lists], ["doc_id", "y", "places"])

    got = train.mapInArrow(places, "doc_id bigint, y int, places array<int>").toArrow().sort_by("doc_id").combine_chunks()
    if not got.num_rows:
        return None
    lists = got.column("places").combine_chunks()
    flat, ends = np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])
    rows = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    positive = np.asarray(got.column("y")).astype(bool)
    test = np.arange(len(rows)) % 5 == 0
    counts = np.ones((2, DIMENSIONS))
    for row, y, held in zip(rows, positive, test, strict=True):
        if not held:
            counts[int(y)][row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = [ratio[r] / max(np.sqrt(ratio[r] @ ratio[r]), 1e-6) for r in rows]
    fitted = np.flatnonzero(~test) if (~test).any() else np.arange(len(rows))
    signs = np.where(positive, 1.0, -1.0)
    weights, bias = descend([rows[i] for i in fitted], [values[i] for i in fitted], signs[fitted], DIMENSIONS)
    curved = np.flatnonzero(test)
    margins = np.array([weights[rows[i]] @ values[i] + bias for i in curved])
    slope, middle = _curve(margins, positive[curved])
    return Model((weights * ratio).tobytes(), (ratio**2).tobytes(), float(bias), slope, middle)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every document, one row each."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                if model is None:
                    scores = np.full(part.num_rows, 0.5)
                else:
                    scores = model.scores(model.margins(*_features(part)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
