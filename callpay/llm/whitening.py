"""Embedding whitening over exact integer covariances, counted with bit-sliced scatter.

Components of a vector become whole numbers x = floor(1024 c) + 100000. In blocks of rows every dimension is shifted
to start at 0 and its bit planes are packed across rows, 64 rows a word. The cross-product of two dimensions is then
the sum of popcount(plane p AND plane q) * 2^(p + q), exact, and the shift is added back by the sums. Blocks
add up in Spark as decimals; the covariance numerators n * sum(x y) - S S' are whole numbers of any size, centred
before the one division that makes them doubles. ``eigh`` sees that matrix alone: what reaches the driver
has the size dimensions * (dimensions + 1) / 2, whatever the number of rows.

Cases: rows whose vector is NULL, or holds NULL or a number that is not finite, take no part, nor do those of a
length other than the most frequent one (of equally frequent ones the greatest); repeated rows count as often
as they occur; a NULL id passes through; numbers beyond 2^50 / 1024 are cut there, a deviation beyond 38 digits is NULL; components without variance have
``whitened`` NULL and no part in ``identity_error``, ``explained`` is NULL where nothing varies; an empty table gives no
rows. Other columns do not pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpay.llm.shared import arrow_rows, stored

SCALE, OFFSET = 1024, 100_000
#: Rows whose bit planes are packed at once, and rows of a batch.
PACKED_ROWS = 1 << 13
LARGEST = 1 << 50
COMPONENTS = 8


def usable(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """Rows with a vector of finite numbers of the most frequent length, the vector as doubles, and that length."""
    vector = F.col(column).cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where(F.col(column).isNotNull()).where(finite).withColumn(column, vector)
    common = kept.groupBy(F.size(column).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    width = common["length"] if common else 0
    return kept.where(F.size(column) == width), width


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column of equally long vectors without NULL as a matrix."""
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def bit_planes(shifted: np.ndarray, bits: int) -> np.ndarray:
    """Words [dimension * bits + bit, word] of numbers [row, dimension] in [0, 2 ** bits)."""
    rows, width = shifted.shape
    padded = np.zeros((width, bits, -(-rows // 64) * 64), np.uint8)
    for p in range(bits):
        padded[:, p, :rows] = ((shifted >> p) & 1).T
    return np.packbits(padded, axis=2, bitorder="little").view(np.uint64).reshape(width * bits, -1)


def scatter(x: np.ndarray) -> tuple[list[int], list[int]]:
    """Sums per dimension and cross-products of all pairs i <= j (row by row), exact whole numbers."""
    rows, width = x.shape
    low = x.min(axis=0)
    shifted = x - low
    bits = max(1, int(shifted.max()).bit_length())
    planes = bit_planes(shifted, bits)
    counts = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).reshape(width, bits)
    # within these bounds weighted counts fit 64 bits; beyond, Python numbers take over
    kind = np.int64 if rows.bit_length() + 2 * bits <= 62 else object
    weights = np.array([1 << p for p in range(bits)], kind)
    ones = [int(v) for v in (counts.astype(kind) * weights).sum(axis=1)]
    lows = [int(v) for v in low]
    sums = [s + rows * m for s, m in zip(ones, lows, strict=True)]
    cross: list[int] = []
    for i in range(width):
        total = np.zeros(width - i, kind)
        rest = planes[i * bits :]
        for p in range(bits):
            if not counts[i, p]:
                continue
            both = np.bitwise_count(rest & planes[i * bits + p]).sum(axis=1, dtype=np.int64)
            total = total + (both.reshape(-1, bits).astype(kind) * weights).sum(axis=1) * weights[p]
        cross += [
            int(t) + lows[i] * ones[j] + lows[j] * ones[i] + rows * lows[i] * lows[j]
            for j, t in zip(range(i, width), total, strict=True)
        ]
    return sums, cross


def _scatter_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Sums of a task as rows (place, total): the count, then sums, then cross-products. Wide totals go as text."""
    n, sums, cross = 0, [0] * width, [0] * (width * (width + 1) // 2)
    for batch in batches:
        if not batch.num_rows:
            continue
        some, pairs = scatter(whole_numbers(matrix_of(batch.column("vector"), width)))
        n += batch.num_rows
        sums = [a + b for a, b in zip(sums, some, strict=True)]
        cross = [a + b for a, b in zip(cross, pairs, strict=True)]
    if n:
        totals = [n, *sums, *cross]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(totals)), pa.int32()), pa.array([str(t) for t in totals])], ["place", "total"]
        )


@dataclass(frozen=True)
class Fit:
    """What a whitening knows of the vectors it was fitted on; ``components`` are columns by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def usable_components(self) -> int:
        """Eigenvalues that double precision tells from 0."""
        least = len(self.sums) * np.finfo(float).eps * max(self.eigenvalues.max(initial=0.0), 0.0)
        return int((self.eigenvalues > least).sum())


def fit(vectors: DataFrame, width: int) -> Fit:
    """Exact sums and covariance of a column ``vector`` of whole doubles lists, and its eigenvectors."""
    with arrow_rows(vectors.sparkSession, PACKED_ROWS):
        parts = stored(
            vectors.select("vector").mapInArrow(partial(_scatter_batches, width=width), "place int, total string"), "scatter"
        )
    totals = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect()
    found = {r.place: int(r.total) for r in totals}
    n, sums = found.get(0, 0), [found.get(1 + i, 0) for i in range(width)]
    covariance, at = np.zeros((width, width)), 1 + width
    for i in range(width):
        for j in range(i, width):
            # one rounding: numerator and n * n are exact
            covariance[i, j] = covariance[j, i] = (n * found.get(at, 0) - sums[i] * sums[j]) / (n * n) if n else 0.0
            at += 1
    values, vectors_ = np.linalg.eigh(covariance) if width else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(values, kind="stable")[::-1]
    return Fit(n, tuple(sums), covariance, values[order], vectors_[:, order])


def _project(batches: Iterator[pa.RecordBatch], fitted: Fit, top: int) -> Iterator[pa.RecordBatch]:
    width, n = len(fitted.sums), fitted.n
    good = min(top, fitted.usable_components)
    scaled = fitted.components[:, :good] / np.sqrt(fitted.eigenvalues[:good])
    sums = np.array(fitted.sums, object)
    whole, part = np.array([s // n for s in fitted.sums], object), np.array([(s % n) / n for s in fitted.sums])
    for batch in batches:
        if not batch.num_rows:
            continue
        x = whole_numbers(matrix_of(batch.column("vector"), width))
        # n x - S fits 64 bits unless numbers are huge; its squares are added up exactly either way
        most = n * (int(np.abs(x).max(initial=0)) + max((abs(int(v)) + 1 for v in whole), default=0))
        if most * most * max(width, 1) < 1 << 62:
            off = n * x - sums.astype(np.int64)
            deviation = [int(v) for v in (off * off).sum(axis=1)]
        else:
            deviation = [sum(v * v for v in row) for row in (n * x.astype(object) - sums)]
        centred = (x.astype(object) - whole if most >= 1 << 62 else x - whole.astype(np.int64)).astype(np.float64) - part
        projected = centred @ scaled
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([str(v) for v in deviation]), pa.array(list(projected), pa.list_(pa.float64()))],
            ["vec_id", "deviation", "whitened"],
        )


def whiten(vectors: DataFrame, column: str = "embedding", top: int = COMPONENTS) -> tuple[DataFrame, Fit]:
    """(rows, fit) of a table (vec_id, vector): rows (vec_id, deviation decimal, whitened list of ``top`` at most).

    ``deviation`` is the exact sum over dimensions of (n x - S)^2.
    """
    kept, width = usable(vectors, column)
    kept = kept.select("vec_id", F.col(column).alias("vector"))
    fitted = fit(kept, width)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    with arrow_rows(vectors.sparkSession, PACKED_ROWS):
        rows = kept.mapInArrow(
            partial(_project, fitted=fitted, top=top), f"vec_id {kind}, deviation string, whitened array<double>"
        )
        rows = stored(rows.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)")), "whitened")
    return rows, fitted


def identity_error(rows: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity, from the rows themselves."""
    def part(i: int) -> Column:
        return F.col("whitened")[i]

    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    if not pairs:
        return 0.0
    found = rows.agg(*[F.covar_pop(part(i), part(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max((abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs if found[f"c{i}_{j}"] is not None), default=0.0)


def component_rows(rows: DataFrame, fitted: Fit, top: int = COMPONENTS) -> DataFrame:
    """One row per vector and component, with what the fit says of it."""
    numbers = min(top, len(fitted.sums))
    error = identity_error(rows, min(numbers, fitted.usable_components))
    total = float(np.trace(fitted.covariance))
    shares = [float(max(v, 0.0) / total) if total > 0 else None for v in fitted.eigenvalues[:numbers]]
    share = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array().cast("array<double>")
    each = rows.withColumn("component", F.explode(F.sequence(F.lit(1), F.lit(numbers)))) if numbers else rows.limit(0).withColumn(
        "component", F.lit(0)
    )
    return each.select(
        "vec_id",
        F.col("component").cast("int").alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        F.col("deviation").try_cast("bigint").alias("deviation"),
        F.get("whitened", F.col("component") - 1).alias("whitened"),
        F.get(share, F.col("component") - 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
