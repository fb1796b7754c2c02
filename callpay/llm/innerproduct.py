"""Exact top-k search by inner product over norm-sorted vectors.

Components become whole numbers x = floor(256 c), so scores are exact. Candidates are sorted over all tasks by falling
length and stored in that order. The singular value decomposition of all vectors (eigenvectors of their Gram matrix,
dimensions squared in size) gives axes that put most of a score into the first coordinates. The stated
queries go against all candidates in blocks of about ``QUERIES``, one block sent to the tasks at a time.

A task walks down its candidates. For a query whose kth best score so far is t, no candidate with |q| |x| < t is left
once lengths have fallen that far (Cauchy-Schwarz); files hold one range of lengths each, so those below every query's
bound are not read. Candidates that remain get a partial score over the leading axes; with the residual bound
|q'| |x'| over the other axes it must reach t, or the candidate is passed over. What is left is scored exactly in
whole numbers. t starts from the query's scores with the ``LONGEST`` longest vectors. Bounds are widened by their rounding
error, and one that equals t is not passed over, so ties are exact.

Cases: vectors that are NULL or hold NULL or a number that is not finite take no part, nor do those of a length other than
the most frequent one; equal rows (id and vector) count once; rows of one id with different vectors are
candidates each, and as queries each has result rows of its own; a row is no candidate of its own id; a NULL id is
no query, and as a candidate comes after all others in ties; numbers beyond 2^27 / 256 are cut there; fewer candidates than
k give fewer rows; an empty table gives none. Other columns do not pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpay.llm.shared import arrow_rows, stored
from callpay.llm.whitening import matrix_of, usable
from callpay.operators.keys import join_keys

SCALE, LARGEST = 256, 1 << 27
TOP = 5
#: Candidates of a batch, queries of a block, queries compared at once, longest vectors that give the first bounds.
BATCH, QUERIES, CHUNK, LONGEST = 1 << 12, 1 << 15, 1 << 10, 1 << 12
#: Share of the summed squares that the leading axes hold.
LEADING = 0.7
#: Stands for a NULL id in ties.
NO_ID = (1 << 63) - 1
LEAST = -(1 << 63)


def _numbers(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.clip(np.floor(SCALE * matrix_of(batch.column("vector"), width)), -LARGEST, LARGEST).astype(np.int32)
        square = np.einsum("ij,ij->i", x, x, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _lists(x), pa.array(square)], ["vec_id", "x", "square"])


def _lists(x: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.reshape(-1)))


def whole_vectors(vectors: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Different rows (vec_id, x, square) sorted by falling length over all tasks, and the number of dimensions."""
    kept, width = usable(vectors, column)
    kept = kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).alias("vector"))
    rows = kept.mapInArrow(partial(_numbers, width=width), "vec_id bigint, x array<int>, square bigint")
    # only rows of repeated ids can be equal; mostly there are none, and no vector moves for it
    repeated = stored(kept.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated-ids")
    if not repeated.isEmpty():
        some = join_keys(rows, repeated, ["vec_id"], "left_semi", null_safe=True).dropDuplicates(["vec_id", "x"])
        rows = join_keys(rows, repeated, ["vec_id"], "left_anti", null_safe=True).unionByName(some)
    order = [F.col("square").desc(), F.col("vec_id").asc_nulls_last()]
    with arrow_rows(vectors.sparkSession, BATCH):
        return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order), "by-length"), width


def _gram(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((width, width))
    for batch in batches:
        x = matrix_of(batch.column("x"), width)
        total += x.T @ x
    at = np.arange(width * width)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1))], ["place", "total"])


def leading_axes(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, the fewest that hold ``LEADING`` of the squares."""
    found = rows.select("x").mapInArrow(partial(_gram, width=width), "place bigint, total double")
    gram = np.zeros(width * width)
    for r in found.groupBy("place").agg(F.sum("total").alias("total")).collect():
        gram[r.place] = r.total
    values, axes = np.linalg.eigh(gram.reshape(width, width))
    values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
    enough = int(np.searchsorted(np.cumsum(values), LEADING * values.sum())) + 1
    return np.ascontiguousarray(axes[:, :enough])


@dataclass(frozen=True)
class Block:
    """Queries as a task holds them: places, ids, vectors, first bounds."""

    place: np.ndarray
    ids: np.ndarray
    x: np.ndarray
    bound: np.ndarray


def _ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(NO_ID), np.int64)


def _first_bounds(batches: Iterator[pa.RecordBatch], ids: np.ndarray, longest: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The kth best score of each query with the longest vectors; NULL if they are too few."""
    width = longest.shape[1]
    for batch in batches:
        q, own = matrix_of(batch.column("x"), width), _ids(batch.column("vec_id"))
        bound = np.full(len(q), LEAST, np.int64)
        for low in range(0, len(q), CHUNK):
            part = slice(low, low + CHUNK)
            scores = _products(q[part], longest)
            scores[own[part, None] == ids[None, :]] = LEAST
            if scores.shape[1] >= k:
                bound[part] = np.partition(scores, -k, axis=1)[:, -k]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(bound, mask=bound == LEAST)], [*batch.schema.names, "bound"]
        )


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact scores of all pairs of two matrices of whole numbers held as doubles."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.shape[1], 1) < 1 << 53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _pair_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", q.astype(np.int64), x.astype(np.int64))


def _scan(batches: Iterator[pa.RecordBatch], queries: Block, axes: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    width, many = len(axes), len(queries.ids)
    q = queries.x.astype(np.float64)
    lead = q @ axes
    length = np.sqrt(np.einsum("ij,ij->i", q, q))
    rest = np.sqrt(np.maximum(length**2 - np.einsum("ij,ij->i", lead, lead), 0.0))
    scores, ids = np.full((many, k), LEAST, np.int64), np.full((many, k), NO_ID, np.int64)
    bound = np.where(queries.bound == LEAST, -np.inf, queries.bound.astype(np.float64))
    for batch in batches:
        if not batch.num_rows:
            continue
        x, own = matrix_of(batch.column("x"), width), _ids(batch.column("vec_id"))
        x_length = np.sqrt(np.asarray(batch.column("square"), np.float64))
        x_lead = x @ axes
        x_rest = np.sqrt(np.maximum(x_length**2 - np.einsum("ij,ij->i", x_lead, x_lead), 0.0))
        reach = length * x_length.max() * (1 + 1e-9) >= bound
        active = np.flatnonzero(reach)
        for low in range(0, len(active), CHUNK):
            some = active[low : low + CHUNK]
            slack = 1e-9 * np.outer(length[some], x_length) + 1e-6
            partial_scores = lead[some] @ x_lead.T + np.outer(rest[some], x_rest) + slack
            may = (partial_scores >= bound[some, None]) & (queries.ids[some, None] != own[None, :])
            qi, xi = np.nonzero(may)
            if len(qi) * 8 > may.size:
                found = _products(q[some], x)[qi, xi]
            else:
                found = _pair_products(q[some[qi]], x[xi])
            good = found >= bound[some[qi]]
            _merge(scores, ids, some[qi[good]], found[good], own[xi[good]])
            bound[some] = np.maximum(bound[some], np.where(scores[some, -1] == LEAST, -np.inf, scores[some, -1]))
    at, nth = np.nonzero(scores != LEAST)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(queries.place[at]), pa.array(queries.ids[at]),
            pa.array(ids[at, nth], mask=ids[at, nth] == NO_ID), pa.array(scores[at, nth]),
        ],
        ["place", "query_id", "vec_id", "score"],
    )


def _merge(scores: np.ndarray, ids: np.ndarray, at: np.ndarray, found: np.ndarray, own: np.ndarray) -> None:
    """Put new pairs into the k best of their queries, by score and then smaller id."""
    touched = np.unique(at)
    if not len(touched):
        return
    k = scores.shape[1]
    every = np.concatenate([np.repeat(touched, k), at])
    score = np.concatenate([scores[touched].reshape(-1), found])
    name = np.concatenate([ids[touched].reshape(-1), own])
    order = np.lexsort((name, ~score, every))
    every, score, name = every[order], score[order], name[order]
    first = np.searchsorted(every, touched)
    take = first[:, None] + np.arange(k)
    scores[touched], ids[touched] = score[take], name[take]


def search(vectors: DataFrame, is_query: Column, k: int = TOP, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row of (vec_id, vector) that ``is_query`` names."""
    spark = vectors.sparkSession
    rows, width = whole_vectors(vectors, column)
    axes = leading_axes(rows, width)
    top = rows.orderBy(F.col("square").desc(), F.col("vec_id").asc_nulls_last()).limit(LONGEST).toArrow().combine_chunks()
    longest = matrix_of(top.column("x").combine_chunks(), width) if top.num_rows else np.zeros((0, width))
    known = _ids(top.column("vec_id").combine_chunks()) if top.num_rows else np.zeros(0, np.int64)
    asked = rows.where(is_query & F.col("vec_id").isNotNull()).mapInArrow(
        partial(_first_bounds, ids=known, longest=longest, k=k), "vec_id bigint, x array<int>, square bigint, bound bigint"
    )
    asked = stored(asked.withColumn("place", F.monotonically_increasing_id()), "queries")
    blocks = -(-asked.count() // QUERIES)
    found = []
    for block in range(blocks):
        here = asked.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not here.num_rows:
            continue
        held = Block(
            np.asarray(here.column("place"), np.int64),
            np.asarray(here.column("vec_id"), np.int64),
            matrix_of(here.column("x").combine_chunks(), width).astype(np.int32),
            np.asarray(here.column("bound").combine_chunks().fill_null(LEAST), np.int64),
        )
        with arrow_rows(spark, BATCH):
            scanned = rows.where(F.col("square") >= _least_square(held)).mapInArrow(
                partial(_scan, queries=held, axes=axes, k=k), "place bigint, query_id bigint, vec_id bigint, score bigint"
            )
            found.append(stored(scanned, "found"))
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _least_square(queries: Block) -> int:
    """Squared length below which no candidate reaches the bound of any query of a block."""
    lengths = np.sqrt(np.einsum("ij,ij->i", queries.x.astype(np.float64), queries.x.astype(np.float64)))
    if (queries.bound <= 0).any() or not lengths.all():
        return 0
    return int((queries.bound / lengths).min() ** 2 * (1 - 1e-9))
