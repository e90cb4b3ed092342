"""Exact top-k by inner product, found by refining histograms of the scores.

Every pass scores all candidates against a block of queries and counts scores in equal bins of each
query's current range; the bin that holds the k-th score becomes the next range, until it is one
number wide. A last pass filters by that k-th score. A task reports only its highest bins down to
its own k-th score, as the k-th of all rows is no lower, and at most k rows per query in the last
pass, least ids first, so ties of a frequent vector cost no more.

Queries are taken in blocks of about ``BLOCK`` rows; a block is all that is ever sent to every task.

Components are floor(scale * x), whatever their size: scores are exact, and one beyond a long's range
counts as the nearest long. Null ids, null vectors, and vectors with null or non-finite components take
no part. Only vectors of equal length are scored.
Rows with a query's id are the query's own; of several with one id the least vector asks. Other
repeated rows are candidates each. A query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship
from .products import HIGH, by_size, complete, products

BLOCK = 8192
BINS = 256
#: Scores that one step holds at a time.
STEP_SCORES = 1 << 22
#: Components of one block at most: 64 MB as doubles.
BLOCK_NUMBERS = 1 << 23


def taking_part(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` of the rows that take part."""
    rows = vectors.where(F.col("vec_id").isNotNull() & complete("embedding"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))


def _scores(ids: np.ndarray, matrix: np.ndarray, block: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query numbers, candidate ids, scores[candidate, query]) in steps."""
    found = block.get(matrix.shape[1])
    if found is None:
        return
    numbers, queries = found
    step = max(1, STEP_SCORES // len(numbers))
    for at in range(0, len(ids), step):
        yield numbers, ids[at : at + step], products(matrix[at : at + step], queries)


def _histogram(candidates: DataFrame, block, owners, lows, widths, k: int, scale: int) -> DataFrame:
    """Counts of scores in each query's bins (the last one: above its range), from each task's
    highest bin down to its k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, width, own = lows.value, widths.value, owners.value
        counts = np.zeros((len(low), BINS + 1), np.int64)
        floor = low.copy()  # nothing below matters any more in this task
        for batch in batches:
            for _, ids, matrix in by_size(batch.column(0), batch.column(1), scale):
                for numbers, names, scores in _scores(ids, matrix, block.value):
                    row, column = np.nonzero(scores >= floor[numbers])
                    keep = names[row] != own[numbers[column]]
                    row, column = row[keep], column[keep]
                    query = numbers[column]
                    above = (scores[row, column] - low[query]).view(np.uint64)  # up to 64 bits: never below the range
                    bins = np.minimum(above // width[query].view(np.uint64), BINS).astype(np.int64)
                    counts += np.bincount(query * (BINS + 1) + bins, minlength=counts.size).reshape(counts.shape)
                    down = np.cumsum(counts[:, ::-1], axis=1) >= k
                    best = BINS - np.argmax(down, axis=1)
                    floor = np.where(down[:, -1], low + best * width, low)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, bins = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(bins), pa.array(counts[query, bins])], names=["query", "bin", "n"]
        )

    return candidates.mapInArrow(run, "query long, bin long, n long")


def _best(candidates: DataFrame, block, owners, lows, k: int, scale: int) -> DataFrame:
    """Of each task and query the k best candidates that reach the query's k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, own = lows.value, owners.value
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            for _, ids, matrix in by_size(batch.column(0), batch.column(1), scale):
                for numbers, names, scores in _scores(ids, matrix, block.value):
                    row, column = np.nonzero(scores >= low[numbers])
                    query = numbers[column]
                    fresh = query, names[row], scores[row, column]
                    keep = fresh[1] != own[query]
                    held = [np.concatenate([a, b[keep]]) for a, b in zip(held, fresh, strict=True)]
                    order = np.lexsort((held[1], -held[2], held[0]))
                    held = [a[order] for a in held]
                    first = np.searchsorted(held[0], held[0])
                    held = [a[np.arange(len(first)) - first < k] for a in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[held[0]]), pa.array(held[1]), pa.array(held[2])], names=["query_id", "vec_id", "score"]
        )

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def kth_bins(histogram: DataFrame, k: int) -> dict[int, int]:
    """The bin of each query's k-th score; queries with fewer candidates have none. One row a query of the block."""
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    counted = histogram.groupBy("query", "bin").agg(F.sum("n").alias("n"))
    reached = counted.withColumn("reached", F.sum("n").over(down)).where(F.col("reached") >= k)
    return {r["query"]: r["bin"] for r in reached.groupBy("query").agg(F.max("bin").alias("bin")).collect()}


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of each query, ties to the smaller id."""
    spark = vectors.sparkSession
    ship(spark)
    candidates = taking_part(vectors)
    asked = cut(taking_part(vectors.where(is_query)).groupBy("vec_id").agg(F.min("v").alias("v")))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v")).alias("numbers")).first()
    blocks = max(1, -(-size.n // block), -(-(size.numbers or 0) // BLOCK_NUMBERS))
    largest = candidates.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    results = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow().combine_chunks()
        if rows.num_rows:
            results = results.unionByName(_block(candidates, rows["vec_id"].chunk(0), rows["v"].chunk(0), k, largest, scale))
    return results


def _block(candidates: DataFrame, ids: pa.Array, vectors: pa.Array, k: int, largest: float, scale: int) -> DataFrame:
    context = candidates.sparkSession.sparkContext
    matrices, reach = {}, np.zeros(len(ids), np.int64)
    for at, _, matrix in by_size(ids, vectors, scale):
        matrices[matrix.shape[1]] = at, matrix
        reach[at] = [min(HIGH, (int(largest) + 1) * scale * sum(abs(int(x)) for x in v)) for v in matrix]
    block, owners = context.broadcast(matrices), context.broadcast(np.asarray(ids))
    lows, widths = -reach, reach // BINS * 2 + 2  # so that all bins together reach from -reach to reach
    refining = True
    while refining:
        sent = context.broadcast(lows.copy()), context.broadcast(widths.copy())
        found = kth_bins(_histogram(candidates, block, owners, *sent, k, scale), k)
        refining = False
        for query, at in found.items():
            refining |= bool(widths[query] > 1)
            lows[query] = int(lows[query]) + at * int(widths[query])
            widths[query] = -(-widths[query] // BINS)
    best = _best(candidates, block, owners, context.broadcast(lows), k, scale)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return cut(ranked.select("query_id", "rank", "vec_id", "score"))
