"""Hard negatives: for each anchor and positive the best differently labelled rows in a window of scores.

The window of a positive with score p holds the scores n with ``low * p <= 100 * n <= high * p``. The
upper limits of an anchor's positives split the scores into disjoint slots, the highest first. One
scan keeps the best ``negatives`` rows of every slot (in each task, then over all tasks): one
candidate belongs to one slot, however many windows overlap there. A window's answer is the merge of
its own slot and all lower ones, cut to the best, of which those under its lower limit fall away.

Anchors are a stated query set against all rows, in blocks that hold at most ``BLOCK_NUMBERS``
components; a block and its limits are all that is ever sent to every task, and a pass over all rows
answers one block. A task holds, and sends, at most ``positives`` rows of an anchor in the first pass and
``negatives`` of a slot in the second, whatever label, vector or partition most rows share.

Null ids, null labels, null vectors and vectors with null or non-finite components take no part. Only
vectors of one length are scored with each other. Rows with an anchor's id are the anchor's own; of
several the least (label, vector) asks, and repeated rows of other ids are candidates each. Scores
beyond a long count as the nearest long. Ties go to the smaller id. Anchors without a positive, and
positives with an empty window (so all with a negative score), have no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship
from .products import by_size, complete, products

#: Components of the anchors of one block: 64 MB as doubles.
BLOCK_NUMBERS = 1 << 23
#: Scores that one step holds at a time.
STEP_SCORES = 1 << 21
ROWS = "anchor int, vec_id long, score long, slot int"
LEAST = -(2**63)
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class _Best:
    """The best ``k`` candidates of each (anchor, slot) seen so far, and the score that one must reach."""

    def __init__(self, anchors: int, slots: int, k: int, least: np.ndarray):
        self.k, self.slots = k, slots
        self.least = least.copy()  # [anchor, slot]
        self.held = [np.zeros(0, np.int64)] * 3  # place = anchor * slots + slot, id, score

    def add(self, place: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        held = [np.concatenate(pair) for pair in zip(self.held, (place, ids, scores), strict=True)]
        order = np.lexsort((held[1], ~held[2], held[0]))  # ~x falls as x rises and never overflows
        held = [a[order] for a in held]
        nth = np.arange(len(order)) - np.searchsorted(held[0], held[0])
        self.held = [a[nth < self.k] for a in held]
        full = nth == self.k - 1
        rows, slots = np.divmod(held[0][full], self.slots)
        self.least[rows, slots] = np.maximum(self.least[rows, slots], held[2][full])


def _scan(candidates: DataFrame, block, limits, k: int, scale: int, same: bool) -> DataFrame:
    """Of each task the best ``k`` candidates of each (anchor, slot), with equal labels or with different ones.

    ``limits`` holds, by anchor, the slots' upper limits (falling) and least scores, both inclusive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, upper, least = block.value["ids"], *limits.value
        best = _Best(len(own), upper.shape[1], k, least)
        step = 64  # the first step is small: it sets what later ones must reach
        for batch in batches:
            labels = np.asarray(batch.column(2))
            for at, ids, matrix in by_size(batch.column(0), batch.column(1), scale):
                for label, (numbers, queries) in block.value["by"].get(matrix.shape[1], {}).items():
                    chosen = np.flatnonzero((labels[at] == label) == same)
                    start = 0
                    while start < len(chosen):
                        rows = chosen[start : start + max(1, min(step, STEP_SCORES // len(numbers)))]
                        start += len(rows)
                        step = min(step * 2, STEP_SCORES)
                        _take(best, numbers, ids[rows], products(matrix[rows], queries), own, upper)
        anchor, slot = np.divmod(best.held[0], upper.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int32()), pa.array(best.held[1]), pa.array(best.held[2]), pa.array(slot, pa.int32())],
            names=["anchor", "vec_id", "score", "slot"],
        )

    return candidates.mapInArrow(run, ROWS)


def _take(best: _Best, numbers, ids, scores, own, upper) -> None:
    """Adds the scores of some rows with some anchors that may still be among the best of their slot."""
    for slot in range(upper.shape[1]):
        within = (scores <= upper[numbers, slot]) & (scores >= best.least[numbers, slot])
        row, column = np.nonzero(within)
        if not len(row):
            continue
        anchor = numbers[column]
        other = ids[row] != own[anchor]
        row, column, anchor = row[other], column[other], anchor[other]
        best.add(anchor * upper.shape[1] + slot, ids[row], scores[row, column])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def _limits(positives: list, n: int, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each anchor: upper limits, falling, and the least score that a window of the slot may hold.

    A slot ends above the next one's upper limit; scores under the lower limit of its highest window
    serve none of the windows that reach down to it, as limits rise with the positive's score.
    """
    upper = np.full((n, k), np.iinfo(np.int64).min)
    least = np.full((n, k), np.iinfo(np.int64).max)  # an unused slot holds nothing
    uppers: dict[int, dict[int, int]] = {}
    for anchor, score in positives:
        if score >= 0:
            own = uppers.setdefault(anchor, {})
            own[high * score // 100] = min(own.get(high * score // 100, score), score)
    for anchor, own in uppers.items():
        falling = sorted(own, reverse=True)
        for slot, limit in enumerate(falling):
            after = falling[slot + 1] + 1 if slot + 1 < len(falling) else LEAST
            upper[anchor, slot] = limit
            least[anchor, slot] = max(after, -(-low * own[limit] // 100))
    return upper, least


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, block_numbers: int = BLOCK_NUMBERS,
) -> DataFrame:
    """``FOUND``: the best negatives of every anchor and positive. ``vectors``: vec_id, embedding, label."""
    spark = vectors.sparkSession
    ship(spark)
    label = F.col("label").cast("long").alias("label")
    names = F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    rows = vectors.where(F.col("vec_id").isNotNull() & label.isNotNull() & complete("embedding"))
    candidates = rows.select(*names, label)
    asking = rows.where(is_anchor).select(*names, label)
    asked = cut(asking.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("of"))
                .select("vec_id", "of.label", "of.embedding"))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("embedding")).alias("numbers")).first()
    blocks = max(1, -(-(size.numbers or 0) // block_numbers))
    results = []
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
        if own.num_rows:
            results.append(_block(candidates, own, positives, negatives, low, high, scale))
    out = spark.createDataFrame([], FOUND)
    for found in results:
        out = out.unionByName(found)
    return out


def _block(candidates: DataFrame, own: pa.Table, positives: int, negatives: int, low: int, high: int, scale: int) -> DataFrame:
    spark = candidates.sparkSession
    context, n = spark.sparkContext, own.num_rows
    table = own.combine_chunks()
    ids, labels = np.asarray(table["vec_id"].chunk(0)), np.asarray(table["label"].chunk(0))
    by: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
    for at, _, matrix in by_size(table["vec_id"].chunk(0), table["embedding"].chunk(0), scale):
        for label in np.unique(labels[at]):
            of = labels[at] == label
            by.setdefault(matrix.shape[1], {})[int(label)] = at[of], matrix[of]
    block = context.broadcast({"ids": ids, "by": by})
    everything = np.full((n, 1), 2**63 - 1), np.full((n, 1), LEAST)
    found = _scan(candidates, block, context.broadcast(everything), positives, scale, same=True)
    best = cut(_ranked(found, positives).select("anchor", F.col("vec_id").alias("positive_id"), "score"))
    pairs = [(r.anchor, r.score) for r in best.select("anchor", "score").collect()]  # at most 5 an anchor of the block
    limits = context.broadcast(_limits(pairs, n, positives, low, high))
    slots = _ranked(_scan(candidates, block, limits, negatives, scale, same=False), negatives)
    falling = F.array_sort(
        F.collect_list(F.struct("score", "vec_id")),
        lambda a, b: F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1))
        .when(a["vec_id"] != b["vec_id"], F.when(a["vec_id"] < b["vec_id"], -1).otherwise(1)).otherwise(0),
    )
    merged = slots.groupBy("anchor").agg(falling.alias("falling"))  # at most slots * negatives rows an anchor
    exact = F.col("positive_score").cast("decimal(25,0)")
    upto = F.filter("falling", lambda x: F.lit(100) * x["score"].cast("decimal(20,0)") <= F.lit(high) * exact)
    taken = F.filter(F.slice(upto, 1, negatives), lambda x: F.lit(100) * x["score"].cast("decimal(20,0)") >= F.lit(low) * exact)
    names = spark.createDataFrame(pa.table({"anchor": pa.array(np.arange(n), pa.int32()), "anchor_id": pa.array(ids)}))
    return cut(
        best.withColumnRenamed("score", "positive_score").join(merged, "anchor").join(F.broadcast(names), "anchor")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(taken).alias("at", "of"))
        .select(
            "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("of.vec_id").alias("negative_id"),
            "positive_score", F.col("of.score").alias("negative_score"),
        )
    )
