"""Near-duplicate classes by SimHash: links between fingerprints at a small Hamming distance.

Every fingerprint is embedded as its bit counts in 16 segments of 4 bits. Flipping a bit moves one
count by one, so the Manhattan distance of two count vectors is a lower bound of the Hamming
distance, and two vectors at distance 2 or less meet in a vector at distance 1 or less from both.
A fingerprint is therefore entered in the grid cell of its vector and in the cells next to it, and
only fingerprints in one cell are compared, bit by bit.

Cells are never joined with themselves beyond ``CELL_PAIRS`` members. In a fuller cell every member
lists the fingerprints inside the cell at one flipped bit or none from its own, and members of the
cell's own vector those with one bit cleared as well, as two of them differ by a bit up and a bit
down. Two members that share one are linked, at most 65 fingerprints can share one, and no link of
the cell is missed.

Equal fingerprints are one node, so a group of copies costs one row. A null or empty text and one
without words has the fingerprint zero. Rows with a null ``doc_id`` get the class of their
fingerprint but never name one. Repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship, steps
from .components import components

SHINGLE = 3
SEED = 42
MOST_BITS = 2
SEGMENTS, WIDTH = 16, 4
#: Members up to which the fingerprints of a cell are compared pair by pair.
CELL_PAIRS = 64
BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def shingles(text: str, size: int) -> list[bytes]:
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint_numbers(texts: list[str], size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The 64-bit fingerprint of each text: bits set in over half of its shingles' hashes."""
    hashes: list[int] = []
    counts = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        parts = shingles(text, size)
        counts[i] = len(parts)
        hashes.extend(map(xxhash.xxh64_intdigest, parts, repeat(seed)))
    return majority_bits(np.array(hashes, "<u8"), counts)


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits that are set in over half of them."""
    own = np.repeat(np.arange(len(counts)), counts) * 256
    octets = hashes.view(np.uint8).reshape(-1, 8)
    out = np.zeros(len(counts), np.uint64)
    for k in range(8):
        seen = np.bincount(own + octets[:, k], minlength=256 * len(counts)).reshape(len(counts), 256)
        over = (2 * (seen @ BIT_OF_BYTE) > counts[:, None]).astype(np.uint8)
        out |= np.packbits(over, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * k)
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint's 64 bits as a signed number."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                numbers = fingerprint_numbers([t or "" for t in part.column("text").to_pylist()], size, seed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(numbers.view(np.int64))], names=["doc_id", "fp"]
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _count(segment: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", WIDTH * segment).bitwiseAND((1 << WIDTH) - 1)).cast("long")


def cells(nodes: DataFrame) -> DataFrame:
    """Every fingerprint in the cell of its counts (``move`` 0) and in those one count up or down (+-(segment + 1))."""
    own = F.lit(0).cast("long")
    for s in range(SEGMENTS):
        own = own + F.shiftleft(_count(s), 3 * s)
    entries = [F.struct(F.col("own").alias("cell"), F.lit(0).alias("move"))]
    for s in range(SEGMENTS):
        step = F.lit(1 << 3 * s).cast("long")
        up = F.struct((F.col("own") + step).alias("cell"), F.lit(s + 1).alias("move"))
        down = F.struct((F.col("own") - step).alias("cell"), F.lit(-s - 1).alias("move"))
        entries += [F.when(_count(s) < WIDTH, up), F.when(_count(s) > 0, down)]
    return nodes.withColumn("own", own).select("fp", "node", F.inline(F.array_compact(F.array(*entries))))


def _inside(fp: Column, move: Column) -> Column:
    """The fingerprints of the entered cell at one flipped bit or none from ``fp``, for ``move`` 0 those with one bit cleared too.

    Two of one vector at distance 2 share the one without the bit that either has alone. The cell
    around theirs that holds it may be compared pairwise, where they are left out.
    """
    every = F.array(*(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(SEGMENTS * WIDTH)))
    bits = F.slice(every, (F.abs(move) - 1) * WIDTH + 1, F.lit(WIDTH))
    fitting = F.filter(bits, lambda b: (fp.bitwiseAND(b) == 0) == (move > 0))
    cleared = F.transform(F.filter(every, lambda b: fp.bitwiseAND(b) != 0), lambda b: fp.bitwiseXOR(b))
    return F.when(move == 0, F.concat(F.array(fp), cleared)).otherwise(F.transform(fitting, lambda b: fp.bitwiseXOR(b)))


def links(nodes: DataFrame, most_bits: int = MOST_BITS, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """Links ``(a, b)`` that join all nodes whose fingerprints are ``most_bits`` or fewer bits apart.

    ``nodes`` has distinct ``fp`` with a ``node`` number each. In full cells a shared neighbour links
    its members to the least of them instead of pairwise; what can be reached is the same.
    """
    if most_bits != 2:
        raise ValueError("grid and full cells are laid out for a distance of 2")
    entered = cells(nodes)
    sizes = entered.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1")
    met = entered.join(sizes, "cell")
    few = met.where(F.col("members") <= cell_pairs).drop("members")
    a, b = few.alias("a"), few.alias("b")
    # two of one vector meet in their own cell; there is no need to compare them in the cells around it
    pairs = a.join(b, "cell").where(
        "a.fp < b.fp AND (a.move <> b.move OR a.move = 0)"
    ).where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= most_bits)
    found = pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    many = met.where(F.col("members") > cell_pairs)
    shared = many.select("node", F.explode(_inside(F.col("fp"), F.col("move"))).alias("between"))
    groups = shared.groupBy("between").agg(F.collect_set("node").alias("nodes"))  # 65 at most
    hub = F.array_min("nodes")
    starred = groups.select(hub.alias("a"), F.explode("nodes").alias("b")).where("a <> b")
    return found.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the least ``doc_id`` linked to it."""
    marked = cut(fingerprints(docs))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL")
    classes = components(links(nodes, most_bits))
    named = nodes.join(classes, "node", "left").select(
        F.col("fp"), F.coalesce("component", "node").alias("component_id")
    )
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(named, "fp", "left").select("doc_id", fingerprint, "component_id")
