"""Best-fit packing of token pieces, planned over the histogram of their lengths.

Only counts by length reach the planner, never documents: at most ``capacity`` numbers, whatever
the corpus holds. The plan is a list of slots "n pieces of this length, from this rank on, go to n
sequences from this id on, at this place"; pieces take slots by joining on rank within length.
Ranks are counted in salted groups, so a length that holds a third of all pieces is no hot task.

Null texts are empty and yield one piece, the closing id. Repeated rows are packed each. Rows with
a null ``doc_id`` are packed too. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_codec import stand_ins
from .chunks import ChunkEncoder
from .common import cut, ship, steps

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces of one length that one task ranks.
RANKED_TOGETHER = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOTS = "length long, first_rank long, n long, first_sequence long, offset long"

_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The tokenizer of a file, one per worker."""
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

        tokenize, table = tokenizer.model.tokenize, dict(enumerate(stand_ins()))
        space = table[32]

        def encode(texts: list[str]) -> list[bytes]:
            """A run of letters is one word of the split pattern and goes to the model at once, the rest the whole way."""
            out: list[bytes | None] = []
            rest = []
            for text in texts:
                word = text[1:] if text[0] == " " else text
                if not word.isalpha():
                    rest.append(text)
                    out.append(None)
                    continue
                if text.isascii():
                    mapped = space + word if word is not text else word
                else:
                    mapped = text.encode().decode("latin-1").translate(table)
                out.append(array("I", [t.id for t in tokenize(mapped)]).tobytes())
            found = iter(tokenizer.encode_batch_fast(rest, add_special_tokens=False))
            return [array("I", next(found).ids).tobytes() if ids is None else ids for ids in out]

        _ENCODERS[path] = ChunkEncoder(encode)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document; only documents over ``capacity`` ids have several.

    The first piece of a longer document takes what the full ones behind it leave over.
    """
    ship(docs.sparkSession)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for part in steps(batch, "text"):
                rows: tuple[list, ...] = ([], [], [], [], [])
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode.ids(texts), strict=True):
                    ids += CLOSING_ID.to_bytes(4, "little")
                    total, at, k = len(ids) // 4, 0, 0
                    size = total % capacity or capacity
                    while at < total:
                        row = doc_id, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])
                        for values, value in zip(rows, row, strict=True):
                            values.append(value)
                        at, k, size = at + size, k + 1, capacity
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(rows, _TYPES, strict=True)], names=_NAMES
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut_up, PIECES)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, n, first sequence, offset) of each slot run.

    Sequences with the same space left are kept together, so a step places a whole run of pieces.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # space left -> runs (first sequence, n) of open sequences
    spaces: list[int] = []  # the keys of room, ascending
    opened = 0

    def leave(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                bisect.insort(spaces, space)
                room[space] = []
            room[space].append((first, n))

    def fill(length: int, rank: int, first: int, n: int, used: int, each: int) -> int:
        """n sequences from ``first`` on take ``each`` pieces of this length."""
        for k in range(each):
            slots.append((length, rank + k * n, n, first, used + k * length))
        leave(capacity - used - each * length, first, n)
        return rank + each * n

    def place(length: int, rank: int, left: int, first: int, n: int, used: int) -> int:
        """As many of ``left`` pieces as the run holds, sequence after sequence; the rest of the run stays open."""
        each = (capacity - used) // length
        full = min(n, left // each)
        if full:
            rank = fill(length, rank, first, full, used, each)
            left -= full * each
        if full < n and left:
            rank = fill(length, rank, first + full, 1, used, left)
            full += 1
        leave(capacity - used, first + full, n - full)
        return rank

    for length in sorted((k for k, v in counts.items() if v), reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                each = capacity // length
                n = -(-(total - rank) // each)
                rank = place(length, rank, total - rank, opened, n, 0)
                opened += n
                continue
            space = spaces[at]
            first, n = room[space].pop()
            if not room[space]:
                del room[space], spaces[at]
            rank = place(length, rank, total - rank, first, n, capacity - space)
    return slots


def ranked(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds ``rank``, from 0 within each length; groups of ``RANKED_TOGETHER`` rows are counted apart."""
    spark = rows.sparkSession
    salts = spark.createDataFrame(
        [(k, -(-v // RANKED_TOGETHER)) for k, v in counts.items()], "length long, salts long"
    )
    salted = rows.join(F.broadcast(salts), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts")
    )
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy("length", "salt").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    )
    return (
        salted.withColumn("own", F.row_number().over(own) - 1)
        .join(starts.drop("count"), ["length", "salt"])
        .withColumn("rank", F.col("own") + F.col("before"))
        .drop("own", "before", "salt", "salts")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``; every sequence is gapless from 0."""
    spark = docs.sparkSession
    cut_pieces = cut(pieces(docs, tokenizer, capacity))
    # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in cut_pieces.groupBy("length").count().collect()}
    slots = spark.createDataFrame(plan(counts, capacity), SLOTS)
    taken = ranked(cut_pieces, counts).join(
        # the plan grows with the number of lengths, not of pieces
        F.broadcast(slots.withColumnRenamed("length", "slot_length")),
        (F.col("length") == F.col("slot_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("first_rank") + F.col("n")),
    )
    sequence = F.col("first_sequence") + F.col("rank") - F.col("first_rank")
    return taken.select(
        "doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset"
    )
