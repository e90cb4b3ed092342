"""Exact removal of word windows that also start in a document with a smaller id.

A window's minimiser is the least hash of the five-word groups in it. Consecutive windows with one
minimiser form a super-k-mer: a run of words that travels as one packed string to the bucket of its
minimiser, where all equal windows meet and are compared word for word.

1. Every super-k-mer is listed as numbers only: minimiser, document, place. A minimiser that
   occurs in one document cannot have a shared window, and its strings never travel.
2. The places left are gathered by document, the strings are cut there and sent to their buckets.
   A bucket is sorted by document, so a window's first sight is in its least document and all later
   documents are flagged as the bucket streams by; only its distinct windows are held.
3. Flagged places are gathered by document, which drops the words they cover.

Minimisers that turn up often in a small sample of documents are heavy. The sample only chooses
the way, never the result: windows of heavy minimisers travel one by one, spread by their own text
and by document. Within such a share all but the least document are flagged at once, and only the
first sights go on to be compared across shares, at most ``SHARES`` documents a window.

Null and empty texts have no words. Rows with a null ``doc_id`` neither lose words nor make others
lose any. Rows that share a ``doc_id`` are judged each by its own text and do not remove each
other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import long_id, ship, steps

WINDOW = 13
GROUP = 5
#: One document in so many is looked at for heavy minimisers ...
SAMPLED = 32
#: ... which are those seen this often in the sample, the most frequent so many of them at most.
HEAVY_SEEN, MOST_HEAVY = 400, 20_000
SHARES = 64
#: A place is a start word and a number of windows; a tag tells apart texts with one id, and shares.
RUN_BITS, SHARE_BITS = 10, 7
MOST_RUN = (1 << RUN_BITS) - 1
#: A run adds a bucket of so many bits, and whether it is heavy, above the place.
PLACE_BITS, BUCKET_BITS = 40, 22
HEAVY_BIT = PLACE_BITS + BUCKET_BITS
LISTED = "mini long, tag int, doc_id long, place long"
CUT = "bucket int, tag int, doc_id long, place long, packed binary"
FLAGGED = "doc_id long, tag int, place long"
DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
RADIX = 0x9E3779B97F4A7C15
LETTER = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) ^ np.uint64(0x94D049BB133111EB)
_POWERS: list[np.ndarray] = []


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((RADIX, pow(RADIX, -1, 1 << 64))):
            steps_ = np.full(size, base, np.uint64)
            steps_[0] = 1
            _POWERS[k : k + 1] = [np.cumprod(steps_)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mark_of(text: bytes) -> int:
    return zlib.crc32(text) >> 8


def no_mark(text: bytes) -> int:  # noqa: ARG001
    return 0


def marker(docs: DataFrame) -> Callable[[bytes], int]:
    """How texts with one id are told apart: not at all where no id is repeated, which saves 3 bytes a run."""
    repeated = docs.groupBy("doc_id").count().where("doc_id IS NOT NULL AND count > 1")
    return mark_of if repeated.limit(1).count() else no_mark


def word_codes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and where it starts. Long texts are read in pieces that end behind a white space."""
    codes, starts, at = [], [], 0
    while at < len(text):
        end = min(len(text), at + (1 << 19))
        while end < len(text) and text[end - 1] not in b" \t\n\x0b\x0c\r":
            end = min(len(text), end + 256)
        piece = np.frombuffer(text, np.uint8, end - at, at)
        inside = np.empty(len(piece) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(SPACE[piece], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, behind = edges[::2], edges[1::2]
        power, inverse = _powers(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(LETTER[piece] * power, out=total[1:])
        codes.append((total[behind] - total[first]) * inverse[first])
        starts.append(first + at)
        at = end
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(codes), np.concatenate(starts)


def group_hashes(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(max(0, len(codes) - GROUP + 1), np.uint64)
    for k in range(GROUP):
        out = out * np.uint64(RADIX) + codes[k : k + len(out)]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def super_kmers(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: text number, start word, number of windows, minimiser; each run within one text."""
    codes, starts = word_codes(b"\n".join(texts))
    none = np.zeros(0, np.int64)
    if len(codes) < window:
        return none, none, none, none
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    first_word = np.searchsorted(starts, begins[:-1])
    counts = np.diff(np.append(first_word, len(starts)))
    first = np.repeat(first_word, counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    least = sliding_least(group_hashes(codes), window - GROUP + 1).view(np.int64)
    at = np.flatnonzero(owner[: len(least)] == owner[window - 1 :])
    mini, own = least[at], owner[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (mini[1:] != mini[:-1]) | (own[1:] != own[:-1])
    begins = np.flatnonzero(fresh)
    runs = np.diff(np.append(begins, len(at)))
    if len(runs) and runs.max() > MOST_RUN:  # a longer run is cut; its parts go to one bucket
        parts = -(-runs // MOST_RUN)
        again = np.repeat(np.arange(len(runs)), parts)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)
        begins, runs = begins[again] + nth * MOST_RUN, np.minimum(MOST_RUN, runs[again] - nth * MOST_RUN)
    return own[begins], (at - first[at])[begins], runs, mini[begins]


def _texts(part: pa.RecordBatch, mark: Callable[[bytes], int]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids, texts and marks of the rows with an id and a text."""
    rows = [(i, t) for i, t in zip(*(c.to_pylist() for c in part.columns[:2]), strict=True) if i is not None and t]
    texts = [t for _, t in rows]
    return np.array([i for i, _ in rows], np.int64), texts, np.array([mark(t) for t in texts], np.int64)


def _binary(docs: DataFrame) -> DataFrame:
    """Texts as UTF-8 bytes, as all splitting is by ASCII white space."""
    return docs.select(long_id(docs), F.col("text").cast("string").cast("binary").alias("text"))


def listed(docs: DataFrame, window: int, heavy: np.ndarray, mark: Callable[[bytes], int] = no_mark) -> DataFrame:
    """Super-k-mers as numbers. The share in ``tag`` is 0, or for a heavy minimiser one of ``SHARES`` by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                ids, texts, marks = _texts(part, mark)
                own, start, runs, mini = super_kmers(texts, window)
                doc_id = ids[own]
                share = np.where(np.isin(mini, heavy), 1 + doc_id % SHARES, 0) if len(heavy) else np.zeros_like(mini)
                tag = ((marks[own] << SHARE_BITS) | share).astype(np.int32)
                columns = mini, tag, doc_id, (start << RUN_BITS) | runs
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_names(LISTED))

    return docs.mapInArrow(run, LISTED)


def heavy_minimisers(docs: DataFrame, window: int, seen: int = HEAVY_SEEN, most: int = MOST_HEAVY) -> np.ndarray:
    """The most frequent of the sample, sorted; ``most`` of them at most, as every task gets the list."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0)
    counts = listed(sample, window, np.zeros(0, np.int64)).groupBy("mini").count().where(F.col("count") >= seen)
    return np.sort(np.array([r.mini for r in counts.orderBy(F.desc("count"), "mini").limit(most).collect()], np.int64))


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each row's list, and all values."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]), column.flatten()


def _cut(docs: DataFrame, runs: DataFrame, window: int, mark: Callable[[bytes], int]) -> DataFrame:
    """The strings of the listed runs; heavy ones window by window, in the bucket of their own text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", 1 << 20):
                out: tuple[list, ...] = ([], [], [], [], [])
                bounds, values = _lists(part.column(3))
                values = values.to_numpy(zero_copy_only=False)
                ids, texts, marks = (part.column(k).to_pylist() for k in range(3))
                for i, (doc_id, text, own) in enumerate(zip(ids, texts, marks, strict=True)):
                    if own == mark(text):
                        _strings(doc_id, text, own, values[bounds[i] : bounds[i + 1]], window, out)
                types = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, types, strict=True)], names=_names(CUT)
                )

    return docs.join(runs, "doc_id").select("doc_id", "text", "mark", "runs").mapInArrow(run, CUT)


def _strings(doc_id: int, text: bytes, mark: int, runs: np.ndarray, window: int, out: tuple[list, ...]) -> None:
    words = text.split()
    line = b" ".join(words)
    ends = np.cumsum([0] + [len(w) + 1 for w in words])
    place = runs & ((1 << PLACE_BITS) - 1)
    first, n = place >> RUN_BITS, place & MOST_RUN
    heavy = (runs >> HEAVY_BIT) > 0
    buckets, tags, ids, places, packed = out
    light = ~heavy
    cuts = zip(ends[first[light]].tolist(), (ends[first[light] + n[light] + window - 1] - 1).tolist(), strict=True)
    packed += [line[a:b] for a, b in cuts]
    buckets += ((runs[light] >> PLACE_BITS) & ((1 << BUCKET_BITS) - 1)).tolist()
    places += place[light].tolist()
    tags += [mark << SHARE_BITS] * int(light.sum())
    share = 1 + doc_id % SHARES
    for start, windows in zip(first[heavy].tolist(), n[heavy].tolist(), strict=True):
        for k in range(start, start + windows):
            string = line[ends[k] : ends[k + window] - 1]
            packed.append(string)
            buckets.append(xxhash.xxh64_intdigest(string) & ((1 << BUCKET_BITS) - 1))
            places.append(k << RUN_BITS | 1)
            tags.append(mark << SHARE_BITS | share)
    ids += [doc_id] * (len(packed) - len(ids))


def _judged(strings: DataFrame, window: int, firsts: bool) -> DataFrame:
    """Streams each bucket and share in the order of documents: flagged runs of windows, or first sights of heavy ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen = None, {}
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            buckets, tags, ids, places, packed = out
            for bucket, tag, doc_id, place, string in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                share = tag & ((1 << SHARE_BITS) - 1)
                if firsts and not share:
                    continue
                if (bucket, share) != key:
                    key, seen = (bucket, share), {}
                start, n = place >> RUN_BITS, place & MOST_RUN
                if n == 1:
                    if (seen.setdefault(string, doc_id) < doc_id) != firsts:
                        buckets.append(bucket)
                        tags.append(tag >> SHARE_BITS << SHARE_BITS)
                        ids.append(doc_id)
                        places.append(place)
                        packed.append(string)
                    continue
                at = [0, *accumulate(len(w) + 1 for w in string.split(b" "))]
                late = [seen.setdefault(string[at[k] : at[k + window] - 1], doc_id) < doc_id for k in range(n)]
                if True in late:
                    k = 0
                    for flag, group in groupby(late):
                        length = sum(1 for _ in group)
                        if flag:
                            tags.append(tag)
                            ids.append(doc_id)
                            places.append((start + k) << RUN_BITS | length)
                        k += length
            if firsts:
                types = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
                columns = [pa.array(v, t) for v, t in zip(out, types, strict=True)]
            else:
                columns = [pa.array(ids, pa.int64()), pa.array(tags, pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=_names(CUT if firsts else FLAGGED))

    share = F.col("tag").bitwiseAND((1 << SHARE_BITS) - 1)
    ordered = strings.repartition("bucket", share).sortWithinPartitions("bucket", share, "doc_id")
    return ordered.mapInArrow(run, CUT if firsts else FLAGGED)


def flagged(docs: DataFrame, window: int, seen: int, most: int, mark: Callable[[bytes], int]) -> DataFrame:
    """``(doc_id, places)``: the windows of each document that also start in a smaller one."""
    heavy = heavy_minimisers(docs, window, seen, most) if most else np.zeros(0, np.int64)
    rows = listed(docs, window, heavy, mark).withColumn("share", F.col("tag").bitwiseAND((1 << SHARE_BITS) - 1))
    met = Window.partitionBy("mini", "share")
    shared = rows.select("*", F.min("doc_id").over(met).alias("lo"), F.max("doc_id").over(met).alias("hi")).where(
        "share > 0 OR lo < hi"
    )
    bucket = F.col("mini").bitwiseAND((1 << BUCKET_BITS) - 1)
    packed = (
        F.shiftleft((F.col("share") > 0).cast("long"), HEAVY_BIT) + F.shiftleft(bucket, PLACE_BITS) + F.col("place")
    )
    runs = shared.groupBy("doc_id", F.shiftright("tag", SHARE_BITS).alias("mark")).agg(
        F.collect_list(packed).alias("runs")  # no more than the document has words
    )
    strings = _cut(docs, runs, window, mark)
    late = _judged(strings, window, False)
    if len(heavy):
        late = late.unionByName(_judged(_judged(strings, window, True), window, False))
    return late.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "place")).alias("places"))


def _with_places(docs: DataFrame, window: int, seen: int, most: int) -> tuple[DataFrame, Callable[[bytes], int]]:
    """Every row with the flagged places of its id, and how texts are told apart; null ids have none."""
    ship(docs.sparkSession)
    rows = _binary(docs)
    mark = marker(rows)
    found = flagged(rows, window, seen, most, mark)
    named = rows.where("doc_id IS NOT NULL").join(found, "doc_id", "left")
    every = named.unionByName(rows.where("doc_id IS NULL"), allowMissingColumns=True)
    return every.select("doc_id", "text", "places"), mark


def _kept(part: pa.RecordBatch, window: int, mark: Callable[[bytes], int]) -> Iterator[tuple[int | None, list[bytes], int]]:
    """Of each row: id, the words outside flagged windows, and the number of words there were."""
    bounds, values = _lists(part.column(2))
    marks = values.field("tag").to_numpy(zero_copy_only=False) >> SHARE_BITS
    places = values.field("place").to_numpy(zero_copy_only=False)
    for i, (doc_id, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
        words = (text or b"").split()
        own = slice(bounds[i], bounds[i + 1])
        at = places[own][marks[own] == mark(text)] if bounds[i] < bounds[i + 1] else ()
        if not len(at):
            yield doc_id, words, len(words)
            continue
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, at >> RUN_BITS, 1)
        np.add.at(change, (at >> RUN_BITS) + (at & MOST_RUN) + window - 1, -1)
        yield doc_id, [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)], len(words)


def removal_digest(docs: DataFrame, window: int = WINDOW, seen: int = HEAVY_SEEN, most: int = MOST_HEAVY) -> DataFrame:
    """Words, removed words and the digest of the kept words of every document."""
    rows, mark = _with_places(docs, window, seen, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                ids, sizes, gone, digests = [], [], [], []
                for doc_id, words, n in _kept(part, window, mark):
                    ids.append(doc_id)
                    sizes.append(n)
                    gone.append(n - len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int64()) for v in (ids, sizes, gone)] + [pa.array(digests, pa.string())],
                    names=_names(DIGEST),
                )

    return rows.mapInArrow(run, DIGEST)


def kept_texts(docs: DataFrame, window: int = WINDOW, seen: int = HEAVY_SEEN, most: int = MOST_HEAVY) -> DataFrame:
    """``doc_id, mark, kept, n_removed`` of the documents that lose words; ``kept`` has single spaces.

    ``mark`` tells apart texts with one id: 24 bits of their CRC-32.
    """
    schema = "doc_id long, mark int, kept string, n_removed long"
    rows, mark = _with_places(docs, window, seen, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                found = [
                    (doc_id, mark_of(text), b" ".join(words).decode(), n - len(words))
                    for text, (doc_id, words, n) in zip(part.column(1).to_pylist(), _kept(part, window, mark), strict=True)
                    if len(words) < n
                ]
                columns = zip(*found, strict=True) if found else ((), (), (), ())
                types = pa.int64(), pa.int32(), pa.string(), pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), t) for v, t in zip(columns, types, strict=True)], names=_names(schema)
                )

    return rows.mapInArrow(run, schema)
