"""Two tokenizers side by side: common boundaries, linked token pairs, and how often each pair is linked.

A text's tokens under A and B are laid over the same bytes. Offsets where both end cut them into groups;
tokens whose bytes overlap are links. Between two neighbouring ends of either side lies exactly one link,
so links are found by merging the two lists of ends.

Counting the pairs of the corpus is an external job in three passes over the shared folder:

1. Each step of texts writes its (pair, document) records as zstd runs, one for each value of the low bits of the B
   id, sorted by B, then A, then document.
2. Runs of one radix meet in a task, which merges them by a heap and adds up each pair. A radix with more than
   ``GROUP_RECORDS`` records is dealt over several tasks by run, whose sums are added up afterwards. In the
   order of B the pairs of one B id follow each other, which yields the highest count of each.
3. The counts go back to the runs of their radix; each run streams what its documents gain, and the gains are
   added up by document.

A frequent pair is one entry of a run's header, so it weighs as much as a rare one before any shuffle. A task
holds one run and the counts of one radix, at most (vocabulary A x vocabulary B) / ``RADIX`` and in practice far less.

B's pieces hold spaces at their start only and A's split pattern breaks at the same places, so texts are cut before
every space that follows a non-space, and the parts are encoded apart and kept in a bounded cache. A vocabulary
without that property is used on whole texts.

Null and empty texts, and texts that either side does not give back byte by byte, have no tokens: zeros, and
an empty string for the digest. Rows stay one to one: repeated and null ids are documents of their own.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import packing
from .bpe_codec import stand_ins
from .chunks import MARKS
from .common import cut, ship, steps

#: Runs that each step writes: one for each value of the low bits of the B id.
RADIX = 16
#: Records of one radix that one task merges.
GROUP_RECORDS = 16_000_000
STEP_BYTES = 4 << 20
#: Bits of an A id in a pair's code.
A_BITS = 24
#: Parts kept in a worker between steps, by number and by the length of their texts and groups.
KEPT_PARTS = 300_000
KEPT_CHARS = 48 << 20
#: Uses since the last clearing that keep a part.
USUAL = 3
#: Counts of pairs that travel together.
PIECE = 1 << 16
CUT_AT = re.compile(r"(?<=\S) ")
SPACE_MARK = "▁"
DIGEST = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, origin long, nth int"
)
STEPPED = DIGEST + ", radix int, records long, pairs binary, spread binary"


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compresses far better than number by number."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _numbers(raw: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _pack(*columns: np.ndarray) -> bytes:
    import zstandard

    out = [np.array([len(c) * c.itemsize for c in columns], np.int64).tobytes(), *map(_planes, columns)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(run: bytes, *dtypes: str) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(run)
    at, out = 8 * len(dtypes), []
    for size, dtype in zip(np.frombuffer(raw, np.int64, len(dtypes)).tolist(), dtypes, strict=True):
        out.append(_numbers(raw[at : at + size], dtype))
        at += size
    return out


HEADER = "<i8", "<i4", "<i8"  # steps from one pair's code to the next, documents and links of each pair
SPREAD = "<i4", "<i4"  # documents by pair, and links of each


class Aligner:
    """Tokens, groups and links of texts, learned part by part."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.encode_a = packing.encoder(path_a).encode
        back = {c: b for b, c in enumerate(stand_ins())}
        vocabulary = json.loads(Path(path_a).read_text())["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else b""
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.pieces.id_to_piece(i) for i in range(len(self.pieces))]
        self.bytes_b = [
            bytes([int(n[3:-1], 16)]) if self.pieces.is_byte(i) else n.replace(SPACE_MARK, " ").encode()
            for i, n in enumerate(names)
        ]
        self.whole = any(SPACE_MARK in n.lstrip(SPACE_MARK) for n in names)
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        #: Each id as text, with the sign that follows it inside a group and at its end.
        self.names_a = [np.array([f"{i}{c}" for i in range(len(self.bytes_a))], object) for c in ",|"]
        self.names_b = [np.array([f"{i}{c}" for i in range(len(self.bytes_b))], object) for c in ",;"]
        self._keep(np.zeros(0, np.int64))

    def _keep(self, kept: np.ndarray) -> None:
        """Forgets all parts but some."""
        if len(kept):
            names = list(self.place)
            self.place = {names[x]: k for k, x in enumerate(kept.tolist())}
            self.codes, self.groups = ([x[k] for k in kept.tolist()] for x in (self.codes, self.groups))
            self.table, self.uses = self.table[kept], np.zeros(len(kept), np.int64)
        else:
            self.place: dict[str, int] = {}
            self.codes: list[bytes] = []  # links of each part
            self.groups: list[str] = []  # with a ; behind each
            self.table = np.zeros((0, 5), np.int64)  # tokens of A and B, groups, links, whether the bytes agree
            self.uses = np.zeros(0, np.int64)
        self.held = sum(map(len, self.place)) + sum(map(len, self.groups)) + sum(map(len, self.codes))

    def parts(self, text: str) -> list[str]:
        """The text's parts; each has one more space in front of it."""
        return [text] if self.whole else CUT_AT.split(text)

    def places(self, parts: list[str]) -> np.ndarray:
        """Where each part stands in the cache, which learns those it lacks and keeps the frequent ones when it is full."""
        if len(self.place) > KEPT_PARTS or self.held > KEPT_CHARS:
            usual = np.flatnonzero(self.uses >= USUAL)
            small = self.held <= KEPT_CHARS
            self._keep(usual[np.argsort(-self.uses[usual], kind="stable")[: KEPT_PARTS // 2]] if small else usual[:0])
        found = list(map(self.place.get, parts))
        if None in found:
            missing = dict.fromkeys(parts)
            self._learn([p for p in missing if p not in self.place])
            found = list(map(self.place.__getitem__, parts))
        out = np.array(found, np.int64)
        self.uses += np.bincount(out, minlength=len(self.uses))
        return out

    def _ids_a(self, parts: list[str]) -> list[bytes]:
        """A word and the mark behind it never share a token of A, so words are encoded once for both."""
        split = [(p[:-1], p[-1]) if p[-1:] in MARKS and p[:-1].isalpha() else (p, "") for p in parts]
        words = list(dict.fromkeys(w for w, _ in split))
        ids = dict(zip(words, self.encode_a([" " + w for w in words]), strict=True))
        marks = {"": b"", **dict(zip(MARKS, self.encode_a(list(MARKS)), strict=True))}
        return [ids[w] + marks[m] for w, m in split]

    def _learn(self, parts: list[str]) -> None:
        ids_a, ids_b = self._ids_a(parts), self.pieces.encode(parts, out_type=int, num_threads=1)
        if "" in parts:  # the space at a text's end; a text of its own would get none in front
            ids_b[parts.index("")] = [self.pieces.piece_to_id(SPACE_MARK)]
        raw = [(" " + p).encode() for p in parts]
        agree = self._agree(ids_a, ids_b, raw)
        table = np.zeros((len(parts), 5), np.int64)
        chosen = [k for k, good in enumerate(agree) if good]
        codes, groups = [b""] * len(parts), [""] * len(parts)
        if chosen:
            own = self._align([ids_a[k] for k in chosen], [ids_b[k] for k in chosen], [len(raw[k]) for k in chosen])
            for k, links, strings in zip(chosen, *own[:2], strict=True):
                codes[k], groups[k] = links, strings
            table[chosen] = own[2]
        self.place.update(zip(parts, range(len(self.codes), len(self.codes) + len(parts)), strict=True))
        self.codes += codes
        self.groups += groups
        self.table = np.concatenate([self.table, table])
        self.uses = np.concatenate([self.uses, np.zeros(len(parts), np.int64)])
        self.held += sum(map(len, raw)) + sum(map(len, groups)) + sum(map(len, codes))

    def _agree(self, ids_a: list[bytes], ids_b: list[list[int]], raw: list[bytes]) -> list[bool]:
        """Whether both sides give each part back. All parts are compared as one; only if they differ, one by one."""

        def spelt(ids: list[int], table: list[bytes]) -> bytes:
            return b"".join(map(table.__getitem__, ids))

        def numbers(ids: bytes) -> list[int]:
            return np.frombuffer(ids, "<u4").tolist()

        all_a, all_b = np.frombuffer(b"".join(ids_a), "<u4"), np.fromiter(chain.from_iterable(ids_b), np.int64)
        upto_a, upto_b = np.cumsum([len(x) // 4 for x in ids_a]), np.cumsum(list(map(len, ids_b)))
        ends = np.cumsum(list(map(len, raw)))
        reach = [np.r_[0, np.cumsum(size[ids])][upto] for size, ids, upto in ((self.size_a, all_a, upto_a), (self.size_b, all_b, upto_b))]
        text = b"".join(raw)
        if all((r == ends).all() for r in reach) and spelt(all_a.tolist(), self.bytes_a) == text == spelt(all_b.tolist(), self.bytes_b):
            return [True] * len(raw)
        return [
            spelt(numbers(a), self.bytes_a) == t == spelt(b, self.bytes_b) for a, b, t in zip(ids_a, ids_b, raw, strict=True)
        ]

    def _align(self, a: list[bytes], b: list[list[int]], sizes: list[int]) -> tuple[list[bytes], list[str], np.ndarray]:
        """Links, groups and figures of parts whose bytes agree; all parts are laid end to end and merged at once."""
        all_a, all_b = np.frombuffer(b"".join(a), "<u4").astype(np.int64), np.fromiter(chain.from_iterable(b), np.int64)
        last = np.cumsum(sizes)
        end_a, end_b = np.cumsum(self.size_a[all_a]), np.cumsum(self.size_b[all_b])
        closes_a, closes_b = np.zeros(last[-1] + 1, bool), np.zeros(last[-1] + 1, bool)
        closes_a[end_a] = closes_b[end_b] = True
        ends, common = np.flatnonzero(closes_a | closes_b), np.flatnonzero(closes_a & closes_b)
        codes = all_b[np.searchsorted(end_b, ends)] << A_BITS | all_a[np.searchsorted(end_a, ends)]
        links, groups = np.searchsorted(ends, last, "right"), np.searchsorted(common, last, "right")
        linked = codes.tobytes()
        stops = (links * 8).tolist()
        # ids as text in the order of the groups, A's before B's
        of_a, of_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        upto_a, upto_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        words = np.empty(len(all_a) + len(all_b), object)
        at_a = np.arange(len(all_a)) + np.r_[0, upto_b][of_a]
        at_b = np.arange(len(all_b)) + upto_a[of_b]
        for at, ids, closing, names in ((at_a, all_a, closes_b[end_a], self.names_a), (at_b, all_b, closes_a[end_b], self.names_b)):
            words[at] = np.where(closing, names[1][ids], names[0][ids])
        spelt, upto = words.tolist(), (upto_a + upto_b)[groups - 1].tolist()
        tokens = [np.diff(np.searchsorted(x, last, "right"), prepend=0) for x in (end_a, end_b)]
        figures = [*tokens, np.diff(groups, prepend=0), np.diff(links, prepend=0), np.ones(len(last), np.int64)]
        return (
            [linked[i:j] for i, j in zip([0, *stops], stops, strict=False)],
            ["".join(spelt[i:j]) for i, j in zip([0, *upto], upto, strict=False)],
            np.stack(figures, axis=1),
        )

    def step(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Figures of each text, and the links' codes with the number of their text."""
        parts = [self.parts(t) if t else [] for t in texts]
        places = self.places([p for own in parts for p in own])
        sizes = np.array(list(map(len, parts)), np.int64)
        stops = np.cumsum(sizes)
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.table[places], axis=0)])
        of_text = sums[stops] - sums[stops - sizes]
        agreed = (sizes > 0) & (of_text[:, 4] == sizes)
        strings = list(map(self.groups.__getitem__, places.tolist()))
        figures = []
        for good, own, i, j in zip(agreed.tolist(), of_text.tolist(), (stops - sizes).tolist(), stops.tolist(), strict=True):
            if good:
                figures.append((*own[:4], hashlib.sha256("".join(strings[i:j])[:-1].encode()).hexdigest()))
            else:
                figures.append((0, 0, 0, 0, ""))
        text_of = np.repeat(np.arange(len(texts)), sizes)
        used = agreed[text_of]
        codes = np.frombuffer(b"".join(map(self.codes.__getitem__, places[used].tolist())), np.int64)
        return figures, codes, np.repeat(text_of[used], self.table[places[used], 3])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def runs(codes: np.ndarray, texts: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """``radix, records, pairs, spread`` of a step's links: records sorted by B, A and text, packed apart by radix."""
    order = np.lexsort((texts, codes))
    codes, texts = codes[order], texts[order]
    first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (texts[1:] != texts[:-1])]) if len(codes) else order
    links = np.diff(np.r_[first, len(codes)])
    codes, texts = codes[first], texts[first]
    radix = (codes >> A_BITS) % RADIX
    for r in np.unique(radix).tolist():
        own = radix == r
        pair, text, n = codes[own], texts[own], links[own]
        head = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        documents, total = np.diff(np.r_[head, len(pair)]), np.add.reduceat(n, head)
        header = _pack(np.diff(pair[head], prepend=0), documents.astype("<i4"), total.astype("<i8"))
        yield r, len(pair), header, _pack(text.astype("<i4"), n.astype("<i4"))


def _stepped(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of two kinds: figures of each document (with the step it came in), and runs of each step."""
    fields = [f.split() for f in STEPPED.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}

    def emit(columns: dict[str, list], n: int) -> pa.RecordBatch:
        given = [pa.array(columns[name] if name in columns else [None] * n, types[t]) for name, t in fields]
        return pa.RecordBatch.from_arrays(given, names=[name for name, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        origin = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in steps(batch, "text", STEP_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                figures, codes, numbers = own.step(texts)
                n_a, n_b, groups, links, digests = map(list, zip(*figures, strict=True))
                yield emit({
                    "doc_id": part.column("doc_id").to_pylist(), "n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": links,
                    "groups_sha256": digests, "origin": [origin] * len(texts), "nth": list(range(len(texts))),
                }, len(texts))
                for radix, records, pairs, spread in runs(codes, numbers):
                    yield emit(
                        {"origin": [origin], "radix": [radix], "records": [records], "pairs": [pairs], "spread": [spread]}, 1
                    )
                origin += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, STEPPED)


def merged(headers: list[bytes]) -> Iterator[tuple[int, int]]:
    """Each pair's code and its links over all runs, in rising order: a heap over the heads of the runs."""

    def entries(header: bytes) -> Iterator[tuple[int, int]]:
        steps_, _, links = _unpack(header, *HEADER)
        return zip(np.cumsum(steps_).tolist(), links.tolist(), strict=True)

    at, total = None, 0
    for code, links in heapq.merge(*map(entries, headers)):
        if code != at:
            if at is not None:
                yield at, total
            at, total = code, 0
        total += links
    if at is not None:
        yield at, total


def _salt(salts: list[int]) -> Column:
    """The task among those of its radix that a run goes to."""
    return F.pmod(F.xxhash64("origin"), F.element_at(F.array(*map(F.lit, salts)), F.col("radix") + 1)).cast("int")


#: Runs that are merged at a time; beyond it sums of several merges are added up with all others.
MERGED_TOGETHER = 512


def _partial_counts(stepped: DataFrame, salts: list[int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []

        def flush() -> Iterator[pa.RecordBatch]:
            found = np.fromiter((x for pair in merged(held) for x in pair), np.int64).reshape(-1, 2)
            for at in range(0, len(found), PIECE):
                codes, links = found[at : at + PIECE].T
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(links)], names=["code", "links"])
            held.clear()

        for batch in batches:
            for header in batch.column(0).to_pylist():
                held.append(header)
                if len(held) == MERGED_TOGETHER:
                    yield from flush()
        if held:
            yield from flush()

    sent = stepped.where("pairs IS NOT NULL").withColumn("salt", _salt(salts)).repartition("radix", "salt")
    return sent.select("pairs").mapInArrow(run, "code long, links long")


def _highest(partial: DataFrame) -> DataFrame:
    """Packed counts by radix: in the order of B, so that each B id's highest count is known when its last pair is seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 2), np.int64)
        for batch in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))], axis=1)])
            side = rows[:, 0] >> A_BITS
            whole = np.searchsorted(side, side[-1]) if len(rows) else 0  # the last B id may go on in the next batch
            yield from _counted(rows[:whole])
            rest = rows[whole:]
        yield from _counted(rest)

    total = partial.groupBy("code").agg(F.sum("links").alias("links"))
    side = F.shiftright("code", A_BITS)
    return total.repartition(side).sortWithinPartitions("code").mapInArrow(run, "radix int, counts binary")


def _counted(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    codes, links = rows.T
    side = codes >> A_BITS
    first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
    best = links == np.repeat(np.maximum.reduceat(links, first), np.diff(np.r_[first, len(side)]))
    radix = side % RADIX
    for r in np.unique(radix).tolist():
        own = np.flatnonzero(radix == r)
        for at in range(0, len(own), PIECE):
            some = own[at : at + PIECE]
            packed = _pack(np.diff(codes[some], prepend=0), links[some], best[some].astype("u1"))
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([packed], pa.binary())], names=["radix", "counts"])


def _gains(stepped: DataFrame, counts: DataFrame, salts: list[int]) -> DataFrame:
    """``origin, nth, n_best, count_sum``: what each document gains from each run it is in."""
    names = ["radix", "salt", "origin", "pairs", "spread"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pieces, known = None, [], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for radix, salt, origin, pairs, spread in zip(*columns, strict=True):
                if (radix, salt) != key:
                    key, pieces, known = (radix, salt), [], None
                if origin is None:  # a piece of counts; all of them come before the runs
                    pieces.append(_unpack(pairs, "<i8", "<i8", "u1"))
                    continue
                if known is None:
                    known = _sorted_counts(pieces)
                    pieces = []
                yield _gain(origin, pairs, spread, known)

    salt = F.explode(F.sequence(F.lit(0), F.element_at(F.array(*map(F.lit, salts)), F.col("radix") + 1) - 1))
    sides = counts.select(
        "radix", salt.alias("salt"), F.lit(None).cast("long").alias("origin"), F.col("counts").alias("pairs"),
        F.lit(None).cast("binary").alias("spread"),
    )
    sent = stepped.where("pairs IS NOT NULL").withColumn("salt", _salt(salts)).select(*names).unionByName(sides)
    ordered = sent.repartition("radix", "salt").sortWithinPartitions("radix", "salt", F.col("origin").asc_nulls_first())
    return ordered.mapInArrow(run, "origin long, nth int, n_best long, count_sum long")


def _sorted_counts(pieces: list[list[np.ndarray]]) -> list[np.ndarray]:
    codes = np.concatenate([np.cumsum(p[0]) for p in pieces])
    order = np.argsort(codes)
    return [codes[order], *(np.concatenate([p[k] for p in pieces])[order] for k in (1, 2))]


def _gain(origin: int, pairs: bytes, spread: bytes, known: list[np.ndarray]) -> pa.RecordBatch:
    steps_, documents, _ = _unpack(pairs, *HEADER)
    texts, links = _unpack(spread, *SPREAD)
    codes, counts, best = known
    at = np.repeat(np.searchsorted(codes, np.cumsum(steps_)), documents)
    links = links.astype(np.int64)
    present, place = np.unique(texts, return_inverse=True)
    n_best, count_sum = np.zeros(len(present), np.int64), np.zeros(len(present), np.int64)
    np.add.at(n_best, place, links * best[at])
    np.add.at(count_sum, place, links * counts[at])
    return pa.RecordBatch.from_arrays(
        [pa.array([origin] * len(present), pa.int64()), pa.array(present, pa.int32()), pa.array(n_best), pa.array(count_sum)],
        names=["origin", "nth", "n_best", "count_sum"],
    )


def align(docs: DataFrame, path_a: str, path_b: str, group_records: int = GROUP_RECORDS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    ship(docs.sparkSession)
    stepped = cut(_stepped(docs, path_a, path_b))
    sizes = {r.radix: r.n for r in stepped.where("pairs IS NOT NULL").groupBy("radix").agg(F.sum("records").alias("n")).collect()}
    salts = [max(1, -(-sizes.get(r, 0) // group_records)) for r in range(RADIX)]
    counts = cut(_highest(_partial_counts(stepped, salts)))
    gains = _gains(stepped, counts, salts).groupBy("origin", "nth").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    rows = stepped.where("pairs IS NULL")
    return rows.join(gains, ["origin", "nth"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")), "groups_sha256",
    )
