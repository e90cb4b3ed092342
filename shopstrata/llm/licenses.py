"""License scan: exact phrases, and an exact containment join of text blocks with notice templates.

A template is found in a block if at least ``THRESHOLD`` of its distinct words are in it. Words are
ordered from rare to frequent by their counts over the whole corpus. To share ``need`` of a
template's t words, a block must hold one of the template's t - need + 1 rarest words (prefix
filter), have ``need`` words at all (length filter), and, where the first common word is met, have
enough words left behind it on both sides (positional filter). What is left is counted exactly.

Blocks are lines, and the whole text as one line, for notices that wrap over lines; what is over
``BLOCK`` words is read as blocks of ``BLOCK`` words every ``STRIDE``, so a notice of up to
``STRIDE`` words is always whole in one. Templates and phrases are parameters
of a few hundred words and go to every task; the corpus is never shuffled.

A block has every template found in it: a cc-by-sa notice holds all of cc-by's words and has both labels.
Short notices differ by a word or two, less than the threshold leaves out, so a template may name
telling words; a block without all of them is no match, however many others it holds.

A null text is empty: no words, no labels, score 0. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_id, ship, steps

THRESHOLD = 0.8
BLOCK, STRIDE = 64, 32

# Exact phrases and their labels, and the words of common notices.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-4.0": "licensed under cc by 4 0",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose",
    "lgpl": "licensed under the gnu lesser general public license version",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
#: Words without which a notice is another one's.
TELLING = {
    "apache-2.0": "apache", "cc-by-nc-4.0": "nc", "cc-by-sa-4.0": "sa", "gpl-3.0": "gnu general", "lgpl": "lesser", "mit": "mit",
    "mpl-2.0": "mozilla", "unlicense": "unencumbered", "cc-by-4.0": "cc by",
}

#: Bytes of words stay (A-Z as a-z), a line's end stays, all else parts words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or b == 10 else 32 for b in range(256)
)
IN_WORD = np.array([FOLD[b] not in b" \n" for b in range(256)])
FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double"
)
_TYPES = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64()]


def count_words(text: bytes) -> int:
    inside = IN_WORD[np.frombuffer(text, np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]) + inside[0]) if len(inside) else 0


def blocks(words_by_line: list[list[bytes]]) -> Iterator[list[bytes]]:
    for words in words_by_line:
        last = max(0, len(words) - BLOCK)
        for at in [*range(0, last, STRIDE), last]:
            yield words[at : at + BLOCK]


@dataclass
class Index:
    """Templates by their rarest words."""

    rank: dict[bytes, int]
    templates: list[tuple[str, list[bytes], int, set[bytes]]]  # label, words from rare to frequent, how many, which
    by_word: dict[bytes, list[tuple[int, int]]]  # word of a prefix -> (template, place)

    @staticmethod
    def of(
        templates: dict[str, str], counts: dict[str, int], threshold: float, telling: dict[str, str] = TELLING
    ) -> Index:
        words = {label: sorted({w.encode() for w in text.split()}) for label, text in templates.items()}
        every = sorted({w for ws in words.values() for w in ws}, key=lambda w: (counts.get(w.decode(), 0), w))
        rank = {w: i for i, w in enumerate(every)}
        rows, by_word = [], {}
        for label, own in sorted(words.items()):
            own = sorted(own, key=rank.__getitem__)
            need = max(1, -(-round(threshold * len(own) * 10**6) // 10**6))
            for place in range(len(own) - need + 1):
                by_word.setdefault(own[place], []).append((len(rows), place))
            rows.append((label, own, need, {w.encode() for w in telling.get(label, "").split()}))
        return Index(rank, rows, by_word)

    def join(self, block: list[bytes]) -> dict[str, float]:
        """Containment of every template that reaches its threshold in the block."""
        own = sorted({w for w in block if w in self.rank}, key=self.rank.__getitem__)
        present, seen, out = set(own), set(), {}
        for at, word in enumerate(own):
            for number, place in self.by_word.get(word, ()):
                if number in seen:
                    continue
                seen.add(number)  # the first common word decides: all others lie behind it on both sides
                label, words, need, telling = self.templates[number]
                if len(own) < need or 1 + min(len(words) - place - 1, len(own) - at - 1) < need:
                    continue
                shared = sum(w in present for w in words)
                if shared >= need and telling <= present:
                    out[label] = shared / len(words)
        return out


def word_counts(docs: DataFrame, words: set[str]) -> dict[str, int]:
    """Occurrences of the given words over all documents."""
    wanted = {w.encode() for w in words}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for part in steps(batch, "text"):
                for text in part.column("text").to_pylist():
                    if text:
                        counts.update(filter(wanted.__contains__, text.translate(FOLD).split()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    rows = docs.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, "word string, n long")
    return {r.word: r.n for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_text(text: bytes, index: Index, phrases: list[tuple[list[bytes], str]], hints: list[bytes]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    folded = text.translate(FOLD)
    if not any(h in folded for h in hints):
        return count_words(text), 0, None, None, "", "", 0.0
    lines = [line.split() for line in folded.split(b"\n")]
    words = [w for line in lines for w in line]
    places: list[int] = []
    base: set[str] = set()
    for phrase, label in phrases:
        at = -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(phrase)] == phrase:
                places.append(at)
                base.add(label)
    scores: dict[str, float] = {}
    for block in blocks([*lines, words] if len(lines) > 1 else lines):
        for label, found in index.join(block).items():
            scores[label] = max(found, scores.get(label, 0.0))
    score = 1.0 if base else max(scores.values(), default=0.0)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted({*base, *scores})), score


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    telling: dict[str, str] = TELLING,
) -> DataFrame:
    """Base places, labels and the best containment of every document (1 where a phrase is found)."""
    ship(docs.sparkSession)
    index = Index.of(templates, word_counts(docs, {w for t in templates.values() for w in t.split()}), threshold, telling)
    exact = [([w.encode() for w in p.split()], label) for p, label in phrases.items()]
    # a text without any of these bytes can hold neither a phrase nor a prefix word
    hints = sorted({max(p, key=len) for p, _ in exact} | set(index.by_word), key=len, reverse=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                rows = [scan_text(t or b"", index, exact, hints) for t in part.column("text").to_pylist()]
                columns = [part.column("doc_id").to_pylist(), *map(list, zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(columns, _TYPES, strict=True)],
                    names=[c.split()[0] for c in FOUND.split(", ")],
                )

    return docs.select(long_id(docs), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, FOUND)
