"""Language of whole texts by a linear-chain conditional random field over their words.

Every word is labelled with a language. Its features are the word itself (lexicon), its prefixes
and suffixes of one to three letters, and its letter pairs and triples, hashed to ``BUCKETS``;
label transitions are learned with them, so a text may switch language between words. Marginals
come from forward-backward over each line; a text's language is the one with the most mass.

The model is fitted on the driver to a bounded sample: ``SAMPLE`` rows a language at most, and of
these ``SAMPLE_WORDS`` words. Half of the training lines are spliced from two languages, so that
transitions are seen. Features of a batch's distinct words are computed once, all in arrays.

Words are runs of letters. A null text, or one without a letter, is ``und`` with score 0. Rows
without a language are not learned from. Without any labelled row every text is ``und``. Repeated
rows give repeated rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import long_id, ship, steps

BUCKETS = 1 << 16
SAMPLE, SAMPLE_WORDS = 300, 60_000
ROUNDS, BATCH, RATE, DECAY = 4, 256, 0.3, 1e-6
LONGEST_LINE = 60
UNDETERMINED = "und"
MARKS = re.compile(r"[^\W\d_]+")
PREDICTED = "doc_id long, lang_pred string, score double"


def words_of(line: str) -> list[str]:
    """Runs of letters; signs that only count (fractions, raised or Roman numerals) may stand beside letters, not alone."""
    found = MARKS.findall(line)
    return found if line.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


# ---- features -----------------------------------------------------------------------------


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one after the other, and where each word's begin."""
    lowered = [w.lower() for w in words]
    marked = "".join(f"\x02{w}\x03" for w in lowered)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in lowered), np.int64, len(lowered))
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(kind: int, owners: np.ndarray, values: np.ndarray) -> None:
        mixed = (values + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        found.append((owners, (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)))

    base = np.uint64(1_000_003)
    for n in (2, 3):  # letter groups, with the marks of the word's ends
        grams = codes[: max(0, len(codes) - n + 1)].copy()
        for k in range(1, n):
            grams = grams * base + codes[k : len(codes) - n + 1 + k]
        inside = np.flatnonzero(owner[: len(grams)] == owner[n - 1 :]) if len(grams) else np.zeros(0, np.int64)
        add(n, owner[inside], grams[inside])
    letters = sizes - 2
    for n in (1, 2, 3):  # affixes
        long = np.flatnonzero(letters >= n)
        prefix, suffix = np.zeros(len(long), np.uint64), np.zeros(len(long), np.uint64)
        for k in range(n):
            prefix = prefix * base + codes[first[long] + 1 + k]
            suffix = suffix * base + codes[first[long] + 1 + letters[long] - n + k]
        add(10 + n, long, prefix)
        add(20 + n, long, suffix)
    lexicon = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in lowered), np.uint64, len(lowered))
    add(31, np.arange(len(words)), lexicon)
    owners = np.concatenate([o for o, _ in found])
    order = np.argsort(owners, kind="stable")
    values = np.concatenate([v for _, v in found])[order]
    counts = np.bincount(owners, minlength=len(words))
    return values, np.cumsum(counts) - counts


def emissions(weights: np.ndarray, values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's features, by label."""
    return np.stack([np.add.reduceat(column[values], begins) for column in weights], axis=1) if len(begins) else np.zeros((0, len(weights)))


# ---- forward-backward ---------------------------------------------------------------------


@dataclass
class Lattice:
    """Words of many lines in the order of their place in the line, longest line first."""

    order: np.ndarray  # word numbers
    active: np.ndarray  # lines that have a word at each place

    @staticmethod
    def of(begins: np.ndarray, sizes: np.ndarray) -> Lattice:
        longest_first = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[longest_first], sizes[longest_first]
        places = np.arange(sizes[0]) if len(sizes) else np.zeros(0, np.int64)
        active = np.searchsorted(-sizes, -places, side="left")  # sizes > place
        line = np.arange(active.sum()) - np.repeat(np.cumsum(active) - active, active)
        return Lattice(begins[line] + np.repeat(places, active), active)


def marginals(emitted: np.ndarray, moves: np.ndarray, start: np.ndarray, lattice: Lattice):
    """Label probabilities of each word, expected label pairs, and label mass at line starts."""
    labels = len(start)
    scores = emitted[lattice.order]
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, first = np.exp(moves), np.exp(start)
    at = np.concatenate([[0], np.cumsum(lattice.active)])
    alpha, scale = np.empty_like(scores), np.empty(len(scores))
    for t in range(len(lattice.active)):
        now = slice(at[t], at[t + 1])
        if t:
            into = alpha[at[t - 1] : at[t - 1] + lattice.active[t]] @ step
            into *= scores[now]
        else:
            into = scores[now] * first
        total = into.sum(axis=1)
        alpha[now], scale[now] = into / total[:, None], total
    beta = np.ones_like(scores)
    pairs = np.zeros((labels, labels))
    for t in range(len(lattice.active) - 2, -1, -1):
        n, nxt = lattice.active[t + 1], slice(at[t + 1], at[t + 2])
        behind = scores[nxt] * beta[nxt] / scale[nxt, None]
        pairs += (alpha[at[t] : at[t] + n].T @ behind) * step
        beta[at[t] : at[t] + n] = behind @ step.T
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    out = np.empty_like(gamma)
    out[lattice.order] = gamma
    return out, pairs, gamma[: lattice.active[0]].sum(axis=0) if len(lattice.active) else np.zeros(labels)


# ---- model --------------------------------------------------------------------------------


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # [label, bucket]
    moves: np.ndarray  # [from, to]
    start: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The label with the most mass over a text's words, and its mean probability."""
        if not self.labels:
            return [(UNDETERMINED, 0.0)] * len(texts)
        numbers: dict[str, int] = {}
        words: list[int] = []
        line_sizes: list[int] = []
        text_words = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(words)
            for line in (text or "").split("\n"):
                found = words_of(line)
                if found:
                    words.extend([numbers.setdefault(w, len(numbers)) for w in found])
                    line_sizes.append(len(found))
            text_words[i] = len(words) - before
        if not words:
            return [(UNDETERMINED, 0.0)] * len(texts)
        values, begins = features(list(numbers))
        emitted = emissions(self.weights, values, begins)[np.array(words)]
        sizes = np.array(line_sizes)
        gamma, _, _ = marginals(emitted, self.moves, self.start, Lattice.of(np.cumsum(sizes) - sizes, sizes))
        owner = np.repeat(np.arange(len(texts)), text_words)
        mass = np.stack([np.bincount(owner, g, len(texts)) for g in gamma.T], axis=1)
        share = mass / np.maximum(1, text_words)[:, None]
        best = share.argmax(axis=1)
        return [
            (self.labels[b], float(min(1.0, s[b]))) if n else (UNDETERMINED, 0.0)
            for b, s, n in zip(best.tolist(), share, text_words.tolist(), strict=True)
        ]


def _lines(text: str) -> list[list[str]]:
    out = []
    for line in text.split("\n"):
        words = words_of(line)
        out += [words[k : k + LONGEST_LINE] for k in range(0, len(words), LONGEST_LINE)]
    return out


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Maximum conditional likelihood by stochastic gradients with adaptive rates, over ``(language, text)`` rows."""
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((0, 0)), np.zeros(0))
    random = np.random.default_rng(seed)
    lines: list[list[list[str]]] = [[] for _ in labels]
    for k, label in enumerate(labels):
        room = SAMPLE_WORDS
        own = [line for lang, text in rows if lang == label for line in _lines(text)]
        for i in random.permutation(len(own)):
            if room <= 0:
                break
            lines[k].append(own[i])
            room -= len(own[i])
    plain = [(line, [k] * len(line)) for k, own in enumerate(lines) for line in own]
    if not plain:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((0, 0)), np.zeros(0))
    mixed = []
    for i in random.permutation(len(plain)):  # the head of a line and the tail of another
        (a, x), (b, y) = plain[i], plain[random.integers(len(plain))]
        p, q = random.integers(len(a) + 1), random.integers(len(b) + 1)
        if p + len(b) - q:
            mixed.append((a[:p] + b[q:], x[:p] + y[q:]))
    examples = plain + mixed
    numbers: dict[str, int] = {}
    encoded = [np.array([numbers.setdefault(w, len(numbers)) for w in words]) for words, _ in examples]
    truth = [np.array(t) for _, t in examples]
    values, begins = features(list(numbers))
    sizes = np.diff(np.append(begins, len(values)))
    n = len(labels)
    model = Model(labels, np.zeros((n, BUCKETS)), np.zeros((n, n)), np.zeros(n))
    squares = [np.full_like(a, 1e-3) for a in (model.weights, model.moves, model.start)]
    for _ in range(ROUNDS):
        order = random.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            words, gold = np.concatenate([encoded[i] for i in chosen]), np.concatenate([truth[i] for i in chosen])
            lengths = np.array([len(encoded[i]) for i in chosen])
            starts = np.cumsum(lengths) - lengths
            count = sizes[words]
            own = np.repeat(np.arange(len(words)), count)
            flat = values[np.repeat(begins[words], count) + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)]
            emitted = emissions(model.weights, flat, np.cumsum(count) - count)
            gamma, pairs, heads = marginals(emitted, model.moves, model.start, Lattice.of(starts, lengths))
            wrong = -gamma
            wrong[np.arange(len(words)), gold] += 1
            seen = np.zeros((n, n))
            inner = np.ones(len(words), bool)
            inner[starts] = False
            np.add.at(seen, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            ahead = np.bincount(gold[starts], minlength=n) - heads
            gradient = np.stack([np.bincount(flat, wrong[own, k], BUCKETS) for k in range(n)])
            for parameter, square, g in zip(
                (model.weights, model.moves, model.start), squares, (gradient, seen - pairs, ahead), strict=True
            ):
                g = g / len(words) - DECAY * parameter
                square += g * g
                parameter += RATE * g / np.sqrt(square)
    return model


def in_training(doc_id: Column) -> Column:
    """False for the held-out quarter of documents, and for those without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``per_language`` labelled training texts of each language, by least hash of their id."""
    known = docs.where(in_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return []
    spark = docs.sparkSession
    # a hash limit a little above the bound, so no language is sorted as a whole
    limits = spark.createDataFrame(
        [(k, min(1.0, 1.2 * per_language / v + 1e-9) * (1 << 32)) for k, v in counts.items()], "lang string, below double"
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    rows = known.join(F.broadcast(limits), "lang").where(place < F.col("below"))
    found = rows.select("lang", "text", place.alias("place"), F.col("doc_id").alias("id")).collect()
    out: list[tuple[str, str]] = []
    for lang in sorted(counts):
        own = sorted((r for r in found if r.lang == lang), key=lambda r: (r.place, r.id, r.text))
        out += [(lang, r.text) for r in own[:per_language]]
    return out


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its text alone; long columns in ``keep`` are handed through."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # labels x BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", 1 << 20):
                found = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([l for l, _ in found], pa.string()),
                        pa.array([s for _, s in found], pa.float64()), *(part.column(c) for c in keep),
                    ],
                    names=["doc_id", "lang_pred", "score", *keep],
                )

    rows = docs.select(long_id(docs), F.col("text").cast("string"), *keep)
    return rows.mapInArrow(run, ", ".join([PREDICTED, *(f"{c} long" for c in keep)]))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the training rows of the same table."""
    rows = predict(docs, fit(sample(docs)))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
