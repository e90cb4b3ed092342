"""Quality rules: two base rules, then robust multivariate outliers by language and source.

Every document becomes five transformed statistics. Location and scatter of each language and
source are minimum-covariance-determinant estimates: from two starts (all rows; rows pulled in to
1.5 deviations) concentration steps keep the ``SHARE`` of rows of least Mahalanobis distance, and
the start with the smaller determinant wins. A step is one aggregation: moments by group and bin of
log distance, cumulated over the bins of a group until the share is reached. Groups below
``LEAST_GROUP`` rows are pooled within their language, then over all. Documents beyond the cut-off,
a chi-square quantile, are rejected.

Statistics are whole numbers of 1/1024, so their sums are exact and results repeat. Built-in
functions only; a hot source is one row per bin after map-side aggregation.

A null text has no words and fails the base rules, as does an empty one. Null languages and sources
are groups of their own. Repeated rows count, and are judged, each. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

STATISTICS = ("length", "word_length", "symbols", "dup_lines", "repeats")
P = len(STATISTICS)
UNIT = 1024
LEAST_WORDS, MOST_REPEATED = 50, 50
SHARE = 0.75
STEPS = 6
LEAST_GROUP = 100
#: Variance that every statistic has at least, as a deviation of 0.15: most documents have no symbols or repeats.
FLOOR = (0.15 * UNIT) ** 2
#: Probability of a normal document beyond the cut-off. At the floor alone a document goes beyond it by 82 % repeated
#: lines or 21 % repeated words, so each statistic can reject by itself.
TAIL = 1e-4
BINS_PER_UNIT = 32
BLANK = r"[\x09-\x0D ]"
#: Group tables up to this many rows (250 bytes each) are sent to all tasks, larger ones are shuffled.
SENT_GROUPS = 40_000


def chi_square(x: float, freedom: int) -> float:
    """Distribution function, by the series of the incomplete gamma function."""
    a, half = freedom / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a))) if x > 0 else 0.0


def chi_square_cutoff(tail: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if 1 - chi_square(middle, freedom) > tail else (low, middle)
    return high


def consistency(share: float, freedom: int) -> float:
    """What the scatter of the innermost share of normal rows must be multiplied by."""
    edge = chi_square_cutoff(1 - share, freedom)
    return share / chi_square(edge, freedom + 2)


# ---- statistics of one text ---------------------------------------------------------------


def _bound(value: Column, then) -> Column:
    """``then(x)`` with x evaluated once, also where it is used inside inner lambdas."""
    return F.transform(F.array(value), then)[0]


def _repeated_words(words: Column) -> Column:
    """Words in a 3-word window found twice or more.

    Hashes only rule out texts without repeats; elsewhere windows are sorted word for word, equal
    neighbours are marked, and the union of their spans is counted.
    """
    def windows(w: Column) -> Column:
        return F.sequence(F.lit(1), F.size(w) - 2)

    def hashed(w: Column) -> Column:
        return F.transform(windows(w), lambda i: F.xxhash64(w[i - 1], w[i], w[i + 1]))

    def exact(w: Column) -> Column:
        def entry(i: Column) -> Column:
            return F.struct(
                F.xxhash64(w[i - 1], w[i], w[i + 1]).alias("h"), w[i - 1].alias("a"), w[i].alias("b"),
                w[i + 1].alias("c"), i.alias("i"),
            )

        def same(x: Column, y: Column) -> Column:
            return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

        def marked(s: Column) -> Column:
            n = F.size(s)
            return F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, j: F.struct(
                                x["i"].alias("i"),
                                (
                                    ((j > 0) & same(x, F.get(s, j - 1))) | ((j < n - 1) & same(x, F.get(s, j + 1)))
                                ).alias("twice"),
                            ),
                        ),
                        lambda x: x["twice"],
                    ),
                    lambda x: x["i"],
                )
            )

        def covered(places: Column) -> Column:
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(
                places,
                start,
                lambda acc, i: F.struct(
                    (acc["n"] + i + 3 - F.greatest(acc["end"], i)).alias("n"), (i + 3).alias("end")
                ),
                lambda acc: acc["n"],
            )

        return _bound(F.sort_array(F.transform(windows(w), entry)), lambda s: covered(marked(s)))

    def counted(w: Column) -> Column:
        some = _bound(hashed(w), lambda h: F.size(F.array_distinct(h)) < F.size(h))
        return F.when(F.size(w) < 4, 0).when(some, exact(w)).otherwise(0)

    return _bound(words, counted)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the base counts and ``base_failed`` of every row, and ``mark``, a hash of its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), text.alias("text")
    )
    words = F.array_remove(F.split("text", BLANK + "+"), "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0)
    marks = F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))
    counts = rows.select(
        "doc_id", "lang", "source",
        F.xxhash64("text").alias("mark"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        marks.cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        _bound(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("r"))).alias("w"),
    )
    counts = counts.withColumn("n_words", F.col("w.n").cast("long")).withColumn(
        "n_repeat_words", F.col("w.r").cast("long")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counts.drop("w").withColumn("base_failed", failed)


def transformed() -> list[Column]:
    """The five statistics in units of 1/1024; only for rows with words."""
    n, chars = F.col("n_words"), F.col("word_chars")
    values = (
        F.log(n),
        4 * F.log(chars / n),
        F.log1p(200 * F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.col("n_lines")),
        2 * F.sqrt(F.col("n_repeat_words") / n),
    )
    return [F.round(v * UNIT).cast("long").alias(name) for name, v in zip(STATISTICS, values, strict=True)]


# ---- estimates ----------------------------------------------------------------------------

PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _moments(x: list[Column]) -> list[Column]:
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(P)]
    return [F.count("*").alias("n"), *sums, *(F.sum(x[i] * x[j]).alias(f"q{i}{j}") for i, j in PAIRS)]


MOMENTS = ["n", *(f"s{i}" for i in range(P)), *(f"q{i}{j}" for i, j in PAIRS)]


def _estimate(moments: DataFrame, factor: float = 1.0) -> DataFrame:
    """Means ``m``, inverse Cholesky factor ``k`` and log determinant of the scatter, from sums."""
    n = F.col("n").cast("double")
    out = moments
    for i in range(P):
        out = out.withColumn(f"m{i}", F.col(f"s{i}") / n)
    for i, j in PAIRS:
        scatter = (F.col(f"q{i}{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")) * factor
        out = out.withColumn(f"c{i}{j}", scatter + FLOOR if i == j else scatter)
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for t in range(j):
            rest = rest - F.col(f"l{i}{t}") * F.col(f"l{j}{t}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-3))) if i == j else rest / F.col(f"l{j}{j}"))
    for j in range(P):
        out = out.withColumn(f"k{j}{j}", 1 / F.col(f"l{j}{j}"))
        for i in range(j + 1, P):
            rest = F.lit(0.0)
            for t in range(j, i):
                rest = rest - F.col(f"l{i}{t}") * F.col(f"k{t}{j}")
            out = out.withColumn(f"k{i}{j}", rest / F.col(f"l{i}{i}"))
    logdet = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(1, P)), 2 * F.log("l00"))
    kept = [f"m{i}" for i in range(P)] + [f"k{i}{j}" for i, j in PAIRS]
    return out.select("group", "start", *kept, logdet.alias("logdet"))


def _distance() -> Column:
    total = F.lit(0.0)
    for i in range(P):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"k{i}{j}") * (F.col(STATISTICS[j]) - F.col(f"m{j}"))
        total = total + z * z
    return total


def _with_state(rows: DataFrame, state: DataFrame, groups: int) -> DataFrame:
    return rows.join(F.broadcast(state) if groups <= SENT_GROUPS else state, "group")


def _start(rows: DataFrame, groups: int) -> DataFrame:
    """Both starts: sums over all rows, and over rows pulled in to 1.5 deviations of the mean."""
    x = [F.col(c) for c in STATISTICS]
    plain = rows.groupBy("group").agg(*_moments(x)).withColumn("start", F.lit(0))
    edges = []
    for i in range(P):
        mean = F.col(f"s{i}") / F.col("n")
        deviation = F.sqrt(F.greatest(F.col(f"q{i}{i}") / F.col("n") - mean * mean, F.lit(FLOOR)))
        edges += [F.floor(mean - 1.5 * deviation).alias(f"a{i}"), F.ceil(mean + 1.5 * deviation).alias(f"b{i}")]
    pulled = [F.least(F.greatest(F.col(c), F.col(f"a{i}")), F.col(f"b{i}")) for i, c in enumerate(STATISTICS)]
    near = _with_state(rows, plain.select("group", *edges), groups)
    near = near.groupBy("group").agg(*_moments(pulled)).withColumn("start", F.lit(1))
    return _estimate(plain.unionByName(near))


def _concentrate(rows: DataFrame, state: DataFrame, groups: int) -> DataFrame:
    """One concentration step of every group and start."""
    step = _with_state(rows, state, groups)
    bins = F.floor(F.log(_distance() + 1e-6) * BINS_PER_UNIT).alias("bin")
    by_bin = step.groupBy("group", "start", bins).agg(*_moments([F.col(c) for c in STATISTICS]))
    inner = Window.partitionBy("group", "start").orderBy("bin")
    whole = Window.partitionBy("group", "start")
    cumulated = by_bin.select(
        "group", "start", "bin", F.sum("n").over(whole).alias("all"), *(F.sum(c).over(inner).alias(c) for c in MOMENTS)
    )
    reached = cumulated.where(F.col("n") >= SHARE * F.col("all")).groupBy("group", "start").agg(
        F.min_by(F.struct(*MOMENTS), "bin").alias("of")
    )
    return _estimate(reached.select("group", "start", "of.*"))


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds ``group``: language and source, or language, or all, whichever has enough rows."""
    def key(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))

    named = rows.withColumn("l", key("lang")).withColumn("s", key("source"))
    counts = named.groupBy("l", "s").agg(F.count("*").alias("n"))
    small = F.sum(F.when(F.col("n") < LEAST_GROUP, F.col("n"))).over(Window.partitionBy("l"))
    group = (
        F.when(F.col("n") >= LEAST_GROUP, F.concat_ws("\x00", "l", "s"))
        .when(F.col("small") >= LEAST_GROUP, F.col("l"))
        .otherwise("")
    )
    groups = counts.withColumn("small", small).select("l", "s", group.alias("group"))
    return named.join(groups, ["l", "s"]).drop("l", "s")


def estimates(rows: DataFrame) -> tuple[DataFrame, int]:
    """``group, m*, k*`` of each group's better start, scaled to normal rows, and the number of groups."""
    groups = rows.agg(F.approx_count_distinct("group")).first()[0]
    state = cut(_start(rows, groups))
    for _ in range(STEPS):
        state = cut(_concentrate(rows, state, groups))
    columns = [c for c in state.columns if c not in ("group", "start", "logdet")]
    best = state.groupBy("group").agg(F.min(F.struct("logdet", "start", *columns)).alias("of"))
    return best.select("group", *(F.col(f"of.{c}").alias(c) for c in columns)), groups


def judge(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Every row's ``doc_id``, ``mark``, counts, ``base_failed``, ``distance`` (null if not measured) and ``kept``."""
    counted = cut(statistics(docs))
    measured = counted.where("NOT base_failed").select("doc_id", "mark", "lang", "source", *transformed())
    grouped = cut(_grouped(measured))
    state, groups = estimates(grouped)
    # the scatter of the innermost share is too small for normal rows
    distance = _distance() / consistency(SHARE, P)
    judged = _with_state(grouped, state, groups).groupBy("doc_id", "mark").agg(F.max(distance).alias("distance"))
    named = judged.select(F.col("doc_id").alias("judged_id"), F.col("mark").alias("judged_mark"), "distance")
    same = F.col("doc_id").eqNullSafe(F.col("judged_id")) & (F.col("mark") == F.col("judged_mark"))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi_square_cutoff(tail, P))
    return counted.join(named, same, "left").drop("judged_id", "judged_mark").withColumn("kept", kept)
