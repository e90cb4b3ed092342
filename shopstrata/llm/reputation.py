"""URL filter by rules first, then by the reputation of the host.

Reputation is empirical Bayes over labelled page outcomes (bad or not): the rate of a suffix is
shrunk towards the rate of all pages, a registered domain towards its suffix, a host towards its
domain. Each level has a beta-binomial prior whose mean is the parent's posterior mean and whose
weight comes from how much the level's counts spread beyond chance (method of moments). A page
without a rule is blocked where the lower posterior bound of its host's bad rate is over a limit.

Built-in functions only. Counts are pre-aggregated, so a host with a third of all pages is one row;
the join back to the pages is on that row, small or left to skew splitting.

A null url or one without ``://`` has an empty host and path: no rule fits it and it is judged like
any other host. A host without labels has its domain's rate. Repeated rows are judged, and counted,
each. Without any labels all pages that no rule fits are allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

#: Endings of two labels under which names are registered; fixed values, extended by the caller.
TWO_LABEL_SUFFIXES = ("co.jp", "co.uk", "com.au", "com.br", "org.uk")
#: Posterior standard deviations below the mean, and the bad rate the bound is held against.
BOUND, LIMIT = 1.645, 0.5
#: Weight of a prior whose level shows no spread, or nothing but spread.
LIGHTEST, HEAVIEST = 0.5, 1000.0


@dataclass(frozen=True)
class Rule:
    """``host`` covers itself and its subdomains, ``path`` every path that starts with it."""

    host: str
    path: str
    verdict: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty where there is no ``://``."""
    found = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest))
    return lower_ascii(host), F.regexp_extract(behind, r"^[^?#]*", 0)


def best_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest fitting rule as a struct (size, rule, verdict), else null; of equal ones the last verdict by name."""
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(
                F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"),
                F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


def domains(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    long = two.isin(*two_label)
    return F.when(long, three).otherwise(two), F.when(long, two).otherwise(F.substring_index(host, ".", -1))


def _shrunk(counts: DataFrame) -> DataFrame:
    """Adds ``weight`` and ``rate``, the posterior mean, to counts with ``n``, ``bad`` and the parent's rate ``prior``.

    The weight is one number for the level; by moments, (bad - n prior)^2 spreads (n - 1) times
    the intra-class correlation beyond chance.
    """
    chance = F.col("n") * F.col("prior") * (1 - F.col("prior"))
    spread = F.pow(F.col("bad") - F.col("n") * F.col("prior"), F.lit(2))
    moments = counts.where("n > 0").agg(
        F.sum(spread - chance).alias("over"), F.sum((F.col("n") - 1) * chance).alias("pairs")
    )
    ratio = F.when(F.col("pairs") > 0, F.col("over") / F.col("pairs"))
    weight = F.when(ratio > 0, F.least(F.lit(HEAVIEST), F.greatest(F.lit(LIGHTEST), 1 / ratio - 1)))
    one = moments.select(F.coalesce(weight, F.lit(HEAVIEST))).scalar()
    rate = (F.col("prior") * F.col("weight") + F.col("bad")) / (F.col("weight") + F.col("n"))
    return counts.withColumn("weight", one).withColumn("rate", rate)


def reputations(outcomes: DataFrame, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``host``, ``rate`` and ``bound`` of every host of ``(host, bad)``; ``bad`` is 0, 1, or null without a label."""
    domain, suffix = domains(F.col("host"), two_label)
    sums = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    by_host = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")
    )
    by_host = by_host.withColumn("domain", domain).withColumn("suffix", suffix)
    by_domain = by_host.groupBy("domain", "suffix").agg(*sums)
    by_suffix = by_domain.groupBy("suffix").agg(*sums)
    total = by_suffix.agg(F.try_divide(F.sum("bad"), F.sum("n"))).scalar()
    suffixes = _shrunk(by_suffix.withColumn("prior", total))
    named = _shrunk(by_domain.join(suffixes.select("suffix", F.col("rate").alias("prior")), "suffix"))
    hosts = _shrunk(by_host.join(named.select("domain", "suffix", F.col("rate").alias("prior")), ["domain", "suffix"]))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + F.col("n") + 1))
    return hosts.select("host", "rate", (F.col("rate") - BOUND * deviation).alias("bound"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page; outcomes are labelled by the rules that fit."""
    host, path = url_parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("best", best_rule(rules, F.col("host"), F.col("path")))
    bad = F.when(F.col("best").isNotNull(), (F.col("best.verdict") == "block").cast("int"))
    hosts = reputations(ruled.select("host", bad.alias("bad")))
    learned = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return ruled.join(hosts, "host").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", learned).alias("verdict"), "rate", "bound",
    )
