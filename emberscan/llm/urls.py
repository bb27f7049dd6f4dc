"""URL filters: host reputation by empirical Bayes, under explicit rules.

Labelled pages give every host a count of outcomes and of bad ones. A host's
share of bad pages is shrunk towards that of its registered domain, that one
towards its suffix, and that one towards the share of all pages. Each step is
a beta-binomial: the parent's shrunk share is the prior mean, the prior's
strength is estimated from all groups of the level by the method of moments. A
host is blocked when the lower bound of its posterior exceeds the limit.

Everything is counted per host first (partial sums before the shuffle), so the
levels work on one row per host; a host holding a third of all pages is one
row there. Pages meet their host's row by an equi-join, which adaptive
execution splits where a host is hot.

Defined results: a null url or one without `://` has an empty host and path; an
empty host has no rule and is allowed. Labels whose quality and toxicity are both null say
nothing; repeated labels of a page count once, bad if any is bad. Without any
label every host is allowed. Repeated pages are judged alike; other columns pass
through, except those of the result's names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.guards import broadcast_if_small
from .shared import keep, lower_ascii

# --- Fixed values: rules, and suffixes of two labels under which domains are registered ---
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DOUBLE_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br",
    "co.in", "com.cn", "com.mx", "co.za", "com.tr", "co.kr", "com.sg", "co.id",
)
# ------------------------------------------------------------------------------------------

MAX_BAD = 0.35  # block when more than this share of a host's pages is surely bad
Z = 1.645  # one-sided 95 %
STRENGTH = (0.5, 1e6)  # bounds of a prior's strength, in pages
DEFAULT_STRENGTH = 10.0  # where no group has two labelled pages
LEVELS = ("suffix", "domain", "host")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path as the contract cuts them."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def registered(host: Column) -> dict[str, Column]:
    """Suffix and registered domain; user and port do not count. A host of one label is its own domain."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    double = F.substring_index(name, ".", -2)
    in_double = double.isin(*DOUBLE_SUFFIXES)
    return {
        "suffix": F.when(in_double, double).otherwise(F.substring_index(name, ".", -1)),
        "domain": F.when(in_double, F.substring_index(name, ".", -3)).otherwise(double),
    }


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule fitting host (or a parent of it) and path, and its verdict; nulls where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def outcomes(labels: DataFrame, page_id: str = "doc_id") -> DataFrame:
    """One row per labelled page: bad 0 or 1."""
    bad = F.greatest(
        (F.col("quality") == 0).cast("bigint"), (F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("bigint")
    )
    said = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return (
        labels.where(said & F.col(page_id).isNotNull())
        .groupBy(F.col(page_id).alias("page_id"))
        .agg(F.max(F.coalesce(bad, F.lit(0))).alias("bad"))
    )


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the strength of the beta prior whose means are the groups' `mu`, by moments of pairs of pages."""
    n, k, mu = F.col("n").cast("double"), F.col("k").cast("double"), F.col("mu")
    pairs = n * (n - 1)
    rho = (F.sum(k * (k - 1)) - F.sum(pairs * mu * mu)) / F.nullif(F.sum(pairs * mu * (1 - mu)), F.lit(0.0))
    low, high = STRENGTH
    found = F.when(rho > 1 / (high + 1), F.greatest(1 / F.least(rho, F.lit(1.0)) - 1, F.lit(low))).otherwise(high)
    return groups.agg(F.when(rho.isNull(), F.lit(DEFAULT_STRENGTH)).otherwise(found).alias("m"))


def reputation(hosts: DataFrame) -> DataFrame:
    """Counts per host (host, suffix, domain, n, k) with the posterior `bad_rate` and its lower `bad_bound`.

    The strengths are single rows, joined without keys; all else joins on the parent's name.
    """
    hosts = keep(hosts)
    overall = hosts.agg(F.sum("k").cast("double").alias("k"), F.sum("n").cast("double").alias("n")).select(
        F.coalesce(F.col("k") / F.nullif(F.col("n"), F.lit(0.0)), F.lit(0.0)).alias("mu")
    )
    frame = hosts
    parent: str | None = None
    for level in LEVELS:
        keys = list(dict.fromkeys(filter(None, (level, parent))))
        groups = frame.groupBy(*keys, "mu").agg(F.sum("n").alias("n"), F.sum("k").alias("k")) if parent else (
            frame.groupBy(level).agg(F.sum("n").alias("n"), F.sum("k").alias("k")).join(F.broadcast(overall))
        )
        groups = keep(groups)
        groups = groups.join(F.broadcast(_strength(groups)))
        a = F.col("k") + F.col("m") * F.col("mu")
        total = F.col("n") + F.col("m")
        groups = groups.select(level, (a / total).alias("_mean"), total.alias("_total"))
        frame = keep(frame.drop("mu").join(groups, level, "left").withColumnRenamed("_mean", "mu"))
        frame = frame if level == LEVELS[-1] else frame.drop("_total")
        parent = level
    p = F.col("mu")
    bound = F.greatest(p - Z * F.sqrt(p * (1 - p) / (F.col("_total") + 1)), F.lit(0.0))
    return frame.select("host", F.col("n").alias("n_labelled"), p.alias("bad_rate"), bound.alias("bad_bound"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_bad: float = MAX_BAD,
) -> DataFrame:
    """Every page with host, path, rule, n_labelled, bad_rate, bad_bound and verdict.

    `labels` holds outcomes by the page's id. Only hosts that have a page are
    rated; the rule, where one fits, decides alone.
    """
    made = ("host", "path", "rule", "verdict", "n_labelled", "bad_rate", "bad_bound")
    host, path = parts(F.col("url"))
    cut = pages.drop(*made).withColumns({"host": host, "path": path})
    seen = cut.select("page_id", "host").where(F.col("page_id").isNotNull()).dropDuplicates(["page_id", "host"])
    counted = (
        seen.join(outcomes(labels), "page_id")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("k"))
    )
    hosts = (
        cut.select("host").distinct().join(counted, "host", "left")
        .select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"))
        .withColumns(registered(F.col("host")))
    )
    rated = broadcast_if_small(reputation(hosts))
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    by_host = F.when((F.col("host") != "") & (F.col("bad_bound") > max_bad), F.lit("block")).otherwise(F.lit("allow"))
    return (
        cut.join(rated, "host", "left")
        .withColumns({"rule": rule, "_said": decision})
        .withColumn("verdict", F.coalesce("_said", by_host))
        .drop("_said")
    )


def allowed(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The pages that may stay, with their own columns."""
    judged = judge(pages.withColumn("_row", F.struct(*pages.columns)), labels, **options)
    return judged.where("verdict = 'allow'").select("_row.*")
