"""URL filters: fixed rules for hosts and paths, then the reputation of the host.

Reputation is the rate of bad pages among a host's labelled ones. Few labels say little, so the rate is shrunk: a
suffix towards all pages, a registered domain towards its suffix, a host towards its domain, each with a beta prior whose
strength is estimated from how far the groups of that level differ. A host is blocked if even the lower bound of its
posterior rate is above the limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Public suffixes of two labels; all others are taken as one label.
DOUBLE_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "com.br", "com.cn", "com.mx", "co.in",
    "co.jp", "ne.jp", "or.jp", "co.kr", "com.tr", "co.za", "com.ar", "com.sg",
)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


@dataclass(frozen=True)
class Reputation:
    """Block where ``mean - z * deviation`` of the posterior rate of bad pages is above ``most_bad``."""

    most_bad: float = 0.25
    z: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 1000.0


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _levels(host: Column) -> dict[str, Column]:
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    double = F.substring_index(name, ".", -2).isin(*DOUBLE_SUFFIXES)
    suffix = F.when(F.size(labels) < 2, F.lit("")).when(double, F.substring_index(name, ".", -2)).otherwise(
        F.substring_index(name, ".", -1))
    domain = F.when(double, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return {"domain": domain, "suffix": suffix}


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule as text and its verdict; the longest that fits wins, null where none does."""
    name, verdict = None, None
    for kind, domain, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        name = F.when(fits, domain + prefix) if name is None else name.when(fits, domain + prefix)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def _strength(groups: DataFrame, limits: Reputation) -> float:
    """Prior strength from the variance between groups ``n, bad`` against that within them: four sums."""
    rate = F.col("bad") / F.col("n")
    sums = groups.agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("squares"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("within"), F.sum(F.col("n") * rate * rate).alias("second"),
    ).head()
    if not sums.n or sums.g < 2 or sums.n <= sums.g:
        return limits.most_strength
    mean = sums.bad / sums.n
    between = max(0.0, sums.second - sums.n * mean * mean) / (sums.g - 1)
    within = sums.within / (sums.n - sums.g)
    size = (sums.n - sums.squares / sums.n) / (sums.g - 1)
    if between <= within:
        return limits.most_strength
    return min(limits.most_strength, max(limits.least_strength, size * within / (between - within)))


def host_reputation(pages: DataFrame, outcomes: DataFrame, limits: Reputation = Reputation()) -> DataFrame:
    """``host, labelled, mean, bound`` of every host in ``pages`` (``page_id, host``), from ``outcomes`` (``page_id, bad``)."""
    told = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = pages.where("page_id IS NOT NULL").join(told, "page_id")
    counts = labelled.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").cast("bigint").alias("bad"))
    hosts = counts.withColumns(_levels(F.col("host"))).checkpoint()
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    all_pages = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).head()
    overall = all_pages.bad / all_pages.n if all_pages.n else 0.0
    of_host, of_domain, of_suffix = (_strength(level, limits) for level in (hosts, domains, suffixes))

    def shrunk(bad: str, n: str, prior: Column, strength: float) -> Column:
        return (F.coalesce(bad, F.lit(0)) + strength * prior) / (F.coalesce(n, F.lit(0)) + strength)

    named = pages.select("host").distinct().withColumns(_levels(F.col("host")))
    joined = named.join(hosts.select("host", F.col("n").alias("hn"), F.col("bad").alias("hb")), "host", "left")
    joined = joined.join(domains.select("domain", F.col("n").alias("dn"), F.col("bad").alias("db")), "domain", "left")
    joined = joined.join(suffixes.select("suffix", F.col("n").alias("sn"), F.col("bad").alias("sb")), "suffix", "left")
    posterior = joined.withColumn("ms", shrunk("sb", "sn", F.lit(overall), of_suffix)).withColumn(
        "md", shrunk("db", "dn", F.col("ms"), of_domain)).withColumn("mean", shrunk("hb", "hn", F.col("md"), of_host))
    weight = F.coalesce("hn", F.lit(0)) + of_host
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return posterior.select(
        "host", F.coalesce("hn", F.lit(0)).alias("labelled"), "mean", (F.col("mean") - limits.z * deviation).alias("bound"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
    limits: Reputation = Reputation(), page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate`` of every page.

    Nulls: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged as the host ``''``
    that has the labels of all such pages; null ids and null outcomes are no labels. Repeated pages are judged one by
    one; of repeated outcomes of a page the worst counts. Of rules of equal length the first in the alphabet wins.
    Without labels no host is blocked. An empty table gives an empty result. Other columns are ignored.
    """
    read = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = host_reputation(read.select("page_id", "host"), outcomes, limits)
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    told = read.join(known.select("host", "mean", "bound"), "host", "left")
    by_host = F.when(F.col("bound") > limits.most_bad, "block").otherwise("allow")
    return told.select(
        F.col("page_id").alias(page_id), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, by_host).alias("verdict"), F.round("mean", 4).alias("bad_rate"))
