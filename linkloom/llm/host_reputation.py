"""URL filter: empirical-Bayes host reputation.

Labelled page outcomes (good or bad) are counted per host. A host's rate is
shrunk towards its registered domain, the domain's towards its suffix and the
suffix's towards the overall rate, each by a beta prior whose weight is fitted to
the spread that the units of that level show (method of moments for the
beta-binomial). A page passes when the lower posterior bound of its host's rate
reaches ``min_rate``. A reviewed rule list goes first.

DataFrame functions only. Pages are reduced to one row per host by a partial
count before anything is shuffled; three one-row statistics reach the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, stage


#: Common public suffixes of two labels under which names are registered.
LONG_SUFFIXES = (
    "ac.jp", "ac.uk", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au",
    "com.bd", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk", "com.pl",
    "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "gob.mx", "gov.au", "gov.br", "gov.cn", "gov.in",
    "gov.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.nz", "org.uk", "org.za",
)
#: The suffix of IP addresses, each of which is a registered domain of its own.
ADDRESSES = "address"
_ADDRESS = r"^(\d+\.\d+\.\d+\.\d+|\[.*\])$"


@dataclass(frozen=True)
class ReputationSettings:
    min_rate: float = 0.5  # of good pages, that the bound must reach
    z: float = 1.645  # one-sided 95 % bound
    max_weight: float = 1000.0  # of a prior, in pages
    #: Suffixes of more than one label under which names are registered.
    long_suffixes: tuple[str, ...] = LONG_SUFFIXES


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule ``host/path`` that fits, else null. A rule
    fits its host and all subdomains when the path starts with the rule's path."""
    rule = verdict = F.lit(None).cast("string")
    for text, outcome in sorted(rules, key=lambda r: len(r[0])):  # the longest is tested first
        at = text.index("/")
        fits = ((host == text[:at]) | F.endswith(host, F.lit("." + text[:at]))) & F.startswith(path, F.lit(text[at:]))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return rule, verdict


def suffix_and_domain(host: Column, settings: ReputationSettings) -> tuple[Column, Column]:
    """Public suffix and registered domain of a host: the last label, or a listed
    longer suffix, and one label more. A port does not count; an IP address is its own domain."""
    name = F.regexp_replace(host, r":\d*$", "")
    long = "|".join(re.escape(s) for s in sorted(settings.long_suffixes, key=len, reverse=True)) or "(?!)"
    ends = F.regexp_extract(name, rf"(?:^|\.)({long})$", 1)
    suffix = F.when(ends != "", ends).otherwise(F.regexp_extract(name, r"([^.]*)$", 1))
    labels = F.split(name, r"\.")
    taken = F.size(F.split(suffix, r"\."))
    start = F.greatest(F.size(labels) - taken, F.lit(1))
    domain = F.array_join(F.slice(labels, start, taken + 1), ".")
    address = F.rlike(name, F.lit(_ADDRESS))
    return F.when(address, F.lit(ADDRESSES)).otherwise(suffix), F.when(address, name).otherwise(domain)


def _weight(units: DataFrame, settings: ReputationSettings) -> float:
    """Weight of the beta prior with mean ``m`` from which the units' rates seem drawn.

    E[(k - n m)^2] / (m (1 - m)) = n + n (n - 1) / (weight + 1), summed over units."""
    spread = F.pow(F.col("k") - F.col("n") * F.col("m"), 2) / (F.col("m") * (1 - F.col("m")))
    row = (
        units.where((F.col("n") > 0) & (F.col("m") > 0) & (F.col("m") < 1))
        .agg(F.sum(spread).alias("s"), F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("p"))
        .first()
    )
    if not row["p"] or row["s"] is None or row["s"] <= row["n"]:
        return settings.max_weight
    return min(settings.max_weight, max(1.0, row["p"] / (row["s"] - row["n"]) - 1))


def _posterior(weight: float) -> Column:
    return (F.col("k") + weight * F.col("m")) / (F.col("n") + weight)


def host_reputation(hosts: DataFrame, settings: ReputationSettings) -> DataFrame:
    """``hosts`` (host, n labelled pages, k good ones, one row per host; other
    columns stay) with ``rate`` and ``bound``, mean and lower bound of the host's
    posterior. Without any label every rate is one half."""
    suffix, domain = suffix_and_domain(F.col("host"), settings)
    hosts = hosts.withColumns({"suffix": suffix, "domain": domain})
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("units")]
    domains = stage(hosts.groupBy("domain", "suffix").agg(*counts), "domains")
    suffixes = domains.groupBy("suffix").agg(*counts)
    whole = domains.agg(*counts, F.sum("units").alias("hosts")).first()
    suffixes = suffixes.withColumn("m", F.lit(((whole["k"] or 0) + 1) / ((whole["n"] or 0) + 2)))
    suffixes = suffixes.select("suffix", "units", _posterior(_weight(suffixes, settings)).alias("m"))
    domains = attach(domains, suffixes, ["suffix"], "units", whole["units"], ["domain"]).withColumn("m", F.col("_found.m"))
    domains = domains.select("domain", "units", _posterior(_weight(domains, settings)).alias("m"))
    hosts = attach(hosts, domains, ["domain"], "units", whole["hosts"] or 0, ["host"]).withColumn("m", F.col("_found.m"))
    weight = _weight(hosts, settings)
    a = F.col("k") + weight * F.col("m")
    b = F.col("n") - F.col("k") + weight * (1 - F.col("m"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.withColumns({"rate": a / (a + b), "bound": a / (a + b) - settings.z * deviation}).drop("m", "_found")


def judge_pages(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str]],
    settings: ReputationSettings = ReputationSettings(),
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, rate, bound``.

    ``outcomes`` holds (page_id, good boolean); several rows of a page count as
    good only if all are, null outcomes and outcomes of unknown pages count
    nothing. A null or malformed url has the empty host, which is judged like any
    other. Repeated pages are judged (and counted) each. Columns of other names
    are not read."""
    urls = pages.select(F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    known = outcomes.where(F.col("good").isNotNull()).groupBy("page_id").agg(F.min("good").alias("good"))
    hosts = stage(
        urls.select("page_id", "host")
        .join(known, "page_id", "left")
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.count("good").alias("n"),
            F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("k"),
        ),
        "hosts",
    )
    total = hosts.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("n")).first()["n"]
    scores = stage(host_reputation(hosts, settings).select("host", "pages", "rate", "bound"), "host-scores")
    judged = attach(urls, scores, ["host"], "pages", total, ["page_id", "path"])
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("_found.bound") >= settings.min_rate, F.lit("allow")).otherwise(F.lit("block"))
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        F.col("_found.rate").alias("rate"), F.col("_found.bound").alias("bound"),
    )
