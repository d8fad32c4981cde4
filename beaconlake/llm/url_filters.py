"""URL filters: rules on host and path, and the reputation of hosts learnt from labelled pages.

Reputation is empirical Bayes. A host's labelled outcomes (good or bad) shrink towards its registered domain, the domain
towards its suffix, and the suffix towards all pages. At each level the strength of the prior is the beta-binomial's,
estimated by moments from how far the groups differ beyond chance. A host is blocked when even the upper bound of its
posterior share of good pages stays below a limit, so little evidence never blocks.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets the method's
verdict for the empty host. Without labelled outcomes everything not ruled out is allowed. Repeated pages are judged
alike; labels that contradict each other count as bad. Columns other than those named here are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.llm.common import LOWER, UPPER, broadcast_if_small, table, written

Rule = tuple[str, str, str]

#: Suffixes of more than one label under which names are registered, besides each last label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")

MIN_GOOD = 0.5
BOUND_Z = 1.645
MAX_STRENGTH = 1000.0


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    found = F.instr(url, "://")
    return F.when(found > 0, F.substr(url, found + 3)).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, its verdict): the longest rule whose host is this host or a parent of it and whose path begins the path.

    ``rules`` are (verdict, host, path); a given list, not a table that grows with the pages.
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def suffix_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*long_suffixes), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*long_suffixes), F.substring_index(host, ".", -3)).otherwise(last_two)


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the mean share of good outcomes and the prior strength that the spread between groups implies."""
    sums = groups.agg(
        F.sum("good").cast("double").alias("x"), F.sum("n").cast("double").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"), F.count(F.lit(1)).cast("double").alias("k"),
        F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("xx"),
    )
    mean = F.coalesce(F.col("x") / F.nullif("n", F.lit(0.0)), F.lit(0.5))
    chance = F.col("p") * (1 - F.col("p"))
    spread = F.col("xx") - F.col("n") * F.col("p") * F.col("p")
    room = chance * (F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1))
    rho = F.coalesce((spread - chance * (F.col("k") - 1)) / F.when(room > 0, room), F.lit(0.0))
    low = 1 / (MAX_STRENGTH + 1)
    rho = F.greatest(F.lit(low), F.least(F.lit(0.999), rho))
    return sums.withColumn("p", mean).select(F.col("p").alias("mean"), (1 / rho - 1).alias("strength"))


def _posterior(groups: DataFrame, prior_mean: str) -> DataFrame:
    """Adds ``mean`` and ``weight`` (the posterior's two numbers); the level's strength is one number."""
    strength = F.lit(_strength(groups).first().strength)
    weight = strength + F.col("n")
    return groups.select(
        *[c for c in groups.columns if c != prior_mean],
        ((strength * F.col(prior_mean) + F.col("good")) / weight).alias("mean"), weight.alias("weight"),
    )


def reputations(outcomes: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> dict[str, DataFrame]:
    """Posterior per ``host``, ``domain`` and ``suffix`` from (host, good, n) outcomes."""
    hosts = outcomes.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    hosts = hosts.select(
        "*", domain_of(F.col("host"), long_suffixes).alias("domain"), suffix_of(F.col("host"), long_suffixes).alias("suffix")
    )
    hosts = written(hosts, "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    suffixes = written(suffixes, "url-suffixes")
    suffixes = _posterior(suffixes.withColumn("prior", F.lit(_strength(suffixes).first().mean)), "prior")
    domains = domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains = _posterior(written(domains, "url-domains"), "prior")
    hosts = hosts.join(domains.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"])
    hosts = _posterior(written(hosts, "url-host-priors"), "prior")
    return {"host": hosts, "domain": domains, "suffix": suffixes}


def upper_bound(mean: Column, weight: Column, z: float = BOUND_Z) -> Column:
    """Upper bound of the posterior share of good pages, by the beta distribution's mean and variance."""
    return mean + z * F.sqrt(mean * (1 - mean) / (weight + 1))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], min_good: float = MIN_GOOD, z: float = BOUND_Z,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, good_bound) for each row of ``pages`` (page_id, url).

    ``outcomes`` has (host, good, n): good ones among n labelled pages. A host without outcomes takes the posterior of
    its domain, then of its suffix; a suffix without any is allowed. Only hosts that occur are looked up, so the pages
    themselves are joined once, with one row per host.
    """
    levels = reputations(outcomes, long_suffixes)
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rated = parsed.select("host").distinct().select(
        "host", domain_of(F.col("host"), long_suffixes).alias("domain"), suffix_of(F.col("host"), long_suffixes).alias("suffix")
    )
    for level, keys in (("host", ["host"]), ("domain", ["domain", "suffix"]), ("suffix", ["suffix"])):
        one = levels[level].select(*keys, F.col("mean").alias(f"mean_{level}"), F.col("weight").alias(f"weight_{level}"))
        rated = rated.join(one, keys, "left")
    mean = F.coalesce("mean_host", "mean_domain", "mean_suffix", F.lit(1.0))
    weight = F.coalesce("weight_host", "weight_domain", "weight_suffix", F.lit(1.0))
    rated = written(rated.select("host", upper_bound(mean, weight, z).alias("good_bound")), "url-bounds")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("good_bound") < min_good, "block").otherwise("allow")
    return parsed.join(broadcast_if_small(rated), "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), "good_bound"
    )


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good, n) of pages whose document is labelled: the last number in a page's path is the document's id.

    Pages are counted by host and document before the join, so a host or document that holds many pages is one row.
    """
    path = path_of(F.col("url"))
    number = F.expr("try_cast(number as bigint)")
    counted = (
        pages.select(host_of(F.col("url")).alias("host"), F.regexp_extract(path, r"/(\d+)(\.\w+)?/?$", 1).alias("number"))
        .select("host", number.alias("doc_id")).where("doc_id is not null")
        .groupBy("host", "doc_id").agg(F.count(F.lit(1)).alias("pages"))
    )
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return counted.join(good, "doc_id").groupBy("host").agg(
        F.sum(F.col("pages") * F.col("quality")).alias("good"), F.sum("pages").alias("n")
    )


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page, by the contract's rules and, where none fits, by the host's reputation."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = labelled_outcomes(pages, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return filter_urls(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")
