"""URL filters: explicit rules first, host reputation by empirical Bayes for the rest.

Labelled page outcomes are counted per host.  A beta-binomial prior is carried down
from all pages to the suffix, from there to the registered domain and on to the host:
each level is shrunk towards the mean of the level above with a strength that the
spread of that level's own rates decides.  A host is blocked when the lower bound of
its posterior rate of bad pages is above the limit; a host without labelled pages is
judged by what the nearest level above it that has some says of a new host.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.columns import UPPER

MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``site`` is a host and the beginning of a path, like ``example.org/en/``."""

    verdict: str
    site: str

    @property
    def host(self) -> str:
        return self.site.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.site[len(self.host):]


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column, suffix_labels: int = 1) -> Column:
    """The suffix of the host, which has ``suffix_labels`` labels, and one label before it."""
    return F.substring_index(host, ".", -(suffix_labels + 1))


def suffix(host: Column, suffix_labels: int = 1) -> Column:
    return F.substring_index(host, ".", -suffix_labels)


def best_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """``(site, verdict)`` of the longest rule that fits, else null.

    At most ``MAX_RULES`` rules, tested in the row.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    chosen = None
    for rule in sorted(rules, key=lambda r: (-len(r.site), r.site)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.site).alias("site"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return F.lit(None).cast("struct<site:string,verdict:string>") if chosen is None else chosen


def _strength(groups: DataFrame, n: Column, bad: Column, mean: Column) -> float:
    """Prior strength of a level: how many pages the level above is worth.

    Method of moments: the variance of the groups' rates around ``mean`` beyond what
    drawing n pages explains.  No such variance leaves the strongest prior, 10,000.
    """
    rate = bad / n
    row = groups.filter(n > 1).agg(
        F.sum(n * (rate - mean) * (rate - mean)).alias("spread"),
        F.sum(mean * (1 - mean)).alias("drawn"), F.sum((n - 1) * mean * (1 - mean)).alias("room"),
    ).first()
    if not row["room"]:
        return 10_000.0
    between = min(max((row["spread"] - row["drawn"]) / row["room"], 1e-4), 0.99)
    return round(1 / between - 1, 6)


@dataclass(frozen=True)
class Levels:
    """What is known of labelled hosts, domains and suffixes, and the prior strength of each level."""

    hosts: DataFrame  # host, a, b
    domains: DataFrame  # domain, mean_domain
    suffixes: DataFrame  # suffix, mean_suffix
    overall: Column
    strengths: dict[str, float]

    def strength_below(self, *levels: str) -> Column:
        """Prior strength of a host when there is no outcome of these levels: their spreads together."""
        same = 1.0
        for level in levels:
            k = self.strengths[level]
            same *= k / (k + 1)
        return F.lit(same / (1 - same))

    def posteriors(self, hosts: DataFrame) -> DataFrame:
        """``(host, a, b)`` for each row of ``hosts``; of those without outcomes by the nearest level that has some."""
        keyed = hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))})
        found = keyed.join(self.hosts, "host", "left").join(self.domains, "domain", "left").join(
            self.suffixes, "suffix", "left")
        mean = F.coalesce("mean_domain", "mean_suffix", self.overall)
        strength = F.when(F.col("mean_domain").isNotNull(), self.strength_below("host")).when(
            F.col("mean_suffix").isNotNull(), self.strength_below("host", "domain")
        ).otherwise(self.strength_below("host", "domain", "suffix"))
        return found.select(
            "host", F.coalesce("a", strength * mean).alias("a"),
            F.coalesce("b", strength * (1 - mean)).alias("b"))


def levels(outcomes: DataFrame, host: str = "host", bad: str = "bad") -> Levels:
    """The posteriors of all levels.

    ``outcomes`` has one row per labelled page, ``bad`` 0 or 1; rows with a null in
    either column are left out.  The three prior strengths are numbers on the driver,
    everything else is grouped and joined.
    """
    hosts = outcomes.filter(F.col(host).isNotNull() & F.col(bad).isNotNull()).groupBy(
        F.col(host).alias("host")
    ).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(bad).cast("double").alias("bad"))
    hosts = hosts.withColumns({
        "domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host")),
    })
    domains = hosts.groupBy("suffix", "domain").agg(
        F.sum("n").alias("n_domain"), F.sum("bad").alias("bad_domain"))
    suffixes = domains.groupBy("suffix").agg(
        F.sum("n_domain").alias("n_suffix"), F.sum("bad_domain").alias("bad_suffix"))
    total = suffixes.agg(F.sum("n_suffix").alias("n"), F.sum("bad_suffix").alias("bad")).first()
    overall = F.lit((total["bad"] + 1) / (total["n"] + 2) if total["n"] else 0.5)
    strengths = {}

    def shrunk(level: DataFrame, name: str, prior: Column) -> DataFrame:
        n, bad_pages = F.col(f"n_{name}"), F.col(f"bad_{name}")
        strength = _strength(level.withColumn("_prior", prior), n, bad_pages, F.col("_prior"))
        strengths[name] = strength
        return level.withColumn(f"mean_{name}", (bad_pages + strength * prior) / (n + strength))

    suffixes = shrunk(suffixes, "suffix", overall)
    domains = shrunk(domains.join(suffixes, "suffix"), "domain", F.col("mean_suffix"))
    named = hosts.withColumnsRenamed({"n": "n_host", "bad": "bad_host"}).join(
        domains.select("domain", "mean_domain"), "domain")
    prior = F.col("mean_domain")
    strength = _strength(named.withColumn("_prior", prior), F.col("n_host"), F.col("bad_host"), F.col("_prior"))
    strengths["host"] = strength
    known = named.select(
        "host", (F.col("bad_host") + strength * prior).alias("a"),
        (F.col("n_host") - F.col("bad_host") + strength * (1 - prior)).alias("b"),
    )
    return Levels(known, domains.select("domain", "mean_domain"), suffixes.select("suffix", "mean_suffix"),
                  overall, strengths)


def reputations(outcomes: DataFrame, host: str = "host", bad: str = "bad") -> DataFrame:
    """``(host, a, b)``: the posterior beta distribution of the rate of bad pages of each labelled host."""
    return levels(outcomes, host, bad).hosts


def lower_bound(a: Column, b: Column, deviations: float) -> Column:
    """Posterior mean less ``deviations`` posterior standard deviations."""
    n = a + b
    return a / n - deviations * F.sqrt(a * b / (n * n * (n + 1)))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = (), url: str = "url",
    limit: float = 0.5, deviations: float = 1.645,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``bound`` and ``verdict``.

    ``outcomes`` is ``(url, bad)``.  A host without outcomes has the prior that its domain
    gives, or else its suffix or all pages.  A page with a null or malformed url, whose
    host and path are empty, is allowed.  Columns of these five names in ``pages`` are
    replaced.
    """
    known = levels(outcomes.select(host_of(F.col("url")).alias("host"), "bad").filter("host <> ''"))
    hosts = pages.select(host_of(F.col(url)).alias("host")).filter("host <> ''").distinct()
    bounds = known.posteriors(hosts).select(
        F.col("host").alias("_host"), lower_bound(F.col("a"), F.col("b"), deviations).alias("_bound"))
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "bound", "verdict")]
    judged = pages.select(
        F.struct(*names).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    judged = judged.withColumn("best", best_rule(rules, F.col("host"), F.col("path")))
    joined = judged.join(bounds, F.col("host") == F.col("_host"), "left")
    reputation = F.when(F.col("_bound") > limit, "block").otherwise("allow")
    return joined.select(
        "page.*", "host", "path", F.col("best.site").alias("rule"), F.col("_bound").alias("bound"),
        F.coalesce(F.col("best.verdict"), reputation).alias("verdict"),
    )
