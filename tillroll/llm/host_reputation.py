"""Empirical-Bayes host reputation for URL filtering (DataFrame only).

Pages that an explicit rule decides are the labelled outcomes.  Their counts are
shrunk from the whole web to the suffix, from the suffix to the registered domain
and from the domain to the host: at each level the parent's posterior mean is the
mean of a beta prior whose strength is estimated from the spread between the
level's groups (beta-binomial moments).  A host is blocked when the upper bound of
its posterior rate of good pages stays below a limit, so an unknown host is judged
by what is known of its domain and suffix, and little evidence never blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str     # starts with /

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Limits:
    z: float = 1.645           # one-sided 95 %
    least_good: float = 0.5
    least_spread: float = 0.001
    most_spread: float = 0.999


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column, pick) -> Column:
    """``pick(rule)`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(pick(r))).otherwise(out)
    return out


def registered_domain(host: Column) -> Column:
    """The last two labels of a host (the host itself if it has fewer)."""
    return F.substring_index(host, ".", -2)


def _strength(groups: DataFrame, limits: Limits) -> float:
    """Prior strength s = (1 - rho) / rho from the moments of (n, k, mean): observed
    squared deviations against binomial ones; no spread gives the largest strength."""
    var = F.col("mean") * (1 - F.col("mean"))
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("mean")) ** 2).alias("seen"),
        F.sum(var).alias("plain"), F.sum(var * (F.col("n") - 1)).alias("spread")).first()
    rho = (row["seen"] - row["plain"]) / row["spread"] if row["spread"] else limits.least_spread
    rho = min(max(rho, limits.least_spread), limits.most_spread)
    return (1 - rho) / rho


def reputations(outcomes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(host, n, k, good_rate, upper) for a table of (host, n labelled, k good), one row
    a host.  Counts at every level are sums of the level below."""
    hosts = outcomes.select("host", F.col("n").cast("double").alias("n"), F.col("k").cast("double").alias("k"),
                            registered_domain(F.col("host")).alias("domain"),
                            F.substring_index("host", ".", -1).alias("suffix"))
    hosts = stored(hosts, "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    root = ((total["k"] or 0.0) + 0.5) / ((total["n"] or 0.0) + 1.0)

    def posterior(groups: DataFrame, s: float) -> DataFrame:
        a = F.lit(s) * F.col("mean") + F.col("k")
        return groups.withColumn("weight", F.lit(s) + F.col("n")).withColumn("post", a / F.col("weight"))

    suffixes = stored(hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
                      .withColumn("mean", F.lit(root)), "suffixes")
    suffixes = posterior(suffixes, _strength(suffixes, limits))
    domains = stored(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
                     .join(suffixes.select("suffix", F.col("post").alias("mean")), "suffix"), "domains")
    domains = posterior(domains, _strength(domains, limits))
    named = stored(hosts.join(domains.select("domain", F.col("post").alias("mean")), "domain"), "hosts-prior")
    sd = F.sqrt(F.col("post") * (1 - F.col("post")) / (F.col("weight") + 1))
    return posterior(named, _strength(named, limits)).select(
        "host", "n", "k", F.col("post").alias("good_rate"), (F.col("post") + F.lit(limits.z) * sd).alias("upper"))


def judge(pages: DataFrame, rules: list[Rule], limits: Limits = Limits(),
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    A rule's verdict stands; other pages get their host's.  A null url or one without
    ``://`` has an empty host and path and is judged by the overall rate.  Repeated rows
    and null ids are judged like any other; only id and url are read; an empty table
    gives an empty one."""
    url = F.col(url_col).cast("string")
    seen = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = seen.withColumns({"rule": longest_rule(rules, F.col("host"), F.col("path"), lambda r: r.name),
                             "by_rule": longest_rule(rules, F.col("host"), F.col("path"), lambda r: r.verdict)})
    outcomes = seen.groupBy("host").agg(F.count("by_rule").alias("n"),
                                        F.count(F.when(F.col("by_rule") == "allow", 1)).alias("k"))
    verdicts = stored(reputations(outcomes, limits).select(
        "host", F.when(F.col("upper") < limits.least_good, "block").otherwise("allow").alias("by_host")), "host-verdicts")
    return (seen.join(verdicts, "host", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host").alias("verdict")))


def judge_sql(rules: list[Rule], limits: Limits = Limits(), pages: str = "pages") -> str:
    """The same verdicts as one DuckDB statement."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ordered]
    case = lambda pick: "CASE " + " ".join(f"WHEN {f} THEN '{pick(r)}'" for f, r in zip(fits, ordered)) + " END"

    def strength(t: str) -> str:
        return (f"SELECT (1 - rho) / rho AS s FROM (SELECT least(greatest(coalesce((seen - plain) / nullif(spread, 0), "
                f"{limits.least_spread}), {limits.least_spread}), {limits.most_spread}) AS rho FROM (SELECT "
                f"sum(n * (k / n - mean) ** 2) AS seen, sum(mean * (1 - mean)) AS plain, "
                f"sum(mean * (1 - mean) * (n - 1)) AS spread FROM {t} WHERE n > 0))")

    return f"""
WITH parts AS (
  SELECT page_id, coalesce(regexp_extract(url, '{_URL}', 1), '') AS h,
         coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM {pages}),
lowered AS (SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host, path FROM parts),
ruled AS (SELECT *, {case(lambda r: r.name)} AS rule, {case(lambda r: r.verdict)} AS by_rule FROM lowered),
hosts AS (
  SELECT host, regexp_extract(host, '(([^.]*[.])?[^.]*)$', 1) AS domain,
         string_split(host, '.')[-1] AS suffix, count(by_rule)::DOUBLE AS n,
         (count(*) FILTER (by_rule = 'allow'))::DOUBLE AS k FROM ruled GROUP BY host),
root AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS mean FROM hosts),
suffixes AS (SELECT suffix, n, k, mean FROM (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix), root),
suffix_s AS ({strength('suffixes')}),
domains AS (
  SELECT d.domain, d.n, d.k, (s * x.mean + x.k) / (s + x.n) AS mean
  FROM (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix, domain) d
  JOIN suffixes x USING (suffix), suffix_s),
domain_s AS ({strength('domains')}),
named AS (
  SELECT h.host, h.n, h.k, (s * d.mean + d.k) / (s + d.n) AS mean FROM hosts h JOIN domains d USING (domain), domain_s),
host_s AS ({strength('named')}),
post AS (SELECT host, (s * mean + k) / (s + n) AS p, s + n AS w FROM named, host_s)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN p + {limits.z} * sqrt(p * (1 - p) / (w + 1))
       < {limits.least_good} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled JOIN post USING (host)"""
