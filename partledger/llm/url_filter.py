"""URL rules and host reputation by empirical Bayes."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from partledger.llm.common import checkpointed

RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MAX_BAD = 0.4  # a host is blocked when its share of bad pages is above this …
SIGMAS = 1.645  # … even at its lower bound, so many posterior deviations below the mean


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host or subdomain, path prefix) and its verdict; null without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, at, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(prefix))
        name, verdict = F.when(fits, at + prefix).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _spread(groups: DataFrame) -> float:
    """Prior strength of a level: the correlation inside groups by moments (0.001 to 0.5), as a number of pages."""
    n, bad, mean = F.col("n"), F.col("bad"), F.col("mean")
    noise = mean * (1 - mean)
    found = groups.agg(
        F.sum((bad - n * mean) * (bad - n * mean) - n * noise).alias("over"), F.sum(n * (n - 1) * noise).alias("pairs")
    ).first()
    within = found["over"] / found["pairs"] if found["pairs"] else 1 / 11
    return 1 / min(0.5, max(0.001, within)) - 1


def _shrunk(groups: DataFrame, strength: float) -> Column:
    return (strength * F.col("mean") + F.col("bad")) / (strength + F.col("n"))


def host_reputation(outcomes: DataFrame, sigmas: float = SIGMAS) -> DataFrame:
    """One row per host of ``outcomes`` (``host, n, bad``: labelled pages and bad ones): posterior mean and lower bound.

    A host's prior is its registered domain's posterior mean, a domain's that of its suffix, a suffix's that of all pages;
    the strength of each prior is estimated from how much groups of that level differ beyond chance. Domain: the last two
    labels without the port; suffix: the last one. Hosts without labelled pages get their domain's mean.
    """
    name = F.regexp_replace("host", r":[0-9]*$", "")
    two, one = F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1), F.regexp_extract(name, r"([^.]+)$", 1)
    hosts = outcomes.groupBy("host").agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad")
    )
    hosts = checkpointed(
        hosts.withColumns({"domain": F.when(two == "", name).otherwise(two), "suffix": F.when(one == "", name).otherwise(one)})
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    total = hosts.agg(*sums).first()
    level = hosts.groupBy("suffix").agg(*sums).withColumn("mean", F.lit(((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)))
    means = level.select("suffix", _shrunk(level, _spread(level)).alias("mean"))
    level = checkpointed(hosts.groupBy("suffix", "domain").agg(*sums).join(means, "suffix"))
    means = level.select("domain", _shrunk(level, _spread(level)).alias("mean"))
    level = checkpointed(hosts.join(means, "domain"))
    strength = _spread(level)
    a = strength * F.col("mean") + F.col("bad")
    size = strength + F.col("n")
    deviation = F.sqrt(a * (size - a) / (size * size * (size + 1)))
    return level.select("host", "n", "bad", (a / size).alias("bad_rate"), (a / size - sigmas * deviation).alias("bad_rate_low"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_bad: float = MAX_BAD,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate, bad_rate_low`` for every page.

    A page's labelled outcome is that of the document with its id: bad if of low quality or toxic (a null label is not
    bad; several labels are several outcomes). Rules come first; other pages are blocked when the lower posterior bound
    of their host's bad rate is above ``max_bad``. An empty or null url belongs to the host with the empty name.
    """
    host, path = url_parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    bad = F.coalesce(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("long"), F.lit(0))
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("bad"))
    known = split.select("page_id", "host").join(marks, "page_id", "left").select("host", "n", "bad")
    judged = split.join(host_reputation(known, sigmas).select("host", "bad_rate", "bad_rate_low"), "host", "left")
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_rate_low") > max_bad, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bad_rate", "bad_rate_low")


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    pages, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "labels"))
    return judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict")


_LEVEL = """(SELECT 1 / LEAST(0.5, GREATEST(0.001, COALESCE(SUM((bad - n * mean) * (bad - n * mean) - n * mean * (1 - mean))
  / NULLIF(SUM(n * (n - 1) * mean * (1 - mean)), 0), CAST(1 AS DOUBLE) / 11))) - 1 FROM {0})"""

ORACLE_SQL = rf"""
WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
marks AS (SELECT doc_id, COUNT(*) AS n, SUM(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
named AS (SELECT host, regexp_replace(host, ':[0-9]*$', '') AS name, SUM(COALESCE(n, 0))::DOUBLE AS n, SUM(COALESCE(bad, 0))::DOUBLE AS bad
  FROM split LEFT JOIN marks ON page_id = doc_id GROUP BY host),
hosts AS (SELECT host, n, bad, COALESCE(NULLIF(regexp_extract(name, '([^.]+\.[^.]+)$', 1), ''), name) AS domain,
  COALESCE(NULLIF(regexp_extract(name, '([^.]+)$', 1), ''), name) AS suffix FROM named),
s AS (SELECT suffix, SUM(n) AS n, SUM(bad) AS bad, (SELECT (SUM(bad) + 0.5) / (SUM(n) + 1) FROM hosts) AS mean FROM hosts GROUP BY suffix),
sk AS (SELECT {_LEVEL.format("s")} AS k),
sm AS (SELECT suffix, (k * mean + bad) / (k + n) AS mean FROM s, sk),
d AS (SELECT domain, SUM(n) AS n, SUM(bad) AS bad, MIN(mean) AS mean FROM hosts JOIN sm USING (suffix) GROUP BY domain, suffix),
dk AS (SELECT {_LEVEL.format("d")} AS k),
dm AS (SELECT domain, (k * mean + bad) / (k + n) AS mean FROM d, dk),
h AS (SELECT host, n, bad, mean FROM hosts JOIN dm USING (domain)),
hk AS (SELECT {_LEVEL.format("h")} AS k),
post AS (SELECT host, k * mean + bad AS a, k + n AS size FROM h, hk),
ruled AS (SELECT page_id, host, path, a, size, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM split JOIN post USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
  WHEN rule IS NOT NULL OR a / size - {SIGMAS} * sqrt(a * (size - a) / (size * size * (size + 1))) > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""
