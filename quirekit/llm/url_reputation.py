"""URL filter by empirical-Bayes host reputation, with an explicit rule list on top."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirekit.llm.common import ascii_lower, salted_join, written

#: Labels that, before a country's two letters, belong to the suffix under which registrations are made (fixed values).
SECOND_LABELS = ("ac", "co", "com", "edu", "gen", "go", "gob", "gouv", "gov", "gv", "id", "ind", "info", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch", "web")
#: Two such labels at the end of a host, and hosts that are addresses: each of those is its own domain, of the suffix "ip".
TWO_LABELS = rf"(?:^|\.)((?:{'|'.join(SECOND_LABELS)})\.[a-z][a-z])$"
ADDRESS = r"^(?:[0-9]+(?:\.[0-9]+){3}|\[.*)$"
BARE = r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is host and path prefix, like ``example.com/en/``; it fits the host and its subdomains."""

    pattern: str
    allow: bool

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``: host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; path up to ``? #``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise("")
    return df.withColumn("host", ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def matching_rule(rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as struct(rule, allow), or null."""
    tests = [F.when(((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path), F.struct(F.lit(r.pattern).alias("rule"), F.lit(r.allow).alias("allow"))) for r in sorted(rules, key=lambda r: -len(r.pattern))]
    return F.coalesce(*tests, F.lit(None).cast("struct<rule:string,allow:boolean>"))


def with_domains(df: DataFrame) -> DataFrame:
    """Adds ``suffix`` and ``domain`` (suffix and one label more) of ``host``, without user and port."""
    bare = F.regexp_extract("host", BARE, 1)
    own, two = bare.rlike(ADDRESS), F.regexp_extract(bare, TWO_LABELS, 1)
    suffix = F.when(own, "ip").when(two != "", two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(own, bare).when(two != "", F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    return df.withColumn("suffix", suffix).withColumn("domain", domain)


def _strength(groups: DataFrame, prior: Column, least: float, most: float) -> float:
    """Prior strength by moments: intra-group correlation of the outcomes around each group's prior mean."""
    n, x, m = F.col("n"), F.col("bad"), prior
    got = groups.agg(F.sum((x - n * m) * (x - n * m)).alias("s"), F.sum(n * m * (1 - m)).alias("v"), F.sum(n * (n - 1) * m * (1 - m)).alias("w")).first()
    rho = (got.s - got.v) / got.w if got.w else 0.0
    rho = min(max(rho, 1 / (1 + most)), 1 / (1 + least))
    return 1 / rho - 1


def host_reputation(outcomes: DataFrame, least: float = 1.0, most: float = 9999.0) -> DataFrame:
    """Posterior of the bad rate of each host from labelled outcomes.

    ``outcomes``: host, rows (pages of the host), n (labelled ones), bad (bad ones), one row per host. Returns it with
    alpha and beta of the host's Beta posterior and ``usual``, the shrunk rate of its suffix. The rate of all pages is the prior mean of a suffix, the shrunk
    rate of a suffix that of its domains, and the shrunk rate of a domain that of its hosts; each level's strength
    is estimated by moments, within [least, most]. Without any labelled page all rates are 1/2.
    """
    hosts = written(with_domains(outcomes))
    domains = written(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("hosts")))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("domains"))
    all_ = domains.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("hosts"), F.lit(0)).alias("hosts"), F.count("*").alias("domains")).first()
    mean = (all_.bad + 0.5) / (all_.n + 1.0)
    k = _strength(suffixes, F.lit(mean), least, most)
    suffixes = suffixes.select("suffix", "domains", ((F.col("bad") + k * mean) / (F.col("n") + k)).alias("m"))
    domains = written(salted_join(domains, suffixes, "suffix", "domains", all_.domains, F.xxhash64("domain")).withColumn("usual", F.col("m")))
    k = _strength(domains, F.col("m"), least, most)
    domains = domains.select("domain", "hosts", "usual", ((F.col("bad") + k * F.col("m")) / (F.col("n") + k)).alias("m"))
    hosts = written(salted_join(hosts, domains, "domain", "hosts", all_.hosts, F.xxhash64("host")))
    k = _strength(hosts, F.col("m"), least, most)
    return hosts.select("host", "rows", "n", "bad", "usual", (F.col("bad") + k * F.col("m")).alias("alpha"), (F.col("n") - F.col("bad") + k * (1 - F.col("m"))).alias("beta"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = (), *, z: float = 1.0, most_bad: float | None = None) -> DataFrame:
    """Every page with host, path, rule and verdict.

    ``pages``: page_id, url. ``outcomes``: page_id, bad (boolean, null for unknown); any of several bad rows of a page
    counts. A page whose url fits a rule gets the verdict of the longest one; any other is blocked if
    the lower posterior bound of its host's bad rate, mean - z * deviation, is over the usual rate of the host's suffix, so
    that more than chance speaks against the host, or over ``most_bad`` if that is given.
    Null urls and urls without ``://`` have an empty host and path; they share the reputation of the empty host.
    Repeated pages are judged one by one; outcomes of unknown pages, and null ids, don't count; further columns of
    either table are ignored. Empty tables give an empty result.
    """
    named = with_parts(pages.select("page_id", "url"))
    known = outcomes.where("bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    labelled = named.select("page_id", "host").join(known, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    counts = named.groupBy("host").agg(F.count("*").alias("rows"))
    hosts = counts.join(labelled, "host", "left").select("host", "rows", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"))
    a, b = F.col("alpha"), F.col("beta")
    rate = a / (a + b)
    known_hosts = host_reputation(hosts).select("host", "rows", "usual", F.col("n").alias("host_labelled"), F.col("bad").alias("host_bad"), (rate - z * F.sqrt(rate * (1 - rate) / (a + b + 1))).alias("host_bound"))
    judged = written(known_hosts)
    total = judged.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    out = salted_join(named, judged, "host", "rows", total, F.xxhash64("page_id", "path")).withColumn("_r", matching_rule(rules))
    bar = F.col("usual") if most_bad is None else F.lit(most_bad)
    allow = F.coalesce(F.col("_r.allow"), F.col("host_bound") <= bar)
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.when(allow, "allow").otherwise("block").alias("verdict"), "host_labelled", "host_bad")


RULES = (Rule("com/", True), Rule("example.com/en/", False), Rule("www.example.com/en/", True), Rule("net/es/", False), Rule("net/fr/", False))


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages``; the label of the document with a page's number is its outcome, bad if of low quality or toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), outcomes, RULES)


ORACLE = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), known AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY 1
), hosts0 AS (
  SELECT host, count(k.page_id) AS n, coalesce(sum(k.bad), 0) AS bad FROM named LEFT JOIN known k USING (page_id) GROUP BY 1
), bare AS (SELECT *, regexp_extract(host, '^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)', 1) AS b FROM hosts0
), tails AS (
  SELECT host, n, bad, b, string_split(b, '.') AS s, regexp_matches(b, '^([0-9]+(\.[0-9]+){3}|\[.*)$') AS own FROM bare
), tails2 AS (
  SELECT host, n, bad, b, own, s, length(s) > 1 AND s[-2] IN (@SECOND@) AND regexp_full_match(s[-1], '[a-z][a-z]') AS long FROM tails
), hosts AS (
  SELECT host, n, bad, CASE WHEN own THEN 'ip' WHEN long THEN array_to_string(s[-2:], '.') ELSE s[-1] END AS suffix,
         CASE WHEN own THEN b WHEN long THEN array_to_string(s[-3:], '.') ELSE array_to_string(s[-2:], '.') END AS domain FROM tails2
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1
), g AS (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1.0::DOUBLE) AS m FROM suffixes
), s1 AS (SELECT suffix, n::DOUBLE AS n, bad::DOUBLE AS bad, m FROM suffixes, g
), k1 AS (SELECT 1 / least(greatest(coalesce((sum((bad - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), 1 / 10000.0::DOUBLE), 0.5::DOUBLE) - 1 AS k FROM s1
), s2 AS (SELECT suffix, (bad + k * m) / (n + k) AS m FROM s1, k1
), d1 AS (SELECT domain, d.n::DOUBLE AS n, d.bad::DOUBLE AS bad, m, m AS usual FROM domains d JOIN s2 USING (suffix)
), k2 AS (SELECT 1 / least(greatest(coalesce((sum((bad - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), 1 / 10000.0::DOUBLE), 0.5::DOUBLE) - 1 AS k FROM d1
), d2 AS (SELECT domain, (bad + k * m) / (n + k) AS m, usual FROM d1, k2
), h1 AS (SELECT host, h.n::DOUBLE AS n, h.bad::DOUBLE AS bad, m, usual FROM hosts h JOIN d2 USING (domain)
), k3 AS (SELECT 1 / least(greatest(coalesce((sum((bad - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), 1 / 10000.0::DOUBLE), 0.5::DOUBLE) - 1 AS k FROM h1
), h2 AS (SELECT host, n, bad, usual, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM h1, k3
), h3 AS (SELECT host, n, bad, usual, a / (a + b) AS r, a + b + 1 AS t FROM h2
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM named
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN r - sqrt(r * (1 - r) / t) <= usual THEN 'allow' ELSE 'block' END AS verdict,
  n::BIGINT AS host_labelled, bad::BIGINT AS host_bad
FROM ruled JOIN h3 USING (host)
""".replace("@SECOND@", ", ".join(f"'{x}'" for x in SECOND_LABELS))
