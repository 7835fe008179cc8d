"""URL filters: empirical-Bayes reputation of hosts, from labelled page outcomes.

Bad pages of a host are binomial; the host's rate is beta around its registered domain's, that domain's around
its suffix's, the suffix's around the overall rate. At each level the prior's weight is estimated by
moments from how much the rates of siblings scatter, and the posterior mean becomes the prior mean one
level below: a host with few labelled pages is judged by its domain, a domain with few by its suffix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import staged, table, without

# Public suffixes of two labels. Any other host has its last label as suffix.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
# The rules of the query, (action, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A host is blocked if its rate of bad pages lies over this rate with a chance of about 95 in 100.
BAD_RATE = 0.5
BOUND_Z = 1.6449
#: Bounds of the estimated weight of a prior, in pages.
WEIGHTS = (2.0, 1000.0)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?`` or ``#``, with A-Z lower-cased; without ``://`` empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; without ``://`` empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    bare = F.regexp_replace(F.regexp_extract(host, r"([^@]*)$", 1), r":\d*$|\.$", "")
    return F.split(bare, r"\.")


def suffix_of(host: Column) -> Column:
    """Public suffix: the last two labels if they are a listed suffix, else the last. Ports and users don't count."""
    parts = _labels(host)
    two = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2)), ".")
    return F.when(two.isin(*SUFFIXES), two).otherwise(F.element_at(parts, -1))


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label before it; the host itself if it has no more than that."""
    parts = _labels(host)
    n = F.size(F.split(suffix_of(host), r"\.")) + 1
    return F.when(F.size(parts) <= n, F.array_join(parts, ".")).otherwise(
        F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
    )


def _shrink(counts: DataFrame, parent: DataFrame | None, parent_key: str | None) -> DataFrame:
    """Posterior (alpha, beta, rate) of each row of ``counts`` around its parent's rate, or the overall rate without one."""
    if parent is None:
        n, bad = counts.agg(F.sum("n"), F.sum("bad")).first()
        rows = counts.withColumn("prior", F.lit(bad / n if n else None).cast("double"))
    else:
        rows = counts.join(parent.select(parent_key, F.col("rate").alias("prior")), parent_key)
    rows = rows.withColumn("prior", F.least(F.greatest("prior", F.lit(0.001)), F.lit(0.999)))
    # E (bad - n p)^2 = p (1 - p) (n + n (n - 1) rho) if rates vary by p (1 - p) rho; the prior's weight is 1 / rho - 1
    scatter = (F.col("bad") - F.col("n") * F.col("prior")) ** 2 / (F.col("prior") * (1 - F.col("prior")))
    over, pairs = rows.agg(F.sum(scatter - F.col("n")), F.sum(F.col("n") * (F.col("n") - 1))).first()
    rho = over / pairs if pairs else 0.0
    weight = min(max(1 / rho - 1, WEIGHTS[0]), WEIGHTS[1]) if rho > 0 else WEIGHTS[1]
    alpha, beta = weight * F.col("prior"), weight * (1 - F.col("prior"))
    rows = rows.withColumns({"alpha": alpha + F.col("bad"), "beta": beta + F.col("n") - F.col("bad")})
    return rows.withColumn("rate", F.col("alpha") / (F.col("alpha") + F.col("beta"))).drop("prior")


def lower_bound(alpha: Column, beta: Column, z: float = BOUND_Z) -> Column:
    """Lower bound of the posterior rate: its mean less z standard deviations of the beta distribution."""
    total = alpha + beta
    return F.greatest(F.lit(0.0), alpha / total - z * F.sqrt(alpha * beta / (total * total * (total + 1))))


def reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, n, bad, rate, bound) for each of the distinct ``hosts``, from ``outcomes`` (host, bad as 0 or 1).

    Rows without host or outcome are passed over. A host without outcomes has its domain's prior, a domain
    without outcomes its suffix's, a suffix without outcomes the overall one; without any outcome at all
    every rate is the least that is assumed, 0.001. Counts are summed before they move, so a host with a third of all pages is one row.
    """
    known = outcomes.where(F.col("host").isNotNull() & F.col("bad").isNotNull())
    known = known.groupBy("host").agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
    none = hosts.select("host").where("host is not null").distinct().select("host", F.lit(0.0).alias("n"), F.lit(0.0).alias("bad"))
    seen = known.unionByName(none).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    seen = staged(seen.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    domains = staged(seen.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = _shrink(suffixes, None, None)
    domains = _shrink(domains, suffixes, "suffix")
    judged = _shrink(seen, domains.drop("suffix"), "domain")
    bound = lower_bound(F.col("alpha"), F.col("beta"))
    return judged.select("host", "n", "bad", "rate", bound.alias("bound"))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and action, or nulls. A rule fits its host and all subdomains if the
    path starts with its path; of rules of one length the one listed first wins."""
    name = action = F.lit(None).cast("string")
    for act, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True)[::-1]:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, bad_rate: float = BAD_RATE) -> DataFrame:
    """``pages`` with host, path, rule, verdict, rate and bound; columns of these names are replaced.

    The rule decides where one fits. Elsewhere a host whose posterior lower bound reaches ``bad_rate`` is
    blocked; one without evidence is allowed, as is a page without a host.
    """
    names = ["host", "path", "rule", "verdict", "rate", "bound"]
    rows = without(pages, names).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    known = reputation(outcomes, rows.select("host")).select("host", "rate", "bound")
    rule, action = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).join(known, "host", "left")
    method = F.when((F.col("host") != "") & (F.col("bound") >= bad_rate), "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce(action, method))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url. An outcome is a label of the document that the url's path names by number:
    bad if it is toxic or of low quality."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").where("quality is not null or toxic is not null")
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    labels = labels.groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))
    number = F.regexp_extract(path_of(F.col("url")), r"^/[^/]*/(\d{1,18})", 1).try_cast("bigint")
    named = pages.select(host_of(F.col("url")).alias("host"), number.alias("doc_id")).where("doc_id is not null")
    outcomes = named.join(labels, "doc_id").select("host", "bad")
    judged = judge(pages, outcomes)
    shown = [F.round(c, 4).alias(c) for c in ("rate", "bound")]
    return judged.select("page_id", "host", "path", "rule", "verdict", *shown)


OP5_SQL = r"""
WITH urls AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM urls
), outcome AS (
  SELECT doc_id, max(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id
), seen AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad
  FROM split LEFT JOIN outcome ON try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]{1,18})', 1), '') AS BIGINT) = doc_id
  GROUP BY host
), part AS (
  SELECT *, string_split(regexp_replace(regexp_extract(host, '([^@]*)$', 1), ':[0-9]*$|\.$', '', 'g'), '.') AS parts FROM seen
), suffix AS (
  SELECT *, CASE WHEN array_to_string(parts[greatest(len(parts) - 1, 1):], '.') IN (@SUFFIXES@)
    THEN array_to_string(parts[greatest(len(parts) - 1, 1):], '.') ELSE parts[len(parts)] END AS suffix FROM part
), named AS (
  SELECT host, n, bad, suffix, array_to_string(parts[greatest(len(parts) - len(string_split(suffix, '.')), 1):], '.') AS domain FROM suffix
), whole AS (
  SELECT sum(bad) / sum(n) AS prior FROM named HAVING sum(n) > 0
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(least(greatest(prior, 0.001), 0.999)) AS p FROM named, whole GROUP BY suffix
), sw AS (
  SELECT least(greatest(coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 END, 1000.0), 2.0), 1000.0) AS w
  FROM (SELECT sum((bad - n * p) ** 2 / (p * (1 - p)) - n) / nullif(sum(n * (n - 1)), 0) AS rho FROM s0)
), s1 AS (
  SELECT suffix, (w * p + bad) / (w + n) AS rate FROM s0, sw
), d0 AS (
  SELECT domain, sum(n) AS n, sum(bad) AS bad, any_value(least(greatest(rate, 0.001), 0.999)) AS p FROM named JOIN s1 USING (suffix) GROUP BY suffix, domain
), dw AS (
  SELECT least(greatest(coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 END, 1000.0), 2.0), 1000.0) AS w
  FROM (SELECT sum((bad - n * p) ** 2 / (p * (1 - p)) - n) / nullif(sum(n * (n - 1)), 0) AS rho FROM d0)
), d1 AS (
  SELECT domain, (w * p + bad) / (w + n) AS rate FROM d0, dw
), h0 AS (
  SELECT host, n, bad, least(greatest(rate, 0.001), 0.999) AS p FROM named JOIN d1 USING (domain)
), hw AS (
  SELECT least(greatest(coalesce(CASE WHEN rho > 0 THEN 1 / rho - 1 END, 1000.0), 2.0), 1000.0) AS w
  FROM (SELECT sum((bad - n * p) ** 2 / (p * (1 - p)) - n) / nullif(sum(n * (n - 1)), 0) AS rho FROM h0)
), h1 AS (
  SELECT host, w * p + bad AS a, w * (1 - p) + n - bad AS b FROM h0, hw
), h2 AS (
  SELECT host, a / (a + b) AS rate, greatest(0.0, a / (a + b) - 1.6449 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) AS bound FROM h1
), ruled AS (
  SELECT split.*, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN host <> '' AND bound >= 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  round(rate, 4) AS rate, round(bound, 4) AS bound
FROM ruled LEFT JOIN h2 USING (host)
""".replace("@SUFFIXES@", ", ".join(f"'{s}'" for s in SUFFIXES))
