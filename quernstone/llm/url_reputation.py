"""URL filters: rules first, then the reputation of the host.

Reputation is empirical Bayes over labelled page outcomes (bad or good; in judge, a page that a block rule covers is
bad and any other good): the share of bad pages of a suffix is shrunk
towards the overall share, a registered domain's towards its suffix, a host's towards its domain. At each level the
prior is a beta distribution whose mean is the parent's posterior mean and whose weight comes from the moments of
the children's counts (overdispersion of a beta-binomial). A page is blocked if the lower bound of its host's
posterior is above `threshold`; a host without outcomes has its domain's prior as posterior.

Cases. Null url or no "://": host and path are empty, no rule fits, and the verdict is that of the empty host.
Repeated pages count each. No outcomes at all: every host has the overall prior (one half), whose lower bound
blocks nothing. A page id may be null. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, materialise

#: (verdict, rule): host and path, cut at the first slash.
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "or.jp", "org.au", "org.uk")


def host_of(url: Column) -> Column:
    h = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(h, ASCII_UPPER, ASCII_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict), null where none fits; of those that fit the longest wins, then the first listed."""
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: -len(r[1]))
    fits = []
    for _, rule in ranked:
        name, slash, rest = rule.partition("/")
        fits.append(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest))
    pick = lambda k: F.coalesce(*[F.when(c, F.lit(r[k])) for c, r in zip(fits, ranked, strict=True)])
    return pick(1), pick(0)


def with_domains(df: DataFrame) -> DataFrame:
    """Adds suffix and domain of the column host. An address or a single label is its own domain and suffix."""
    two = F.substring_index("host", ".", -2)
    suffix = F.when(F.col("host").rlike(r"^[0-9.]*[0-9][0-9.]*(:[0-9]*)?$"), F.col("host")).when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index("host", ".", -1))
    df = df.withColumn("suffix", suffix)
    rest = F.expr("substring(host, 1, greatest(length(host) - length(suffix) - 1, 0))")
    return df.withColumn("domain", F.when(rest == "", F.col("host")).otherwise(F.concat_ws(".", F.substring_index(rest, ".", -1), F.col("suffix"))))


def shrunk(children: DataFrame, parents: DataFrame, on: list[str] | None) -> DataFrame:
    """children (key, on, n, k) with the posterior mean and weight that the parents' means (on, mean) lead to."""
    rows = children.join(parents.select(*on, F.col("mean").alias("m")), on) if on else children.crossJoin(F.broadcast(parents.select(F.col("mean").alias("m"))))
    spread = F.pow(F.col("k") - F.col("n") * F.col("m"), 2) - F.col("n") * F.col("m") * (1 - F.col("m"))
    pairs = F.col("n") * (F.col("n") - 1) * F.col("m") * (1 - F.col("m"))
    # One row: the moments of all children.
    rho = rows.agg(F.coalesce(F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.try_divide(F.sum(spread), F.sum(pairs)))), F.lit(0.5)).alias("rho"))
    rows = rows.crossJoin(F.broadcast(rho)).withColumn("s", 1 / F.col("rho") - 1)
    return rows.select(*children.columns, ((F.col("k") + F.col("s") * F.col("m")) / (F.col("n") + F.col("s"))).alias("mean"), (F.col("n") + F.col("s")).alias("weight"))


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, k, mean, bound) of a table of (host, bad) with a row for each page; bad: 1, 0 or null (no label)."""
    n = materialise(with_domains(outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))).select("host", "domain", "suffix", "n", "k"), "url-hosts")
    domains = n.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    root = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1)).alias("mean"))
    by_suffix = shrunk(suffixes, root, None)
    by_domain = shrunk(domains, by_suffix, ["suffix"])
    # a domain is named by its suffix too: an address and a host of one label more can agree in the rest
    by_host = shrunk(n, by_domain, ["domain", "suffix"])
    bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return by_host.select("host", "n", "k", "mean", bound.alias("bound"))


def judge(pages: DataFrame, rules=RULES, threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) of every page. The labelled outcome of a page is bad if a block rule covers it, else good."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("said", said)
    known = reputation(rows.select("host", F.coalesce(F.col("said") == "block", F.lit(False)).cast("int").alias("bad")), z)
    verdict = F.coalesce("said", F.when(F.col("bound") > threshold, F.lit("block")).otherwise(F.lit("allow")))
    return rows.join(known.select("host", "bound"), "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bound")


_LEVEL = """
{name}_in AS (SELECT c.*, p.mean AS m FROM {children} c JOIN {parents} p {on}),
{name}_rho AS (SELECT coalesce(greatest(0.001, least(0.999, sum(power(k - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0))), 0.5) AS rho FROM {name}_in),
{name} AS (SELECT i.* EXCLUDE (m), (k + (1 / rho - 1) * m) / (n + (1 / rho - 1)) AS mean, n + (1 / rho - 1) AS weight FROM {name}_in i, {name}_rho)"""


def oracle(rules=RULES, threshold: float = 0.5, z: float = 1.645) -> str:
    ranked = sorted(rules, key=lambda r: -len(r[1]))
    cases = {}
    for what in (1, 0):
        cases[what] = "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{s + p}') THEN '{r[what]}'" for r in ranked for h, s, p in [r[1].partition("/")]) + " END"
    levels = "".join([
        _LEVEL.format(name="s", children="suffixes", parents="root", on="ON true") + ",",
        _LEVEL.format(name="d", children="domains", parents="s", on="USING (suffix)") + ",",
        _LEVEL.format(name="h", children="hosts", parents="d", on="ON c.domain = p.domain AND c.suffix = p.suffix"),
    ])
    two = "array_to_string(string_split(host, '.')[-2:], '.')"
    return f"""
WITH parts AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{ASCII_UPPER}', '{ASCII_LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, {cases[1]} AS rule, {cases[0]} AS said FROM parts),
counts AS (SELECT host, count(*)::DOUBLE AS n, coalesce(sum((said = 'block')::INT), 0)::DOUBLE AS k FROM ruled GROUP BY host),
cut AS (SELECT *, CASE WHEN regexp_matches(host, '^[0-9.]*[0-9][0-9.]*(:[0-9]*)?$') THEN host WHEN {two} IN ({", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)}) THEN {two} ELSE string_split(host, '.')[-1] END AS suffix FROM counts),
rest AS (SELECT *, substring(host, 1, greatest(length(host) - length(suffix) - 1, 0)) AS rest FROM cut),
hosts AS (SELECT host, CASE WHEN rest = '' THEN host ELSE string_split(rest, '.')[-1] || '.' || suffix END AS domain, suffix, n, k FROM rest),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
root AS (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS mean FROM suffixes),{levels}
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN mean - {z} * sqrt(mean * (1 - mean) / (weight + 1)) > {threshold} THEN 'block' ELSE 'allow' END) AS verdict FROM ruled LEFT JOIN h USING (host)"""
