"""URL verdicts: fixed rules first, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionsift.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Verdict and prefix of each rule.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


@dataclass(frozen=True)
class Reputation:
    """A host is blocked when its share of bad pages is above ``max_bad`` with the given certainty."""

    max_bad: float = 0.5
    z: float = 1.645  # the posterior's lower bound is its mean less z standard deviations
    weakest: float = 1.0  # bounds of a prior's weight, in pages
    strongest: float = 10_000.0


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")


def url_parts(pages: DataFrame, page_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host`` (A-Z lower-cased) and ``path``; both empty without a URL or a ``://``."""
    at = {c: i for i, c in reversed(list(enumerate(pages.columns)))}
    plain = pages.toDF(*[f"_c{i}" for i in range(len(pages.columns))]).select(
        F.col(f"_c{at[page_col]}").cast("long").alias("page_id"),
        F.coalesce(F.col(f"_c{at[url_col]}").cast("string"), F.lit("")).alias("_url"),
    )
    pattern = "^([^/?#]*)([^?#]*)"
    rest = _after(F.col("_url"))
    return plain.select(
        "page_id",
        F.translate(F.regexp_extract(rest, pattern, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(rest, pattern, 2).alias("path"),
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits host (or a parent of it) and path, and its verdict; NULL if none does."""
    rule = verdict = F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, model: Reputation) -> DataFrame:
    """The weight of the prior of a level, in pages, by the moments of its children's shares; one row."""
    sums = children.agg(
        F.count(F.lit(1)).cast("double").alias("m"),
        F.sum("n").cast("double").alias("n"),
        F.sum("bad").cast("double").alias("x"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("xx"),
    )
    p = F.col("x") / F.col("n")
    spread = F.col("m") * (F.col("xx") - F.col("n") * p * p) / ((F.col("m") - 1) * F.col("n"))
    noise = p * (1 - p) * F.col("m") / F.col("n")  # what chance adds to shares that weigh by their pages
    strength = F.when(
        (F.col("m") > 1) & (spread - noise > 0),
        F.greatest(
            F.lit(model.weakest), F.least(F.lit(model.strongest), (p * (1 - p) - spread) / (spread - noise))
        ),
    ).otherwise(F.lit(model.strongest))
    return sums.select(strength.alias("k"), F.coalesce(p, F.lit(0.0)).alias("p"))


def host_reputation(outcomes: DataFrame, model: Reputation = Reputation()) -> DataFrame:
    """``host``, labelled pages ``n``, ``bad`` ones, posterior ``mean`` and lower ``bound`` of the bad share.

    ``outcomes`` has a row per labelled page: ``host`` and ``bad`` (0 or 1; NULL counts as
    unlabelled). The beta-binomial prior of a host is its registered domain's shrunken share (the last two
    labels of the name), that of a domain its suffix's (the last label), that of a suffix the share of all;
    each level's weight comes from the moments of its children. Counts are combined before any shuffle, so a
    host with a third of the rows is no burden; the levels' single-row statistics are joined as such.
    """
    hosts = (
        outcomes.where("bad IS NOT NULL")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
        .withColumns(
            {"domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)}
        )
    )
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)

    def shrunk(level: DataFrame, prior: DataFrame | None, on: str | None, children: DataFrame) -> DataFrame:
        whole = F.broadcast(_strength(children, model))  # one row
        with_prior = level.join(prior, on) if prior is not None else level
        mean = "prior" if prior is not None else "p"
        return with_prior.join(whole, F.lit(True), "left").withColumn(
            "mean", (F.col("bad") + F.col("k") * F.col(mean)) / (F.col("n") + F.col("k"))
        )

    of_suffix = shrunk(suffixes, None, None, suffixes).select("suffix", F.col("mean").alias("prior"))
    of_domain = shrunk(domains, of_suffix, "suffix", domains).select("domain", F.col("mean").alias("prior"))
    known = shrunk(hosts, of_domain, "domain", hosts)
    weight = F.col("n") + F.col("k")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return known.select("host", "n", "bad", "mean", (F.col("mean") - model.z * sd).alias("bound"))


def url_verdicts(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=RULES,
    model: Reputation = Reputation(),
    page_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Every page with host, path, rule and verdict.

    The longest fitting rule decides; without one, a host whose posterior bound is above
    ``max_bad`` is blocked and any other is allowed, hosts without a labelled page included. NULL and odd URLs have an empty
    host and path, fit no rule and are judged like any host. Repeated rows get repeated results; an
    empty table gives no row; other columns are ignored.
    """
    parts = url_parts(pages, page_col, url_col)
    blocked = host_reputation(outcomes, model).where(F.col("bound") > model.max_bad)
    marked = parts.join(blocked.select("host", F.lit(True).alias("_bad")), "host", "left")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return marked.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("_bad"), "block").otherwise("allow")).alias("verdict"),
    )


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host`` and ``bad`` of the pages whose document is labelled; a page's path names its document.

    Bad is a document of quality 0 or one that is toxic. A document labelled more than once is bad if
    any label says so; NULL labels say nothing.
    """
    number = F.regexp_extract(F.col("path"), "/([0-9]{1,18})", 1)
    hosts = url_parts(pages).select("host", F.when(number != "", number.cast("long")).alias("doc_id"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0
    )
    known = labels.select("doc_id", bad.alias("bad")).groupBy("doc_id").agg(F.max("bad").alias("bad"))
    return hosts.join(known, "doc_id").select("host", "bad")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read_table(spark, sf_dir, "pages")
    return url_verdicts(pages, labelled_pages(pages, common.read_table(spark, sf_dir, "labels")))


def _level_sql(name: str, level: str, prior: str, prior_join: str, mean: str, model: Reputation) -> str:
    return f"""
{name}_whole AS (
  SELECT count(*)::DOUBLE m, sum(n)::DOUBLE n, sum(bad)::DOUBLE x, sum(bad * bad / n) xx FROM {level}
), {name}_k AS (
  SELECT x / n AS p, CASE WHEN m > 1 AND m * (xx - x * x / n) / ((m - 1) * n) - x / n * (1 - x / n) * m / n > 0
    THEN greatest({model.weakest}, least({model.strongest}, (x / n * (1 - x / n) - m * (xx - x * x / n) / ((m - 1) * n))
      / (m * (xx - x * x / n) / ((m - 1) * n) - x / n * (1 - x / n) * m / n)))
    ELSE {model.strongest} END AS k FROM {name}_whole
), {name}_post AS (
  SELECT l.*, w.k, (l.bad + w.k * {mean}) / (l.n + w.k) AS mean FROM {level} l CROSS JOIN {name}_k w {prior_join}
)"""


def op7_sql(rules=RULES, model: Reputation = Reputation()) -> str:
    says = []
    for _, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        says.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{text}'")
    verdicts = " ".join(f"WHEN rule = '{text}' THEN '{verdict}'" for verdict, text in rules)
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(r, '^([^/?#]*)([^?#]*)', 2) AS path FROM rest
), known AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad
  FROM labels GROUP BY doc_id
), hosts AS (
  SELECT host, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, list_aggregate(split(host, '.')[-2:], 'string_agg', '.') AS domain,
    split(host, '.')[-1] AS suffix
  FROM parts JOIN known ON try_cast(regexp_extract(path, '/([0-9]{{1,18}})', 1) AS BIGINT) = doc_id WHERE bad IS NOT NULL GROUP BY host
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), {_level_sql("suffix", "suffixes", "", "", "w.p", model)}, {_level_sql("domain", "domains", "suffix", "JOIN suffix_post s ON s.suffix = l.suffix", "s.mean", model)},
{_level_sql("host", "hosts", "domain", "JOIN domain_post d ON d.domain = l.domain", "d.mean", model)}, ruled AS (
  SELECT page_id, host, path, CASE {" ".join(says)} END AS rule FROM parts
)
SELECT page_id, r.host, path, rule, CASE {verdicts} WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN (
  SELECT host FROM host_post WHERE mean - {model.z} * sqrt(mean * (1 - mean) / (n + k + 1)) > {model.max_bad}
) b ON r.host = b.host"""
