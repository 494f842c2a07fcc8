"""URL verdicts: address rules, then empirical-Bayes host reputation. DataFrame expressions throughout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from assay.session import materialise

# Fixed values of the query: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Reputation:
    """Limits of the posterior test: a host is blocked when even the lower bound of its bad share is this high."""

    max_bad: float = 0.25
    z: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 10_000.0
    shared_suffixes: tuple[str, ...] = ()  # suffixes of several labels under which names are registered, as co.uk


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What lies between the first :// and the next /, ? or #, with A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, shared: tuple[str, ...] = ()) -> Column:
    """Last label of a host, or the longest of the ``shared`` suffixes that it ends with."""
    return _tail(host, shared, 0)


def domain_of(host: Column, shared: tuple[str, ...] = ()) -> Column:
    """A host's suffix and the label before it; the host itself if it has no more."""
    return _tail(host, shared, 1)


def _tail(host: Column, shared: tuple[str, ...], more: int) -> Column:
    out = F.substring_index(host, ".", -1 - more)
    for suffix in sorted(shared, key=lambda s: s.count(".")):
        fits = (host == suffix) | host.endswith("." + suffix)
        out = F.when(fits, F.substring_index(host, ".", -1 - suffix.count(".") - more)).otherwise(out)
    return out


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null: same host or a subdomain, same start of path."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _strength(groups: DataFrame, name: str, limits: Reputation) -> DataFrame:
    """One row: prior strength at a level by the method of moments over its groups (n, bad); none without outcomes."""
    share = F.col("bad") / F.col("n")
    one = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"),
        F.count(F.lit(1)).cast("double").alias("g"), F.sum(F.col("n") * F.col("n")).cast("double").alias("n2"),
        F.sum(F.col("n") * share * share).alias("ss"),
    ).filter("n > 0")
    p = (F.col("bad") + 1) / (F.col("n") + 2)
    within = p * (1 - p)
    spread = F.col("ss") - 2 * p * F.col("bad") + p * p * F.col("n")
    size = F.col("n") - F.col("n2") / F.col("n")
    between = F.when(size > 0, (spread - (F.col("g") - 1) * within) / F.when(size > 0, size))
    free = F.when(between > 0, within / F.when(between > 0, between) - 1).otherwise(F.lit(limits.most_strength))
    return one.select(F.greatest(F.lit(limits.least_strength), F.least(F.lit(limits.most_strength), free)).alias(name), p.alias(f"p_{name}"))


def host_reputation(outcomes: DataFrame, limits: Reputation = Reputation(), hosts: DataFrame | None = None) -> DataFrame:
    """(host, n, bad, bad_share, bound, blocked) per host of the labelled pages (host, bad) and of ``hosts`` (host).

    A suffix's bad share is shrunk to the overall share, a registered domain's to its suffix's, a host's to
    its domain's, each by a beta prior whose strength comes from the spread of that level's groups. Where a
    level has no outcomes its share is that of the level above, so a new host is judged by its domain's prior,
    else its suffix's, else the overall one. A host is blocked if its posterior mean less z posterior deviations
    is max_bad or more. Without any outcome there is no prior and no row.
    """
    own = materialise(outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")))
    known = own if hosts is None else own.select("host").union(hosts.select("host")).distinct().join(own, "host", "left")
    placed = lambda rows: rows.withColumn("domain", domain_of(F.col("host"), limits.shared_suffixes)).withColumn(
        "suffix", suffix_of(F.col("host"), limits.shared_suffixes))
    own, known = placed(own), placed(known)
    domains = materialise(own.groupBy("domain", "suffix").agg(F.sum("n").alias("n_d"), F.sum("bad").alias("bad_d")))
    suffixes = materialise(domains.groupBy("suffix").agg(F.sum("n_d").alias("n_s"), F.sum("bad_d").alias("bad_s")))
    sums = lambda rows, level: rows.select(F.col("n" + level).alias("n"), F.col("bad" + level).alias("bad"))
    k_s, k_d = _strength(sums(suffixes, "_s"), "k_s", limits), _strength(sums(domains, "_d"), "k_d", limits)
    k_h = _strength(sums(own, ""), "k_h", limits)
    # Three tables of one row each.
    priors = k_s.crossJoin(k_d.select("k_d")).crossJoin(k_h.select("k_h"))

    rows = known.join(domains.drop("suffix"), "domain", "left").join(suffixes, "suffix", "left")
    rows = rows.fillna(0, ["n", "bad", "n_d", "bad_d", "n_s", "bad_s"]).crossJoin(F.broadcast(priors))
    rows = rows.withColumn("m_s", (F.col("bad_s") + F.col("k_s") * F.col("p_k_s")) / (F.col("n_s") + F.col("k_s")))
    rows = rows.withColumn("m_d", (F.col("bad_d") + F.col("k_d") * F.col("m_s")) / (F.col("n_d") + F.col("k_d")))
    a = F.col("bad") + F.col("k_h") * F.col("m_d")
    b = F.col("n") - F.col("bad") + F.col("k_h") * (1 - F.col("m_d"))
    mean = a / (a + b)
    bound = mean - F.lit(limits.z) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return rows.select(
        "host", "n", "bad", mean.alias("bad_share"), bound.alias("bound"), (bound >= limits.max_bad).alias("blocked"),
    )


def judge(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id",
    rules: tuple = RULES, limits: Reputation = Reputation(),
) -> DataFrame:
    """(id, host, path, rule, verdict) per page: the longest fitting rule's verdict, else its host's.

    A page's outcome is bad where a label of its id says quality 0 or toxic 1; pages with several labels are
    bad if one says so, labels with neither value say nothing. Hosts without outcomes are judged by the prior of
    their registered domain, suffix or all pages; a domain is the last two labels of a host unless
    ``limits.shared_suffixes`` names a longer suffix. Addresses without a host, and all where nothing is labelled,
    are allowed unless a rule says otherwise. Null addresses have empty host and path. Repeated rows
    each come back and count as one page each; null ids have no label. Other columns are ignored; empty
    tables are fine.

    Outcomes are summed by host on the map side; the verdict table is joined to the pages as a written
    table, so a host with a third of all pages is split.
    """
    url = F.col(url_col)
    hosts = pages.select(F.col(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    said = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    marks = labels.filter(said).groupBy(F.col(label_id_col).alias("_label_id")).agg(F.max(bad).alias("bad"))
    named = hosts.filter("host != ''")
    outcomes = named.join(materialise(marks), F.col("_id") == F.col("_label_id")).select("host", "bad")
    blocked = materialise(host_reputation(outcomes, limits, named.select("host").distinct()).filter("blocked").select(F.col("host").alias("_host"), F.lit("block").alias("_verdict")))
    found = hosts.join(blocked, F.col("host") == F.col("_host"), "left").withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    return found.select(
        F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.col("_verdict"), F.lit("allow")).alias("verdict"),
    )


# The same in DuckDB: rules inline, moments per level, posterior bound.
CHECK = r"""
with h as (
    select page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages),
l as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
      from labels where quality is not null or toxic is not null group by doc_id),
g as (select host, cast(count(*) as double) as n, cast(sum(bad) as double) as bad
      from h join l on page_id = doc_id where host != '' group by host),
gd as (select *, array_to_string(string_split(host, '.')[-2:], '.') as domain, string_split(host, '.')[-1] as suffix from g),
d as (select domain, suffix, sum(n) as n, sum(bad) as bad from gd group by domain, suffix),
s as (select suffix, sum(n) as n, sum(bad) as bad from d group by suffix),
levels as (select 'h' as level, n, bad from gd union all select 'd', n, bad from d union all select 's', n, bad from s),
m as (select level, sum(n) as n, sum(bad) as bad, count(*) as g, sum(n * n) as n2, sum(bad * bad / n) as ss,
             (sum(bad) + 1) / (sum(n) + 2) as p from levels group by level),
b as (select *, (ss - 2 * p * bad + p * p * n - (g - 1) * p * (1 - p)) / (n - n2 / n) as between_ from m),
k as (select level, p, greatest(1.0, least(10000.0, case when n - n2 / n > 0 and between_ > 0 then p * (1 - p) / between_ - 1 else 10000.0 end)) as k from b),
u as (select distinct host, array_to_string(string_split(host, '.')[-2:], '.') as domain, string_split(host, '.')[-1] as suffix
      from h where host != ''),
ms as (select v.suffix, (coalesce(bad, 0) + k * p) / (coalesce(n, 0) + k) as m
       from (select distinct suffix from u) v left join s using (suffix), k where level = 's'),
md as (select v.domain, (coalesce(bad, 0) + k * ms.m) / (coalesce(n, 0) + k) as m
       from (select distinct domain, suffix from u) v join ms using (suffix) left join d using (domain), k where level = 'd'),
ab as (select u.host, coalesce(bad, 0) + k * md.m as a, coalesce(n - bad, 0) + k * (1 - md.m) as b
       from u join md using (domain) left join g using (host), k where level = 'h'),
rep as (select host from ab where a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= 0.25),
r as (select page_id, host, path,
        case when (host = 'example.org' or suffix(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
             when (host = 'example.org' or suffix(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
             when (host = 'com' or suffix(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
             when (host = 'com' or suffix(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
             when (host = 'org' or suffix(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
      from h)
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            when host in (select host from rep) then 'block' else 'allow' end as verdict
from r"""
