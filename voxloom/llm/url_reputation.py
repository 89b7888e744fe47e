"""URL filter by rules and empirical-Bayes host reputation.

Labelled page outcomes are added up per host. Each level's share of bad pages is
shrunk towards the level above it, from host to registered domain to suffix to
all pages, with beta-binomial priors whose strength is fitted to the spread of
that level. A host is blocked if the lower bound of its posterior is above the
limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, materialize

#: (verdict, host and path); the longest that fits a url wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Where no table of public suffixes is given, one of these before a country's two letters is part of the suffix; all others have one label.
SECOND_LEVELS = ("ac", "co", "com", "edu", "go", "gob", "gov", "ltd", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
#: Rows that a table of suffixes may have; the public suffix list has about 10,000.
MOST_SUFFIXES = 50_000
LIMIT = 0.5
Z = 1.645
#: Least and largest intra-class correlation; the prior's strength is 1 / it - 1.
LEAST_RHO, MOST_RHO = 0.002, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url):
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def suffix_rules(table: DataFrame) -> tuple[str, ...]:
    """The rules in a table's column `suffix`, as public suffix lists have them: names, *.name for any label before it, !name for exceptions."""
    found = [r["suffix"] for r in table.select(F.translate("suffix", UPPER, LOWER).alias("suffix")).distinct().limit(MOST_SUFFIXES + 1).collect()]
    if len(found) > MOST_SUFFIXES:
        raise ValueError(f"more than {MOST_SUFFIXES} suffixes")
    return tuple(sorted(x for x in found if x))


def _labels(host, suffixes):
    """Number of labels of the host's suffix: that of the longest rule that fits, one less for exceptions, 1 if none does."""
    if suffixes is None:
        return F.when(host.rlike(rf"(^|\.)({'|'.join(SECOND_LEVELS)})\.[a-z]{{2}}$"), 2).otherwise(1)
    out, exceptions = F.lit(1), F.lit(None).cast("int")
    by: dict[tuple[int, str], list[str]] = {}
    for rule in suffixes:
        kind, name = ("!", rule[1:]) if rule.startswith("!") else ("*", rule[2:]) if rule.startswith("*.") else ("", rule)
        by.setdefault((name.count(".") + 1 + (kind == "*"), kind), []).append(name)
    for (n, kind), names in sorted(by.items()):
        fits = F.substring_index(host, ".", -(n - (kind == "*"))).isin(*names)
        if kind == "!":
            exceptions = F.when(fits, n - 1).otherwise(exceptions)
        else:
            out = F.when(fits & (F.size(F.split(host, r"\.")) >= n), n).otherwise(out)
    return F.coalesce(exceptions, out)


def _last(host, n):
    """The last n labels of the host."""
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - n + 1), n), ".")


def suffix_of(host, suffixes=None):
    return _last(host, _labels(host, suffixes))


def domain_of(host, suffixes=None):
    return _last(host, _labels(host, suffixes) + 1)


def rule_of(host, path, rules=RULES):
    """(verdict, rule): that of the longest rule that fits, else nulls."""
    verdict = rule = F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: len(r[1])):
        at, _, rest = name.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
        rule = F.when(fits, F.lit(name)).otherwise(rule)
    return verdict, rule


def _shrunk(children: DataFrame, parents: DataFrame | None, key: str, up: str) -> DataFrame:
    """children (key, up, n, bad) with the mean above each (`m`) and the fitted strength of the level (`k`)."""
    if parents is None:
        top = children.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        above = top.select(((F.coalesce("bad", F.lit(0)) + 1.0) / (F.coalesce("n", F.lit(0)) + 2.0)).alias("m"))
        seen = children.crossJoin(F.broadcast(above))
    else:
        seen = children.join(parents.select(F.col(up), F.col("mean").alias("m")), up)
    noise = F.col("n") * F.col("m") * (1 - F.col("m"))
    spread = seen.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) - noise).alias("over"), F.sum((F.col("n") - 1) * noise).alias("scale")
    )
    rho = F.coalesce(F.col("over") / F.nullif(F.col("scale"), F.lit(0.0)), F.lit(LEAST_RHO))
    strength = spread.select((1 / F.greatest(F.lit(LEAST_RHO), F.least(F.lit(MOST_RHO), rho)) - 1).alias("k"))
    both = seen.crossJoin(F.broadcast(strength))
    return both.withColumn("mean", (F.col("bad") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k")))


def reputation(hosts: DataFrame, limit: float = LIMIT, z: float = Z, suffixes=None) -> DataFrame:
    """host, mean, lower, blocked, n_pages, from host, n_pages, n, bad: one row for each host.

    Hosts without labelled pages have their domain's posterior as a prior alone.
    """
    named = hosts.withColumns({"domain": domain_of(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)})
    domains = named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = materialize(_shrunk(tops, None, "suffix", ""), "suffixes")
    domains = materialize(_shrunk(domains, tops, "domain", "suffix").select("domain", "mean"), "domains")
    found = _shrunk(named, domains, "host", "domain")
    size = F.col("n") + F.col("k") + 1
    lower = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / size)
    return found.select("host", "n_pages", "mean", lower.alias("lower"), (lower > limit).alias("blocked"))


def judge(
    pages: DataFrame, labels: DataFrame, rules=RULES, limit: float = LIMIT, z: float = Z, suffixes: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule, verdict, mean, lower: a row for each row of pages.

    A page's outcome is bad if the label of its id says quality 0 or toxic 1;
    rows without an id or without either label say nothing, repeated labels
    count as often as they stand. A null url has an empty host and path. Hot
    hosts are looked up by broadcast, all others by shuffle. suffixes (column
    `suffix`, MOST_SUFFIXES rows at most) are the rules of a public suffix list;
    without it SECOND_LEVELS stand for one. Other columns are not looked at.
    """
    rules_of_suffixes = None if suffixes is None else suffix_rules(suffixes)
    url = F.col("url").cast("string")
    seen = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    outcome = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0
    )
    told = (
        labels.select(F.col("doc_id").cast("long").alias("page_id"), outcome.cast("long").alias("bad"))
        .where("page_id is not null and bad is not null")
        .groupBy("page_id")
        .agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    )
    # rows without an id have keys of their own that no label has, which spreads them
    own_key = F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit("none "), F.hex(F.xxhash64("host", "path"))))
    hosts = (
        seen.select("host", own_key.alias("key"))
        .join(told.select(F.col("page_id").cast("string").alias("key"), "n", "bad"), "key", "left")
        .groupBy("host")
        .agg(F.count("*").alias("n_pages"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    known = materialize(reputation(materialize(hosts, "hosts"), limit, z, rules_of_suffixes), "reputation")
    told_by = F.col("_found")
    verdict, rule = rule_of(F.col("host"), F.col("path"), rules)
    return lookup(seen, "host", known, "n_pages").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(told_by["blocked"], "block").otherwise("allow")).alias("verdict"),
        told_by["mean"].alias("mean"),
        told_by["lower"].alias("lower"),
    )
