"""URL filter: explicit host/path rules, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host, registered domain and suffix. From the top
down, each level's rate is shrunk towards its parent's by a beta-binomial prior whose strength is
estimated from the spread of that level's rates (moments). A host is blocked if the lower bound of its
posterior bad rate is over the threshold: few outcomes move a host little from its domain's rate.

Registered domain: the last two labels of the host without user info and port (three where the last two are a known two-label
suffix); suffix: what follows the domain's first label. A numeric address (four numbers, or in brackets) is its own domain and suffix.

Defined results: a null url or one without ``://`` has an empty host and path and is allowed; a host
without outcomes takes its domain's posterior; several outcomes of one page count once (bad if any is);
null outcomes do not count; no outcomes at all: everything without a rule is allowed; repeated rows are judged one by one;
an empty table gives no rows. Other columns are kept; those named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialize

#: (host and path, verdict); a rule fits its host and all subdomains if the url's path starts with its path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
THRESHOLD, Z = 0.5, 1.645  # block where posterior mean - Z deviations is over THRESHOLD
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0  # of the priors, in outcomes
#: Suffixes of two labels. Well-known public ones; a parameter.
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "co.za", "com.cn")
ADDED = ("host", "path", "rule", "verdict", "bad_rate", "bad_bound")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. The rules are a parameter, so this is one expression."""
    def fits(rule: str) -> Column:
        own, start = rule[:rule.index("/")], rule[rule.index("/"):]
        return ((host == own) | host.endswith("." + own)) & path.startswith(start)
    found = [F.when(fits(r), F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict"))) for r, v in sorted(rules, key=lambda x: (-len(x[0]), x[0]))]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def registered(host: Column, two_labels=TWO_LABELS) -> tuple[Column, Column]:
    """(registered domain, suffix)."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    address = bare.rlike(r"^[0-9]+(\.[0-9]+){3}$") | bare.startswith("[")
    last = F.substring_index(bare, ".", -2)
    domain = F.when(last.isin(*two_labels), F.substring_index(bare, ".", -3)).otherwise(last)
    suffix = F.when(last.isin(*two_labels), last).otherwise(F.substring_index(bare, ".", -1))
    return F.when(address, bare).otherwise(domain), F.when(address, bare).otherwise(suffix)


def _strength(level: DataFrame, parent: str) -> Column:
    """The prior's strength for a level with columns n, bad, and its parent's rate: moments of (rate - parent's rate)."""
    p = F.col(parent)
    spread = F.sum(F.when(F.col("n") > 0, F.col("n") * F.pow(F.col("bad") / F.col("n") - p, F.lit(2.0))))
    noise = F.sum(F.when(F.col("n") > 0, p * (1 - p)))
    even = F.sum(F.when(F.col("n") > 0, F.col("n") * p * (1 - p)))
    # E[spread] = noise + (even - noise) / (1 + strength), so that more spread than noise means a weaker prior.
    share = (spread - noise) / F.nullif(even - noise, F.lit(0.0))
    return F.least(F.greatest(F.coalesce(F.when(share > 0, 1 / share - 1), F.lit(MOST_STRENGTH)), F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))


def _shrunk(level: DataFrame, parent: str, rate: str) -> DataFrame:
    """``level`` with its strength and the shrunk ``rate``."""
    k = level.agg(_strength(level, parent).alias("strength"))
    return level.crossJoin(F.broadcast(k)).withColumn(rate, (F.col("bad") + F.col("strength") * F.col(parent)) / (F.col("n") + F.col("strength")))  # one row


def reputation(hosts: DataFrame, z: float = Z, two_labels=TWO_LABELS) -> DataFrame:
    """(host, n, bad) -> host, bad_rate (posterior mean), bad_bound (its lower bound); null where nothing is labelled."""
    domain, suffix = registered(F.col("host"), two_labels)
    base = hosts.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    total = base.agg((F.sum("bad") / F.nullif(F.sum("n"), F.lit(0))).alias("all_rate"))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = _shrunk(base.groupBy("suffix").agg(*sums).crossJoin(F.broadcast(total)), "all_rate", "suffix_rate").select("suffix", "suffix_rate")
    domains = base.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    domains = _shrunk(domains, "suffix_rate", "domain_rate").select("domain", "domain_rate")
    out = _shrunk(base.join(domains, "domain"), "domain_rate", "bad_rate")
    size = F.col("n") + F.col("strength")
    return out.select("host", "bad_rate", (F.col("bad_rate") - z * F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (size + 1))).alias("bad_bound"))


def judge(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url: str = "url", rules=RULES,
          threshold: float = THRESHOLD, z: float = Z, two_labels=TWO_LABELS) -> DataFrame:
    """``pages`` with host, path, rule, verdict, bad_rate and bad_bound. ``outcomes``: (page_id, bad boolean)."""
    keep = [c for c in pages.columns if c not in ADDED]
    host, path = split_url(F.col(url))
    found = pages.select(*keep, host.alias("host"), path.alias("path"))
    once = outcomes.select(F.col("page_id").alias("__id"), "bad").where("bad is not null").groupBy("__id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counted = found.select(F.col(id_col).alias("__id"), "host").join(once, "__id", "left")
    hosts = counted.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).where("host != ''")
    hosts = materialize(hosts, "url-hosts")  # every level of the reputation reads it
    known = reputation(hosts, z, two_labels).withColumnRenamed("host", "__host")
    out = found.withColumn("__rule", rule_for(F.col("host"), F.col("path"), rules)).join(known, F.col("host") == F.col("__host"), "left")
    method = F.when(F.col("bad_bound") > threshold, "block").otherwise("allow")
    return out.select(*keep, "host", "path", F.col("__rule.rule").alias("rule"), F.coalesce("__rule.verdict", method).alias("verdict"), "bad_rate", "bad_bound")
