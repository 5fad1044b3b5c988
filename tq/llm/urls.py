"""URL filters by host reputation, with DataFrame functions only.

Rules (host, path prefix) judge the pages they fit; the longest rule wins. Their verdicts are the
labelled outcomes from which a reputation is learned: the rate of blocked pages of a host is shrunk
towards that of its registered domain, this one towards its suffix, and the suffix towards all pages,
each through a beta prior whose mean is the level above and whose strength is estimated from the
spread between hosts (beta-binomial moments). A page that no rule fits is blocked if the lower bound
of its host's posterior, mean - BOUND standard deviations, is over LIMIT.

Counts are summed per host before anything is joined, so a host with a third of all pages is one row
per task; pages meet their host's posterior in an ordinary join whose skew adaptive execution splits.

Rows: a url that is null or has no ``://`` has an empty host and path, fits no rule and takes the
verdict of the reputation of the empty host; repeated pages are judged each for itself; without any
labelled page the prior mean is 0 and everything unruled is allowed. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tq.llm.common import lower_ascii

#: Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Suffixes of two labels; any other suffix is the last label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "co.za", "com.mx", "com.tr")
BOUND, LIMIT = 1.645, 0.5
#: Bounds of a prior's strength, in pages; the lower one also holds where the spread can't be estimated.
WEAKEST, STRONGEST = 2.0, 1000.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null if none fits. Equally long: the first in the list."""
    rule = verdict = F.lit(None).cast("string")
    for decision, name, prefix in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule, verdict = F.when(fits, name + prefix).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    long = two.isin(*LONG_SUFFIXES)
    return F.when(long, two).otherwise(F.substring_index(host, ".", -1)), F.when(long, three).otherwise(two)


def level(groups: DataFrame, key: str, parent: str | None) -> DataFrame:
    """Sums of the level above the hosts of ``groups``."""
    keys = [key] if parent is None else [key, parent]
    return groups.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def reputation(pages: DataFrame) -> DataFrame:
    """(host, bound) from pages with ``host`` and ``outcome`` (1 blocked, 0 allowed, null unknown)."""
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = (
        pages.groupBy("host")
        .agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).alias("bad"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    )
    # moments of the beta-binomial: groups k, pages N, sum of squares, weighted spread around the mean
    moments = hosts.where("n > 0").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("N"),
        F.sum("bad").alias("B"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("spread"),
    )
    p = F.coalesce(F.col("B") / F.col("N"), F.lit(0.0))
    within = p * (1 - p)
    free = F.col("k") - 1
    rho = (F.col("spread") - F.col("B") * p - within * free) / ((F.col("N") - F.col("squares") / F.col("N") - free) * within)
    usable = (within > 0) & (F.col("k") > 1) & ((F.col("N") - F.col("squares") / F.col("N") - free) > 0)
    strength = F.when(usable & (rho > 0), F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), (1 - rho) / rho))).when(
        usable, F.lit(STRONGEST)
    ).otherwise(F.lit(WEAKEST))
    mean, weight = map(F.lit, moments.select(p, F.round(strength, 6)).first())  # two numbers, whatever the table

    def shrunk(above: Column) -> Column:
        return (F.col("bad") + weight * above) / (F.col("n") + weight)

    suffixes = level(hosts, "suffix", None).select("suffix", shrunk(mean).alias("p1"))
    domains = level(hosts, "domain", "suffix").join(suffixes, "suffix").select("domain", shrunk(F.col("p1")).alias("p2"))
    a = F.col("bad") + weight * F.col("p2")
    b = F.col("n") - F.col("bad") + weight * (1 - F.col("p2"))
    bound = a / (a + b) - BOUND * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.join(domains, "domain").select("host", bound.alias("bound"))


def judged(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page."""
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), verdict.alias("ruling"))
    known = reputation(ruled.select("host", F.when(F.col("ruling") == "block", 1).when(F.col("ruling") == "allow", 0).alias("outcome")))
    learned = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return ruled.join(known, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("ruling", learned).alias("verdict"))
