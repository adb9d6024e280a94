"""URL filters: rules by longest match, then empirical-Bayes host reputation. Native.

Reputation is the rate of bad outcomes among labelled pages. A page's outcome is that of the item
it shows: by default the document whose id ends its path (``/en/7817.html``), found among the labels
of documents. Counts of a host are shrunk towards
its registered domain's rate, the domain's towards its suffix's, the suffix's towards the overall
rate: each level has a beta prior whose mean is the parent's posterior mean and whose strength is
fitted to the level's own spread by moments (between 1 and ``MAX_STRENGTH``). A host is blocked if
even the lower bound of its posterior is over the threshold, so hosts with little evidence pass.

Pages are joined with one row a host, never with each other; counts are pre-aggregated before
they are shuffled, and a host with a third of all pages is split by Spark's skew join.

Defined results: a page that shows no labelled item is no evidence; a null url, or one without ``://``, has an empty host and path; the empty host
has a reputation like any other. Repeated label rows count once (bad if any of them is), repeated pages as often as they occur. Very
long urls are judged whole; an id of more than 18 digits is none. Bounds equal to the threshold
pass. Without
labels every host has the prior mean 0.5 with no evidence and passes. Empty tables give empty
results; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
THRESHOLD, Z, MAX_STRENGTH = 0.5, 1.645, 1000.0

#: Second-level labels under which names are registered; fixed values.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/en/", "block"),
    UrlRule("example.com", "/en/7", "allow"),
    UrlRule("net", "/de/", "allow"),
    UrlRule("example.net", "/de/8", "block"),
    UrlRule("org", "/es/", "block"),
)


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    return df.withColumns({"host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def matched(rules: Sequence[UrlRule], value: str) -> Column:
    """``value`` (name or verdict) of the longest rule that fits host and path; null if none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, value))).otherwise(out)
    return out


def levels(host: str = "host") -> dict[str, Column]:
    """Registered domain and public suffix of a host."""
    parts = F.split(F.col(host), r"\.")
    deep = F.size(parts)
    two = (deep >= 3) & (F.length(F.element_at(parts, -1)) == 2) & F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")).isin(*SECOND_LEVEL)
    last = lambda n: F.when(deep >= n, F.concat_ws(".", F.slice(parts, -n, n))).otherwise(F.col(host))
    return {"domain": F.when(two, last(3)).otherwise(last(2)), "suffix": F.when(two, last(2)).otherwise(last(1))}


def _shrunk(child: DataFrame, parent: DataFrame, key: str | None) -> DataFrame:
    """``child`` (n, bad) with its posterior's a and b under its parent's mean (column mean)."""
    total = child.agg(F.sum("n").alias("N"), F.sum("bad").alias("X"), F.sum(F.expr("if(n > 0, bad * bad / cast(n as double), 0D)")).alias("Q"), F.sum(F.col("n").cast("double") * F.col("n")).alias("N2"), F.count_if(F.col("n") > 0).alias("k"))
    fit = total.select(
        F.expr("X / cast(nullif(N, 0) as double)").alias("m"), F.expr("Q - X * (X / cast(nullif(N, 0) as double))").alias("s"), F.expr("N - N2 / nullif(N, 0)").alias("t"), "k"
    ).select(F.expr(f"coalesce(least({MAX_STRENGTH}D, greatest(1D, m * (1 - m) / nullif(greatest(s - (k - 1) * m * (1 - m), 0D), 0D) * t - 1)), {MAX_STRENGTH}D)").alias("strength"))
    # both sides of these joins but the children are single rows
    with_prior = child.join(parent, key, "left") if key else child.crossJoin(F.broadcast(parent))
    return with_prior.crossJoin(F.broadcast(fit)).withColumn("a", F.expr("strength * mean + bad")).withColumn("b", F.expr("strength * (1 - mean) + n - bad")).drop("mean", "strength")


#: The document that a page shows: the number that ends its path.
SHOWN = r"/([0-9]{1,18})(?:/|\.html?)?$"


def shown_document(path: str = "path") -> Column:
    """The id at the end of a path such as ``/en/7817.html``; null where there is none."""
    return F.nullif(F.regexp_extract(path, SHOWN, 1), F.lit("")).try_cast("long")


def reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a host of ``pages`` (host, item): host, n, bad, posterior_mean, lower_bound.

    ``labels`` has item and bad (boolean): a page's outcome is that of its item.
    """
    outcome = labels.where("item is not null and bad is not null").groupBy("item").agg(F.bool_or("bad").cast("long").alias("bad"))
    # counted by (host, item) first, so neither a host nor an item with a third of all pages meets in one task
    seen = pages.groupBy("host", "item").agg(F.count(F.lit(1)).alias("times")).join(outcome, "item", "left")
    counted = seen.groupBy("host").agg(F.coalesce(F.sum(F.expr("if(bad is not null, times, 0)")), F.lit(0)).alias("n"), F.coalesce(F.sum(F.expr("bad * times")), F.lit(0)).alias("bad")).withColumns(levels())
    hosts = materialize(counted, "hosts")  # read by all three levels
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    root = suffixes.agg(F.expr("coalesce(sum(bad) / cast(nullif(sum(n), 0) as double), 0.5D)").alias("mean"))
    mean = F.expr("a / (a + b)").alias("mean")
    suffix_mean = _shrunk(suffixes, root, None).select("suffix", mean)
    domain_mean = _shrunk(domains, suffix_mean, "suffix").select("domain", mean)
    post = _shrunk(hosts, domain_mean, "domain").withColumn("posterior_mean", F.expr("a / (a + b)"))
    return post.select("host", "n", "bad", "posterior_mean", F.expr(f"greatest(0D, posterior_mean - {Z}D * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))").alias("lower_bound"))


def judge(pages: DataFrame, labels: DataFrame, item: Column | None = None, rules: Sequence[UrlRule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's posterior_mean and lower_bound for each page.

    ``item`` (over page_id, url, host and path) names what the page shows, as ``labels`` (item, bad)
    does; by default the document whose id ends the path.
    """
    parts = url_parts(pages.select("page_id", "url")).withColumn("item", shown_document() if item is None else item)
    rep = reputation(parts, labels).select("host", "posterior_mean", "lower_bound")
    verdict = F.coalesce(matched(rules, "verdict"), F.when(F.col("lower_bound") > threshold, "block").otherwise("allow"))
    return parts.join(rep, "host", "left").select("page_id", "host", "path", matched(rules, "name").alias("rule"), verdict.alias("verdict"), "posterior_mean", "lower_bound")
