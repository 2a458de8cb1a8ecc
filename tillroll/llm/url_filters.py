"""Judging page addresses by rules, and by the reputation of their host where no rule fits.

Labelled pages give each host a number of outcomes and of bad ones. A host with few of them says little, so
its rate is shrunk towards its registered domain's, that towards its suffix's, and that towards the rate of
all pages: each level's children are taken to be draws from a beta distribution, whose strength is fitted
to how much the children's rates differ beyond what binomial noise explains. A host is blocked when the
lower bound of its posterior rate lies above the limit; hosts never seen take their parent's posterior.

Everything is grouped before it is joined: one row per host, domain and suffix. The verdicts of hosts that hold a
thousandth of the pages or more, at most a thousand hosts, are broadcast to their pages; all other pages are
joined by host. An address that is null or
has no `://` has an empty host and path, fits no rule and is judged like an unseen host of no domain.
Repeated pages are judged alike, each for itself; an empty table gives no rows. Columns other than those named are
not read, so their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values of the job: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Suffixes of two labels under which hosts are registered; all others are taken to have one. Common ones only: a
# longer list may be put in its place.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp",
    "or.jp", "co.kr", "com.ar", "com.br", "com.cn", "com.hk", "com.mx", "com.sg", "com.tr", "com.tw",
)
# Addresses in numbers, of version 4 or, in brackets, of version 6.
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$"

# Hosts with at least this share of all pages, so as many at most, are broadcast to their pages.
HOT_SHARE = 1000

# A prior counts as this many outcomes at least and at most.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
# Standard deviations below the posterior mean, and the rate of bad pages that is put up with.
BOUND_SDS = 1.64
LIMIT = 0.35


def _rest(url: Column) -> Column:
    """What follows the first `://`."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return F.translate(F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.substring_index(F.substring_index(_rest(url), "#", 1), "?", 1)
    slash = F.instr(rest, "/")
    return F.when(slash > 0, F.substr(rest, slash)).otherwise(F.lit(""))


def _name(host: Column) -> Column:
    """The host without its port."""
    return F.regexp_replace(host, ":[0-9]*$", "")


def _is_address(name: Column) -> Column:
    return name.rlike(ADDRESS)


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where they are listed in SUFFIXES; all addresses share one suffix of their own."""
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    return F.when(_is_address(name), "address").when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it; an address is a domain of its own."""
    name = _name(host)
    listed = F.substring_index(name, ".", -2).isin(*SUFFIXES)
    return (
        F.when(_is_address(name), name)
        .when(listed, F.substring_index(name, ".", -3))
        .otherwise(F.substring_index(name, ".", -2))
    )


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null where none does."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    found = [
        F.when(
            ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(begin)),
            F.struct(F.lit(own + begin).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, own, begin in ranked
    ]
    return F.coalesce(*found)


def _beta(children: DataFrame, parent: str) -> DataFrame:
    """Strength of the beta prior per parent, from its children's `n` and `bad` (method of moments)."""
    sums = children.groupBy(parent).agg(
        F.sum("n").cast("double").alias("total"),
        F.sum("bad").cast("double").alias("bads"),
        F.sum((F.col("bad") * F.col("bad")).cast("double") / F.col("n")).alias("squares"),
        F.sum((F.col("n") * F.col("n")).cast("double")).alias("sizes"),
        F.count("*").cast("double").alias("kids"),
    )
    rate = F.col("bads") / F.col("total")
    noise = rate * (1 - rate)
    # Between-children variance by the usual one-way estimate.
    spread = (F.col("squares") - F.col("bads") * rate - (F.col("kids") - 1) * noise) / (
        F.col("total") - F.col("sizes") / F.col("total")
    )
    spread = F.when((F.col("kids") > 1) & (F.col("total") > F.col("kids")), spread)
    strength = F.when(spread > 0, F.least(F.lit(MOST_STRENGTH), F.greatest(F.lit(LEAST_STRENGTH), noise / spread - 1)))
    return sums.select(parent, F.coalesce(strength, F.lit(MOST_STRENGTH)).alias("strength"))


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """Posterior of hosts, domains and suffixes from labelled outcomes (`host`, `bad` 0/1), each with its key,
    `mean` and `weight` (outcomes and prior together); and mean and weight of all pages.

    Rows without an outcome are left out; without any, the tables are empty and the mean of all is 0. The
    outcomes are counted once, to one stored row per host; all levels stand on that.
    """
    hosts = stored(
        outcomes.where(F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad"),
        "host-outcomes",
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = suffixes.withColumn("every", F.lit("all"))
    every = tops.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    top = (every["bad"] / every["n"], float(every["n"])) if every["n"] else (0.0, 0.0)
    strength = _beta(tops, "every").select("strength").first()
    strength = strength[0] if strength else MOST_STRENGTH

    def shrunk(children: DataFrame, key: str, parent: str, above: DataFrame, prior: DataFrame) -> DataFrame:
        own = children.join(prior, parent).join(above.select(parent, F.col("mean").alias("__above")), parent)
        weight = F.col("n") + F.col("strength")
        mean = (F.col("bad") + F.col("strength") * F.col("__above")) / weight
        return own.select(key, *({"domain", "suffix"} & set(children.columns) - {key}), mean.alias("mean"), weight.alias("weight"))

    weight = F.col("n") + F.lit(strength)
    mean = (F.col("bad") + F.lit(strength) * F.lit(top[0])) / weight
    suffix_rates = suffixes.select("suffix", mean.alias("mean"), weight.alias("weight"))
    domain_rates = shrunk(domains, "domain", "suffix", suffix_rates, _beta(domains, "suffix"))
    host_rates = shrunk(hosts, "host", "domain", domain_rates, _beta(hosts, "domain"))
    return host_rates, domain_rates, suffix_rates, top


def bound(mean: Column, weight: Column) -> Column:
    """Lower end of the posterior rate of bad pages."""
    return mean - BOUND_SDS * F.sqrt(mean * (1 - mean) / (weight + 1))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, bound of every page."""
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    seen = seen.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("__fit"))
    # One row per host that occurs, whatever the number of its pages.
    hosts = seen.groupBy("host").agg(F.count(F.lit(1)).alias("__pages")).select(
        "host", "__pages", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")
    )
    by_host, by_domain, by_suffix, top = reputation(outcomes)
    for rates, key in ((by_host, "host"), (by_domain, "domain"), (by_suffix, "suffix")):
        hosts = hosts.join(
            rates.select(key, bound(F.col("mean"), F.col("weight")).alias(f"of_{key}")), key, "left"
        )
    of_every = bound(F.lit(top[0]), F.lit(top[1]))
    known = stored(
        hosts.select("host", F.coalesce("of_host", "of_domain", "of_suffix", of_every).alias("bound"), "__pages"),
        "host-bounds",
    )
    least = max(1, (known.agg(F.sum("__pages")).first()[0] or 0) // HOT_SHARE)
    hot = known.where(F.col("__pages") >= least).select("host", "bound")
    large = seen.join(F.broadcast(hot), "host", "left")
    few = known.where(F.col("__pages") < least).select("host", "bound")
    rest = large.where("bound is null").drop("bound").join(few, "host")
    verdict = F.coalesce(F.col("__fit.verdict"), F.when(F.col("bound") > limit, "block").otherwise("allow"))
    return large.where("bound is not null").unionByName(rest).select(
        "page_id", "host", "path", F.col("__fit.rule").alias("rule"), verdict.alias("verdict"), "bound"
    )
