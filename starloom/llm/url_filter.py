"""URL rules, and host reputations by empirical Bayes where no rule speaks.

Labelled page outcomes (good or not) are counted per host, registered domain and suffix. Each
level's good rate is shrunk towards the level above: a level's prior is a beta distribution whose
mean is the parent's shrunk rate and whose strength is the moment estimate of how little the
level's rates differ from their parents' (at least ``MIN_STRENGTH``). A host is blocked if its
posterior puts at least ``SURE`` of its weight on rates below ``MIN_GOOD``: the upper bound of the
posterior is its ``SURE`` quantile, and it is below ``MIN_GOOD`` if the regularised incomplete beta
function there is that large. The function is worked out by its continued fraction.

A registered domain is a public suffix and one label. Public suffixes of two labels are those whose
last label is a country and whose first one is ``SECOND_LEVEL``, and what ``suffixes`` names; any
other suffix is the last label.

Counts are summed before the shuffle, so a host with a third of all pages is one row by then. The
reputations are one row per host, joined by broadcast when counted small. Defined cases: a null
URL or one without ``://`` has empty host and path, no rule, and the root's reputation, as has
any host without a dot for its domain and suffix. Outcomes that are null count for nothing. Of
rules that fit with equal length the later one counts. Repeated pages get a row each; other columns
are kept in ``row``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import ascii_lower, join_measured, let, written

# (verdict, host, path), matched by host and its subdomains and by the path's beginning.
RULES: list[tuple[str, str, str]] = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# First labels of public suffixes below a country's, as in co.in or com.cn.
SECOND_LEVEL = "ac co com edu go gob gov gouv govt ltd me mil ne net nom or org plc sch".split()
# Countries under which such labels are registered by anyone, and are no suffixes.
PLAIN_COUNTRIES = "at ch cz de dk eu fi fr it nl no se us".split()
# Others, sites of unrelated owners.
OTHER_SUFFIXES = ["blogspot.com", "github.io", "herokuapp.com", "netlify.app", "pages.dev", "wordpress.com"]
MIN_STRENGTH = 2.0
MAX_STRENGTH = 1000.0
MIN_GOOD = 0.6
SURE = 0.95
# Terms of the continued fraction; for strengths of a million, far more than are needed.
TERMS = 200


def host_of(url: Column) -> Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(text, r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.regexp_extract(text, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def levels(host: Column, suffixes: list[str] = OTHER_SUFFIXES) -> Column:
    """(suffix, domain) of a host; its port is left out."""
    name = F.regexp_replace(host, r":[0-9]*$", "")

    def split(labels: Column) -> Column:
        two = F.array_join(F.slice(labels, -2, 2), ".")
        country, below = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
        by_country = (
            (F.length(country) == 2) & ~country.isin(PLAIN_COUNTRIES) & below.isin(SECOND_LEVEL)
        )
        last = F.when(
            (F.size(labels) > 1) & (by_country | two.isin(suffixes)), F.lit(2)
        ).otherwise(F.lit(1))
        return let(
            last,
            lambda n: F.struct(
                F.array_join(F.slice(labels, -n, n), ".").alias("suffix"),
                F.when(
                    F.size(labels) > n, F.array_join(F.slice(labels, -n - 1, n + 1), ".")
                )
                .otherwise(F.array_join(labels, "."))
                .alias("domain"),
            ),
        )

    return let(F.split(name, r"\."), split)


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The rule that fits with the longest text, as (verdict, rule), or null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))
        found = F.when(fits, rule).otherwise(found)
    return found


def _shrunk(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """Children (.., n, good, parent key) with their beta posterior ``a``, ``b`` and ``mean``."""
    # Parents without labelled pages have rows too, so that the join is whole.
    parents = parents.select(parent, F.col("mean").alias("prior"))
    rows = written(join_measured(children, written(parents, "parents"), [parent]), "children")
    # Of the children with labels: how far their rates lie from the parents' beyond chance.
    off = F.col("good") / F.col("n") - F.col("prior")
    chance = F.col("prior") * (1 - F.col("prior"))
    found = (
        rows.where("n > 0")
        .agg(
            F.sum((F.col("n") - 1) * chance).alias("chance"),
            F.sum(F.col("n") * off * off - chance).alias("beyond"),
        )
        .first()
    )
    strength = MAX_STRENGTH
    if found["beyond"] is not None and found["beyond"] > 0:
        strength = found["chance"] / found["beyond"] - 1
    strength = min(max(strength, MIN_STRENGTH), MAX_STRENGTH)
    a = F.col("good") + strength * F.col("prior")
    b = F.col("n") - F.col("good") + strength * (1 - F.col("prior"))
    return rows.withColumn("a", a).withColumn("b", b).withColumn("mean", a / (a + b))


def reputations(outcomes: DataFrame) -> DataFrame:
    """(host, below) for every host, from rows (host, good); ``good`` is null if not known.

    ``below`` is the weight of the host's posterior on rates under ``MIN_GOOD``.
    """
    known = F.col("good").isNotNull()
    hosts = written(
        outcomes.groupBy("host")
        .agg(F.count_if(known).alias("n"), F.count_if(known & F.col("good")).alias("good"))
        .withColumn("level", levels(F.col("host")))
        .select("host", "level.domain", "level.suffix", "n", "good"),
        "hosts",
    )
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("root", F.lit(""))
    root = hosts.agg(*sums).select(
        F.lit("").alias("root"),
        (
            (F.coalesce("good", F.lit(0)) + MIN_STRENGTH / 2)
            / (F.coalesce("n", F.lit(0)) + MIN_STRENGTH)
        ).alias("mean"),
    )
    by_suffix = _shrunk(suffixes, root, "root")
    by_domain = _shrunk(domains, by_suffix, "suffix")
    by_host = _shrunk(hosts.drop("suffix"), by_domain.drop("suffix"), "domain")
    return by_host.select("host", beta_weight(F.col("a"), F.col("b"), MIN_GOOD).alias("below"))


def log_gamma(x: Column) -> Column:
    """Of positive numbers, by Stirling's series from 8 on; good to 12 digits."""
    # ln gamma(x) is ln gamma(x + 8) less the logarithms of x, x + 1, ... x + 7.
    low = F.log(x)
    for k in range(1, 8):
        low = low + F.log(x + k)
    y = x + 8
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - low


def beta_weight(a: Column, b: Column, x: float) -> Column:
    """The weight that a beta distribution has below ``x``."""

    def lower(a: Column, b: Column, x: float) -> Column:
        # Lentz's way through the continued fraction, from its first term on.
        tiny = 1e-300
        front = F.exp(
            log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * math.log(x) + b * math.log1p(-x)
        )

        def kept(value: Column) -> Column:
            return F.when(F.abs(value) < tiny, F.lit(tiny)).otherwise(value)

        def step(acc: Column, m: Column) -> Column:
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            d1 = 1 / kept(1 + even * acc["d"])
            c1 = kept(1 + even / acc["c"])
            d2 = 1 / kept(1 + odd * d1)
            c2 = kept(1 + odd / c1)
            return F.struct(c2.alias("c"), d2.alias("d"), (acc["f"] * d1 * c1 * d2 * c2).alias("f"))

        d = 1 / kept(1 - (a + b) * x / (a + 1))
        start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("f"))
        terms = F.transform(F.sequence(F.lit(1), F.lit(TERMS)), lambda i: i.cast("double"))
        return front * F.aggregate(terms, start, step)["f"] / a

    # The fraction converges quickly on the side of the mean only.
    left = F.lit(x) < (a + 1) / (a + b + 2)
    return F.when(left, lower(a, b, x)).otherwise(1 - lower(b, a, 1 - x))


def judge(
    pages: DataFrame,
    good: Column,
    rules: list[tuple[str, str, str]] = RULES,
    url: str = "url",
) -> DataFrame:
    """(row, host, path, rule, verdict) for every page; ``good`` is its outcome or null."""
    rows = pages.select(
        F.struct(*[pages[c] for c in pages.columns]).alias("row"),
        host_of(pages[url]).alias("host"),
        path_of(pages[url]).alias("path"),
        good.alias("good"),
    )
    known = written(reputations(rows.select("host", "good")), "reputations")
    by_rule = ruled(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("below") >= SURE, F.lit("block")).otherwise(F.lit("allow"))
    return (
        join_measured(rows.drop("good"), known, ["host"])
        .withColumn("by_rule", by_rule)
        .select(
            "row",
            "host",
            "path",
            F.col("by_rule.rule").alias("rule"),
            F.coalesce("by_rule.verdict", by_host).alias("verdict"),
        )
    )
