"""URL filter: explicit rules first, the reputation of the host for all other urls.

Method (empirical Bayes). Labelled page outcomes (good or not) are counted per host, registered
domain and suffix. A suffix' rate of good pages is shrunk to the rate of all pages, a domain's to
its suffix', a host's to its domain's: each level has a beta prior whose mean is the posterior
mean one level up and whose weight is estimated from the outcomes, by matching the spread of the
rates at that level (beta-binomial moments). A host is allowed when the lower bound of its
posterior, ``deviations`` standard deviations below the mean, reaches ``least_good``. Hosts
without an outcome take the prior of their domain, suffix, or all pages.

Outcomes come from labelled documents: a page shows a document when one of its text blocks is a
line of that document (white space made equal, ``least_words`` words or more). Lines on which
labelled documents disagree say nothing. A page is good when at least half of the telling lines
it shows are good; pages with the same url and html count once.

All steps are joins and aggregates that combine before the shuffle. One row per line, page or
host is all that travels; texts become 64-bit keys before. The reputations are one row per host;
whether they are broadcast is decided by the size they were written with.

Results of odd rows: a NULL url, or one without ``://``, has an empty host and path, fits no rule
and is judged by the reputation of the empty host. Urls have any length. NULL or empty html shows
no outcome. Repeated rows are judged alike, each for itself. Without any label, every rate is that
of the prior above all (``prior_good``). Ties: of rules of equal length the one with the longer
host wins; a bound equal to ``least_good`` allows. Extra columns pass through; those called like a
result column give way to it. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import SPACE_CLASS, set_aside, stored, without

# Public suffixes of two labels; any other suffix is the last label.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.in", "co.jp", "ne.jp", "or.jp",
    "co.kr", "co.nz", "co.za", "com.ar", "com.br", "com.cn", "com.mx", "com.tr", "com.tw",
)
# Character references that can stand in a line.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

HIDDEN = r"(?is)<script\b.*?</script[^>]*>|<style\b.*?</style[^>]*>|<!--.*?-->"
TAG = r"<[^>]*>"


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains where the path starts with ``/path``."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class Settings:
    least_words: int = 8  # shortest line that tells where a page's text is from
    prior_good: float = 0.5  # rate above all levels, worth ``prior_pages`` pages
    prior_pages: float = 2.0
    least_weight: float = 1.0  # bounds of the estimated prior weights, in pages
    most_weight: float = 1000.0
    deviations: float = 1.645
    least_good: float = 0.5


def _name_pattern(part: str) -> str:
    two = "|".join(re.escape(s) for s in SUFFIXES)
    suffix = f"(?:{two}|[^.]+)"
    return rf"(?:^|\.)({suffix})$" if part == "suffix" else rf"(?:^|\.)([^.]+\.{suffix}|[^.]*)$"


SUFFIX_PATTERN, DOMAIN_PATTERN = _name_pattern("suffix"), _name_pattern("domain")
HOST_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
NAME_PATTERN = r"(?s)^(?:.*@)?([^:]*)"
ADDRESS = r"^[0-9.]*$|^\["


def url_parts(url: Column) -> dict[str, Column]:
    """``host`` (A-Z lower-cased) and ``path`` of a url; empty when there is none."""
    known = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(known, HOST_PATTERN, 1)
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return {"host": F.translate(host, upper, lower), "path": F.regexp_extract(known, HOST_PATTERN, 2)}


def levels(host: Column) -> dict[str, Column]:
    """Registered domain and suffix; an address without name is its own domain, without suffix."""
    name = F.regexp_extract(host, NAME_PATTERN, 1)
    address = host.rlike(ADDRESS)
    return {
        "domain": F.when(address, host).otherwise(F.regexp_extract(name, DOMAIN_PATTERN, 1)),
        "suffix": F.when(address, F.lit("")).otherwise(F.regexp_extract(name, SUFFIX_PATTERN, 1)),
    }


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct of rule and verdict; NULL when none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _decoded(text: Column) -> Column:
    for reference, char in REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(char))
    return text


def _line_keys(lines: Column, least_words: int) -> Column:
    """Keys of the lines with enough words, white space made equal."""
    even = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, f"{SPACE_CLASS}+", " ")))
    long = F.filter(even, lambda x: F.size(F.split(x, " ")) >= least_words)
    return F.array_distinct(F.transform(long, lambda x: F.xxhash64(x)))


def page_outcomes(
    pages: DataFrame, documents: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """(host, good): one row per distinct page that shows lines of labelled documents."""
    judged = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("_good"))
    least = settings.least_words
    told = documents.select("doc_id", _line_keys(F.split("text", "\n"), least).alias("_keys")).join(judged, "doc_id")
    telling = (
        told.select(F.explode("_keys").alias("_line"), "_good").groupBy("_line")
        .agg(F.min("_good").alias("_good"), F.max("_good").alias("_most")).where("_good = _most").drop("_most"))
    blocks = F.transform(F.split(F.regexp_replace("html", HIDDEN, " "), TAG), lambda x: _decoded(x))
    shown = stored(pages.select(
        url_parts(F.col("url"))["host"].alias("host"), F.xxhash64("url", "html").alias("_page"),
        F.explode(_line_keys(blocks, least)).alias("_line")))
    # A line that very many pages show is one row here; what is left is small or joined as AQE splits it.
    found = stored(shown.select("_line").distinct().join(telling, "_line"))
    return (
        shown.join(found, "_line").groupBy("_page")
        .agg(F.min("host").alias("host"), (2 * F.sum("_good") >= F.count(F.lit(1))).alias("good"))
        .select("host", "good"))


def _prior_weight(children: DataFrame, settings: Settings) -> DataFrame:
    """One row: pages that the prior of this level is worth, from children with n, k and the mean above."""
    n, k, m = F.col("n"), F.col("k"), F.col("above")
    spread = F.sum((k - n * m) * (k - n * m) - n * m * (1 - m))
    share = spread / F.nullif(F.sum(n * (n - 1) * m * (1 - m)), F.lit(0.0))
    least, most = 1 / (1 + settings.most_weight), 1 / (1 + settings.least_weight)
    held = F.least(F.greatest(F.coalesce(share, F.lit(least)), F.lit(least)), F.lit(most))
    return children.agg(((1 - held) / held).alias("weight"))


def reputations(hosts: DataFrame, outcomes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per distinct host: outcomes ``n``, good ones ``k``, posterior ``mean`` and lower ``bound``."""
    counts = outcomes.where("host is not null and good is not null").groupBy("host").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.count_if("good").cast("double").alias("k"))
    every = hosts.select("host").where("host is not null").distinct().join(counts, "host", "full")
    every = stored(every.select(
        "host", F.coalesce("n", F.lit(0.0)).alias("n"), F.coalesce("k", F.lit(0.0)).alias("k"),
        *[c.alias(name) for name, c in levels(F.col("host")).items()]))
    totals = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = every.groupBy("suffix", "domain").agg(*totals)
    suffixes = every.groupBy("suffix").agg(*totals)
    a = settings.prior_good * settings.prior_pages
    everything = every.agg(
        ((F.coalesce(F.sum("k"), F.lit(0.0)) + a) / (F.coalesce(F.sum("n"), F.lit(0.0)) + settings.prior_pages))
        .alias("above"))

    def shrunk(children: DataFrame, keys: list[str]) -> DataFrame:
        """Adds the prior's weight and the posterior mean to children that know the mean above."""
        # The weight is a global aggregate: one row.
        weighted = children.crossJoin(F.broadcast(_prior_weight(children, settings)))
        mean = (F.col("k") + F.col("weight") * F.col("above")) / (F.col("n") + F.col("weight"))
        return weighted.select(*keys, "n", "k", "above", "weight", mean.alias("mean"))

    top = shrunk(suffixes.crossJoin(F.broadcast(everything)), ["suffix"])
    middle = shrunk(
        domains.join(top.select("suffix", F.col("mean").alias("above")), "suffix"), ["suffix", "domain"])
    low = shrunk(every.join(
        middle.select("suffix", "domain", F.col("mean").alias("above")), ["suffix", "domain"]), ["host"])
    pages = F.col("n") + F.col("weight")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (pages + 1))
    return low.select("host", "n", "k", "mean", (F.col("mean") - settings.deviations * deviation).alias("bound"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], outcomes: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row."""
    own = without(pages, "host", "path", "rule", "verdict")
    aside = set_aside(own, "url")
    parts = aside.withColumns(url_parts(F.col("url")))
    known = stored(reputations(parts, outcomes, settings).select("host", F.col("bound").alias("_bound")))
    fitted = parts.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("_bound") >= settings.least_good, F.lit("allow")).otherwise(F.lit("block"))
    return fitted.join(known, "host", "left").select(
        *aside.columns, "host", "path", F.col("_fit.rule").alias("rule"),
        F.coalesce("_fit.verdict", method).alias("verdict"),
    ).toDF(*own.columns, "host", "path", "rule", "verdict")
