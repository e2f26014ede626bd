"""URL filter: rules first, then empirical-Bayes reputation of the host.

Labelled page outcomes are counted by host. Each level is shrunk towards the one above it by a
beta-binomial prior: host to registered domain, domain to suffix, suffix to the overall rate. A
suffix is the last label, or the last two where registrars sell names below both (``SUFFIXES``); the
registered domain is the suffix and the label before it.
The strength of each prior comes from the spread between siblings (method of moments), so levels
whose members differ a lot lend little. A host is blocked when even the lower bound of its
posterior bad rate is above the limit.

``filter_urls`` takes any outcome column, so labels of a trusted source serve as well as
``page_outcome``, the rule the query uses because the pages carry no label. An unlabelled host is
judged by its domain, or else its suffix, or else the overall rate.

Counts are exact and the tables are one row a host, domain or suffix; pages meet the verdicts of
their host in a join that adaptive execution splits when one host holds a third of the pages.

A null url, or one without ://, has an empty host and path. Rules of equal length that fit one page
are settled by code point order, the later one wins. Unlabelled pages count nowhere.
Repeated rows count each time. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import staged

RULES = (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
)
# Public suffixes of two labels.
SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk",
    "co.za", "com.ar", "com.au", "com.bo", "com.br", "com.cn", "com.co", "com.ec", "com.eg", "com.hk", "com.mx", "com.my",
    "com.ng", "com.pe", "com.ph", "com.pk", "com.pl", "com.py", "com.sg", "com.tr", "com.tw", "com.ua", "com.uy", "com.ve",
    "com.vn", "edu.ar", "edu.au", "edu.br", "edu.uy", "gob.ar", "gob.mx", "gov.au", "gov.br", "gov.uk", "gub.uy", "ne.jp",
    "net.au", "net.br", "net.uy", "or.jp", "or.kr", "org.ar", "org.au", "org.br", "org.uk", "org.uy", "org.za",
)
Z = 1.645  # one-sided 95 %
LIMIT = 0.5
BAD_SHARE = 0.1  # of a page's words
STRENGTHS = (1.0, 1000.0)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def page_outcome(html: Column, share: float = BAD_SHARE) -> Column:
    """1 for a bad page, 0 for a good one, null without words: bad if more than ``share`` of its
    words end in a run of three or more symbols, as text that lost its encoding does."""
    text = F.regexp_replace(html, r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")
    words = F.regexp_count(text, F.lit(r"\S+"))
    junk = F.regexp_count(text, F.lit(r"(?:[%#*$~^|]{3,}|(?:&amp;){3,}|&{3,})(?:\s|$)"))
    return F.when(words > 0, (junk > share * words).cast("int"))


def levels(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    last, two, three = (F.substring_index(host, ".", -n) for n in (1, 2, 3))
    wide = two.isin(*suffixes)
    return F.when(wide, three).otherwise(two), F.when(wide, two).otherwise(last)


def _shrunk(table: DataFrame, parent: Column, known: Column) -> tuple[Column, Column]:
    """Posterior mean and size of each row under a prior around its parent's mean. The prior is
    worth no more outcomes than the parent's posterior (``known``) rests on.

    Strength by moments: with rates p of n outcomes around m, the variance between siblings is
    the mean of (p - m)^2 - m(1 - m)/n, and a beta prior of strength s has m(1 - m)/(s + 1)."""
    low, high = STRENGTHS
    m = F.greatest(F.least(parent, F.lit(0.9999)), F.lit(0.0001))
    n, bad = F.col("n"), F.col("bad")
    spread, inner = table.agg(
        F.try_divide(F.sum(n * F.pow(F.try_divide(bad, n) - m, F.lit(2)) - F.when(n > 0, m * (1 - m))), F.sum(n)),
        F.try_divide(F.sum(n * m * (1 - m)), F.sum(n)),
    ).collect()[0]
    strength = high if not spread or spread <= 0 else min(high, max(low, inner / spread - 1))
    prior = F.least(F.lit(float(strength)), known)
    return F.coalesce(F.try_divide(m * prior + bad, prior + n), m), prior + n


def host_reputation(outcomes: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """Posterior of every host from (host, bad); null outcomes count nowhere."""
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = staged(
        outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    bad, n = suffixes.agg(F.sum("bad"), F.sum("n")).collect()[0]

    mean, size = _shrunk(suffixes, F.lit(bad / n if n else 0.0), F.lit(float(n or 0)))
    top = suffixes.select("suffix", mean.alias("parent"), size.alias("known"))
    middle = domains.join(top, "suffix")
    mean, size = _shrunk(middle, F.col("parent"), F.col("known"))
    middle = middle.select("domain", "suffix", mean.alias("parent"), size.alias("known"))
    bottom = hosts.join(middle, ["domain", "suffix"])
    mean, size = _shrunk(bottom, F.col("parent"), F.col("known"))
    return bottom.select("host", "n", "bad", mean.alias("mean"), size.alias("size")).withColumn(
        "lower", F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1)))


def filter_urls(
    pages: DataFrame, bad: Column, url_col: str = "url", rules=RULES, limit: float = LIMIT, suffixes=SUFFIXES,
) -> DataFrame:
    """All columns of ``pages`` but those of the same names, with host, path, rule, verdict,
    and the lower bound of the host's bad rate (``bad_rate_bound``)."""
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "bad_rate_bound")]
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    scores = staged(host_reputation(pages.select(host.alias("host"), bad.cast("bigint").alias("bad")), suffixes)
                    .select("host", F.col("lower").alias("bad_rate_bound")), "reputation")
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("bad_rate_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return (
        pages.select(*own, host.alias("host"), path.alias("path")).join(scores, "host", "left")
        .select(*own, "host", "path", name.alias("rule"), F.coalesce(verdict, judged).alias("verdict"), "bad_rate_bound")
    )
