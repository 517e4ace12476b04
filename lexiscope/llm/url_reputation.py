"""URL filter: explicit rules, then empirical-Bayes reputation of hosts.

Labelled page outcomes (1: bad) are counted by host, by registered domain and by suffix.  The bad share of a
suffix is shrunk towards the global one, that of a domain towards its suffix's, that of a host towards its
domain's, each by a beta-binomial prior whose strength comes from how far the groups of that level spread around
their parents (method of moments).  What is left for a host is a beta posterior of its bad share; the host is blocked
where that posterior puts at least ``CERTAINTY`` of its mass above ``LIMIT``.  A page follows the longest
rule that fits its URL, else its host.

Built-in functions only.  Counts are summed before they move; where a row must find its group's posterior, the at most
256 groups with over 1/256 of the rows are broadcast and the others are joined by shuffle.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import find_by, ready, written
from lexiscope.llm.quality_rules import log_gamma

#: (verdict, host, path): a rule fits its host and all hosts below it, where the URL's path begins with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
MAX_RULES = 1_000
#: A host is blocked if its bad share is above LIMIT with a posterior probability of at least CERTAINTY.
LIMIT, CERTAINTY = 0.5, 0.95
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1_000.0
#: Posteriors of up to so many pages are integrated by a continued fraction, larger ones by Paulson's cube roots.
EXACT_PAGES, FRACTION_STEPS = 10_000, 300

#: Suffixes of two labels under which domains are registered, beside all single labels.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx",
    "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for a null or a text without ``://``."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, _URL, 1), UPPER, LOWER), F.regexp_extract(text, _URL, 2)


def groups_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user, port and final dot.

    An IPv4 address or a bracketed IPv6 one is its own domain below the suffix ``ip``; a host of one label is its own
    domain and suffix.
    """
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"(:\d*)?\.?$", "")
    labels = F.split(bare, r"\.")
    last_two = F.substring_index(bare, ".", -2)
    address = bare.rlike(r"^(\d{1,3}\.){3}\d{1,3}$|^\[.*\]$")
    two = last_two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(address, F.lit("ip")).when(two, last_two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(address, bare).when(two & (F.size(labels) > 2), F.substring_index(bare, ".", -3)).otherwise(last_two)
    return domain, suffix


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null where none fits; of equally long rules the one with the
    longer host, then the ASCII-least.  At most ``MAX_RULES`` rules (they are part of the plan)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    name = verdict = F.lit(None).cast("string")
    # The last rule of this order that fits is written outermost.
    for what, where, begins in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(begins)
        name, verdict = F.when(fits, where + begins).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def outcomes_of(labels: DataFrame) -> DataFrame:
    """``page_id, bad`` from rows ``doc_id, quality, toxic``: bad where a row of the id says quality 0 or toxic 1.

    Ids with only null labels have no outcome; several rows of an id count as one page, bad if one is.
    """
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(bad).alias("bad")).where("bad is not null")


def strength(groups: DataFrame) -> float:
    """Strength of the prior that spreads ``groups`` (``n, bad, mu``) around their parents' shares ``mu``.

    Method of moments: the sum of n (p - mu)^2 / (mu (1 - mu)) has expectation k + (N - k) rho over k groups of N
    pages, and rho is 1 / (strength + 1).  Kept within WEAKEST and STRONGEST, the latter also where no group has
    two pages.
    """
    off = F.col("bad") / F.col("n") - F.col("mu")
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * off * off / (F.col("mu") * (1 - F.col("mu")))).alias("s"),
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    if not row.n or row.n <= row.k or row.s <= row.k:
        return STRONGEST
    rho = (row.s - row.k) / (row.n - row.k)
    return min(STRONGEST, max(WEAKEST, 1 / rho - 1))


def above_limit(a: str, b: str, limit: float, certainty: float) -> Column:
    """Whether a beta(a, b) variable is above ``limit`` with a probability of at least ``certainty``.

    Up to EXACT_PAGES the incomplete beta function is summed by its continued fraction (modified Lentz, on the side of
    the mean where it converges fast); beyond, Paulson's cube-root approximation is off by far less than a page.
    """
    x, y = f"{limit!r}D", f"{1 - limit!r}D"
    tiny = "1e-300D"

    def below(p: str, q: str, at: str) -> str:  # P(beta(p, q) <= at), good for at < (p + 1) / (p + q + 2)
        keep = lambda v: f"(case when abs({v}) < {tiny} then {tiny} else {v} end)"
        even = f"(m * ({q} - m) * {at} / (({p} + 2 * m - 1.0D) * ({p} + 2 * m)))"
        odd = f"(-({p} + m) * ({p} + {q} + m) * {at} / (({p} + 2 * m) * ({p} + 2 * m + 1.0D)))"
        d1, c1 = f"1.0D / {keep(f'(1.0D + {even} * s.d)')}", keep(f"(1.0D + {even} / s.c)")
        d2, c2 = f"1.0D / {keep(f'(1.0D + {odd} * s.d)')}", keep(f"(1.0D + {odd} / s.c)")
        first = f"1.0D / {keep(f'(1.0D - ({p} + {q}) * {at} / ({p} + 1.0D))')}"
        ratio = (f"aggregate(transform(sequence(1, {FRACTION_STEPS}), i -> cast(i as double)), "
                 f"named_struct('c', 1.0D, 'd', {first}, 'h', {first}), (s, m) -> "
                 f"element_at(transform(array(named_struct('c', {c1}, 'd', {d1}, 'h', s.h * ({c1}) * ({d1}))), "
                 f"s -> named_struct('c', {c2}, 'd', {d2}, 'h', s.h * ({c2}) * ({d2}))), 1), s -> s.h)")
        front = (f"exp({log_gamma(f'({p} + {q})')} - {log_gamma(p)} - {log_gamma(q)} + {p} * ln({at}) "
                 f"+ {q} * ln(1.0D - {at}))")
        return f"{front} * {ratio} / {p}"

    mass = (f"case when {x} < ({a} + 1.0D) / ({a} + {b} + 2.0D) then 1.0D - {below(a, b, x)} "
            f"else {below(b, a, y)} end")
    left, right = f"pow({b} * {x}, 1.0D / 3)", f"pow({a} * {y}, 1.0D / 3)"
    z = (f"3 * ({left} * (1.0D - 1.0D / (9 * {b})) - {right} * (1.0D - 1.0D / (9 * {a}))) "
         f"/ sqrt({left} * {left} / {b} + {right} * {right} / {a})")
    return F.expr(f"case when {a} + {b} <= {EXACT_PAGES} then {mass} >= {certainty!r}D "
                  f"else {z} <= {NormalDist().inv_cdf(1 - certainty)!r}D end")


def reputations(hosts: DataFrame, limit: float = LIMIT, certainty: float = CERTAINTY) -> DataFrame:
    """``host, n_pages, n, bad, share, blocked`` from counts ``host, n_pages, n`` (labelled), ``bad`` of each host.

    ``share`` is the posterior mean of the host's bad share.  A host without labelled pages has its domain's
    share; without any label the global share is 1/2 and nothing is blocked.
    """
    domain, suffix = groups_of(F.col("host"))
    hosts = written(hosts.select("*", domain.alias("domain"), suffix.alias("suffix")), "url-hosts")
    domains = written(hosts.groupBy("domain").agg(
        F.min("suffix").alias("suffix"), F.count(F.lit(1)).alias("n_hosts"), F.sum("n").alias("n"),
        F.sum("bad").alias("bad")), "url-domains")
    suffixes = written(domains.groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n_domains"), F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-suffixes")
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mu = ((whole.bad or 0) + 1) / ((whole.n or 0) + 2)

    def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
        m = strength(groups)
        return groups.withColumn("share", (m * F.col("mu") + F.col("bad")) / (m + F.col("n"))), m

    suffixes, _ = shrunk(suffixes.withColumn("mu", F.lit(mu)))
    domains, _ = shrunk(written(find_by(
        domains, suffixes.select("suffix", F.col("share").alias("mu"), "n_domains"), "suffix", "n_domains"),
        "url-domains"))
    hosts, m = shrunk(written(find_by(
        hosts, domains.select("domain", F.col("share").alias("mu"), "n_hosts"), "domain", "n_hosts"), "url-hosts"))
    hosts = hosts.withColumns({"a": m * F.col("mu") + F.col("bad"), "b": m * (1 - F.col("mu")) + F.col("n") - F.col("bad")})
    return hosts.select("host", "n_pages", "n", "bad", "share", above_limit("a", "b", limit, certainty).alias("blocked"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT,
          certainty: float = CERTAINTY) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_labelled, share`` of every row of ``pages`` (``page_id, url``).

    ``outcomes`` has ``page_id, bad`` (0 or 1), one row an id.  ``verdict`` is the longest fitting rule's, else
    ``block`` where the page's host is blocked, else ``allow``; ``n_labelled`` and ``share`` tell of the host.  Pages
    without a host (null, no ``://``) share one empty host whose outcomes count like another's.  Rows that repeat an id
    are pages of their own with the id's outcome; a null id has none.  Other columns are ignored; no rows give no rows.
    """
    ready(pages.sparkSession)
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = rows.select("page_id", "host").join(outcomes.select("page_id", F.col("bad").cast("long").alias("bad")),
                                               "page_id", "left")
    counts = seen.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"), F.count("bad").alias("n"),
                                      F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    known = written(reputations(counts, limit, certainty), "url-reputations")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = find_by(rows, known.select("host", "n_pages", F.col("n").alias("n_labelled"), "share", "blocked"),
                    "host", "n_pages")
    return found.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        "n_labelled", "share")
