"""op13 against a plain version: rules by definition, posteriors by numeric integration."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiscope.llm import url_reputation as u
from lexiscope.llm.queries import op13_url_verdicts

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def rule_for(host, path):
    best = None
    for verdict, where, begins in RULES:
        if (host == where or host.endswith("." + where)) and path.startswith(begins):
            if best is None or len(where + begins) > len(best[1]):
                best = verdict, where + begins
    return best or (None, None)


def mass_above(a, b, x, steps=400_001):
    """P(beta(a, b) > x) on an even grid of logits."""
    t = np.linspace(-60, 60, steps)
    p = 1 / (1 + np.exp(-t))
    d = a * np.log(p) + b * np.log1p(-p)
    d = np.exp(d - d.max())
    return d[p > x].sum() / d.sum()


def plain(pages, bad_of, limit=u.LIMIT, certainty=u.CERTAINTY):
    """Verdicts of (page_id, url) rows; domains are the last two labels, suffixes the last."""
    hosts = defaultdict(lambda: [0, 0])
    for i, url in pages:
        h = hosts[parts(url)[0]]
        if bad_of.get(i) is not None:
            h[0] += 1
            h[1] += bad_of[i]
    up = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    top = {d: d.split(".")[-1] for d in up.values()}
    domains, suffixes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for h, (n, b) in hosts.items():
        for where, key in ((domains, up[h]), (suffixes, top[up[h]])):
            where[key][0] += n
            where[key][1] += b
    whole = [sum(x[k] for x in hosts.values()) for k in (0, 1)]
    mu = (whole[1] + 1) / (whole[0] + 2)

    def shrink(groups, parent):
        seen = [(n, b, parent(g)) for g, (n, b) in groups.items() if n]
        s = sum(n * (b / n - m) ** 2 / (m * (1 - m)) for n, b, m in seen)
        total, k = sum(n for n, _, _ in seen), len(seen)
        power = 1000.0 if total <= k or s <= k else min(1000.0, max(1.0, (total - k) / (s - k) - 1))
        return {g: (power * parent(g) + b) / (power + n) for g, (n, b) in groups.items()}, power

    by_suffix, _ = shrink(suffixes, lambda g: mu)
    by_domain, _ = shrink(domains, lambda g: by_suffix[top[g]])
    share, power = shrink(hosts, lambda g: by_domain[up[g]])
    out = []
    for i, url in pages:
        host, path = parts(url)
        verdict, rule = rule_for(host, path)
        n, b = hosts[host]
        m = by_domain[up[host]]
        if verdict is None:
            gone = mass_above(power * m + b, power * (1 - m) + n - b, limit) >= certainty
            verdict = "block" if gone else "allow"
        out.append((i, host, path, rule, verdict, n, round(share[host], 9)))
    return sorted(out, key=str)


def judged(spark, pages, outcomes, **more):
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("verdict", F.lit("clash")).withColumn(
        "host", F.lit("clash")).withColumn("n", F.lit(3)).withColumn("bad", F.lit(9)).withColumn("mu", F.lit(0.5))
    found = u.judge(df, spark.createDataFrame(outcomes, "page_id long, bad int"), **more).collect()
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.n_labelled, round(r.share, 9)) for r in found), key=str)


def made_up():
    rng = np.random.default_rng(5)
    rates = {"a.bad.com": 0.97, "b.bad.com": 0.9, "c.fine.com": 0.05, "d.fine.com": 0.1, "x.spam.info": 0.95,
             "y.spam.info": 0.99, "z.spam.info": 0.9, "once.example.org": 0.5, "tionsh.example.net": 0.3}
    hosts = sorted(rates)
    pages, outcomes = [], []
    for i in range(1500):
        h = hosts[min(int(rng.geometric(0.3)) - 1, len(hosts) - 1)]  # one host has a third of the pages
        pages.append((i, f"https://{h.upper() if i % 9 == 0 else h}/{('en', 'de', 'fr')[i % 3]}/{i}?q=1#t"))
        if rng.random() < 0.4:
            outcomes.append((i, int(rng.random() < rates[h])))
    return pages, outcomes


def test_verdicts_equal_the_plain_version(spark):
    pages, outcomes = made_up()
    pages += [(5000 + i, f"http://new{i}.spam.info/fr/") for i in range(3)] + [(6000, "http://new.fine.com/de")]
    pages += [(None, "http://a.bad.com/en/"), (3, pages[3][1]), pages[4], pages[4], (7000, None), (7001, ""),
              (7002, "no scheme"), (7003, "://"), (7004, "x://H?p"), (7005, "http://a.net"), (7006, "http://net/"),
              (7007, "http://a.net/"), (7008, "http://example.net/en/"), (7009, "http://notexample.net/en/x"),
              (7010, "http://q.example.com/de/"), (7011, "http://org/fr/"), (7012, "http://borg/fr/"),
              (7013, "a\nb://two.lines.org/fr/\nx"), (7014, "http://u.org/" + "p" * 100_000), (7015, "http://é.ORG/Fr/")]
    got, want = judged(spark, pages, outcomes), plain(pages, dict(outcomes))
    assert got == want
    verdicts = {(h, v) for _, h, _, rule, v, _, _ in got if rule is None}
    assert ("a.bad.com", "block") in verdicts and ("c.fine.com", "allow") in verdicts and ("c.fine.com", "block") not in verdicts


def test_without_outcomes_or_pages(spark):
    pages = [(1, "http://a.b/"), (2, None)]
    assert judged(spark, pages, []) == plain(pages, {})
    assert judged(spark, [], [(1, 1)]) == []


def test_groups_of_hosts(spark):
    given = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.example.com", "user@x.example.com:8080", "localhost", "10.0.0.1:80",
             "[::1]:80", "", "end.example.org."]
    domain, suffix = u.groups_of(F.col("h"))
    got = spark.createDataFrame([(h,) for h in given], "h string").select(domain, suffix).collect()
    assert [tuple(r) for r in got] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.com", "com"), ("example.com", "com"),
        ("localhost", "localhost"), ("10.0.0.1", "ip"), ("[::1]", "ip"), ("", ""), ("example.org", "org")]


def test_outcomes_of_labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, None), (5, None, 0), (6, 1, None), (7, 1, 0), (7, 0, 0), (None, 0, 0)]
    got = u.outcomes_of(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()
    assert {tuple(r) for r in got} == {(1, 0), (2, 1), (3, 1), (5, 0), (6, 0), (7, 1)}


def test_rule_ties_and_bounds(spark):
    df = spark.createDataFrame([("x.b.a", "/q")], "h string, p string")
    both = u.rule_of(F.col("h"), F.col("p"), [("allow", "a", "/q"), ("block", "b.a", "/"), ("allow", "x.b.a", "")])
    assert tuple(df.select(*both).first()) == ("x.b.a", "allow")
    with pytest.raises(ValueError):
        u.rule_of(F.col("h"), F.col("p"), [("allow", str(i), "/") for i in range(1001)])


@pytest.mark.parametrize("limit", [0.5, 0.2])
def test_posterior_mass(spark, limit):
    shapes = [(0.02, 0.3), (1.0, 1.0), (0.5, 4.0), (3.0, 0.7), (40.0, 40.0), (55.0, 40.0), (900.0, 950.0), (2000.0, 7800.0),
              (30_000.0, 29_500.0), (30_000.0, 121_000.0)]
    df = spark.createDataFrame(shapes, "a double, b double")
    for certainty in (0.05, 0.3, 0.7, 0.95):
        got = [r[0] for r in df.select(u.above_limit("a", "b", limit, certainty)).collect()]
        for (a, b), above in zip(shapes, got):
            want = mass_above(a, b, limit)
            assert math.isclose(want, certainty, abs_tol=2e-3) or above == (want >= certainty), (a, b, want)


def test_query_reads_every_page(spark, sf):
    got = op13_url_verdicts(spark, sf).toPandas()
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    bad = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in labels}
    want = plain([tuple(r) for r in pages], bad)
    assert sorted(zip(got.page_id, got.host, got.path, got.verdict)) == sorted((w[0], w[1], w[2], w[4]) for w in want)
