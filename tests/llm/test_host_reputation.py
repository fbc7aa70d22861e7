"""The url filter: parts, rules and reputations against plain Python, the query against its SQL."""

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import host_reputation as hr
from kpiloom.llm import queries
from tests.conftest import SF_DIR
from tests.test_oracle import multiset

RULES = [hr.Rule(*r) for r in queries.URL_RULES]
PAGES = "page_id long, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    for c in "?#":
        path = path.split(c)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules=RULES):
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.pattern), len(r.host)), default=None)


URLS = [
    None, "", "no url", "http://", "http://EXAMPLE.com", "https://a.example.com/en/x?y=/fr/#z", "https://example.com/en",
    "http://WWW.example.com/en/1", "http://x.www.example.com/en/1", "http://xexample.com/en/", "ftp://a.net/es/?q", "http://a.net?x=/es/",
    "http://a.net#/es/", "http://net/fr/", "http://É.net/fr/\nx", "http://u:p@h.org:80/p", "a://b://c/d", "http://1.2.3.4/es/",
    "http://co.uk/", "http://a.co.uk/" + "long/" * 20000, "://x.com/", "http://com/",
]


def test_parts_rules_and_levels(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES)
    outcomes = spark.createDataFrame([], "host string, good boolean")
    got = {r.page_id: r for r in hr.judge(df.withColumn("Rule", F.lit("mine")), RULES, outcomes).collect()}
    for i, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule.pattern if rule else None), url
        if rule:
            assert got[i].verdict == rule.verdict
    assert len({r.verdict for r in got.values() if r.rule is None}) == 1
    hosts = ["a.b.example.com", "example.com", "com", "a.b.co.uk", "b.co.uk", "co.uk", "1.2.3.4", "", "u:p@x.y.org:8080", "[::1]:80"]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("*", *[c.alias(n) for n, c in hr.levels(F.col("host")).items()])
    assert [(r.domain, r.suffix) for r in rows.collect()] == [
        ("example.com", "com"), ("example.com", "com"), ("com", "com"), ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"),
        ("co.uk", "co.uk"), ("1.2.3.4", ""), ("", ""), ("y.org", "org"), ("[::1]:80", "")]
    assert hr.judge(df.limit(0), RULES, outcomes).count() == 0


def plain_reputations(outcomes, hosts, s=hr.Settings()):
    """(mean, bound) per host, level by level."""
    count = {h: [0, 0] for h in hosts}
    for host, good in outcomes:
        count.setdefault(host, [0, 0])
        count[host][0] += 1
        count[host][1] += good
    domain = {h: ".".join(h.split(".")[-2:]) for h in count}
    suffix = {h: h.split(".")[-1] for h in count}

    def total(key):
        out = {}
        for h, (n, k) in count.items():
            a = out.setdefault(key(h), [0, 0])
            a[0] += n
            a[1] += k
        return out

    def level(children, above):
        spread = sum((k - n * above[c]) ** 2 - n * above[c] * (1 - above[c]) for c, (n, k) in children.items())
        room = sum(n * (n - 1) * above[c] * (1 - above[c]) for c, (n, k) in children.items())
        share = min(max(spread / room if room else 0, 1 / (1 + s.most_weight)), 1 / (1 + s.least_weight))
        weight = (1 - share) / share
        return weight, {c: (k + weight * above[c]) / (n + weight) for c, (n, k) in children.items()}

    n, k = map(sum, zip(*count.values()))
    m0 = (k + s.prior_good * s.prior_pages) / (n + s.prior_pages)
    tops = total(suffix.get)
    _, top = level(tops, dict.fromkeys(tops, m0))
    middles = total(domain.get)
    _, middle = level(middles, {d: top[d.split(".")[-1]] for d in middles})
    weight, low = level(count, {h: middle[domain[h]] for h in count})
    return {
        h: (low[h], low[h] - s.deviations * (low[h] * (1 - low[h]) / (count[h][0] + weight + 1)) ** 0.5) for h in count}


@pytest.mark.parametrize("seed", range(3))
def test_reputations_against_plain_python(spark, seed):
    rng = random.Random(seed)
    hosts = [f"h{i}.d{i % 7}.{'com' if i % 7 < 4 else 'org'}" for i in range(60)]
    rate = {h: rng.betavariate(2, 2) if int(h.split(".")[1][1:]) % 2 else 0.95 for h in hosts}
    seen = [h for h in hosts[:50] for _ in range(rng.choice([0, 1, 3, 40]))] + [hosts[3]] * 400
    outcomes = [(h, rng.random() < rate[h]) for h in seen]
    df = spark.createDataFrame([(h,) for h in hosts + hosts[:5] + [None]], "host string").repartition(4)
    given = spark.createDataFrame(outcomes, "host string, good boolean").repartition(3)
    got = {r.host: r for r in hr.reputations(df, given).collect()}
    want = plain_reputations(outcomes, hosts)
    assert set(got) == set(hosts)
    for h in hosts:
        assert got[h]["mean"] == pytest.approx(want[h][0], abs=1e-9) and got[h]["bound"] == pytest.approx(want[h][1], abs=1e-9)


def test_bad_hosts_are_blocked_and_unknown_ones_follow_their_domain(spark):
    outcomes = [(f"h{i}.good.com", True) for i in range(20) for _ in range(10)]
    outcomes += [(f"h{i}.farm.org", False) for i in range(20) for _ in range(10)]
    outcomes += [(f"h{i}.mixed.org", i != 7) for i in range(12) for _ in range(30)]
    given = spark.createDataFrame(outcomes, "host string, good boolean")
    urls = ["http://h1.good.com/", "http://new.good.com/", "http://h1.farm.org/", "http://new.farm.org/", "http://h7.mixed.org/", "http://h8.mixed.org/"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: r.verdict for r in hr.judge(pages, [], given).collect()}
    assert [got[i] for i in range(6)] == ["allow", "allow", "block", "block", "block", "allow"]


def test_page_outcomes(spark):
    good, bad, both = ("the good line %d of some words in a row", "the bad line %d of some words in a row", "shared line of more than eight words in all")
    docs = spark.createDataFrame(
        [(1, good % 1 + "\n" + both), (2, bad % 1 + "\n" + both), (3, good % 2), (4, None), (None, good % 3), (5, bad % 2)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (3, 1, None), (5, 1, 1), (4, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    html = ["<p>the  good line 1 of some\twords in a row</p>", f"<p>{bad % 1}<br>{good % 2}", f"<b>{both}</b>", None, "",
            f"<script>{good % 1}</script><!-- {good % 1} --><p>{bad % 2}", f"<p>{bad % 2}<p>{bad % 1}<p>{good % 1}"]
    rows = [(i, f"http://h{i}.com/", h) for i, h in enumerate(html)] + [(9, "http://h0.com/", html[0]), (8, None, html[0])]
    pages = spark.createDataFrame(rows, PAGES)
    got = sorted((r.host, r.good) for r in hr.page_outcomes(pages, docs, labels).collect())
    assert got == [("", True), ("h0.com", True), ("h1.com", True), ("h5.com", False), ("h6.com", False)]
    assert hr.page_outcomes(pages, docs, labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_registered_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    ours, theirs = queries.registered()[name](spark, SF_DIR), con.execute(queries.statements()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    assert multiset(ours.columns, ours.collect()) == multiset(names, theirs.fetchall())
